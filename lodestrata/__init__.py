"""Medallion ingestion, cleansing, star schemas and measures as Spark DataFrame operators."""
