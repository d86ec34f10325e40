"""Queries that search, join, archive and judge whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm import decontaminate, neighbours, ngram_join, quality, warc, whitening
from lodestrata.llm.registry import query, table
from lodestrata.session import scratch_folder


@query()
def op2_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item within its error budget: doc_id, item_id, distance."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their class, the class of equal words, and the number of documents at 0.8 or more."""
    return ngram_join.similarity_classes(table(spark, sf_dir, "documents"))


@query()
def op4_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors by cosine of every fiftieth vector."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), every=50, k=5)


@query()
def op6_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through archives with embedded dictionaries and back."""
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return warc.round_trip(table(spark, sf_dir, "pages"), columns)


@query()
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with a calibrated quality score; labels of the held-out fold are not looked at."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scores = quality.quality_scores(docs, labels, scratch_folder(spark))
    held_out = F.coalesce(quality.fold(F.col("doc_id")) == 2, F.lit(False))
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query()
def op11_weighted_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors on the first eight components of their covariance. A deviation beyond 64 bits is null."""
    rows = whitening.whiten(table(spark, sf_dir, "embeddings"), scratch_folder(spark), components=8, weights="counts")
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))
