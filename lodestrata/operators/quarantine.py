"""Rejected rows stay visible, with the reason they were set aside."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rejected(df: DataFrame, flag: Column, reason: str) -> DataFrame:
    return df.where(flag).withColumns(
        {"_quarantine_reason": F.lit(reason), "_quarantined_at_utc": F.current_timestamp()}
    )


def split_on_flag(df: DataFrame, flag: Column, reason: str) -> tuple[DataFrame, DataFrame]:
    """(rows where the flag is false, rejected rows). A NULL flag belongs to neither."""
    return df.where(~flag), rejected(df, flag, reason)


def rejection_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per rejection category; an empty category counts zero."""
    summary: DataFrame | None = None
    for category, df in tables.items():
        line = df.agg(F.count("*").alias("row_count")).select(F.lit(category).alias("category"), "row_count")
        summary = line if summary is None else summary.unionAll(line)
    return summary


def summary_query(tables: Mapping[str, str]) -> str:
    """The same summary as SQL over tables of the catalog, for a lasting view: category -> qualified name."""
    lines = [f"SELECT '{category}' AS category, count(*) AS row_count FROM {name}" for category, name in tables.items()]
    return " UNION ALL ".join(lines)
