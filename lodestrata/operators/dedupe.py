"""Choosing one record per key, and setting the others aside."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.operators.skew import join_unique, key_of, ranked


def latest_version(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in `order`.

    The rank filter is pushed into the map side of the shuffle (WindowGroupLimit), so each task
    forwards one row per key however many versions a key has.
    """
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def support(df: DataFrame, identity: dict[str, Column], name: str) -> DataFrame:
    """Adds how many rows share the row's identity. NULL members of an identity match each other."""
    members = [f"_id_{k}" for k in identity]
    marked = df.withColumns(dict(zip(members, identity.values())))
    counts = marked.groupBy(*members).agg(F.count("*").alias(name))
    return join_unique(marked, counts, members).drop(*members)


def best_supported(
    df: DataFrame,
    entity: Sequence[str],
    identity: dict[str, Column],
    tie: Sequence[str],
    names: tuple[str, str, str] = ("supporting_snapshot_count", "candidate_rank", "candidate_count"),
) -> DataFrame:
    """Candidates with support, rank within the entity (support first, then `tie`) and candidate count.

    `tie` names columns that tell the rows of an entity apart, such as a row number and its file.
    """
    supporting, rank, count = names
    return ranked(support(df, identity, supporting), entity, _support_order(supporting, tie), rank=rank, count=count)


def best_supported_one(
    df: DataFrame, entity: Sequence[str], identity: dict[str, Column], tie: Sequence[str], names: tuple[str, str]
) -> DataFrame:
    """The first candidate of each entity by `best_supported`'s order, with its support and the candidate count.

    The others are cut before the shuffle and never ranked.
    """
    supporting, count = names
    first = latest_version(support(df, identity, supporting), entity, _support_order(supporting, tie))
    return join_unique(first, df.groupBy(*entity).agg(F.count("*").alias(count)), entity)


def _support_order(supporting: str, tie: Sequence[str]) -> list[Column]:
    return [F.col(supporting).desc(), *(F.col(name).asc_nulls_last() for name in tie)]


def with_version_count(df: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    """Adds the number of rows that share the key.

    Counts are grouped by what they are joined on, so that they are dealt once; the sort compares hashes before keys.
    """
    keyed = df.withColumns({"_hash": F.hash(*key), "_key": key_of(key)})
    counts = keyed.groupBy("_hash", "_key").agg(F.count("*").alias(name))
    return keyed.join(counts, ["_hash", "_key"], "left").drop("_hash", "_key")


def unique_rows(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key occurs once; every row of a repeated key is left out, exact copies too.

    Two rows are enough to see that a key repeats, so each task forwards no more than two per key.
    """
    group = Window.partitionBy(*key)
    few = df.withColumn("_place", F.row_number().over(group.orderBy(*key))).where(F.col("_place") <= 2)
    return few.withColumn("_n", F.count("*").over(group)).where(F.col("_n") == 1).drop("_place", "_n")


def conflicting_rows(df: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    """Every row of a repeated key, with the number of rows that share it."""
    repeated = df.groupBy(*key).agg(F.count("*").alias(name)).where(F.col(name) > 1)
    return join_unique(df, repeated, key, how="inner")


def drop_conflicts(df: DataFrame, key: Sequence[str], name: str = "version_count") -> tuple[DataFrame, DataFrame]:
    """(rows with a key of their own, rows that contend for one)."""
    return unique_rows(df, key), conflicting_rows(df, key, name)


def surplus_rows(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: total rows and the rows beyond one per key."""
    per_key = df.groupBy(*key).agg(F.count("*").alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("issues"),
    )
