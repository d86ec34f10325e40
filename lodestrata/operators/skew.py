"""Joins and rankings that stay spread out when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.session import scratch_folder


def key_of(columns: Sequence[str | Column]) -> Column:
    """Columns as one struct: NULL members compare equal, as they do in a grouping."""
    return F.struct(*columns)


def join_unique(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join many `left` rows to at most one `right` row per key; NULL keys match each other.

    A plain shuffle join: where a key holds a large share of the rows, adaptive execution splits its partition and
    copies the one right row to every part.
    """
    extra = [name for name in right.columns if name not in on]
    keyed = right.select(key_of(on).alias("_key"), *extra)
    return left.withColumn("_key", key_of(on)).join(keyed, "_key", how).drop("_key")


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Join on columns in which NULL matches NULL, as groups do; `on` comes first, taken from the side that has it."""
    if not on:
        raise ValueError("nothing to join on")
    left, right = (
        side.select(key_of(on).alias("_key"), *(name for name in side.columns if name not in on)) for side in (left, right)
    )
    joined = left.join(right, "_key", how)
    rest = [name for name in joined.columns if name != "_key"]
    return joined.select(*(F.col(f"_key.{name}").alias(name) for name in on), *rest)


def ranked(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    rank: str = "rank",
    count: str = "count",
) -> DataFrame:
    """row_number and group size over `keys`, for groups of any size.

    Rows are stored once, dealt by range on keys and order; a group that fills many partitions stands in them slice by
    slice. A rank is the row's place in its slice plus the rows of the slices before, of which a group has no more
    than there are partitions. `order` must tell the rows of a group apart.
    """
    spark = df.sparkSession
    folder = scratch_folder(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()
    by_key = [F.col(name).asc_nulls_last() for name in keys]
    (
        df.repartitionByRange(parts, *by_key, *order)
        .sortWithinPartitions(*by_key, *order)
        .withColumn("_at", place.bitwiseAND(F.lit((1 << 33) - 1)))
        .withColumn("_slice", F.shiftright(place, 33))
        .write.parquet(folder)
    )
    rows = spark.read.parquet(folder).withColumn("_group", key_of(keys))
    spans = rows.groupBy("_group", "_slice").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    group = Window.partitionBy("_group")
    before = F.sum("_rows").over(group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.select(
        "_group", "_slice", "_first", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_rows").over(group).alias(count)
    )
    return (
        rows.join(spans, ["_group", "_slice"])
        .withColumn(rank, F.col("_before") + F.col("_at") - F.col("_first") + 1)
        .drop("_group", "_slice", "_at", "_first", "_before")
    )
