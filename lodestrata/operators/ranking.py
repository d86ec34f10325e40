"""Top lists, shares of a total, and total rows. All of them work on aggregated rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.functions import safe_ratio


def top_n_per_group(
    counts: DataFrame,
    group: str,
    label: str,
    measure: str,
    n: int,
    rank: str = "rank",
    total: str = "group_total",
    percent: str = "group_percent",
    digits: int = 2,
) -> DataFrame:
    """The n largest labels per group (ties by label) with the group's total and the label's share.

    The total is a second small aggregate rather than a window, which leaves the rank filter alone in
    its window: Spark then cuts every group to n rows before the shuffle.
    """
    order = Window.partitionBy(group).orderBy(F.col(measure).desc(), F.col(label).asc_nulls_last())
    leaders = counts.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= n)
    totals = counts.groupBy(group).agg(F.sum(measure).alias(total))
    return leaders.join(totals, group).withColumn(percent, safe_ratio(F.col(measure), F.col(total), 100, digits))


def top_n_with_ties(df: DataFrame, measure: str, n: int, rank: str = "rank") -> DataFrame:
    """Rows ranked n or better by a measure; rows level with the last one stay in. NULL ranks last.

    The n largest values are found first (each task forwards n) and reach the rows as one array: a value's place in it is its
    rank, and what is not in it is out. However many rows are level, they stay where they are.
    """
    most = df.select(measure).orderBy(F.col(measure).desc_nulls_last()).limit(n)
    known = most.agg(F.sort_array(F.collect_list(measure), asc=False).alias("values")).scalar()
    value = F.col(measure)
    place = F.when(value.isNotNull(), F.nullif(F.array_position(known, value), F.lit(0)))
    last = F.when(value.isNull() & (F.size(known) < n), F.size(known) + 1)
    return df.withColumn(rank, F.coalesce(place, last).cast("int")).where(F.col(rank).isNotNull())


def with_total(
    df: DataFrame,
    group: str,
    sums: Sequence[str],
    ratios: dict[str, Column],
    label: str = "Total",
) -> DataFrame:
    """Sums per group and one grand-total row, with ratios computed from the sums of each row."""
    per_group = df.groupBy(group).agg(*(F.sum(name).alias(name) for name in sums))
    levels = per_group.rollup(group).agg(
        *(F.sum(name).alias(name) for name in sums), F.grouping(group).alias("_total")
    )
    named = levels.withColumn(group, F.when(F.col("_total") == 1, F.lit(label)).otherwise(F.col(group)))
    return named.withColumns(ratios).drop("_total")
