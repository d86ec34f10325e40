"""Calendars, stays, as-of values and trailing windows at day grain."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestrata.operators.skew import join_null_safe, join_unique, key_of


def days_between(first: Column, last: Column) -> Column:
    """Inclusive array of dates, NULL when the interval is empty (sequence itself would fail)."""
    return F.when(first <= last, F.sequence(first, last))


def date_attributes(df: DataFrame, date: str = "date") -> DataFrame:
    day = F.col(date)
    return df.withColumns(
        {
            "year": F.year(day).cast("long"),
            "quarter": F.quarter(day).cast("long"),
            "month_number": F.month(day).cast("long"),
            "month_name": F.date_format(day, "MMMM"),
            "month_start": F.trunc(day, "MM"),
            "month_end": F.last_day(day),
        }
    )


def calendar(spark: SparkSession, first: datetime.date | str, last: datetime.date | str) -> DataFrame:
    """One row per day of the inclusive range, with month fields."""
    bounds = spark.range(1).select(F.lit(first).cast("date").alias("first"), F.lit(last).cast("date").alias("last"))
    return calendar_of(bounds)


def calendar_of(bounds: DataFrame) -> DataFrame:
    """Calendar over a one-row (first, last) relation, such as the min and max of a fact's date."""
    days = bounds.select(F.explode(days_between(F.col("first"), F.col("last"))).alias("date"))
    return date_attributes(days)


def collapse_stays(
    df: DataFrame,
    key: str,
    start: str,
    end: str,
    latest: dict[str, str] | None = None,
    at: str | None = None,
    tie: Sequence[str] = (),
) -> DataFrame:
    """One stay per key: earliest start, latest known end, and `latest` columns as of the greatest `at`.

    Gaps between stays are not kept, and an open end is only open when every end of the key is. A
    NULL value never wins over an earlier known one.
    """
    aggregates = [F.min(start).alias(start), F.max(end).alias(end)]
    for out, column in (latest or {}).items():
        moment = F.when(F.col(column).isNotNull() & F.col(at).isNotNull(), F.struct(at, *tie, column))
        aggregates.append(F.max(moment)[column].alias(out))
    return df.groupBy(key).agg(*aggregates)


def explode_interval(
    df: DataFrame, start: str, end: str, low: Column, high: Column, out: str = "date"
) -> DataFrame:
    """One row per day of [start, end] inside [low, high]; an open end runs to `high`."""
    first = F.greatest(F.col(start), low)
    last = F.least(F.coalesce(F.col(end), high), high)
    return df.withColumn(out, F.explode(days_between(first, last))).drop(start, end)


def daily_changes(
    changes: DataFrame,
    key: str,
    change_date: str,
    value: str,
    tie: Sequence[str] = (),
    floor: Column | None = None,
) -> DataFrame:
    """Last known value per key and day. Changes before `floor` are carried to it.

    Aggregated before the shuffle, and what is left per key is bounded by the days of the calendar.
    """
    known = changes.where(F.col(key).isNotNull() & F.col(change_date).isNotNull() & F.col(value).isNotNull())
    day = F.col(change_date) if floor is None else F.greatest(F.col(change_date), floor)
    newest = F.max(F.struct(change_date, *tie, value))
    return known.groupBy(key, day.alias("_day")).agg(newest[value].alias("_value"))


def as_of_join(
    left: DataFrame,
    changes: DataFrame,
    key: str,
    left_date: str,
    change_date: str,
    value: str,
    out: str,
    tie: Sequence[str] = (),
    fallback: Column | None = None,
    floor: Column | None = None,
    unique: bool = True,
) -> DataFrame:
    """Adds the value of the latest change on or before the row's day, else `fallback`.

    Days and changes are merged on one timeline per key and the last known value is carried forward,
    so the work is linear: no pair of a day and a change is ever formed. With `unique` the rows of
    `left` are one per key and day, which bounds a timeline by the calendar; otherwise the value is
    found for the distinct days first and joined back.
    """
    if not unique:
        days = left.select(key, left_date).distinct()
        found = as_of_join(days, changes, key, left_date, change_date, value, "_as_of", tie, floor=floor)
        filled = join_unique(left, found, [key, left_date])
        result = F.col("_as_of") if fallback is None else F.coalesce("_as_of", fallback)
        return filled.withColumn(out, result).drop("_as_of")

    probes = left.withColumns({"_day": F.col(left_date), "_probe": F.lit(1)})
    news = daily_changes(changes, key, change_date, value, tie, floor).withColumn("_probe", F.lit(0))
    line = Window.partitionBy(key).orderBy("_day", "_probe").rowsBetween(Window.unboundedPreceding, 0)
    merged = probes.unionByName(news, allowMissingColumns=True).withColumn(
        "_found", F.last("_value", ignorenulls=True).over(line)
    )
    result = F.col("_found") if fallback is None else F.coalesce("_found", fallback)
    return merged.where(F.col("_probe") == 1).withColumn(out, result).drop("_day", "_probe", "_value", "_found")


def level_segments(
    stays: DataFrame,
    key: str,
    start: str,
    end: str,
    changes: DataFrame,
    snapshots: DataFrame,
    low: Column,
    high: Column,
    unit: str = "MM",
    out: str = "level",
) -> DataFrame:
    """Cuts each stay into segments of constant level: the latest change so far, else the period's snapshot.

    `changes` is (key, day, value) and `snapshots` (key, period start, value), both one row per key and
    day. Only change days and period starts pass through the shuffle. The days of a segment can be
    exploded afterwards without moving a row, which is what makes a day fact affordable.

    Returns the stay's other columns with `_from`, `_to` and `out`.
    """
    c_key, c_day, c_value = changes.columns
    s_key, s_day, s_value = snapshots.columns
    clipped = stays.withColumns(
        {
            "_first": F.greatest(F.col(start), low),
            "_last": F.least(F.coalesce(F.col(end), high), high),
        }
    ).where(F.col("_first") <= F.col("_last"))

    # A period's first day starts a segment whether or not there is news on it: a snapshot ends with its period.
    step = F.expr({"MM": "interval 1 month", "week": "interval 7 days"}[unit])
    empty = F.lit(None).cast(changes.schema[c_value].dataType)
    period_starts = F.sequence(F.trunc("_first", unit), F.trunc("_last", unit), step)

    def points_of(owner: str, day: Column, change: Column = empty, shot: Column = empty) -> list[Column]:
        named = key_of([F.col(owner).alias(key)])
        return [named.alias("_owner"), day.alias("_day"), change.alias("_change"), shot.alias("_shot")]

    starts = clipped.select(*points_of(key, F.explode(period_starts)))
    news = changes.where(F.col(c_key).isNotNull()).select(*points_of(c_key, F.col(c_day), change=F.col(c_value)))
    shots = snapshots.where(F.col(s_key).isNotNull()).select(*points_of(s_key, F.col(s_day), shot=F.col(s_value)))

    # Points of one day share a range frame, so all of them see its news; only the last of them is
    # followed by a later day and yields a segment that is not empty.
    line = Window.partitionBy("_owner").orderBy(F.unix_date("_day"))
    so_far = line.rangeBetween(Window.unboundedPreceding, 0)
    dated_shot = F.struct(F.trunc("_day", unit).alias("period"), F.col("_shot").alias("value"))
    shot = F.when(F.col("_shot").isNotNull(), dated_shot)
    segments = starts.unionByName(news).unionByName(shots).select(
        "_owner",
        "_day",
        F.lead("_day").over(line).alias("_next"),
        F.last("_change", ignorenulls=True).over(so_far).alias("_change"),
        F.last(shot, ignorenulls=True).over(so_far).alias("_shot"),
    )
    in_period = F.when(F.col("_shot.period") == F.trunc("_day", unit), F.col("_shot.value"))
    return (
        clipped.withColumn("_owner", key_of([key]))
        .join(segments, "_owner")
        .withColumns(
            {
                "_from": F.greatest("_day", "_first"),
                "_to": F.least(F.date_sub(F.coalesce("_next", F.date_add("_last", 1)), 1), F.col("_last")),
                out: F.coalesce("_change", in_period),
            }
        )
        .where(F.col("_from") <= F.col("_to"))
        .drop(start, end, "_owner", "_day", "_next", "_change", "_shot", "_first", "_last")
    )


def count_days(df: DataFrame, start: str, end: str, low: Column, high: Column) -> int:
    """Days of all intervals [start, end] inside [low, high]; an open end runs to `high`. One job over `df`."""
    first = F.greatest(F.col(start), low)
    last = F.least(F.coalesce(F.col(end), high), high)
    return df.select(F.when(first <= last, F.date_diff(last, first) + 1).alias("n")).agg(F.sum("n")).first()[0] or 0


def deal_segments(
    segments: DataFrame, key: str, low: Column, high: Column, days: int, step: int = 7, per_task: int = 2_000_000
) -> DataFrame:
    """Segments inside [low, high], cut every `step` days from `low` on and dealt so that a task explodes about `per_task` days.

    Adaptive execution sees the bytes of the segments, which say little of their days, so the number of tasks comes from
    `days`. Pieces of one stretch of the calendar go to tasks of their own, by the hash of `key` where one task is too small
    for them: what a task writes by day falls into `step` folders.
    """
    stretch = lambda day: F.floor(F.date_diff(day, low) / step).cast("int")
    spans = max(1, segments.sparkSession.range(1).select(stretch(high) + 1).first()[0])
    lanes = max(1, -(-days // (spans * per_task)))
    pieces = segments.withColumn("_stretch", F.explode(F.sequence(stretch(F.col("_from")), stretch(F.col("_to")))))
    opens = F.date_add(low, F.col("_stretch") * step)
    cut = pieces.withColumns(
        {
            "_from": F.greatest("_from", opens),
            "_to": F.least(F.col("_to"), F.date_add(opens, step - 1)),
            "_lane": F.col("_stretch") * lanes + F.pmod(F.hash(key), F.lit(lanes)),
        }
    )
    return cut.repartitionById(spans * lanes, "_lane").drop("_stretch", "_lane")


def explode_segments(segments: DataFrame, out: str = "date") -> DataFrame:
    """One row per day of each segment."""
    return segments.withColumn(out, F.explode(days_between(F.col("_from"), F.col("_to")))).drop("_from", "_to")


def date_spine(days: DataFrame, date: str, groups: DataFrame | None = None) -> DataFrame:
    """Every calendar day, for every group when groups are given.

    The calendar reaches the groups as one array value (a scalar subquery, bounded by its days).
    """
    if groups is None:
        return days.select(date).distinct()
    every_day = days.agg(F.sort_array(F.collect_set(date))).scalar()
    return groups.withColumn(date, F.explode(every_day))


def _trailing(date: str, group: Sequence[str], days: int) -> Window:
    line = Window.partitionBy(*group) if group else Window.partitionBy()
    return line.orderBy(F.unix_date(date)).rangeBetween(-(days - 1), 0)


def trailing(
    daily: DataFrame,
    days: DataFrame,
    date: str,
    length: int,
    sums: Sequence[str],
    group: Sequence[str] = (),
    groups: DataFrame | None = None,
) -> DataFrame:
    """Sums of `daily` over the last `length` days ending at each calendar day, and the days that exist in it.

    `daily` holds one row per group and day, so a window never sees more than the calendar.
    """
    if group and groups is None:
        groups = daily.select(*group).distinct()
    line = _trailing(date, group, length)
    filled = join_null_safe(date_spine(days, date, groups if group else None), daily, [*group, date], "left")
    return filled.select(
        *group,
        date,
        *(F.coalesce(F.sum(name).over(line), F.lit(0)).alias(name) for name in sums),
        F.count("*").over(line).alias("dates_in_window"),
    )


def trailing_distinct(
    df: DataFrame,
    days: DataFrame,
    key: str,
    date: str,
    length: int,
    out: str,
    group: Sequence[str] = (),
    groups: DataFrame | None = None,
) -> DataFrame:
    """Distinct keys seen in the last `length` days ending at each calendar day.

    A key counts from a day it is seen until `length` days later or until it is seen again, whichever
    comes first. Adding up these arrivals and departures gives the exact distinct count with two rows
    per key and day instead of one per window the day falls in.
    """
    if group and groups is None:
        groups = df.select(*group).distinct()
    known = df.select(*group, key, date).where(F.col(key).isNotNull())
    seen = known.distinct().join(days.select(date).distinct(), date, "left_semi")
    following = F.lead(date).over(Window.partitionBy(*group, key).orderBy(date))
    gone = F.least(following, F.date_add(date, length))
    steps = seen.withColumn("_gone", gone).select(
        *group,
        F.explode(
            F.array(
                F.struct(F.col(date).alias("day"), F.lit(1).alias("by")),
                F.struct(F.col("_gone").alias("day"), F.lit(-1).alias("by")),
            )
        ).alias("_step"),
    )
    changes = steps.select(*group, F.col("_step.day").alias(date), F.col("_step.by").alias("_by"), F.lit(0).alias("_in"))
    spine = date_spine(days, date, groups if group else None).withColumns({"_by": F.lit(0), "_in": F.lit(1)})
    merged = changes.unionByName(spine).groupBy(*group, date).agg(F.sum("_by").alias("_by"), F.max("_in").alias("_in"))
    line = (Window.partitionBy(*group) if group else Window.partitionBy()).orderBy(date)
    running = F.sum("_by").over(line.rowsBetween(Window.unboundedPreceding, 0))
    return merged.withColumn(out, running).where(F.col("_in") == 1).select(*group, date, out)
