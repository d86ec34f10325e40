"""Calendars, stays, as-of values and point-in-interval checks over the sample tables."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.catalog.base import Sample, day, iso, query
from lodestrata.catalog.model import SEGMENT_ORDER, daily_errors, user_days
from lodestrata.functions import join_text, outside_interval
from lodestrata.operators.skew import join_unique
from lodestrata.operators.temporal import (
    as_of_join,
    calendar_of,
    collapse_stays,
    daily_changes,
    explode_interval,
    explode_segments,
    level_segments,
)
from lodestrata.sources.tables import mapping

WINDOW = (datetime.date(2024, 1, 5), datetime.date(2024, 1, 25))


@query("""
    WITH bounds AS (SELECT min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS b FROM events),
    days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM bounds),
    counts AS (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1)
    SELECT CAST(days.d AS VARCHAR) AS date, CAST(extract(year FROM days.d) AS BIGINT) AS year,
           CAST(extract(quarter FROM days.d) AS BIGINT) AS quarter, CAST(extract(month FROM days.d) AS BIGINT) AS month_number,
           monthname(days.d) AS month_name,
           CAST(CAST(date_trunc('month', days.d) AS DATE) AS VARCHAR) AS month_start,
           CAST(last_day(days.d) AS VARCHAR) AS month_end, coalesce(n, 0) AS event_count
    FROM days LEFT JOIN counts ON counts.d = days.d
""")
def calendar_dim(spark: SparkSession, root: str) -> DataFrame:
    s = Sample(spark, root)
    counts = s.events.groupBy(day("ts").alias("date")).agg(F.count("*").alias("event_count"))
    bounds = s.events.agg(F.min(day("ts")).alias("first"), F.max(day("ts")).alias("last"))
    days = calendar_of(bounds).join(counts, "date", "left").fillna({"event_count": 0})
    return days.withColumns({name: iso(name) for name in ("date", "month_start", "month_end")})


@query("""
    SELECT c_mktsegment AS segment, 'Segment ' || c_mktsegment AS segment_name,
           CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 1 WHEN 'AUTOMOBILE' THEN 2 WHEN 'BUILDING' THEN 3
                             WHEN 'MACHINERY' THEN 4 WHEN 'FURNITURE' THEN 5 END AS display_order,
           true AS is_assumed, count(*) AS customer_count
    FROM customer
    GROUP BY c_mktsegment
""")
def static_dim(spark: SparkSession, root: str) -> DataFrame:
    order = mapping(spark, SEGMENT_ORDER, "segment string, display_order int")
    counts = Sample(spark, root).customer.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.count("*").alias("customer_count")
    )
    return counts.join(order, "segment").select(
        "segment",
        join_text(F.lit("Segment "), F.col("segment")).alias("segment_name"),
        "display_order",
        F.lit(True).alias("is_assumed"),
        "customer_count",
    )


def _stays(s: Sample) -> DataFrame:
    """Stay per user: first signup day to last purchase day, open where nothing was bought."""
    kind = F.col("event_type")
    moves = s.events.where(kind.isin("signup", "purchase")).select(
        "user_id",
        "event_id",
        "event_type",
        F.when(kind == "signup", day("ts")).alias("start_day"),
        F.when(kind == "purchase", day("ts")).alias("end_day"),
        "ts",
    )
    return collapse_stays(
        moves, "user_id", "start_day", "end_day", latest={"last_move": "event_type"}, at="ts", tie=["event_id"]
    )


_STAYS = """
    stays AS (
        SELECT user_id, min(CAST(ts AS DATE)) FILTER (WHERE event_type = 'signup') AS start_day,
               max(CAST(ts AS DATE)) FILTER (WHERE event_type = 'purchase') AS end_day,
               last(event_type ORDER BY ts, event_id) AS last_move
        FROM events
        WHERE event_type IN ('signup', 'purchase')
        GROUP BY user_id
    )
"""


@query("WITH" + _STAYS + """
    SELECT user_id, CAST(start_day AS VARCHAR) AS start_day, CAST(end_day AS VARCHAR) AS end_day, last_move FROM stays
""")
def stay_summary(spark: SparkSession, root: str) -> DataFrame:
    stays = _stays(Sample(spark, root))
    return stays.withColumns({name: iso(name) for name in ("start_day", "end_day")})


@query("WITH" + _STAYS + """
    , days AS (SELECT CAST(unnest(generate_series(DATE '2024-01-05', DATE '2024-01-25', INTERVAL 1 DAY)) AS DATE) AS d)
    SELECT user_id, last_move, CAST(d AS VARCHAR) AS date
    FROM stays JOIN days ON (start_day IS NULL OR d >= start_day) AND (end_day IS NULL OR d <= end_day)
""")
def interval_explode(spark: SparkSession, root: str) -> DataFrame:
    days = explode_interval(_stays(Sample(spark, root)), "start_day", "end_day", *map(F.lit, WINDOW))
    return days.withColumn("date", iso("date"))


@query("""
    WITH probes AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events)
    SELECT user_id, CAST(d AS VARCHAR) AS date,
           (SELECT last(e.event_type ORDER BY e.ts, e.event_id) FROM events e
            WHERE e.user_id = probes.user_id AND CAST(e.ts AS DATE) <= d) AS latest_type
    FROM probes
""")
def as_of_lookup(spark: SparkSession, root: str) -> DataFrame:
    s = Sample(spark, root)
    changes = s.events.select("user_id", "event_id", "event_type", "ts", day("ts").alias("changed"))
    found = as_of_join(
        user_days(s.events), changes, "user_id", "date", "changed", "event_type", "latest_type", tie=["ts", "event_id"]
    )
    return found.withColumn("date", iso("date"))


_LEVELS = """
    levels AS (
        SELECT p.user_id, p.d,
               coalesce((SELECT last(e.event_type ORDER BY e.ts, e.event_id) FROM events e
                         WHERE e.user_id = p.user_id AND CAST(e.ts AS DATE) <= p.d
                           AND e.event_type IN ('error', 'purchase')), c.c_mktsegment) AS level
        FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events) p
        LEFT JOIN customer c ON c.c_custkey = p.user_id
    )
"""


def _levels(s: Sample) -> DataFrame:
    """User days with the latest error or purchase so far, else the customer's segment."""
    changes = s.events.where(F.col("event_type").isin("error", "purchase")).select(
        "user_id", "event_id", "event_type", "ts", day("ts").alias("changed")
    )
    users = s.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    return as_of_join(
        user_days(s.events).join(users, "user_id", "left"),
        changes,
        "user_id",
        "date",
        "changed",
        "event_type",
        "level",
        tie=["ts", "event_id"],
        fallback=F.col("segment"),
    ).drop("segment")


@query("WITH" + _LEVELS + "SELECT user_id, CAST(d AS VARCHAR) AS date, level FROM levels")
def as_of_with_fallback(spark: SparkSession, root: str) -> DataFrame:
    return _levels(Sample(spark, root)).withColumn("date", iso("date"))


@query("""
    SELECT e.event_id, e.user_id,
           (SELECT last(x.event_type ORDER BY x.ts, x.event_id) FROM events x
            WHERE x.user_id = e.user_id AND x.event_type IN ('signup', 'purchase')
              AND CAST(x.ts AS DATE) <= CAST(e.ts AS DATE)) AS latest_move
    FROM events e
    WHERE e.event_type = 'error'
""")
def as_of_for_events(spark: SparkSession, root: str) -> DataFrame:
    s = Sample(spark, root)
    kind = F.col("event_type")
    changes = s.events.where(kind.isin("signup", "purchase")).select(
        "user_id", F.col("event_id").alias("move_id"), F.col("event_type").alias("move"), "ts", day("ts").alias("changed")
    )
    errors = s.events.where(kind == "error").select("event_id", "user_id", day("ts").alias("date"))
    return as_of_join(
        errors, changes, "user_id", "date", "changed", "move", "latest_move", tie=["ts", "move_id"], unique=False
    ).drop("date")


@query("WITH" + _STAYS + """
    , flagged AS (
        SELECT CASE WHEN s.user_id IS NULL THEN 'no stay' WHEN s.start_day IS NULL THEN 'no start'
                    WHEN CAST(e.ts AS DATE) < s.start_day THEN 'before'
                    WHEN CAST(e.ts AS DATE) > s.end_day THEN 'after' ELSE 'inside' END AS place
        FROM events e LEFT JOIN stays s ON s.user_id = e.user_id
        WHERE e.event_type = 'error'
    )
    SELECT place <> 'inside' AS outside_flag, count(*) AS error_count FROM flagged GROUP BY 1
""")
def point_in_interval(spark: SparkSession, root: str) -> DataFrame:
    s = Sample(spark, root)
    flag = outside_interval(F.col("date"), F.col("start_day"), F.col("end_day"))
    # Errors are counted per user and day before they meet the stays.
    return (
        daily_errors(s.events)
        .join(_stays(s), "user_id", "left")
        .groupBy(flag.alias("outside_flag"))
        .agg(F.sum("error_count").alias("error_count"))
    )


@query("WITH" + _LEVELS + """
    SELECT e.event_id, e.user_id, CAST(CAST(e.ts AS DATE) AS VARCHAR) AS date, l.level, e.value
    FROM events e JOIN levels l ON l.user_id = e.user_id AND l.d = CAST(e.ts AS DATE)
    WHERE e.event_type = 'error'
""")
def fact_event_enriched(spark: SparkSession, root: str) -> DataFrame:
    s = Sample(spark, root)
    errors = s.events.where(F.col("event_type") == "error").select("event_id", "user_id", day("ts").alias("date"), "value")
    return join_unique(errors, _levels(s), ["user_id", "date"], how="inner").withColumn("date", iso("date"))


@query("WITH" + _STAYS + """
    , days AS (SELECT CAST(unnest(generate_series(DATE '2024-01-05', DATE '2024-01-25', INTERVAL 1 DAY)) AS DATE) AS d),
    stay_days AS (
        SELECT user_id, last_move, d
        FROM stays JOIN days ON (start_day IS NULL OR d >= start_day) AND (end_day IS NULL OR d <= end_day)
    ), weekly AS (
        SELECT user_id, CAST(date_trunc('week', ts) AS DATE) AS week, first(event_type ORDER BY ts, event_id) AS first_type
        FROM events GROUP BY 1, 2
    )
    SELECT s.user_id, s.last_move, CAST(s.d AS VARCHAR) AS date,
           coalesce((SELECT last(e.event_type ORDER BY e.ts, e.event_id) FROM events e
                     WHERE e.user_id = s.user_id AND e.event_type = 'error' AND CAST(e.ts AS DATE) <= s.d),
                    w.first_type) AS level
    FROM stay_days s LEFT JOIN weekly w ON w.user_id = s.user_id AND w.week = CAST(date_trunc('week', s.d) AS DATE)
""")
def stay_day_levels(spark: SparkSession, root: str) -> DataFrame:
    s = Sample(spark, root)
    low, high = map(F.lit, WINDOW)
    errors = s.events.where(F.col("event_type") == "error").select(
        "user_id", "event_id", "event_type", "ts", day("ts").alias("changed")
    )
    changes = daily_changes(errors, "user_id", "changed", "event_type", ["ts", "event_id"], low)
    weekly = s.events.groupBy("user_id", F.trunc(day("ts"), "week").alias("week")).agg(
        F.min(F.struct("ts", "event_id", "event_type"))["event_type"].alias("first_type")
    )
    segments = level_segments(_stays(s), "user_id", "start_day", "end_day", changes, weekly, low, high, unit="week")
    return explode_segments(segments).withColumn("date", iso("date"))
