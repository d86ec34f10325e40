"""The sample tables as a star: nations, segments and days against user days, errors and purchases."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.catalog.base import Sample, day
from lodestrata.operators.star import Bridged, Relation, StarModel, dense_spine
from lodestrata.operators.temporal import calendar
from lodestrata.plans.measures import Amount, Latest, Rate
from lodestrata.sources.tables import mapping

SEGMENT_ORDER = [("HOUSEHOLD", 1), ("AUTOMOBILE", 2), ("BUILDING", 3), ("MACHINERY", 4), ("FURNITURE", 5)]

RELATIONS = (
    Relation("user_day", "nation_key", "dim_nation", "nation_key"),
    Relation("user_day", "segment", "dim_segment", "segment"),
    Relation("user_day", "date", "dim_date", "date"),
    Relation("error", "nation_key", "dim_nation", "nation_key"),
    Relation("error", "segment", "dim_segment", "segment"),
    Relation("error", "date", "dim_date", "date"),
    Relation("purchase", "nation_key", "dim_nation", "nation_key"),
    Relation("purchase", "date", "dim_date", "date"),
    Relation("occupancy", "nation_key", "dim_nation", "nation_key"),
)

WEEK = 7
USER_DAYS = Amount("user_day", "date")
ERRORS = Amount("error", "date", "error_count")
PURCHASERS = Amount("purchase", "date", "user_id", distinct=True)

OCCUPANCY = Latest("occupancy", "occupied", "units", "month_start")
TRAILING_RATE = Rate(PURCHASERS.over(WEEK), USER_DAYS.over(WEEK), daily=True)
ERROR_RATE = Rate(ERRORS, USER_DAYS, scale=100)
ROLLING_RATE = Rate(ERRORS.over(WEEK), USER_DAYS.over(WEEK), scale=100)


def dim_nation(s: Sample) -> DataFrame:
    named = s.nation.join(s.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return named.select(F.col("n_nationkey").alias("nation_key"), "n_name", "r_name")


def span(facts: DataFrame, moment: str) -> tuple[datetime.date, datetime.date]:
    """First and last day of a fact, looked up once: a calendar is built from two dates, not from the fact."""
    first, last = facts.agg(F.min(moment).alias("first"), F.max(moment).alias("last")).select(day("first"), day("last")).first()
    return first, last


def event_calendar(s: Sample) -> DataFrame:
    return calendar(s.spark, *span(s.events, "ts"))


def _placed(s: Sample, shape: Callable[[DataFrame], DataFrame]) -> Bridged:
    """Events as one row per user and day, under the nation and segment of their user."""
    users = s.customer.select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_nationkey").alias("nation_key"),
        F.col("c_mktsegment").alias("segment"),
    )
    return Bridged(s.events, "user_id", users, shape)


def user_days(events: DataFrame) -> DataFrame:
    return events.select("user_id", day("ts").alias("date")).distinct()


def daily_errors(events: DataFrame) -> DataFrame:
    errors = events.where(F.col("event_type") == "error")
    return errors.groupBy("user_id", day("ts").alias("date")).agg(F.count("*").alias("error_count"))


def purchase_days(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == "purchase").select("user_id", day("ts").alias("date")).distinct()


def order_months(s: Sample) -> DataFrame:
    return calendar(s.spark, *span(s.orders, "o_orderdate")).select("month_start", "month_end").distinct()


def monthly_occupancy(s: Sample) -> DataFrame:
    """Nation by month of the order calendar: customers ordering on the month's last day over suppliers."""
    months = order_months(s)
    ordered = s.orders.select("o_custkey", day("o_orderdate").alias("month_end"))
    at_month_end = ordered.where(F.col("month_end") == F.last_day("month_end")).distinct()
    customers = s.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation_key"))
    occupied = (
        at_month_end.join(customers, "o_custkey").groupBy("nation_key", "month_end").agg(F.count("*").alias("occupied"))
    )
    units = s.supplier.groupBy(F.col("s_nationkey").alias("nation_key")).agg(F.count_distinct("s_suppkey").alias("units"))
    members = s.nation.select(F.col("n_nationkey").alias("nation_key"))
    return dense_spine(
        members, months, [(occupied, ["nation_key", "month_end"]), (units, ["nation_key"])], {"occupied": 0, "units": 0}
    )


def sample_model(spark: SparkSession, root: str, *facts: str) -> StarModel:
    """The dimensions with the named facts."""
    s = Sample(spark, root)
    build = {
        "user_day": lambda: _placed(s, user_days),
        "error": lambda: _placed(s, daily_errors),
        "purchase": lambda: _placed(s, purchase_days),
        "occupancy": lambda: monthly_occupancy(s),
    }
    tables = {
        "dim_nation": dim_nation(s),
        "dim_segment": mapping(spark, SEGMENT_ORDER, "segment string, display_order int"),
        **{name: build[name]() for name in facts},
    }
    if set(facts) - {"occupancy"}:
        tables["dim_date"] = event_calendar(s)
    return StarModel(tables, tuple(r for r in RELATIONS if {r.fact, r.dim} <= set(tables)))
