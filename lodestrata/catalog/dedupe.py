"""Version choice, support ranking, conflicts and quarantine over the sample tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.catalog.base import Sample, day, iso, query
from lodestrata.functions import out_of_order
from lodestrata.operators.dedupe import (
    best_supported,
    best_supported_one,
    conflicting_rows,
    latest_version,
    surplus_rows,
    unique_rows,
    with_version_count,
)
from lodestrata.operators.quarantine import rejected, rejection_summary
from lodestrata.operators.skew import ranked

LINE_KEY = ("l_orderkey", "l_linenumber")


@query("""
    WITH shipped AS (
        SELECT o.o_orderstatus, CAST(l.l_shipdate AS DATE) AS ship_day, CAST(o.o_orderdate AS DATE) AS order_day
        FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
    )
    SELECT o_orderstatus, ship_day < order_day AS shipped_before_ordered, count(*) AS line_count
    FROM shipped
    GROUP BY 1, 2
""")
def event_order_flags(spark: SparkSession, root: str) -> DataFrame:
    s = Sample(spark, root)
    # Lines are counted per order and ship day before the join: an order of any size crosses it as a few rows.
    shipped = s.lineitem.groupBy("l_orderkey", day("l_shipdate").alias("ship_day")).agg(F.count("*").alias("n"))
    ordered = s.orders.select("o_orderkey", "o_orderstatus", day("o_orderdate").alias("order_day"))
    joined = shipped.join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
    flag = out_of_order(F.col("order_day"), F.col("ship_day"))
    return joined.groupBy("o_orderstatus", flag.alias("shipped_before_ordered")).agg(F.sum("n").alias("line_count"))


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag,
           CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_day, l_extendedprice
    FROM lineitem
    QUALIFY row_number() OVER (
        PARTITION BY l_orderkey
        ORDER BY CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END, l_shipdate DESC, l_linenumber DESC,
                 l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1
""", name="latest_version")
def latest_version_per_order(spark: SparkSession, root: str) -> DataFrame:
    order = [
        (F.col("l_returnflag") == "R").desc_nulls_last(),
        *(
            F.col(name).desc_nulls_last()
            for name in ("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
        ),
    ]
    lines = Sample(spark, root).lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate", "l_extendedprice"
    )
    return (
        latest_version(lines, ["l_orderkey"], order)
        .withColumn("ship_day", iso(day("l_shipdate")))
        .drop("l_shipdate")
    )


def _events(spark: SparkSession, root: str) -> DataFrame:
    return Sample(spark, root).events.select("event_id", "user_id", "event_type", day("ts").alias("event_day"))


def _identity() -> dict:
    return {"user": F.col("user_id"), "kind": F.lower("event_type")}


_CANDIDATES = """
    WITH scored AS (
        SELECT event_id, user_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_day,
               count(*) OVER (PARTITION BY user_id, event_type) AS support
        FROM events
    ), candidates AS (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_day ORDER BY support DESC, event_id) AS candidate_rank,
               count(*) OVER (PARTITION BY user_id, event_day) AS candidate_count
        FROM scored
    )
"""


@query(_CANDIDATES + "SELECT * FROM candidates")
def candidate_ranks(spark: SparkSession, root: str) -> DataFrame:
    names = ("support", "candidate_rank", "candidate_count")
    found = best_supported(_events(spark, root), ["user_id", "event_day"], _identity(), ["event_id"], names)
    return found.withColumn("event_day", iso("event_day"))


@query(_CANDIDATES + "SELECT * EXCLUDE (candidate_rank) FROM candidates WHERE candidate_rank = 1")
def best_supported_candidate(spark: SparkSession, root: str) -> DataFrame:
    names = ("support", "candidate_count")
    found = best_supported_one(_events(spark, root), ["user_id", "event_day"], _identity(), ["event_id"], names)
    return found.withColumn("event_day", iso("event_day"))


_HASHED = """
    WITH candidates AS (
        SELECT 'all' AS entity, md5(CAST(event_id AS VARCHAR)) AS code, value FROM events
    )
    SELECT entity, code, row_number() OVER (PARTITION BY entity ORDER BY value DESC, code) AS place,
           count(*) OVER (PARTITION BY entity) AS size
    FROM candidates
"""


@query(_HASHED)
def hot_group_ranks(spark: SparkSession, root: str) -> DataFrame:
    """All events as one group, told apart by a hash."""
    events = Sample(spark, root).events.select(
        F.lit("all").alias("entity"), F.md5(F.col("event_id").cast("string").cast("binary")).alias("code"), "value"
    )
    order = [F.col("value").desc_nulls_last(), F.col("code").asc()]
    return ranked(events, ["entity"], order, rank="place", count="size").drop("value")


@query("""
    WITH versions AS (
        SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity, count(*) OVER (PARTITION BY l_orderkey) AS versions
        FROM lineitem
    )
    SELECT versions, l_returnflag, count(*) AS line_count, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
    FROM versions
    GROUP BY versions, l_returnflag
""")
def version_counts(spark: SparkSession, root: str) -> DataFrame:
    lines = Sample(spark, root).lineitem.select("l_orderkey", "l_returnflag", "l_quantity")
    return (
        with_version_count(lines, ["l_orderkey"], "versions")
        .groupBy("versions", "l_returnflag")
        .agg(F.count("*").alias("line_count"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"))
    )


@query("""
    SELECT l_returnflag, l_linestatus, count(*) AS line_count, CAST(sum(l_partkey) AS BIGINT) AS part_sum
    FROM (SELECT * FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1)
    GROUP BY l_returnflag, l_linestatus
""")
def drop_conflicts(spark: SparkSession, root: str) -> DataFrame:
    lines = Sample(spark, root).lineitem.select(*LINE_KEY, "l_partkey", "l_returnflag", "l_linestatus")
    return (
        unique_rows(lines, LINE_KEY)
        .groupBy("l_returnflag", "l_linestatus")
        .agg(F.count("*").alias("line_count"), F.sum("l_partkey").alias("part_sum"))
    )


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS version_count,
           'Conflicting records share the same line' AS _quarantine_reason
    FROM lineitem
    QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1
""")
def quarantine_split(spark: SparkSession, root: str) -> DataFrame:
    lines = Sample(spark, root).lineitem.select(*LINE_KEY, "l_partkey", "l_suppkey")
    contending = conflicting_rows(lines, LINE_KEY, "version_count")
    reason = "Conflicting records share the same line"
    return rejected(contending, F.col("version_count") > 1, reason).drop("_quarantined_at_utc")


@query("""
    SELECT 'conflicting_lines' AS category,
           (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM
                (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) AS row_count
    UNION ALL
    SELECT 'shipped_before_ordered',
           (SELECT count(*) FROM lineitem, orders
            WHERE l_orderkey = o_orderkey AND CAST(l_shipdate AS DATE) < CAST(o_orderdate AS DATE))
    UNION ALL
    SELECT 'customers_in_debt', (SELECT count(*) FROM customer WHERE c_acctbal < 0)
    UNION ALL
    SELECT 'brands_outside_range', (SELECT count(*) FROM part WHERE CAST(substr(p_brand, 7) AS INTEGER) > 14)
""", name="rejection_summary")
def rejection_summary_lines(spark: SparkSession, root: str) -> DataFrame:
    s = Sample(spark, root)
    per_line = s.lineitem.groupBy(*LINE_KEY).agg(F.count("*").alias("n")).where(F.col("n") > 1)
    shipped = s.lineitem.groupBy("l_orderkey", day("l_shipdate").alias("ship_day")).agg(F.count("*").alias("n"))
    early = shipped.join(s.orders, F.col("l_orderkey") == F.col("o_orderkey")).where(
        out_of_order(day("o_orderdate"), F.col("ship_day"))
    )
    weighted = [
        df.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count")).select(F.lit(name).alias("category"), "row_count")
        for name, df in (("conflicting_lines", per_line), ("shipped_before_ordered", early))
    ]
    counted = rejection_summary(
        {
            "customers_in_debt": s.customer.where(F.col("c_acctbal") < 0),
            "brands_outside_range": s.part.where(~F.col("p_brand").rlike(r"^Brand#([1-9]|1[0-4])\z")),
        }
    )
    return weighted[0].unionAll(weighted[1]).unionAll(counted)


@query("""
    SELECT 'order' AS grain, count(*) AS row_count, count(*) - count(DISTINCT l_orderkey) AS issues FROM lineitem
    UNION ALL
    SELECT 'line', count(*), count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
    FROM lineitem
    UNION ALL
    SELECT 'user event', count(*), count(*) - (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM events))
    FROM events
""")
def duplicates_removed(spark: SparkSession, root: str) -> DataFrame:
    s = Sample(spark, root)
    grains = {
        "order": surplus_rows(s.lineitem, ["l_orderkey"]),
        "line": surplus_rows(s.lineitem, LINE_KEY),
        "user event": surplus_rows(s.events, ["user_id", "event_type"]),
    }
    lines = [df.select(F.lit(name).alias("grain"), "row_count", "issues") for name, df in grains.items()]
    return lines[0].unionAll(lines[1]).unionAll(lines[2])
