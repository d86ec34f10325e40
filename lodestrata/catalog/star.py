"""Star joins, dense spines, orphan keys, gates and row filters over the sample tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.catalog.base import Sample, day, iso, query
from lodestrata.catalog.model import dim_nation, monthly_occupancy
from lodestrata.functions import safe_ratio
from lodestrata.operators.quality import (
    Check,
    ForeignKey,
    NotNull,
    Unique,
    reconcile,
    run_checks,
    snapshot_hash,
    table_counts,
)
from lodestrata.operators.star import Bridged, Relation, StarModel, orphan_count
from lodestrata.session import scratch_folder
from lodestrata.sources.tables import publish, published_view
from lodestrata.sources.versions import read_published

_SPINE = """
    months AS (
        SELECT DISTINCT CAST(date_trunc('month', d) AS DATE) AS month_start, last_day(d) AS month_end
        FROM (SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)),
                                                 INTERVAL 1 DAY)) AS DATE) AS d FROM orders)
    ), monthly AS (
        SELECT n.n_nationkey, n.n_name, n.n_regionkey, m.month_start, m.month_end,
               (SELECT count(DISTINCT o.o_custkey) FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
                WHERE c.c_nationkey = n.n_nationkey AND CAST(o.o_orderdate AS DATE) = m.month_end) AS occupied,
               (SELECT count(DISTINCT s_suppkey) FROM supplier s WHERE s.s_nationkey = n.n_nationkey) AS units
        FROM nation n, months m
    )
"""


@query("WITH" + _SPINE + """
    SELECT n_nationkey AS nation_key, CAST(month_start AS VARCHAR) AS month_start, CAST(month_end AS VARCHAR) AS month_end,
           occupied, units, CASE WHEN units > 0 THEN 100.0 * occupied / units END AS percent, true AS is_proxy
    FROM monthly
""")
def dense_spine_monthly(spark: SparkSession, root: str) -> DataFrame:
    return monthly_occupancy(Sample(spark, root)).select(
        "nation_key",
        iso("month_start").alias("month_start"),
        iso("month_end").alias("month_end"),
        "occupied",
        "units",
        safe_ratio(F.col("occupied"), F.col("units"), 100).alias("percent"),
        F.lit(True).alias("is_proxy"),
    )


@query("WITH" + _SPINE + """
    SELECT n_name, r_name, CAST(month_start AS VARCHAR) AS month_start, occupied, units,
           CASE WHEN units > 0 THEN round(100.0 * occupied / units, 2) END AS percent
    FROM monthly JOIN region ON r_regionkey = n_regionkey
    ORDER BY month_start, n_name
""")
def period_rate_report(spark: SparkSession, root: str) -> DataFrame:
    s = Sample(spark, root)
    return (
        monthly_occupancy(s)
        .join(dim_nation(s), "nation_key")
        .select(
            "n_name",
            "r_name",
            iso("month_start").alias("month_start"),
            "occupied",
            "units",
            safe_ratio(F.col("occupied"), F.col("units"), 100, 2).alias("percent"),
        )
        .orderBy("month_start", "n_name")
    )


@query("""
    SELECT c_nationkey, count(*) AS orphan_orders
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    GROUP BY c_nationkey
""")
def orphan_keys(spark: SparkSession, root: str) -> DataFrame:
    s = Sample(spark, root)
    per_customer = s.orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    building = s.customer.where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("o_custkey"))
    loose = per_customer.join(building, "o_custkey", "left_anti")
    homes = s.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return loose.join(homes, "o_custkey", "left").groupBy("c_nationkey").agg(F.sum("n").alias("orphan_orders"))


@query("""
    SELECT (SELECT count(*) FROM orders WHERE o_custkey NOT IN
                (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')) AS issues
""")
def orphan_total(spark: SparkSession, root: str) -> DataFrame:
    s = Sample(spark, root)
    return orphan_count(s.orders, "o_custkey", s.customer.where(F.col("c_mktsegment") == "BUILDING"), "c_custkey")


@query("""
    SELECT 'orders' AS "table", 'unique o_orderkey' AS "check", count(*) - count(DISTINCT o_orderkey) AS issues FROM orders
    UNION ALL
    SELECT 'lineitem', 'unique l_orderkey, l_linenumber',
           (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
    UNION ALL
    SELECT 'events', 'unique user_id, ts',
           (SELECT count(*) FROM events) - (SELECT count(*) FROM (SELECT DISTINCT user_id, ts FROM events))
""")
def grain_uniqueness(spark: SparkSession, root: str) -> DataFrame:
    s = Sample(spark, root)
    return run_checks(
        {"orders": s.orders, "lineitem": s.lineitem, "events": s.events},
        [
            Unique("orders", ("o_orderkey",)),
            Unique("lineitem", ("l_orderkey", "l_linenumber")),
            Unique("events", ("user_id", "ts")),
        ],
    )


@query("""
    SELECT 'orders' AS "table", 'not null o_custkey' AS "check",
           count(CASE WHEN o_custkey IS NULL THEN 1 END) AS issues FROM orders
    UNION ALL SELECT 'orders', 'price above 1000', count(CASE WHEN o_totalprice <= 1000 THEN 1 END) FROM orders
    UNION ALL SELECT 'orders', 'not open', count(CASE WHEN o_orderstatus = 'O' THEN 1 END) FROM orders
    UNION ALL SELECT 'customer', 'not null c_mktsegment', count(CASE WHEN c_mktsegment IS NULL THEN 1 END) FROM customer
    UNION ALL SELECT 'customer', 'balance not negative', count(CASE WHEN c_acctbal < 0 THEN 1 END) FROM customer
    UNION ALL SELECT 'lineitem', 'quantity between 1 and 40', count(CASE WHEN l_quantity > 40 OR l_quantity < 1 THEN 1 END)
    FROM lineitem
    UNION ALL SELECT 'lineitem', 'l_orderkey in orders', count(*) FROM lineitem
              WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL SELECT 'orders', 'o_custkey in customer', count(*) FROM orders
              WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
""")
def not_null_and_check(spark: SparkSession, root: str) -> DataFrame:
    s = Sample(spark, root)
    return run_checks(
        {"orders": s.orders, "customer": s.customer, "lineitem": s.lineitem},
        [
            NotNull("orders", "o_custkey"),
            Check("orders", "price above 1000", F.col("o_totalprice") > 1000),
            Check("orders", "not open", F.col("o_orderstatus") != "O"),
            NotNull("customer", "c_mktsegment"),
            Check("customer", "balance not negative", F.col("c_acctbal") >= 0),
            Check("lineitem", "quantity between 1 and 40", F.col("l_quantity").between(1, 40)),
            ForeignKey("lineitem", "l_orderkey", "orders", "o_orderkey"),
            ForeignKey("orders", "o_custkey", "customer", "c_custkey"),
        ],
    )


@query("""
    WITH counts AS (
        SELECT 'region' AS name, (SELECT count(DISTINCT n_regionkey) FROM nation) AS expected, (SELECT count(*) FROM region) AS actual
        UNION ALL SELECT 'nation', (SELECT count(DISTINCT c_nationkey) FROM customer), (SELECT count(*) FROM nation)
        UNION ALL SELECT 'orders', (SELECT count(DISTINCT l_orderkey) FROM lineitem), (SELECT count(*) FROM orders)
        UNION ALL SELECT 'part', (SELECT max(p_partkey) + 1 FROM part), (SELECT count(*) FROM part)
    )
    SELECT name, expected, actual, expected = actual AS ok FROM counts
""")
def row_count_reconcile(spark: SparkSession, root: str) -> DataFrame:
    """Counts against what other tables, or the table's own last key, make of them."""
    s = Sample(spark, root)
    expected = {
        "region": s.nation.agg(F.count_distinct("n_regionkey")),
        "nation": s.customer.agg(F.count_distinct("c_nationkey")),
        "orders": s.lineitem.agg(F.count_distinct("l_orderkey")),
        "part": s.part.agg(F.max("p_partkey") + 1),
    }
    counted = table_counts({name: getattr(s, name) for name in expected})
    return reconcile(counted, {name: one.first()[0] for name, one in expected.items()})


@query("""
    SELECT DISTINCT CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month_start,
           CAST(last_day(CAST(o_orderdate AS DATE)) AS VARCHAR) AS month_end
    FROM orders
""")
def distinct_periods(spark: SparkSession, root: str) -> DataFrame:
    ordered = day("o_orderdate")
    return (
        Sample(spark, root)
        .orders.select(iso(F.trunc(ordered, "MM")).alias("month_start"), iso(F.last_day(ordered)).alias("month_end"))
        .distinct()
    )


@query("""
    SELECT l_returnflag, l_linestatus, count(*) AS line_count,
           CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS quantity, count(DISTINCT l_orderkey) AS order_count
    FROM lineitem
    GROUP BY l_returnflag, l_linestatus
""")
def keyed_sums(spark: SparkSession, root: str) -> DataFrame:
    return (
        Sample(spark, root)
        .lineitem.groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.count("*").alias("line_count"),
            F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity"),
            F.count_distinct("l_orderkey").alias("order_count"),
        )
    )


def _order_model(s: Sample) -> StarModel:
    """Orders under nations: orders carry their customer's nation, counted per customer and status first."""

    def per_customer(orders: DataFrame) -> DataFrame:
        return orders.groupBy("o_custkey", "o_orderstatus").agg(
            F.count("*").alias("order_count"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("price")
        )

    homes = s.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation_key"))
    return StarModel(
        {"dim_nation": dim_nation(s), "orders": Bridged(s.orders, "o_custkey", homes, per_customer)},
        (Relation("orders", "nation_key", "dim_nation", "nation_key"),),
    )


def _order_metrics(model: StarModel) -> DataFrame:
    return (
        model["orders"]
        .groupBy("o_orderstatus")
        .agg(F.sum("order_count").alias("order_count"), F.sum("price").cast("double").alias("price"))
    )


_ROLE_SQL = """
    SELECT o_orderstatus, count(*) AS order_count, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS price
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
         JOIN region ON r_regionkey = n_regionkey
    WHERE {predicate}
    GROUP BY o_orderstatus
"""


@query(_ROLE_SQL.format(predicate="r_name = 'ASIA'"))
def role_filter_region(spark: SparkSession, root: str) -> DataFrame:
    model = _order_model(Sample(spark, root))
    return _order_metrics(model.filtered({"dim_nation": F.col("r_name") == "ASIA"}))


@query(_ROLE_SQL.format(predicate="n_name = 'NATION_7'"))
def role_filter_entity(spark: SparkSession, root: str) -> DataFrame:
    model = _order_model(Sample(spark, root))
    return _order_metrics(model.filtered({"dim_nation": F.col("n_name") == "NATION_7"}))


@query("""
    SELECT o_orderstatus, o_orderpriority, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day, o_totalprice FROM orders
""")
def published_columns(spark: SparkSession, root: str) -> DataFrame:
    orders = Sample(spark, root).orders.withColumn("order_day", iso(day("o_orderdate")))
    return published_view(orders, ["o_orderstatus", "o_orderpriority", "order_day", "o_totalprice"])


@query("""
    SELECT 'orders' AS name, count(*) AS row_count, true AS repeatable, true AS change_seen,
           count(*) + count(o_orderkey) + count(o_totalprice) AS filled FROM orders
    UNION ALL
    SELECT 'events', count(*), true, true, count(*) + count(event_id) + count(value) FROM events
""")
def snapshot_fingerprint(spark: SparkSession, root: str) -> DataFrame:
    """Two written runs, the second in another order, have one print; a run with one value moved to another column has not."""
    s = Sample(spark, root)
    folder = scratch_folder(spark)
    tables = {
        "orders": (s.orders.select("o_orderkey", "o_totalprice", F.lit(None).cast("double").alias("spare")), "o_totalprice"),
        "events": (s.events.select("event_id", "value", F.lit(None).cast("double").alias("spare")), "value"),
    }
    lines = []
    for name, (table, moved) in tables.items():
        first = table.withColumn("at", F.lit("first run"))
        again = table.withColumn("at", F.lit("second run")).sortWithinPartitions(F.col(moved).desc())
        other = first.withColumns({moved: F.lit(None).cast("double"), "spare": F.col(moved)})
        runs = []
        for n, run in enumerate((first, again, other)):
            publish(run, f"{folder}/{name}-{n}")
            written = read_published(spark, f"{folder}/{name}-{n}")
            runs.append(snapshot_hash(written, ("at",)).withColumn("run", F.lit(n)))
        counted = read_published(spark, f"{folder}/{name}-0").drop("at")
        values = counted.agg(sum((F.count(c) for c in counted.columns), F.count("*")).alias("filled"))
        both = runs[0].unionAll(runs[1]).unionAll(runs[2]).unionByName(values, allowMissingColumns=True)
        prints = both.agg(
            F.max("rows").alias("row_count"),
            (F.count_distinct(F.when(F.col("run") < 2, F.col("hash"))) == 1).alias("repeatable"),
            (F.count_distinct("hash") == 2).alias("change_seen"),
            F.max("filled").alias("filled"),
        )
        lines.append(prints.select(F.lit(name).alias("name"), "*"))
    return lines[0].unionAll(lines[1])
