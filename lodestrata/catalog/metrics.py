"""Reports, measures, top lists and total rows over the sample tables."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.catalog.base import Sample, day, iso, query
from lodestrata.catalog.model import (
    ERROR_RATE,
    OCCUPANCY,
    PURCHASERS,
    ROLLING_RATE,
    SEGMENT_ORDER,
    TRAILING_RATE,
    USER_DAYS,
    WEEK,
    dim_nation,
    monthly_occupancy,
    order_months,
    sample_model,
)
from lodestrata.functions import safe_ratio
from lodestrata.operators.ranking import top_n_per_group as top_labels
from lodestrata.operators.ranking import top_n_with_ties as leaders
from lodestrata.operators.ranking import with_total
from lodestrata.operators.star import Relation, StarModel
from lodestrata.plans.measures import Amount, Rate, Total, evaluate, trailing_series, with_total_row
from lodestrata.sources.tables import mapping


@query("""
    WITH counted AS (
        SELECT n_name, o_orderpriority, count(*) AS order_count
        FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
        GROUP BY n_name, o_orderpriority
    ), shares AS (
        SELECT *, CAST(sum(order_count) OVER per_nation AS BIGINT) AS nation_order_count,
               CAST(row_number() OVER (per_nation ORDER BY order_count DESC, o_orderpriority) AS INTEGER) AS priority_rank
        FROM counted
        WINDOW per_nation AS (PARTITION BY n_name)
    )
    SELECT n_name, o_orderpriority, order_count, nation_order_count, priority_rank,
           round(100.0 * order_count / nation_order_count, 2) AS percent
    FROM shares
    WHERE priority_rank <= 3
    ORDER BY n_name, priority_rank
""")
def top_n_per_group(spark: SparkSession, root: str) -> DataFrame:
    s = Sample(spark, root)
    # One row per customer and priority crosses the join, however many orders a customer has.
    per_customer = s.orders.groupBy("o_custkey", "o_orderpriority").agg(F.count("*").alias("n"))
    homes = s.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation_key"))
    counts = (
        per_customer.join(homes, "o_custkey")
        .groupBy("nation_key", "o_orderpriority")
        .agg(F.sum("n").alias("order_count"))
    )
    top = top_labels(
        counts, "nation_key", "o_orderpriority", "order_count", 3, "priority_rank", "nation_order_count", "percent"
    )
    return (
        top.join(dim_nation(s).select("nation_key", "n_name"), "nation_key")
        .drop("nation_key")
        .orderBy("n_name", "priority_rank")
    )


_FACTS = """
    user_day AS (
        SELECT DISTINCT user_id, CAST(ts AS DATE) AS d, n_name, r_name, c_mktsegment AS segment
        FROM events JOIN customer ON c_custkey = user_id JOIN nation ON n_nationkey = c_nationkey
             JOIN region ON r_regionkey = n_regionkey
    ), error AS (
        SELECT event_id, user_id, CAST(ts AS DATE) AS d, n_name, r_name, c_mktsegment AS segment
        FROM events JOIN customer ON c_custkey = user_id JOIN nation ON n_nationkey = c_nationkey
             JOIN region ON r_regionkey = n_regionkey
        WHERE event_type = 'error'
    ), purchase AS (
        SELECT DISTINCT user_id, CAST(ts AS DATE) AS d, n_name, r_name
        FROM events JOIN customer ON c_custkey = user_id JOIN nation ON n_nationkey = c_nationkey
             JOIN region ON r_regionkey = n_regionkey
        WHERE event_type = 'purchase'
    ), days AS (
        SELECT CAST(unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d
        FROM events
    )
"""

_OCCUPANCY = """
    occupancy AS (
        SELECT n_name, r_name, CAST(date_trunc('month', d) AS DATE) AS month_start,
               (SELECT count(DISTINCT o_custkey) FROM orders JOIN customer ON c_custkey = o_custkey
                WHERE c_nationkey = n_nationkey AND CAST(o_orderdate AS DATE) = last_day(d)) AS occupied,
               (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS units
        FROM nation JOIN region ON r_regionkey = n_regionkey,
             (SELECT DISTINCT CAST(date_trunc('month', x) AS DATE) AS d
              FROM (SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)),
                                                  INTERVAL 1 DAY)) AS x FROM orders))
    )
"""


@query("WITH" + _FACTS + """
    , exposure AS (SELECT n_name, segment, count(*) AS day_count FROM user_day GROUP BY n_name, segment),
    hits AS (SELECT n_name, segment, count(*) AS error_count FROM error GROUP BY n_name, segment)
    SELECT e.n_name, e.segment, coalesce(h.error_count, 0) AS error_count, e.day_count,
           round(100.0 * coalesce(h.error_count, 0) / e.day_count, 4) AS errors_per_100_days
    FROM exposure e LEFT JOIN hits h ON h.n_name = e.n_name AND h.segment = e.segment
""")
def rate_by_two_keys(spark: SparkSession, root: str) -> DataFrame:
    model = sample_model(spark, root, "user_day", "error")
    keys = ["nation_key", "segment"]
    exposure = model["user_day"].groupBy(*keys).agg(F.count("*").alias("day_count"))
    hits = model["error"].groupBy(*keys).agg(F.sum("error_count").alias("error_count"))
    rated = exposure.join(hits, keys, "left").fillna({"error_count": 0})
    names = model["dim_nation"].select("nation_key", "n_name")
    return rated.join(names, "nation_key").select(
        "n_name",
        "segment",
        "error_count",
        "day_count",
        safe_ratio(F.col("error_count"), F.col("day_count"), 100, 4).alias("errors_per_100_days"),
    )


@query("WITH" + _OCCUPANCY + """
    SELECT n_name, CASE WHEN sum(units) > 0 THEN CAST(sum(occupied) AS DOUBLE) / sum(units) END AS ratio
    FROM occupancy o
    WHERE month_start = (SELECT max(month_start) FROM occupancy x WHERE x.n_name = o.n_name)
    GROUP BY n_name
""")
def latest_period_ratio(spark: SparkSession, root: str) -> DataFrame:
    return evaluate(sample_model(spark, root, "occupancy"), {"ratio": OCCUPANCY}, ("dim_nation.n_name",))


@query("WITH" + _OCCUPANCY + """
    SELECT r_name, CAST(sum(occupied) AS DOUBLE) / sum(units) AS ratio
    FROM occupancy
    WHERE month_start = (SELECT max(month_start) FROM occupancy)
    GROUP BY r_name
    ORDER BY ratio DESC
""")
def latest_period_by_region(spark: SparkSession, root: str) -> DataFrame:
    by_region = evaluate(sample_model(spark, root, "occupancy"), {"ratio": OCCUPANCY}, ("dim_nation.r_name",))
    return by_region.orderBy(F.col("ratio").desc())


@query("WITH" + _OCCUPANCY + """
    SELECT CAST(month_start AS VARCHAR) AS month_start, CAST(sum(occupied) AS DOUBLE) / sum(units) AS ratio
    FROM occupancy
    GROUP BY month_start
    ORDER BY 1
""")
def ratio_by_period(spark: SparkSession, root: str) -> DataFrame:
    """The latest-period ratio at the grain of months: each month is its own latest one."""
    s = Sample(spark, root)
    months = order_months(s)
    model = StarModel(
        {"dim_month": months, "occupancy": monthly_occupancy(s)},
        (Relation("occupancy", "month_start", "dim_month", "month_start"),),
    )
    ratios = evaluate(model, {"ratio": OCCUPANCY}, ("dim_month.month_start",))
    return ratios.withColumn("month_start", iso("month_start")).orderBy("month_start")


@query("WITH" + _FACTS + """
    SELECT CAST(days.d AS VARCHAR) AS date,
           (SELECT count(DISTINCT user_id) FROM purchase p WHERE p.d <= days.d AND p.d > days.d - 7) AS event_count,
           (SELECT count(*) FROM user_day u WHERE u.d <= days.d AND u.d > days.d - 7) AS day_count,
           (SELECT count(*) FROM days x WHERE x.d <= days.d AND x.d > days.d - 7) AS dates_in_window,
           round((SELECT count(DISTINCT user_id) FROM purchase p WHERE p.d <= days.d AND p.d > days.d - 7)
                 / (CAST((SELECT count(*) FROM user_day u WHERE u.d <= days.d AND u.d > days.d - 7) AS DOUBLE)
                    / (SELECT count(*) FROM days x WHERE x.d <= days.d AND x.d > days.d - 7)), 6) AS rate
    FROM days
""")
def trailing_rate(spark: SparkSession, root: str) -> DataFrame:
    rate = Rate(PURCHASERS, USER_DAYS, daily=True)
    series = trailing_series(sample_model(spark, root, "user_day", "purchase"), rate, "dim_date", WEEK)
    return series.withColumns({"date": iso("date"), "rate": F.round("rate", 6)})


@query("WITH" + _FACTS + """
    SELECT r.r_name, CAST(days.d AS VARCHAR) AS date,
           (SELECT count(DISTINCT user_id) FROM purchase p
            WHERE p.r_name = r.r_name AND p.d <= days.d AND p.d > days.d - 7) AS event_count,
           (SELECT count(*) FROM user_day u WHERE u.r_name = r.r_name AND u.d <= days.d AND u.d > days.d - 7) AS day_count
    FROM days, (SELECT DISTINCT r_name FROM user_day) r
""")
def trailing_rate_by_region(spark: SparkSession, root: str) -> DataFrame:
    rate = Rate(PURCHASERS, USER_DAYS, daily=True)
    series = trailing_series(sample_model(spark, root, "user_day", "purchase"), rate, "dim_date", WEEK, ("dim_nation.r_name",))
    return series.select("r_name", iso("date").alias("date"), "event_count", "day_count")


@query("WITH" + _FACTS + """
    , daily AS (
        SELECT days.d, (SELECT count(*) FROM error e WHERE e.d = days.d) AS errors,
               (SELECT count(*) FROM user_day u WHERE u.d = days.d) AS users
        FROM days
    ), rolled AS (
        SELECT d, CAST(sum(errors) OVER last_week AS BIGINT) AS event_count,
               CAST(sum(users) OVER last_week AS BIGINT) AS day_count, count(*) OVER last_week AS dates_in_window
        FROM daily
        WINDOW last_week AS (ORDER BY d RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)
    )
    SELECT CAST(d AS VARCHAR) AS date, event_count, day_count, dates_in_window,
           round(100.0 * event_count / day_count, 6) AS rate
    FROM rolled
""")
def rolling_incident_rate(spark: SparkSession, root: str) -> DataFrame:
    series = trailing_series(sample_model(spark, root, "user_day", "error"), ERROR_RATE, "dim_date", WEEK)
    return series.withColumns({"date": iso("date"), "rate": F.round("rate", 6)})


@query("""
    SELECT o_orderpriority, count(DISTINCT o_orderkey) AS completed_orders
    FROM orders
    WHERE o_orderstatus = 'F'
    GROUP BY o_orderpriority
""")
def distinct_completed(spark: SparkSession, root: str) -> DataFrame:
    """The distinct amount itself, by the label of a dimension: orders count once they have a day of completion."""
    orders = Sample(spark, root).orders
    done = F.when(F.col("o_orderstatus") == "F", day("o_orderdate")).alias("done")
    model = StarModel(
        {
            "dim_priority": orders.select("o_orderpriority").distinct(),
            "orders": orders.select("o_orderkey", F.col("o_orderpriority").alias("priority"), done),
        },
        (Relation("orders", "priority", "dim_priority", "o_orderpriority"),),
    )
    completed = Total(Amount("orders", "done", "o_orderkey", distinct=True), empty=None)
    return evaluate(model, {"completed_orders": completed}, ("dim_priority.o_orderpriority",)).where("completed_orders IS NOT NULL")


_COMPLETED_RANGE = (datetime.date(1996, 1, 1), datetime.date(2000, 12, 31))


@query("""
    SELECT * FROM (
        SELECT o_orderpriority, count(DISTINCT o_orderkey) AS completed_orders,
               CAST(rank() OVER (ORDER BY count(DISTINCT o_orderkey) DESC) AS INTEGER) AS rank
        FROM orders
        WHERE o_orderstatus = 'F' AND o_orderpriority IS NOT NULL
          AND CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
        GROUP BY o_orderpriority
    ) WHERE rank <= 3
""")
def completed_in_range(spark: SparkSession, root: str) -> DataFrame:
    low, high = map(F.lit, _COMPLETED_RANGE)
    done = Sample(spark, root).orders.where(
        (F.col("o_orderstatus") == "F")
        & F.col("o_orderpriority").isNotNull()
        & (F.col("o_orderdate") >= low.cast("timestamp_ntz"))
        & (F.col("o_orderdate") < F.date_add(high, 1).cast("timestamp_ntz"))
    )
    counted = done.groupBy("o_orderpriority").agg(F.count_distinct("o_orderkey").alias("completed_orders"))
    return leaders(counted, "completed_orders", 3)


@query("""
    WITH lines AS (SELECT s_nationkey, count(*) AS supplier_count FROM supplier GROUP BY s_nationkey),
    best AS (SELECT s_nationkey, rank() OVER (ORDER BY supplier_count DESC) AS r FROM lines)
    SELECT n_name, count(*) AS customer_count
    FROM customer JOIN nation ON n_nationkey = c_nationkey
    WHERE c_nationkey IN (SELECT s_nationkey FROM best WHERE r <= 5)
    GROUP BY n_name
""")
def top_n_with_ties(spark: SparkSession, root: str) -> DataFrame:
    s = Sample(spark, root)
    suppliers = s.supplier.groupBy(F.col("s_nationkey").alias("nation_key")).agg(F.count("*").alias("supplier_count"))
    best = leaders(suppliers, "supplier_count", 5).select("nation_key")
    customers = s.customer.groupBy(F.col("c_nationkey").alias("nation_key")).agg(F.count("*").alias("customer_count"))
    names = dim_nation(s).select("nation_key", "n_name")
    return customers.join(best, "nation_key", "left_semi").join(names, "nation_key").select("n_name", "customer_count")


@query("WITH" + _FACTS + """
    , parts AS (
        SELECT r_name, 0 AS error_count, count(*) AS day_count FROM user_day GROUP BY r_name
        UNION ALL SELECT r_name, count(*), 0 FROM error GROUP BY r_name
    )
    SELECT coalesce(r_name, 'Total') AS r_name, CAST(sum(error_count) AS BIGINT) AS error_count,
           CAST(sum(day_count) AS BIGINT) AS day_count, round(100.0 * sum(error_count) / sum(day_count), 6) AS rate
    FROM parts
    GROUP BY ROLLUP (r_name)
""")
def matrix_with_total(spark: SparkSession, root: str) -> DataFrame:
    model = sample_model(spark, root, "user_day", "error")
    by = ["dim_nation.r_name"]
    region = F.col("`dim_nation.r_name`").alias("r_name")
    days = model.with_attributes("user_day", by).groupBy(region).agg(F.count("*").alias("day_count"))
    errors = model.with_attributes("error", by).groupBy(region).agg(F.sum("error_count").alias("error_count"))
    joined = days.join(errors, "r_name", "left").fillna({"error_count": 0})
    rate = {"rate": safe_ratio(F.col("error_count"), F.col("day_count"), 100, 6)}
    return with_total(joined, "r_name", ["error_count", "day_count"], rate)


_MATRIX_PARTS = """
    SELECT {label} AS n_name,
           (SELECT CAST(sum(occupied) AS DOUBLE) / nullif(sum(units), 0) FROM occupancy o
            WHERE month_start = (SELECT max(month_start) FROM occupancy) {o}) AS occupancy,
           (SELECT count(DISTINCT user_id) FROM purchase p WHERE p.d > (SELECT max(d) - 7 FROM days) {p})
             / nullif((SELECT count(*) FROM user_day u WHERE u.d > (SELECT max(d) - 7 FROM days) {u}) / 7.0, 0) AS trailing_rate,
           100.0 * (SELECT count(*) FROM error e WHERE 1 = 1 {e}) / nullif((SELECT count(*) FROM user_day u WHERE 1 = 1 {u}), 0) AS error_rate
"""


@query("WITH" + _FACTS + "," + _OCCUPANCY + ", matrix AS (" + _MATRIX_PARTS.format(
    label="n.n_name",
    o="AND o.n_name = n.n_name",
    p="AND p.n_name = n.n_name",
    u="AND u.n_name = n.n_name",
    e="AND e.n_name = n.n_name",
) + " FROM (SELECT n_name FROM nation) n UNION ALL" + _MATRIX_PARTS.format(
    label="'Total'", o="", p="", u="", e=""
) + """)
    SELECT n_name, round(occupancy, 6) AS occupancy, round(trailing_rate, 6) AS trailing_rate, round(error_rate, 6) AS error_rate
    FROM matrix
""")
def entity_matrix(spark: SparkSession, root: str) -> DataFrame:
    measures = {"occupancy": OCCUPANCY, "trailing_rate": TRAILING_RATE, "error_rate": ERROR_RATE}
    model = sample_model(spark, root, "occupancy", "user_day", "purchase", "error")
    matrix = with_total_row(model, measures, "dim_nation.n_name", "dim_date")
    return matrix.withColumns({name: F.round(name, 6) for name in ("occupancy", "trailing_rate", "error_rate")})


@query("WITH" + _FACTS + "," + _OCCUPANCY + """
    SELECT (SELECT CAST(sum(occupied) AS DOUBLE) / sum(units) FROM occupancy
            WHERE month_start = (SELECT max(month_start) FROM occupancy)) AS occupancy,
           round((SELECT count(DISTINCT user_id) FROM purchase WHERE d > (SELECT max(d) - 7 FROM days))
             / ((SELECT count(*) FROM user_day WHERE d > (SELECT max(d) - 7 FROM days)) / 7.0), 6) AS trailing_rate,
           round(100.0 * (SELECT count(*) FROM error) / (SELECT count(*) FROM user_day), 6) AS error_rate,
           round(100.0 * (SELECT count(*) FROM error WHERE d > (SELECT max(d) - 7 FROM days))
             / (SELECT count(*) FROM user_day WHERE d > (SELECT max(d) - 7 FROM days)), 6) AS rolling_rate,
           (SELECT count(DISTINCT user_id) FROM purchase) AS purchasers
""")
def kpi_card(spark: SparkSession, root: str) -> DataFrame:
    measures = {
        "occupancy": OCCUPANCY,
        "trailing_rate": TRAILING_RATE,
        "error_rate": ERROR_RATE,
        "rolling_rate": ROLLING_RATE,
        "purchasers": Total(PURCHASERS),
    }
    model = sample_model(spark, root, "occupancy", "user_day", "purchase", "error")
    card = evaluate(model, measures, calendar="dim_date")
    return card.withColumns({name: F.round(name, 6) for name in ("trailing_rate", "error_rate", "rolling_rate")})


@query("WITH" + _FACTS + """
    SELECT u.segment, round(100.0 * (SELECT count(*) FROM error e WHERE e.segment = u.segment AND e.r_name = 'EUROPE')
                            / count(*), 6) AS rate
    FROM user_day u
    WHERE u.r_name = 'EUROPE'
    GROUP BY u.segment
""")
def kpi_by_label(spark: SparkSession, root: str) -> DataFrame:
    model = sample_model(spark, root, "user_day", "error").filtered({"dim_nation": F.col("r_name") == "EUROPE"})
    rates = evaluate(model, {"rate": ERROR_RATE}, ("dim_segment.segment",))
    return rates.withColumn("rate", F.round("rate", 6))


@query("""
    SELECT c_mktsegment AS segment,
           CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 1 WHEN 'AUTOMOBILE' THEN 2 WHEN 'BUILDING' THEN 3
                             WHEN 'MACHINERY' THEN 4 ELSE 5 END AS display_order,
           count(*) AS order_count
    FROM orders JOIN customer ON c_custkey = o_custkey
    GROUP BY c_mktsegment
    ORDER BY display_order
""")
def sort_by_display_order(spark: SparkSession, root: str) -> DataFrame:
    s = Sample(spark, root)
    order = mapping(spark, SEGMENT_ORDER, "segment string, display_order int")
    per_customer = s.orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    segments = s.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"))
    counts = per_customer.join(segments, "o_custkey").groupBy("segment").agg(F.sum("n").alias("order_count"))
    return counts.join(order, "segment").orderBy("display_order")


@query("""
    WITH placed AS (
        SELECT o_orderkey, o_orderstatus, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS segment
        FROM orders LEFT JOIN customer ON c_custkey = o_custkey
    ), labels AS (SELECT DISTINCT segment, 0 AS is_total FROM placed UNION ALL SELECT NULL, 1)
    SELECT CASE WHEN is_total = 1 THEN 'Total' ELSE l.segment END AS segment,
           (SELECT count(*) FROM placed p WHERE is_total = 1 OR p.segment IS NOT DISTINCT FROM l.segment) AS order_count,
           (SELECT count(DISTINCT o_orderkey) FROM placed p
            WHERE o_orderstatus = 'P' AND (is_total = 1 OR p.segment IS NOT DISTINCT FROM l.segment)) AS pending,
           (SELECT nullif(count(*), 0) FROM placed p WHERE o_orderstatus = 'X' AND (is_total = 1 OR p.segment IS NOT DISTINCT FROM l.segment))
             AS lost_share
    FROM labels l
""")
def unknown_member(spark: SparkSession, root: str) -> DataFrame:
    """Orders of a segment that the dimension lacks: they are the group without a name, and the total is the sum of all groups.
    A rate without events is blank."""
    s = Sample(spark, root)
    segments = s.customer.select(F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("segment"))
    dim = segments.where(F.col("segment") != "BUILDING")
    placed = s.orders.select("o_orderkey", "o_orderstatus", F.col("o_custkey").alias("custkey"), day("o_orderdate").alias("date"))
    facts = {"ordered": placed, "pending": placed.where("o_orderstatus = 'P'"), "lost": placed.where("o_orderstatus = 'X'")}
    model = StarModel({"dim": dim, **facts}, tuple(Relation(name, "custkey", "dim", "custkey") for name in facts))
    ordered = Amount("ordered", "date")
    measures = {
        "order_count": Total(ordered),
        "pending": Total(Amount("pending", "date", "o_orderkey", distinct=True)),
        "lost_share": Rate(Amount("lost", "date"), ordered, empty=None),
    }
    found = evaluate(model, measures, ("dim.segment",), total="Total")
    return found.withColumn("lost_share", F.col("lost_share").cast("long"))
