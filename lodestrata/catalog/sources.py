"""Drops and published tables written from the sample tables and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lodestrata.catalog.base import Sample, day, iso, query
from lodestrata.functions import blank_to_null, parse_date, try_int
from lodestrata.session import scratch_folder
from lodestrata.operators.quality import reconcile
from lodestrata.sources import publish, read_drop, read_drop_parts, read_model
from lodestrata.sources.tables import mapping
from lodestrata.sources.versions import current_release, read_release, release, versions, write_version

IN_FOLDER = r"period=([0-9]{4}_[0-9]{2})/"


@query("""
    SELECT strftime(o_orderdate, '%Y_01') AS _source_month, 'orders' AS _source_table,
           count(*) AS order_count,
           count(CASE WHEN o_orderstatus <> 'P' THEN 1 END) AS priority_count,
           CAST(sum(o_orderkey) AS BIGINT) AS key_sum,
           CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) AS first_day,
           true AS rows_numbered,
           count(DISTINCT o_orderstatus = 'P') AS layout_count,
           count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS padded_rows
    FROM orders
    GROUP BY 1
""")
def csv_drop_lineage(spark: SparkSession, root: str) -> DataFrame:
    folder = scratch_folder(spark)
    orders = Sample(spark, root).orders
    key, priority = F.col("o_orderkey"), F.col("o_orderpriority")
    ordered = F.date_format("o_orderdate", "MM/dd/yyyy").alias("order_date")
    period = F.date_format(F.trunc("o_orderdate", "year"), "yyyy_MM").alias("period")
    # Two layouts of the same drop: pending orders come without a priority and with their columns turned round.
    layouts = {
        "settled": orders.where("o_orderstatus <> 'P'").select(key.alias("id"), priority.alias("priority"), ordered, period),
        "pending": orders.where("o_orderstatus = 'P'").select(ordered, key.alias("id"), period),
    }
    for name, df in layouts.items():
        df.write.partitionBy("period").option("header", True).csv(f"{folder}/{name}")

    drop = read_drop(spark, folder, "*.csv", "orders", IN_FOLDER, recursive=True)
    per_file = drop.groupBy("_source_month", "_source_table", "_source_file").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("priority").isNull()).alias("padded"),
        F.collect_set(F.col("priority").isNull()).alias("layouts"),
        F.max("_row_number").alias("last"),
        F.sum("_row_number").alias("ordinals"),
        F.count(blank_to_null(F.col("priority"))).alias("priorities"),
        F.sum(try_int(F.col("id"))).alias("keys"),
        F.min(parse_date(F.col("order_date"))).alias("first_day"),
    )
    numbered = (F.col("last") == F.col("rows")) & (F.col("ordinals") * 2 == F.col("rows") * (F.col("rows") + 1))
    return per_file.groupBy("_source_month", "_source_table").agg(
        F.sum("rows").alias("order_count"),
        F.sum("priorities").alias("priority_count"),
        F.sum("keys").alias("key_sum"),
        iso(F.min("first_day")).alias("first_day"),
        F.every(numbered).alias("rows_numbered"),
        F.size(F.array_distinct(F.flatten(F.collect_list("layouts")))).cast("long").alias("layout_count"),
        F.sum("padded").alias("padded_rows"),
    )


@query("""
    SELECT o_orderstatus, CAST(o_orderstatus AS VARCHAR) || '-' || substr(o_orderpriority, 1, 1) AS code, count(*) AS order_count,
           CAST(sum(CAST(o_totalprice AS DECIMAL(12, 2))) AS DOUBLE) AS price,
           CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS last_day
    FROM orders
    GROUP BY 1, 2
""")
def publish_read_back(spark: SparkSession, root: str) -> DataFrame:
    folder = scratch_folder(spark)
    orders = Sample(spark, root).orders.select(
        "o_orderstatus", "o_orderpriority", F.col("o_totalprice").alias("price"), day("o_orderdate").alias("order_day")
    )
    publish(orders, f"{folder}/orders.parquet", partition_by=["o_orderstatus"])
    stored = read_model(spark, folder, ["orders"], {"orders": {"price": "decimal(12,2)"}})["orders"]
    code = F.concat_ws("-", "o_orderstatus", F.substring("o_orderpriority", 1, 1))
    return stored.groupBy("o_orderstatus", code.alias("code")).agg(
        F.count("*").alias("order_count"),
        F.sum("price").cast("double").alias("price"),
        iso(F.max("order_day")).alias("last_day"),
    )


@query("""
    SELECT o_orderstatus AS status, count(*) AS row_count, count(*) FILTER (o_totalprice > 400000) AS set_aside,
           count(*) FILTER (o_totalprice > 400000 AND o_orderstatus <> 'P') AS two_too_many,
           min(CASE WHEN o_totalprice > 400000 THEN o_orderstatus || ',"' || o_orderkey || ',x",' || o_orderpriority ||
               CASE WHEN o_orderstatus = 'P' THEN ',SURPLUS' ELSE ',SURPLUS,"a, b"' END END) AS first_line,
           true AS rows_numbered
    FROM orders GROUP BY 1
""")
def malformed_rows_set_aside(spark: SparkSession, root: str) -> DataFrame:
    """Lines with more fields than the header leave the table and stand in the quarantine as they were delivered."""
    folder = scratch_folder(spark)
    status, dear = F.col("o_orderstatus"), F.col("o_totalprice") > 400000
    key = F.concat(F.lit('"'), F.col("o_orderkey").cast("string"), F.lit(',x"'))
    surplus = F.when(dear & (status == "P"), "SURPLUS").when(dear, 'SURPLUS,"a, b"')
    line = F.concat_ws(",", status, key, "o_orderpriority", surplus).alias("status,id,priority")
    Sample(spark, root).orders.select(line).write.option("header", True).option("sep", "\x01").option("quote", "").csv(
        f"{folder}/period=2024_01"
    )
    drop = read_drop_parts(spark, folder, "*.csv", "orders", IN_FOLDER, recursive=True)
    clean = drop.rows.select("status", F.lit(None).cast("string").alias("line"), F.lit(0).alias("extra"), "_source_file", "_row_number")
    aside = drop.malformed.select(
        F.substring("_line", 1, 1).alias("status"),
        F.col("_line").alias("line"),
        (F.col("_delivered_fields") - F.col("_header_fields")).alias("extra"),
        "_source_file",
        "_row_number",
    )
    both = clean.unionAll(aside)
    per_file = both.groupBy("_source_file").agg(
        F.count("*").alias("rows"), F.max("_row_number").alias("last"), F.sum("_row_number").alias("ordinals")
    )
    numbered = per_file.agg(F.every((F.col("last") == F.col("rows")) & (F.col("ordinals") * 2 == F.col("rows") * (F.col("rows") + 1))))
    return both.groupBy("status").agg(
        F.count("*").alias("row_count"),
        F.count("line").alias("set_aside"),
        F.count_if(F.col("extra") == 2).alias("two_too_many"),
        F.min("line").alias("first_line"),
        F.lit(numbered.scalar()).alias("rows_numbered"),
    )


@query("""
    SELECT 'orders' AS name, count(*) FILTER (o_orderstatus <> 'P') AS first_rows, count(*) AS row_count,
           count(*) FILTER (o_totalprice > 400000) AS dear, CAST(2 AS BIGINT) AS versions_known FROM orders
    UNION ALL
    SELECT 'customer', count(*) FILTER (c_acctbal >= 0), count(*), count(*) FILTER (c_acctbal > 9000), 2 FROM customer
""")
def published_twice(spark: SparkSession, root: str) -> DataFrame:
    """Two tables replaced together: until the second release they read as the first one made them, then as a whole anew. Rows
    are counted by the tasks that write them."""
    folder, s = scratch_folder(spark), Sample(spark, root)
    tables = {
        "orders": (s.orders, F.col("o_orderstatus") != "P", F.col("o_totalprice") > 400000),
        "customer": (s.customer, F.col("c_acctbal") >= 0, F.col("c_acctbal") > 9000),
    }

    def write(first: bool) -> tuple[dict, dict[str, tuple[int, int]]]:
        written, counts = {}, {}
        for name, (table, part, dear) in tables.items():
            chosen = table.where(part) if first else table
            seen = Observation()
            watched = chosen.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(dear).alias("dear"))
            written[name] = {"version": write_version(watched, f"{folder}/{name}"), "columns": chosen.columns}
            counts[name] = (seen.get["rows"], seen.get["dear"])
        return written, counts

    release(spark, folder, write(True)[0])
    written, counts = write(False)
    before = {name: df.count() for name, df in read_release(spark, folder).items()}
    release(spark, folder, written)
    lines = [(name, before[name], *counts[name]) for name in current_release(spark, folder)]
    counted = mapping(spark, lines, "name string, first_rows long, observed long, dear long")
    stored = None
    for name, df in read_release(spark, folder).items():
        line = df.agg(F.count("*").alias("actual")).select(F.lit(name).alias("name"), "actual")
        stored = line if stored is None else stored.unionAll(line)
    checked = reconcile(stored, {name: counts[name][0] for name in counts}).where("ok")
    known = mapping(spark, [(name, len(versions(spark, f"{folder}/{name}"))) for name in tables], "name string, versions_known long")
    return counted.join(checked.select("name", F.col("actual").alias("row_count")), "name").join(known, "name").select(
        "name", "first_rows", "row_count", "dear", "versions_known"
    )
