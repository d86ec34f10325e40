"""Drops, gates and the pipeline's own table builders over the sample tables, cast into the shapes of the drops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.catalog.base import Sample, day, iso, query
from lodestrata.operators.quality import NotNull, QualityError, RowCount, Unique, raise_on_issues, run_checks
from lodestrata.plans import silver
from lodestrata.session import scratch_folder
from lodestrata.sources import drop_manifest, manifest_issues, published_view, read_drop

IN_FOLDER = r"period=([0-9]{4}_[0-9]{2})/"


@query("""
    SELECT o_orderstatus AS status, count(*) AS order_count,
           count(CASE WHEN o_orderstatus <> 'P' THEN 1 END) AS priorities,
           count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS days
    FROM orders
    GROUP BY 1
""")
def short_rows_padded(spark: SparkSession, root: str) -> DataFrame:
    """Lines that end early: pending orders have two fields, open ones three, finished ones all four."""
    folder = scratch_folder(spark)
    status, key = F.col("o_orderstatus"), F.col("o_orderkey").cast("string")
    line = F.concat_ws(
        ",", status, key, F.when(status != "P", F.col("o_orderpriority")), F.when(status == "F", iso(day("o_orderdate")))
    )
    lines = Sample(spark, root).orders.select(line.alias("status,id,priority,order_day"))
    lines.write.option("header", True).option("sep", "\x01").option("quote", "").csv(f"{folder}/period=2024_01")
    drop = read_drop(spark, folder, "*.csv", "orders", IN_FOLDER, recursive=True)
    return drop.groupBy("status").agg(
        F.count("id").alias("order_count"), F.count("priority").alias("priorities"), F.count("order_day").alias("days")
    )


def _yearly_drop(spark: SparkSession, root: str, names: list[str]) -> str:
    """A folder for each year of each domain, with as many files as the tasks that write it make."""
    folder = scratch_folder(spark)
    s = Sample(spark, root)
    tables = {"orders": (s.orders, "o_orderdate", "o_orderkey"), "lineitem": (s.lineitem, "l_shipdate", "l_orderkey")}
    for name in names:
        table, moment, key = tables[name]
        period = F.date_format(F.trunc(moment, "year"), "yyyy_MM").alias("period")
        rows = table.select(F.col(key).cast("string").alias("id"), period)
        rows.write.partitionBy("period").option("header", True).csv(f"{folder}/{name}")
    return folder


@query("""
    SELECT 'orders' AS _source_table, strftime(o_orderdate, '%Y_01') AS _source_month, count(*) AS row_count,
           true AS files_listed, true AS file_is_named, CAST(1 AS BIGINT) AS ingest_times, true AS rows_numbered
    FROM orders GROUP BY 2
    UNION ALL
    SELECT 'lineitem', strftime(l_shipdate, '%Y_01'), count(*), true, true, 1, true FROM lineitem GROUP BY 2
""")
def drops_of_two_domains(spark: SparkSession, root: str) -> DataFrame:
    """One load for every domain; file name, period, row number and ingest time of each row."""
    folder = _yearly_drop(spark, root, ["orders", "lineitem"])
    loads = [read_drop(spark, f"{folder}/{name}", "*.csv", name, IN_FOLDER, recursive=True) for name in ("orders", "lineitem")]
    per_file = (
        loads[0]
        .unionByName(loads[1])
        .groupBy("_source_table", "_source_month", "_source_file")
        .agg(
            F.count("id").alias("rows"),
            F.max("_row_number").alias("last"),
            F.sum("_row_number").alias("ordinals"),
            F.collect_set("_ingested_at_utc").alias("times"),
        )
    )
    numbered = (F.col("last") == F.col("rows")) & (F.col("ordinals") * 2 == F.col("rows") * (F.col("rows") + 1))
    found = per_file.groupBy("_source_table", "_source_month").agg(
        F.sum("rows").alias("row_count"),
        F.count("*").alias("files"),
        F.every(F.col("_source_file").rlike(r"^part-[^/]*[.]csv\z")).alias("file_is_named"),
        F.size(F.array_distinct(F.flatten(F.collect_list("times")))).cast("long").alias("ingest_times"),
        F.every(numbered).alias("rows_numbered"),
    )
    # The files that a listing shows are those that rows come from.
    listed = drop_manifest(spark, f"{folder}/*/*", {"": "*.csv"}).groupBy(
        F.regexp_extract("path", "/(orders|lineitem)/", 1).alias("_source_table"),
        F.regexp_extract("path", IN_FOLDER, 1).alias("_source_month"),
    ).agg(F.count("*").alias("listed"))
    return found.join(listed, ["_source_table", "_source_month"], "left").select(
        "_source_table", "_source_month", "row_count", (F.col("files") == F.col("listed")).alias("files_listed"),
        "file_is_named", "ingest_times", "rows_numbered",
    )


@query("""
    SELECT 'orders' AS domain, CAST(7 AS BIGINT) AS expected, count(DISTINCT year(o_orderdate)) AS actual,
           count(DISTINCT year(o_orderdate)) = 7 AS ok FROM orders
    UNION ALL
    SELECT 'lineitem', 7, count(DISTINCT year(l_shipdate)), count(DISTINCT year(l_shipdate)) = 7 FROM lineitem
    UNION ALL
    SELECT 'returns', 1, 0, false
""")
def manifest_gate(spark: SparkSession, root: str) -> DataFrame:
    """A folder of each year was delivered for two domains, however many files are in it, and none of a third."""
    folder = _yearly_drop(spark, root, ["orders", "lineitem"])
    years = lambda name: drop_manifest(spark, f"{folder}/{name}/*", {name: "*.csv"}).select(
        "domain", F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("path")
    )
    found = years("orders").unionAll(years("lineitem")).distinct()
    return manifest_issues(found, {"orders": 7, "lineitem": 7, "returns": 1})


@query("""
    SELECT 'nation' AS "table", 'unique n_name' AS "check", count(*) - count(DISTINCT n_name) AS issues, false AS stops FROM nation
    UNION ALL SELECT 'orders', 'not null o_orderpriority', count(*) - count(o_orderpriority), false FROM orders
    UNION ALL SELECT 'finished', 'row count 0', count(*), count(*) > 0 FROM orders WHERE o_orderstatus = 'F'
""")
def gate_report(spark: SparkSession, root: str) -> DataFrame:
    """A unique label, a required column and a checkpoint count, each with whether its gate stops a run."""
    s = Sample(spark, root)
    tables = {"nation": s.nation, "orders": s.orders, "finished": s.orders.where("o_orderstatus = 'F'")}
    checks = [Unique("nation", ("n_name",)), NotNull("orders", "o_orderpriority"), RowCount("finished", 0)]
    lines = []
    for check in checks:
        report = run_checks(tables, [check])
        try:
            raise_on_issues(report)
            stops = False
        except QualityError:
            stops = True
        lines.append(report.withColumn("stops", F.lit(stops)))
    return lines[0].unionAll(lines[1]).unionAll(lines[2])


@query("SELECT o_orderpriority, count(*) AS order_count FROM orders GROUP BY 1")
def logical_view(spark: SparkSession, root: str) -> DataFrame:
    published_view(Sample(spark, root).orders, ["o_orderkey", "o_orderpriority"], "orders_shown")
    return spark.sql("SELECT o_orderpriority, count(*) AS order_count FROM orders_shown GROUP BY 1")


def _lineage(month: Column, row: Column) -> list[Column]:
    return [
        F.lit("a.csv").alias("_source_file"),
        F.lit("domain").alias("_source_table"),
        month.alias("_source_month"),
        row.alias("_row_number"),
        F.lit(None).cast("timestamp").alias("_ingested_at_utc"),
    ]


@query("""
    SELECT CAST(o_custkey AS VARCHAR) AS lease_id, CAST(o_orderkey AS VARCHAR) AS resident_id,
           CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS move_out,
           CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS DOUBLE) AS monthly_rate
    FROM orders
    QUALIFY row_number() OVER (
        PARTITION BY o_custkey
        ORDER BY CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END, strftime(o_orderdate, '%Y_%m') DESC, o_orderkey DESC) = 1
""")
def lease_versions(spark: SparkSession, root: str) -> DataFrame:
    moved = F.when(F.col("o_orderstatus") == "F", iso(day("o_orderdate")))
    bronze = Sample(spark, root).orders.select(
        F.col("o_custkey").cast("string").alias("lease_id"),
        F.col("o_orderkey").cast("string").alias("resident_id"),
        F.lit(" u1 ").alias("unit_id"),
        F.lit("C001").alias("community_id"),
        iso(day("o_orderdate")).alias("move_in_date"),
        moved.alias("move_out_date"),
        F.lit("").alias("move_out_reason"),
        F.col("o_totalprice").cast("decimal(12,2)").cast("string").alias("monthly_rate"),
        *_lineage(F.date_format("o_orderdate", "yyyy_MM"), F.col("o_orderkey")),
    )
    return silver.leases(bronze).select(
        "lease_id", "resident_id", iso("move_out_date").alias("move_out"), F.col("monthly_rate").cast("double").alias("monthly_rate")
    )


@query("""
    SELECT CAST(l_orderkey AS VARCHAR) AS lead_id, l_shipmode AS status
    FROM (SELECT l_orderkey, max(l_linestatus) AS l_shipmode, count(*) AS n FROM lineitem GROUP BY l_orderkey)
    WHERE n = 1
""")
def leads_without_conflict(spark: SparkSession, root: str) -> DataFrame:
    none = F.lit(None).cast("string")
    bronze = Sample(spark, root).lineitem.select(
        F.col("l_orderkey").cast("string").alias("lead_id"),
        F.lit("C001").alias("community_id"),
        none.alias("lead_source"),
        *(iso(day("l_shipdate")).alias(c) for c in ("created_date", "tour_date", "deposit_date", "move_in_date")),
        F.col("l_linestatus").alias("status"),
        none.alias("lost_reason"),
        *_lineage(F.lit("2024_01"), F.col("l_linenumber").cast("long")),
    )
    return silver.leads(silver.lead_candidates(bronze)).select("lead_id", "status")


@query("""
    WITH typed AS (
        SELECT o_custkey, o_orderkey, o_orderpriority, strftime(o_orderdate, '%Y-01-01') AS month,
               count(*) OVER (PARTITION BY o_custkey, lower(o_orderpriority)) AS support
        FROM orders
    )
    SELECT CAST(o_custkey AS VARCHAR) AS resident_id, month, o_orderpriority AS last_name
    FROM typed
    QUALIFY row_number() OVER (PARTITION BY o_custkey, month ORDER BY support DESC, o_orderkey) = 1
""")
def resident_snapshots(spark: SparkSession, root: str) -> DataFrame:
    none = F.lit(None).cast("string")
    bronze = Sample(spark, root).orders.select(
        F.col("o_custkey").cast("string").alias("resident_id"),
        F.lit("C001").alias("community_id"),
        none.alias("first_name"),
        F.col("o_orderpriority").alias("last_name"),
        *(none.alias(c) for c in ("dob", "gender", "admit_date", "discharge_date", "care_level", "acuity_score", "mobility_status")),
        *_lineage(F.date_format(F.trunc("o_orderdate", "year"), "yyyy_MM"), F.col("o_orderkey")),
    )
    found = silver.residents(silver.resident_candidates(bronze))
    return found.select("resident_id", iso("snapshot_month").alias("month"), "last_name")


@query("""
    SELECT CAST(p_partkey AS VARCHAR) AS unit_id, CAST(substr(p_brand, 7) AS INTEGER) > 14 AS invalid_community_flag,
           CAST(CAST(p_retailprice AS DECIMAL(12, 2)) AS DOUBLE) AS monthly_rent
    FROM part
""")
def unit_communities(spark: SparkSession, root: str) -> DataFrame:
    number = F.substring("p_brand", 7, 10).cast("int")
    bronze = Sample(spark, root).part.select(
        F.col("p_partkey").cast("string").alias("unit_id"),
        F.concat(F.lit(" C"), F.lpad(number.cast("string"), 3, "0")).alias("community_id"),
        F.lit("al").alias("unit_type"),
        F.col("p_retailprice").cast("decimal(12,2)").cast("string").alias("monthly_rent"),
        F.lit("2024-01-31").alias("snapshot_date"),
        *_lineage(F.lit("2024_01"), F.col("p_partkey")),
    )
    return silver.units(bronze).select("unit_id", "invalid_community_flag", F.col("monthly_rent").cast("double").alias("monthly_rent"))


@query("""
    SELECT event_type, count(*) AS shift_count,
           count(CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) BETWEEN 0 AND 200 THEN 1 END) AS valid_rates,
           CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS rate_sum
    FROM events
    GROUP BY 1
""")
def shift_rates(spark: SparkSession, root: str) -> DataFrame:
    """The rate under the key of each row, parsed out of the events' own property text."""
    bronze = Sample(spark, root).events.select(
        F.col("event_id").cast("string").alias("shift_id"),
        F.lit("C001").alias("community_id"),
        F.col("user_id").cast("string").alias("employee_id"),
        F.lit(" k ").alias("role"),
        iso(day("ts")).alias("shift_date"),
        F.lit("8").alias("hours_worked"),
        F.replace("props", F.lit('"'), F.lit("'")).alias("hourly_rate"),
        F.col("event_type").alias("event_type"),
        *_lineage(F.lit("2024_01"), F.col("event_id")),
    )
    kinds = bronze.select(F.col("shift_id").alias("_id"), "event_type")
    typed = silver.shifts(bronze).join(kinds, F.col("shift_id") == F.col("_id"))
    return typed.groupBy("event_type").agg(
        F.count("*").alias("shift_count"),
        F.count_if(~F.col("hourly_rate_invalid_flag")).alias("valid_rates"),
        F.sum("hourly_rate").cast("long").alias("rate_sum"),
    )


@query("""
    WITH stays AS (
        SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS low, max(CAST(o_orderdate AS DATE)) AS high
        FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey
    )
    SELECT l_returnflag AS incident_type, count(*) AS incident_count,
           count(CASE WHEN s.o_custkey IS NULL OR CAST(l_shipdate AS DATE) < low OR CAST(l_shipdate AS DATE) > high THEN 1 END) AS outside
    FROM lineitem LEFT JOIN stays s ON s.o_custkey = l_suppkey
    GROUP BY 1
""")
def incidents_outside_stays(spark: SparkSession, root: str) -> DataFrame:
    s = Sample(spark, root)
    stays = (
        s.orders.where("o_orderstatus = 'F'")
        .groupBy(F.col("o_custkey").cast("string").alias("resident_id"))
        .agg(F.min(day("o_orderdate")).alias("admit_date"), F.max(day("o_orderdate")).alias("discharge_date"))
    )
    bronze = s.lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("incident_id"),
        F.col("l_suppkey").cast("string").alias("resident_id"),
        F.lit("C001").alias("community_id"),
        iso(day("l_shipdate")).alias("incident_date"),
        F.col("l_returnflag").alias("incident_type"),
        F.lit("3").alias("severity"),
        F.lit("").alias("reported_by"),
        *_lineage(F.lit("2024_01"), F.col("l_orderkey")),
    )
    return (
        silver.incidents(bronze, stays)
        .groupBy("incident_type")
        .agg(F.count("*").alias("incident_count"), F.count_if("outside_residency_flag").alias("outside"))
    )
