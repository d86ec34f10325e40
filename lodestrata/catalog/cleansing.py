"""Cleansing functions over whole columns made dirty in a known way."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.catalog.base import Sample, iso, query
from lodestrata.functions import (
    blank_to_null,
    bounded_int,
    full_match,
    join_text,
    map_variants,
    month_from_period,
    out_of_range_or_null,
    parse_date,
    parse_keyed_value,
    parse_timestamp,
    try_int,
)


@query("""
    WITH known AS (
        SELECT CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS segment, c_nationkey, c_name
        FROM customer
    )
    SELECT segment, count(*) AS customer_count, count(DISTINCT c_nationkey) AS nation_count,
           max(c_name) AS last_name
    FROM known
    GROUP BY segment
""", name="blank_to_null")
def blank_to_null_keys(spark: SparkSession, root: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    padded = (
        F.when(F.col("c_acctbal") < 0, F.lit("   "))
        .when(F.col("c_nationkey") < 12, F.concat(F.lit("  "), segment, F.lit(" ")))
        .otherwise(segment)
    )
    return (
        Sample(spark, root)
        .customer.groupBy(blank_to_null(padded).alias("segment"))
        .agg(
            F.count("*").alias("customer_count"),
            F.count_distinct("c_nationkey").alias("nation_count"),
            F.max(F.trim(F.concat(F.lit(" "), "c_name"))).alias("last_name"),
        )
    )


@query("""
    SELECT CASE WHEN NOT (o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '5-LOW'))
                THEN strftime(o_orderdate, '%Y-%m') END AS order_month,
           count(*) AS order_count,
           CASE WHEN max(CASE WHEN o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '5-LOW') THEN 1 ELSE 0 END) = 0
                THEN CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) END AS first_day,
           CASE WHEN max(CASE WHEN o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '5-LOW') THEN 1 ELSE 0 END) = 0
                THEN CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) END AS last_day
    FROM orders
    GROUP BY 1
""")
def parse_date_mixed(spark: SparkSession, root: str) -> DataFrame:
    status, priority, moment = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderdate")
    text = (
        F.when(status == "F", F.date_format(moment, "yyyy-MM-dd"))
        .when((status == "O") & priority.isin("1-URGENT", "2-HIGH"), F.date_format(moment, "M/d/yyyy"))
        .when(status == "O", F.date_format(moment, "MM/dd/yyyy"))
        .when(priority == "1-URGENT", F.lit(""))
        .when(priority == "5-LOW", F.lit("not-a-date"))
        .when(priority == "3-MEDIUM", F.date_format(moment, "yyyy/M/d"))
        .otherwise(F.concat(F.lit("  "), F.date_format(moment, "yyyy-MM-dd"), F.lit(" ")))
    )
    parsed = Sample(spark, root).orders.select(parse_date(text).alias("parsed"))
    return parsed.groupBy(F.date_format("parsed", "yyyy-MM").alias("order_month")).agg(
        F.count("*").alias("order_count"),
        iso(F.min("parsed")).alias("first_day"),
        iso(F.max("parsed")).alias("last_day"),
    )


SEGMENT_SPELLINGS = {
    "auto": "Automobile",
    "automobile": "Automobile",
    "bldg": "Building",
    "building": "Building",
    "hh": "Household",
    "household": "Household",
    "mach": "Machinery",
    "machinery": "Machinery",
}


@query("""
    SELECT CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Automobile' WHEN 'BUILDING' THEN 'Building'
                             WHEN 'HOUSEHOLD' THEN 'Household' WHEN 'MACHINERY' THEN 'Machinery' END AS segment,
           count(*) AS customer_count,
           CAST(sum(CAST(c_acctbal AS DECIMAL(18, 2))) AS DOUBLE) AS balance
    FROM customer
    GROUP BY 1
""")
def normalize_variants(spark: SparkSession, root: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    short = (
        F.when(segment == "AUTOMOBILE", "Auto")
        .when(segment == "BUILDING", "BLDG")
        .when(segment == "HOUSEHOLD", "hh")
        .when(segment == "MACHINERY", "Mach")
        .otherwise("other")
    )
    raw = (
        F.when(F.col("c_nationkey") < 8, F.concat(F.lit(" "), segment))
        .when(F.col("c_nationkey") < 16, short)
        .otherwise(F.initcap(segment))
    )
    return (
        Sample(spark, root)
        .customer.groupBy(map_variants(raw, SEGMENT_SPELLINGS).alias("segment"))
        .agg(
            F.count("*").alias("customer_count"),
            F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("balance"),
        )
    )


@query("""
    WITH raw AS (
        SELECT p_brand, CASE p_brand WHEN 'Brand#1' THEN 'x' WHEN 'Brand#2' THEN ''
                                     WHEN 'Brand#3' THEN p_size || '.5' ELSE CAST(p_size AS VARCHAR) END AS txt
        FROM part
    ), typed AS (SELECT p_brand, txt, TRY_CAST(txt AS INTEGER) AS num FROM raw)
    SELECT p_brand, count(*) AS part_count,
           count(CASE WHEN num >= 1 AND num <= 10 THEN 1 END) AS kept_count,
           count(CASE WHEN num < 1 OR num > 10 THEN 1 END) AS invalid_count,
           count(DISTINCT txt) AS raw_values,
           CAST(coalesce(sum(CASE WHEN num >= 1 AND num <= 10 THEN num END), 0) AS BIGINT) AS kept_sum
    FROM typed
    GROUP BY p_brand
""")
def bounded_int_flag(spark: SparkSession, root: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    text = (
        F.when(F.col("p_brand") == "Brand#1", "x")
        .when(F.col("p_brand") == "Brand#2", "")
        .when(F.col("p_brand") == "Brand#3", F.concat(size, F.lit(".5")))
        .otherwise(size)
    )
    kept, invalid = bounded_int(F.col("raw"), 1, 10)
    return (
        Sample(spark, root)
        .part.select("p_brand", text.alias("raw"))
        .select("p_brand", "raw", kept.alias("kept"), invalid.alias("invalid"))
        .groupBy("p_brand")
        .agg(
            F.count("*").alias("part_count"),
            F.count("kept").alias("kept_count"),
            F.count_if("invalid").alias("invalid_count"),
            F.count_distinct("raw").alias("raw_values"),
            F.coalesce(F.sum("kept"), F.lit(0)).cast("long").alias("kept_sum"),
        )
    )


@query("""
    WITH stored AS (
        SELECT event_type,
               CASE event_type
                    WHEN 'click' THEN CAST(props->>'$.k' AS DECIMAL(10, 2))
                    WHEN 'error' THEN CAST(props->>'$.k' AS DECIMAL(10, 2)) END AS rate
        FROM events
    )
    SELECT event_type, count(*) AS event_count, count(rate) AS parsed_count,
           count(CASE WHEN rate IS NULL OR rate < 0 OR rate > 50 THEN 1 END) AS invalid_count,
           CAST(coalesce(sum(rate), 0) AS DOUBLE) AS rate_sum
    FROM stored
    GROUP BY event_type
""")
def keyed_json_rate(spark: SparkSession, root: str) -> DataFrame:
    quoted = F.replace("props", F.lit('"'), F.lit("'"))
    document = (
        F.when(F.col("event_type") == "signup", F.concat(quoted, F.lit(" and more")))
        .when(F.col("event_type") == "view", F.translate(quoted, "0123456789", "xxxxxxxxxx"))
        .otherwise(quoted)
    )
    key = (
        F.when(F.col("event_type") == "error", F.lit("k"))
        .when(F.col("event_type") == "purchase", F.lit("missing"))
        .otherwise(F.lit(" k "))
    )
    return (
        Sample(spark, root)
        .events.select("event_type", parse_keyed_value(document, key).alias("rate"))
        .groupBy("event_type")
        .agg(
            F.count("*").alias("event_count"),
            F.count("rate").alias("parsed_count"),
            F.count_if(out_of_range_or_null(F.col("rate"), 0, 50)).alias("invalid_count"),
            F.coalesce(F.sum("rate"), F.lit(0)).cast("double").alias("rate_sum"),
        )
    )


@query("""
    SELECT CASE WHEN p_type = 'PROMO' THEN 'unknown'
                WHEN p_size > 45 OR CAST(substr(p_brand, 7) AS INTEGER) > 14 THEN 'invalid'
                ELSE 'valid' END AS outcome,
           count(*) AS part_count, min(p_partkey) AS first_part, max(p_partkey) AS last_part
    FROM part
    GROUP BY 1
""")
def regex_validity_flag(spark: SparkSession, root: str) -> DataFrame:
    brand = (
        F.when(F.col("p_type") == "PROMO", F.lit(None).cast("string"))
        .when(F.col("p_size") > 45, F.concat("p_brand", F.lit("\n")))
        .otherwise(F.col("p_brand"))
    )
    invalid = ~full_match(brand, "Brand#([1-9]|1[0-4])")
    outcome = F.when(invalid, "invalid").when(~invalid, "valid").otherwise("unknown")
    return (
        Sample(spark, root)
        .part.groupBy(outcome.alias("outcome"))
        .agg(
            F.count("*").alias("part_count"),
            F.min("p_partkey").alias("first_part"),
            F.max("p_partkey").alias("last_part"),
        )
    )


@query("""
    SELECT o_orderpriority,
           count(*) AS order_count,
           count(CASE WHEN o_orderpriority <> '5-LOW' THEN 1 END) AS money_count,
           CAST(coalesce(sum(CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_totalprice AS DECIMAL(12, 2)) END), 0)
                AS DOUBLE) AS money_sum,
           count(CASE WHEN o_orderpriority <> '1-URGENT' THEN 1 END) AS moment_count,
           CAST(sum(CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 0 WHEN '3-MEDIUM' THEN 4
                    ELSE CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END) AS BIGINT) AS rating_sum,
           count(DISTINCT date_trunc('month', o_orderdate)) AS period_count,
           min(strftime(o_orderdate, '%Y-%m-01')) AS first_period
    FROM orders
    GROUP BY o_orderpriority
""")
def typed_casts(spark: SparkSession, root: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    money = F.when(priority == "5-LOW", "n/a").otherwise(F.col("o_totalprice").cast("decimal(12,2)").cast("string"))
    moment = F.when(priority == "1-URGENT", "2025").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    rating = (
        F.when(priority == "3-MEDIUM", "3.5")
        .when(priority == "4-NOT SPECIFIED", "none")
        .otherwise(F.substring("o_orderpriority", 1, 1))
    )
    typed = Sample(spark, root).orders.select(
        "o_orderpriority",
        money.try_cast("decimal(12,2)").alias("money"),
        parse_timestamp(moment).alias("moment"),
        try_int(rating).alias("rating"),
        month_from_period(F.date_format("o_orderdate", "yyyy_MM")).alias("period"),
    )
    return typed.groupBy("o_orderpriority").agg(
        F.count("*").alias("order_count"),
        F.count("money").alias("money_count"),
        F.coalesce(F.sum("money"), F.lit(0)).cast("double").alias("money_sum"),
        F.count("moment").alias("moment_count"),
        F.coalesce(F.sum("rating"), F.lit(0)).cast("long").alias("rating_sum"),
        F.count_distinct("period").alias("period_count"),
        iso(F.min("period")).alias("first_period"),
    )


@query("""
    SELECT s_suppkey, s_name, s_nationkey,
           'Supplier ' || s_name || CASE WHEN s_acctbal < 0 THEN ' in debt' ELSE '' END AS label,
           true AS is_assumed
    FROM supplier
""")
def project_except_plus(spark: SparkSession, root: str) -> DataFrame:
    note = F.when(F.col("s_acctbal") < 0, F.lit(" in debt"))
    return (
        Sample(spark, root)
        .supplier.withColumns(
            {"label": join_text(F.lit("Supplier "), F.col("s_name"), note), "is_assumed": F.lit(True)}
        )
        .drop("s_acctbal")
    )
