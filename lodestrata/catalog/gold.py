"""The pipeline's silver, quarantine and gold builders over the sample tables, cast into the shapes of the drops.

Customers are residents with a snapshot a month, finished orders are changes of care, parts are units, events are incidents.
"""

from __future__ import annotations

from functools import cached_property, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.catalog.base import Sample, day, iso, query
from lodestrata.catalog.layers import _lineage
from lodestrata.operators.quarantine import summary_query
from lodestrata.plans import gold, silver
from lodestrata.plans.quarantine import quarantine_tables
from lodestrata.plans.refresh import PARTITIONS, export_gold, import_gold, side_by_side
from lodestrata.session import scratch_folder
from lodestrata.sources.tables import catalog_view, published_catalog_view, quoted
from lodestrata.sources.versions import read_published, read_version, write_version

VIEWS = "lodestrata_sample"
MONTHS = range(1, 7)


def _community(number: Column) -> Column:
    return F.concat(F.lit("C"), F.lpad(number.cast("string"), 3, "0"))


def _new_year(plus: Column) -> Column:
    return F.date_add(F.lit("2025-01-01").cast("date"), plus.cast("int"))


def _level(number: Column) -> Column:
    """The three levels as drops spell them."""
    return F.get(F.array(F.lit(" IL"), F.lit("assisted"), F.lit("Memory ")), number.cast("int"))


class Layers(Sample):
    """Bronze tables in the shape of the drops, and what the pipeline makes of them."""

    def _dealt(self, table: DataFrame, key: str, *columns: str) -> DataFrame:
        """Columns of a table whose rows are about to multiply, on as many tasks as a shuffle has: its file is small, and one task's."""
        return table.select(key, *columns).repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")), key)

    def stored(self, df: DataFrame) -> DataFrame:
        """A table that is used more than once, as the refresh stores it."""
        return read_version(self.spark, write_version(df, scratch_folder(self.spark)), df.columns, df.schema)

    @cached_property
    def bronze_residents(self) -> DataFrame:
        key, none = F.col("c_custkey"), F.lit(None).cast("string")
        month = F.explode(F.array(*map(F.lit, MONTHS))).alias("month")
        admitted = _new_year(key % 120)
        left = F.when(F.col("c_mktsegment") == "BUILDING", iso(_new_year(key % 120 + 40)))
        customers = self._dealt(self.customer, "c_custkey", "c_nationkey", "c_name", "c_acctbal", "c_mktsegment")
        snapshots = customers.select(
            key,
            _community(F.col("c_nationkey") % 14 + 1).alias("community_id"),
            F.col("c_name").alias("last_name"),
            iso(admitted).alias("admit_date"),
            left.alias("discharge_date"),
            "c_acctbal",
            month,
        )
        namesake = snapshots.where((F.col("month") == 3) & (F.col("c_acctbal") < 0)).withColumn("last_name", F.lit("Namesake"))
        both = snapshots.withColumn("row", key).unionByName(namesake.withColumn("row", -key - 1))
        return both.select(
            key.cast("string").alias("resident_id"),
            "community_id",
            none.alias("first_name"),
            "last_name",
            none.alias("dob"),
            none.alias("gender"),
            "admit_date",
            "discharge_date",
            _level((key + F.col("month")) % 3).alias("care_level"),
            F.lit("3").alias("acuity_score"),
            none.alias("mobility_status"),
            *_lineage(F.format_string("2025_%02d", "month"), F.col("row").cast("long")),
        )

    @cached_property
    def bronze_changes(self) -> DataFrame:
        finished = self.orders.where(F.col("o_orderstatus") == "F")
        return finished.select(
            F.col("o_custkey").cast("string").alias("resident_id"),
            iso(_new_year(F.col("o_orderkey") % 200)).alias("change_date"),
            F.lit("").alias("previous_level"),
            _level(F.col("o_orderkey") % 3).alias("new_level"),
            F.concat(F.lit(" "), F.col("o_orderpriority")).alias("reason"),
            *_lineage(F.lit("2025_01"), F.col("o_orderkey")),
        )

    @cached_property
    def bronze_units(self) -> DataFrame:
        return self._dealt(self.part, "p_partkey", "p_brand", "p_retailprice").select(
            F.col("p_partkey").cast("string").alias("unit_id"),
            _community(F.substring("p_brand", 7, 10).cast("int")).alias("community_id"),
            F.lit("al").alias("unit_type"),
            F.col("p_retailprice").cast("decimal(12,2)").cast("string").alias("monthly_rent"),
            F.explode(F.array(*(F.lit(f"2025-{m:02d}-01") for m in MONTHS))).alias("snapshot_date"),
            *_lineage(F.lit("2025_01"), F.col("p_partkey")),
        )

    @cached_property
    def bronze_incidents(self) -> DataFrame:
        return self.events.select(
            F.col("event_id").cast("string").alias("incident_id"),
            F.col("user_id").cast("string").alias("resident_id"),
            _community(F.col("event_id") % 14 + 1).alias("community_id"),
            iso(_new_year(F.col("event_id") % 181)).alias("incident_date"),
            F.col("event_type").alias("incident_type"),
            (F.col("event_id") % 5 + 1).cast("string").alias("severity"),
            F.lit("").alias("reported_by"),
            *_lineage(F.lit("2025_01"), F.col("event_id")),
        )

    @cached_property
    def bronze_leads(self) -> DataFrame:
        none = F.lit(None).cast("string")
        return self.lineitem.select(
            F.col("l_orderkey").cast("string").alias("lead_id"),
            F.lit("C001").alias("community_id"),
            none.alias("lead_source"),
            *(iso(day("l_shipdate")).alias(c) for c in ("created_date", "tour_date", "deposit_date", "move_in_date")),
            F.col("l_linestatus").alias("status"),
            none.alias("lost_reason"),
            *_lineage(F.lit("2024_01"), F.col("l_linenumber").cast("long")),
        )

    @cached_property
    def bronze_leases(self) -> DataFrame:
        moved = F.when(F.col("o_orderstatus") == "F", iso(day("o_orderdate")))
        return self.orders.select(
            F.col("o_custkey").cast("string").alias("lease_id"),
            F.col("o_orderkey").cast("string").alias("resident_id"),
            F.lit(" u1 ").alias("unit_id"),
            F.lit("C001").alias("community_id"),
            iso(day("o_orderdate")).alias("move_in_date"),
            moved.alias("move_out_date"),
            F.when(F.col("o_totalprice") > 250000, F.col("o_orderstatus")).alias("move_out_reason"),
            F.col("o_totalprice").cast("decimal(12,2)").cast("string").alias("monthly_rate"),
            *_lineage(F.date_format("o_orderdate", "yyyy_MM"), F.col("o_orderkey")),
        )

    @cached_property
    def candidates(self) -> DataFrame:
        return silver.resident_candidates(self.bronze_residents)

    @cached_property
    def residents(self) -> DataFrame:
        return self.stored(silver.residents(self.candidates))

    @cached_property
    def stays(self) -> DataFrame:
        return self.stored(silver.resident_stays(self.residents))

    @cached_property
    def units(self) -> DataFrame:
        return silver.units(self.bronze_units)

    @cached_property
    def incidents(self) -> DataFrame:
        return silver.incidents(self.bronze_incidents, self.stays)

    @cached_property
    def resident_days(self) -> DataFrame:
        """The day fact as it is stored: by day, in one write."""
        days = gold.fact_resident_day(self.stays, self.residents, silver.care_history(self.bronze_changes))
        folder = scratch_folder(self.spark)
        write_version(days, folder, PARTITIONS["fact_resident_day"])
        return read_published(self.spark, folder).select(*days.columns)

    @cached_property
    def occupancy(self) -> DataFrame:
        dims = gold.dim_community(self.spark), gold.dim_date(self.spark)
        return gold.fact_occupancy_monthly(*dims, self.resident_days, self.units)

    @cached_property
    def valid_incidents(self) -> DataFrame:
        return gold.fact_incident(self.incidents, self.resident_days)

    @cached_property
    def leases(self) -> DataFrame:
        return gold.fact_lease(silver.leases(self.bronze_leases))


@query("""
    SELECT CAST(o_custkey AS VARCHAR) AS resident_id, CAST(DATE '2025-01-01' + CAST(o_orderkey % 200 AS INTEGER) AS VARCHAR) AS change_date,
           CAST(NULL AS VARCHAR) AS previous_level,
           (['Independent Living', 'Assisted Living', 'Memory Care'])[CAST(o_orderkey % 3 AS INTEGER) + 1] AS new_level,
           o_orderpriority AS reason, o_orderkey AS _row_number
    FROM orders WHERE o_orderstatus = 'F'
""")
def silver_care_history(spark: SparkSession, root: str) -> DataFrame:
    history = silver.care_history(Layers(spark, root).bronze_changes)
    return history.select("resident_id", iso("change_date").alias("change_date"), "previous_level", "new_level", "reason", "_row_number")


@query("""
    SELECT CAST(event_id AS VARCHAR) AS review_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS review_date,
           CASE WHEN value >= 10 THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS rating,
           event_type AS review_text, CAST(NULL AS VARCHAR) AS response_text,
           CASE WHEN event_type <> 'click' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS responded_at
    FROM events
""")
def silver_reviews(spark: SparkSession, root: str) -> DataFrame:
    """Ratings that are no numbers and answers without a time become NULL."""
    stars = F.regexp_extract("props", "([0-9]+)", 1)
    answered = F.when(F.col("event_type") == "click", "soon").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    bronze = Sample(spark, root).events.select(
        F.col("event_id").cast("string").alias("review_id"),
        F.lit("C001").alias("community_id"),
        iso(day("ts")).alias("review_date"),
        F.when(F.col("value") >= 10, stars).otherwise("none").alias("rating"),
        F.concat(F.lit(" "), F.col("event_type")).alias("review_text"),
        F.lit("  ").alias("response_text"),
        answered.alias("responded_at"),
        *_lineage(F.lit("2024_01"), F.col("event_id")),
    )
    responded = F.date_format("responded_at", "yyyy-MM-dd HH:mm:ss").alias("responded_at")
    return silver.reviews(bronze).select("review_id", iso("review_date").alias("review_date"), "rating", "review_text", "response_text", responded)


_STAYS = """
    stay AS (
        SELECT c_custkey AS k, printf('C%03d', c_nationkey % 14 + 1) AS community_id,
               DATE '2025-01-01' + CAST(c_custkey % 120 AS INTEGER) AS low,
               CASE WHEN c_mktsegment = 'BUILDING' THEN DATE '2025-01-01' + CAST(c_custkey % 120 + 40 AS INTEGER) END AS high
        FROM customer
    )
"""
_DAYS = _STAYS + """, lived AS (
        SELECT k, community_id, CAST(unnest(generate_series(low, least(coalesce(high, DATE '2025-06-30'), DATE '2025-06-30'),
                                                            INTERVAL 1 DAY)) AS DATE) AS d FROM stay
    ), change AS (
        SELECT o_custkey AS k, DATE '2025-01-01' + CAST(o_orderkey % 200 AS INTEGER) AS d, arg_max(o_orderkey % 3, o_orderkey) AS number
        FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2
    ), days AS (
        SELECT lived.k, lived.community_id, lived.d,
               (['Independent Living', 'Assisted Living', 'Memory Care'])
                 [CAST(coalesce(change.number, (lived.k + month(lived.d)) % 3) AS INTEGER) + 1] AS care_level
        FROM lived ASOF LEFT JOIN change ON lived.k = change.k AND lived.d >= change.d
    )
"""


@query("WITH" + _DAYS + """
    SELECT CAST(k AS VARCHAR) AS resident_id, community_id, CAST(d AS VARCHAR) AS date, care_level, CAST(1 AS INTEGER) AS resident_day_count
    FROM days
""")
def gold_resident_days(spark: SparkSession, root: str) -> DataFrame:
    return Layers(spark, root).resident_days.withColumn("date", iso("date"))


_UNITS = """, unit AS (
        SELECT printf('C%03d', CAST(substr(p_brand, 7) AS INTEGER)) AS community_id, count(DISTINCT p_partkey) AS units
        FROM part GROUP BY 1 HAVING community_id <= 'C014'
    ), month AS (
        SELECT CAST(unnest(generate_series(DATE '2025-01-01', DATE '2025-06-01', INTERVAL 1 MONTH)) AS DATE) AS month_start
    ), community AS (SELECT printf('C%03d', unnest(generate_series(1, 14))) AS community_id),
    monthly AS (
        SELECT c.community_id, m.month_start, last_day(m.month_start) AS month_end,
               (SELECT count(DISTINCT k) FROM days x WHERE x.community_id = c.community_id AND x.d = last_day(m.month_start)) AS occupied,
               coalesce((SELECT units FROM unit u WHERE u.community_id = c.community_id), 0) AS units
        FROM community c, month m
    )
"""


@query("WITH" + _DAYS + _UNITS + """
    SELECT community_id, CAST(month_start AS VARCHAR) AS month_start, CAST(month_end AS VARCHAR) AS month_end,
           occupied AS occupied_resident_count, units AS valid_unit_count,
           CASE WHEN units > 0 THEN round(100.0 * occupied / units, 6) END AS occupancy_proxy_percent, true AS occupancy_is_proxy
    FROM monthly
""")
def gold_occupancy(spark: SparkSession, root: str) -> DataFrame:
    """Six of 181 folders of the day fact are read."""
    return Layers(spark, root).occupancy.withColumns(
        {
            "month_start": iso("month_start"),
            "month_end": iso("month_end"),
            "occupancy_proxy_percent": F.round("occupancy_proxy_percent", 6),
        }
    )


_LEASES = """
    SELECT CAST(o_custkey AS VARCHAR) AS lease_id, CAST(o_orderkey AS VARCHAR) AS resident_id, 'u1' AS unit_id, 'C001' AS community_id,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS move_in_date,
           CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS move_out_date,
           CASE WHEN o_totalprice > 250000 THEN o_orderstatus ELSE 'Unknown' END AS move_out_reason,
           CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS DOUBLE) AS monthly_rate
    FROM orders
    QUALIFY row_number() OVER (
        PARTITION BY o_custkey
        ORDER BY CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END, strftime(o_orderdate, '%Y_%m') DESC, o_orderkey DESC) = 1
"""


@query(_LEASES)
def gold_leases(spark: SparkSession, root: str) -> DataFrame:
    return Layers(spark, root).leases.withColumns(
        {"move_in_date": iso("move_in_date"), "move_out_date": iso("move_out_date"), "monthly_rate": F.col("monthly_rate").cast("double")}
    )


_INCIDENTS = _DAYS + """, happened AS (
        SELECT event_id, user_id, event_type, DATE '2025-01-01' + CAST(event_id % 181 AS INTEGER) AS d FROM events
    )
"""


@query("WITH" + _INCIDENTS + """
    SELECT CAST(event_id AS VARCHAR) AS incident_id, CAST(user_id AS VARCHAR) AS resident_id,
           printf('C%03d', event_id % 14 + 1) AS community_id, CAST(h.d AS VARCHAR) AS incident_date, care_level,
           event_type AS incident_type, CAST(event_id % 5 + 1 AS INTEGER) AS severity
    FROM happened h JOIN days ON days.k = user_id AND days.d = h.d
""")
def gold_incidents(spark: SparkSession, root: str) -> DataFrame:
    return Layers(spark, root).valid_incidents.withColumn("incident_date", iso("incident_date"))


@query("WITH" + _DAYS + """, place AS (
        SELECT printf('C%03d', i) AS community_id, CASE WHEN i <= 5 THEN 'OR' WHEN i <= 9 THEN 'AZ' ELSE 'TX' END AS state_code,
               CASE WHEN i <= 5 THEN 'Pacific Northwest' WHEN i <= 9 THEN 'Southwest' ELSE 'South' END AS region
        FROM (SELECT unnest(generate_series(1, 14)) AS i)
    )
    SELECT 'Community ' || p.community_id AS community_name, state_code, region, true AS geography_is_assumed, care_level,
           CASE care_level WHEN 'Independent Living' THEN 1 WHEN 'Assisted Living' THEN 2 ELSE 3 END AS display_order,
           CAST(year(d) AS BIGINT) AS year, CAST(quarter(d) AS BIGINT) AS quarter, CAST(month(d) AS BIGINT) AS month_number,
           monthname(d) AS month_name, CAST(last_day(d) AS VARCHAR) AS month_end, count(*) AS resident_days
    FROM days JOIN place p ON p.community_id = days.community_id
    GROUP BY ALL
""")
def gold_dimensions(spark: SparkSession, root: str) -> DataFrame:
    """The day fact under every attribute of its three dimensions."""
    layers = Layers(spark, root)
    named = (
        layers.resident_days.groupBy("community_id", "date", "care_level")
        .agg(F.sum("resident_day_count").alias("n"))
        .join(gold.dim_community(spark), "community_id")
        .join(gold.dim_care_level(spark), "care_level")
        .join(gold.dim_date(spark), "date")
    )
    attributes = ["community_name", "state_code", "region", "geography_is_assumed", "care_level", "display_order"]
    attributes += ["year", "quarter", "month_number", "month_name", "month_end"]
    return named.groupBy(*attributes).agg(F.sum("n").alias("resident_days")).withColumn("month_end", iso("month_end"))


_OUTSIDE = """
    SELECT event_id FROM happened h LEFT JOIN stay s ON s.k = h.user_id
    WHERE s.k IS NULL OR h.d < s.low OR h.d > s.high
"""
_REJECTS = "WITH" + _INCIDENTS + f""", rejects AS (
        SELECT 'resident_conflicts' AS category, CAST(c_custkey AS VARCHAR) AS id,
               'Unsupported duplicate resident/month candidate' AS reason FROM customer WHERE c_acctbal < 0
        UNION ALL
        SELECT 'invalid_unit_communities', CAST(p_partkey AS VARCHAR), 'Community ID outside C001-C014'
        FROM part, generate_series(1, 6) WHERE CAST(substr(p_brand, 7) AS INTEGER) > 14
        UNION ALL
        SELECT 'conflicting_leads', CAST(l_orderkey AS VARCHAR), 'Conflicting records share the same lead ID' FROM lineitem
        WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)
        UNION ALL
        SELECT 'incidents_outside_residency', CAST(event_id AS VARCHAR), 'Incident date outside resident stay interval'
        FROM ({_OUTSIDE})
    )
"""
_KEYS = {
    "resident_conflicts": "resident_id",
    "invalid_unit_communities": "unit_id",
    "conflicting_leads": "lead_id",
    "incidents_outside_residency": "incident_id",
}


def _rejects(layers: Layers) -> dict[str, DataFrame]:
    prospects = silver.lead_candidates(layers.bronze_leads)
    return quarantine_tables(layers.candidates, layers.units, prospects, layers.incidents)


@query(_REJECTS + "SELECT category, id, reason, count(*) AS row_count, true AS time_known FROM rejects GROUP BY ALL")
def quarantined_rows(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the four quarantine tables by id."""
    lines = [
        held.groupBy(F.lit(name).alias("category"), F.col(_KEYS[name]).alias("id"), F.col("_quarantine_reason").alias("reason")).agg(
            F.count("*").alias("row_count"), F.every(F.col("_quarantined_at_utc").isNotNull()).alias("time_known")
        )
        for name, held in _rejects(Layers(spark, root)).items()
    ]
    return lines[0].unionAll(lines[1]).unionAll(lines[2]).unionAll(lines[3])


@query(_REJECTS + "SELECT category, count(*) AS row_count FROM rejects GROUP BY category")
def rejection_view(spark: SparkSession, root: str) -> DataFrame:
    """The summary as a lasting view of the catalog, over lasting views of stored quarantine tables."""
    folder = scratch_folder(spark)
    rejects = _rejects(Layers(spark, root))
    stored = side_by_side({name: partial(write_version, held, f"{folder}/{name}") for name, held in rejects.items()})
    for name, held in rejects.items():
        published_catalog_view(spark, f"{VIEWS}.{name}", stored[name], held.columns)
    catalog_view(spark, f"{VIEWS}.rejection_summary", summary_query({name: quoted(f"{VIEWS}.{name}") for name in _KEYS}))
    return spark.table(f"{VIEWS}.rejection_summary")


@query("SELECT o_orderpriority, o_orderstatus, count(*) AS order_count FROM orders GROUP BY ALL")
def published_view_by_name(spark: SparkSession, root: str) -> DataFrame:
    """Allow-listed columns under a qualified name that any session reads."""
    name = f"{VIEWS}.orders_shown"
    published_catalog_view(spark, name, f"{root}/orders.parquet", ["o_orderpriority", "o_orderstatus"])
    return spark.sql(f"SELECT o_orderpriority, o_orderstatus, count(*) AS order_count FROM {name} GROUP BY ALL")


@query("WITH" + _INCIDENTS + _UNITS + f""", counted AS (
        SELECT 'dim_date' AS name, 181 AS row_count UNION ALL SELECT 'dim_community', 14 UNION ALL SELECT 'dim_care_level', 3
        UNION ALL SELECT 'fact_resident_day', count(*) FROM days UNION ALL SELECT 'fact_occupancy_monthly', count(*) FROM monthly
        UNION ALL SELECT 'fact_lease', count(*) FROM ({_LEASES})
        UNION ALL SELECT 'fact_incident', count(*) FROM happened h JOIN days ON days.k = user_id AND days.d = h.d
    )
    SELECT name, CAST(row_count AS BIGINT) AS row_count, true AS same_columns FROM counted
""")
def gold_export(spark: SparkSession, root: str) -> DataFrame:
    """The seven gold tables exported twice and imported: the later release, with the columns of the tables."""
    layers = Layers(spark, root)
    # As in a refresh, a fact is built once, and what is exported is the stored table.
    base = side_by_side({"fact_resident_day": lambda: layers.resident_days, "fact_lease": lambda: layers.stored(layers.leases)})
    derived = side_by_side(
        {
            "fact_occupancy_monthly": lambda: layers.stored(layers.occupancy),
            "fact_incident": lambda: layers.stored(layers.valid_incidents),
        }
    )
    tables = {
        "dim_date": gold.dim_date(spark),
        "dim_community": gold.dim_community(spark),
        "dim_care_level": gold.dim_care_level(spark),
        **base,
        **derived,
    }
    folder = scratch_folder(spark)
    export_gold({name: df.limit(1) for name, df in tables.items()}, folder)
    export_gold(tables, folder)
    model = import_gold(spark, folder)
    lines = [
        model[name].agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("name"), "row_count", F.lit(model[name].columns == df.columns).alias("same_columns")
        )
        for name, df in tables.items()
    ]
    united = lines[0]
    for line in lines[1:]:
        united = united.unionAll(line)
    return united

