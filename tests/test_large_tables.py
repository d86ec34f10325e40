"""What keeps the day fact, the export, the quarantine and the drops within a task's memory as tables grow."""

import datetime

import pytest
from pyspark.sql import functions as F

from lodestrata.catalog import gold as queries
from lodestrata.functions.cleanse import parse_date
from lodestrata.operators.dedupe import with_version_count
from lodestrata.operators.temporal import count_days, deal_segments, explode_segments
from lodestrata.sources import drops

LOW, HIGH = datetime.date(2025, 1, 1), datetime.date(2025, 6, 30)


@pytest.fixture
def sorted_joins(spark):
    """Nothing is small enough to be broadcast by itself."""
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "-1")
    yield
    spark.conf.set(conf, before)


@pytest.fixture
def tables(spark, tmp_path):
    """The sample's tables with a few rows of their own."""
    moment = "timestamp '2024-03-01 10:00:00'"
    rows = {
        "customer": "id c_custkey, id % 25 c_nationkey, concat('N', id) c_name, 1.0D - id % 2 * 2 c_acctbal, "
        "if(id % 3 = 0, 'BUILDING', 'OTHER') c_mktsegment",
        "orders": f"id % 20 o_custkey, id o_orderkey, if(id % 2 = 0, 'F', 'O') o_orderstatus, {moment} o_orderdate, "
        "1000.0D * id o_totalprice, '1-URGENT' o_orderpriority",
        "part": "id p_partkey, concat('Brand#', id % 20 + 1) p_brand, 10.5D p_retailprice",
        "events": f"id event_id, id % 40 user_id, 'click' event_type, {moment} ts",
        "lineitem": f"id % 70 l_orderkey, id l_linenumber, {moment} l_shipdate, 'O' l_linestatus",
    }
    for name, columns in rows.items():
        spark.sql(f"SELECT {columns} FROM range(100)").coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_segments_are_dealt_by_their_days(spark):
    """300 stays of a month: one task per month before, whatever it holds."""
    segments = spark.range(300).select(
        F.col("id").cast("string").alias("k"), F.lit(datetime.date(2025, 1, 1)).alias("_from"), F.lit(datetime.date(2025, 1, 31)).alias("_to")
    )
    dealt = explode_segments(deal_segments(segments, "k", F.lit(LOW), F.lit(HIGH), 300 * 31, per_task=100))
    per_task = dealt.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.count_distinct("date").alias("folders"))
    assert per_task.agg(F.max("folders"), F.max("n") < 1000).first() == (7, True)
    expected = explode_segments(segments)
    assert dealt.count() == expected.count() and dealt.exceptAll(expected).isEmpty()


def test_segments_of_every_length_keep_their_days(spark):
    rows = [(str(i), LOW + datetime.timedelta(i), min(HIGH, LOW + datetime.timedelta(i + i * 7 % 29))) for i in range(181)]
    segments = spark.createDataFrame([*rows, (None, HIGH, HIGH)], "k string, _from date, _to date")
    dealt = explode_segments(deal_segments(segments, "k", F.lit(LOW), F.lit(HIGH), 0))
    expected = explode_segments(segments)
    assert dealt.columns == expected.columns
    assert dealt.count() == expected.count() and dealt.exceptAll(expected).isEmpty()


def test_count_days(spark):
    day = lambda text: text and datetime.date.fromisoformat(text)
    stays = [("2024-12-30", "2025-01-02"), ("2025-06-29", None), (None, "2025-01-01"), ("2025-07-01", None), ("2025-03-02", "2025-03-01")]
    df = spark.createDataFrame([tuple(map(day, s)) for s in stays], "a date, b date")
    assert count_days(df, "a", "b", F.lit(LOW), F.lit(HIGH)) == 2 + 2 + 1
    assert count_days(df.limit(0), "a", "b", F.lit(LOW), F.lit(HIGH)) == 0


def test_facts_are_built_once_for_both_exports(spark, tables, monkeypatch):
    exported = []
    export = queries.export_gold
    monkeypatch.setattr(queries, "export_gold", lambda model, folder: exported.append(model) or export(model, folder))
    counts = {row["name"]: row["row_count"] for row in queries.gold_export(spark, tables).collect()}
    assert counts["fact_lease"] == 20 and counts["fact_occupancy_monthly"] == 84 and counts["fact_incident"] > 0
    for name, df in exported[1].items():
        if name.startswith("fact_"):
            assert not {"Join", "Window", "Aggregate"} & set(_plan(df).replace("(", " ").split()), name
            assert "Exchange" not in _plan(df), name


def test_rows_that_multiply_are_spread_first(spark, tables):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    layers = queries.Layers(spark, tables)
    assert layers.bronze_units.rdd.getNumPartitions() == parts
    assert layers.bronze_residents.rdd.getNumPartitions() == 2 * parts
    assert layers.bronze_units.count() == 600 and layers.bronze_residents.count() == 650


def test_rejection_view_counts(spark, tables):
    found = {row["category"]: row["row_count"] for row in queries.rejection_view(spark, tables).collect()}
    assert found["resident_conflicts"] == 50 and found["invalid_unit_communities"] == 180 and found["conflicting_leads"] == 60


def test_version_counts_are_dealt_once(spark, sorted_joins):
    rows = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "k string")
    counted = with_version_count(rows, ["k"], "n")
    assert _plan(counted).count("Exchange hashpartitioning") == 2
    assert sorted(map(tuple, counted.collect()), key=str) == [("a", 2), ("a", 2), ("b", 1), (None, 2), (None, 2)]


def test_plain_dates_are_those_the_expressions_find(spark):
    texts = ["2025-01-02", "\t202-01-02", "2025-01-2T", "+202-01-02", "0000-01-01", "9999-12-31", "2025-02-30", "2025/01/02", "12/31/2025"]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(parse_date(F.col("t")).cast("string").alias("d"))
    assert [r.d for r in found.collect()] == [
        "2025-01-02", "0202-01-02", None, None, "0000-01-01", "9999-12-31", None, "2025-01-02", "2025-12-31"
    ]


def test_headers_are_found_without_a_sort_of_all_lines(spark, tmp_path, monkeypatch):
    """Blank lines come first, a header comes late, and files share a task."""
    files = {"a.csv": "\n  \nid,name\n1,x\n", "b.csv": "id,name\n" * 3, "c.csv": "z\n", "empty.csv": "", "blank.csv": "\n \n"}
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    paths = sorted(f"file:{tmp_path / name}" for name in files)
    plans = []
    frame = type(spark.range(0))
    iterate = frame.toLocalIterator
    monkeypatch.setattr(frame, "toLocalIterator", lambda self, *a: plans.append(_plan(self)) or iterate(self, *a))
    found = {names: sorted(of) for names, of in drops._headers(spark, paths).items()}
    assert found == {("id", "name"): [f"file:{tmp_path}/a.csv", f"file:{tmp_path}/b.csv"], ("z",): [f"file:{tmp_path}/c.csv"]}
    assert plans and "Sort" not in plans[0]
