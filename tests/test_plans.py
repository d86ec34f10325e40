"""What the physical plans of all queries have in common."""

import re
from pathlib import Path

import pytest

from lodestrata.catalog import QUERIES
from lodestrata.catalog.gold import Layers
from lodestrata.plans import gold, reports

ROOT = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not ROOT.exists(), reason="sample tables are not here")

COLUMNS = {"lineitem": 11, "orders": 6, "events": 6, "customer": 5}
WHOLE_ROWS = {"snapshot_fingerprint"}  # hashes every column


@pytest.fixture(scope="module")
def unbroadcast(spark):
    """Plans as they are when no side is small enough to broadcast by itself."""
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(unbroadcast, name):
    plan = QUERIES[name](unbroadcast, str(ROOT))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert not re.search(r"PythonUDF|ArrowEvalPython|MapInPandas|FlatMapGroups", plan)
    for columns, path in re.findall(r"FileScan parquet \[(.*?)\].*?Location: \S+\(1 paths\)\[(.*?)\]", plan):
        table = Path(path).stem
        if name not in WHOLE_ROWS and table in COLUMNS:
            read = [c for c in columns.split(",") if c]
            assert len(read) < COLUMNS[table], f"{table}: {columns}"


def test_nothing_is_broadcast_by_force(unbroadcast):
    for name, query in QUERIES.items():
        plan = query(unbroadcast, str(ROOT))._jdf.queryExecution().optimizedPlan().toString()
        assert "strategy=broadcast" not in plan, name


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _depth(line: str) -> int:
    return len(re.match(r"[ :+\-|]*", line).group())


def _below_aggregate(plan: str, text: str, keys: str) -> bool:
    """Whether a line with `text` stands under an aggregate whose keys begin with `keys`."""
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if re.search(rf"Aggregate \[{keys}", line):
            for under in lines[i + 1 :]:
                if _depth(under) <= _depth(line):
                    break
                if text in under:
                    return True
    return False


@pytest.mark.parametrize(("name", "keys"), [("role_filter_region", "o_custkey"), ("role_filter_entity", "o_custkey"), ("kpi_by_label", "user_id")])
def test_filters_reach_the_raw_fact(spark, name, keys):
    assert _below_aggregate(_optimized(QUERIES[name](spark, str(ROOT))), "LeftSemi", keys)


def test_groups_and_total_read_a_fact_once(spark):
    """User days, errors and purchases are three facts made of events; occupancy reads orders."""
    plan = _optimized(QUERIES["entity_matrix"](spark, str(ROOT)))
    assert len(re.findall(r"Relation \[.*event_type", plan)) == 3 and len(re.findall(r"Relation \[.*o_orderdate", plan)) == 1


@pytest.mark.parametrize(("name", "tables"), [("grain_uniqueness", ["l_orderkey", "o_orderkey", "event_id"]), ("not_null_and_check", ["l_orderkey", "o_orderkey", "c_custkey"])])
def test_checks_read_each_table_once(spark, name, tables):
    plan = _optimized(QUERIES[name](spark, str(ROOT)))
    assert [len(re.findall(rf"Relation \[{first}|Relation \[\S*,?{first}#", plan)) for first in tables] == [1, 1, 1]


def test_month_ends_are_found_by_folder(spark):
    plan = Layers(spark, str(ROOT)).occupancy._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[isnotnull\(date#\d+\), \(date#\d+ = last_day\(date#\d+\)\)\]", plan)


def test_export_of_days_moves_no_row(spark):
    days = Layers(spark, str(ROOT)).resident_days
    assert days.columns == ["resident_id", "community_id", "date", "care_level", "resident_day_count"]
    assert "Exchange" not in days._jdf.queryExecution().executedPlan().toString()


def test_windows_read_only_their_days(spark):
    layers = Layers(spark, str(ROOT))
    tables = {"dim_date": gold.dim_date(spark), "dim_community": gold.dim_community(spark), "fact_resident_day": layers.resident_days, "fact_lease": layers.leases}
    rate = reports.measures(gold.gold_model(tables), ("move_out_rate",))
    assert re.search(r"PartitionFilters: \[isnotnull\(date#\d+\), \(date#\d+ >=", rate._jdf.queryExecution().executedPlan().toString())


def test_ties_need_no_single_window(spark):
    plan = QUERIES["completed_in_range"](spark, str(ROOT))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "TakeOrderedAndProject" in plan
