"""Every registered query against its SQL on the smallest sample."""

import math
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry_module  # noqa: E402
from lodestrata.catalog import ORACLES, QUERIES  # noqa: E402

ROOT = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not ROOT.exists(), reason="sample tables are not here")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in ROOT.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_sql(spark, oracle, name):
    df = QUERIES[name](spark, str(ROOT))
    cursor = oracle.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert table(df.columns, df.collect()) == table(columns, cursor.fetchall())


SPREAD = ["candidate_ranks", "hot_group_ranks", "best_supported_candidate", "version_counts", "quarantine_split", "as_of_for_events", "fact_event_enriched"]


@pytest.mark.parametrize("name", SPREAD)
def test_plain_shuffles_give_the_same(spark, oracle, name):
    """The same answer without broadcasts and without adaptive execution."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    saved = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        test_query_agrees_with_its_sql(spark, oracle, name)
    finally:
        for key, value in saved.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_queries_without_sql_return_rows(spark):
    for name in sorted(set(QUERIES) - set(ORACLES)):
        assert QUERIES[name](spark, str(ROOT)).count() > 0


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns[0] and df.count() > 0
