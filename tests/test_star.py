import datetime as dt

import pytest
from pyspark.sql import functions as F

from lodestrata.functions import safe_ratio
from lodestrata.operators.quality import (
    Check,
    ForeignKey,
    NotNull,
    QualityError,
    RowCount,
    Unique,
    raise_on_counts,
    raise_on_issues,
    raise_on_mismatch,
    reconcile,
    row_metrics,
    run_checks,
    snapshot_hash,
    table_counts,
)
from lodestrata.operators.quarantine import rejection_summary, split_on_flag
from lodestrata.operators.ranking import top_n_per_group, top_n_with_ties, with_total
from lodestrata.plans.measures import Amount, Rate, Total, evaluate, trailing_series
from lodestrata.operators.star import Bridged, Relation, StarModel, dense_spine, one_row, orphan_count, orphans
from lodestrata.sources.tables import mapping, publish, published_view, read_model


@pytest.fixture(scope="module")
def model(spark):
    dim = mapping(spark, [("a", "north"), ("b", "north"), ("c", "south")], "id string, region string")
    fact = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4), ("x", 5), (None, 6)], "id string, v int")
    other = spark.createDataFrame([(1,), (2,)], "v int")
    return StarModel({"dim": dim, "fact": fact, "other": other}, (Relation("fact", "id", "dim", "id"),))


def test_filters_travel_to_related_facts_only(model):
    north = model.filtered({"dim": F.col("region") == "north"})
    assert sorted(r.v for r in north["fact"].collect()) == [1, 2, 3]
    assert north["other"].count() == 2
    assert model["fact"].count() == 6


def test_attributes_come_over_relations(model):
    df = model.with_attributes("fact", ["dim.region"])
    assert {(r["dim.region"], r["n"]) for r in df.groupBy("`dim.region`").agg(F.count("*").alias("n")).collect()} == {("north", 3), ("south", 1)}
    with pytest.raises(ValueError, match="no relation"):
        model.with_attributes("other", ["dim.region"])


def test_orphans_include_null_keys(model):
    assert sorted(r.v for r in orphans(model["fact"], "id", model["dim"], "id").collect()) == [5, 6]
    assert orphan_count(model["fact"], "id", model["dim"], "id").first()[0] == 2


def test_mapping_is_a_local_relation(spark, model):
    plan = model["fact"].join(model["dim"], "id")._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" in plan and "BroadcastHashJoin" in plan


def test_dense_spine_fills_gaps(spark):
    members = spark.createDataFrame([("a",), ("b",)], "id string")
    periods = spark.createDataFrame([(1, 10), (2, 20)], "p int, q int")
    counts = spark.createDataFrame([("a", 20, 7)], "id string, q int, n int")
    got = dense_spine(members, periods, [(counts, ["id", "q"])], {"n": 0})
    assert {tuple(r) for r in got.select("id", "p", "q", "n").collect()} == {("a", 1, 10, 0), ("a", 2, 20, 7), ("b", 1, 10, 0), ("b", 2, 20, 0)}


def test_top_lists(spark):
    counts = spark.createDataFrame([("g", "z", 5), ("g", "a", 3), ("g", "b", 3), ("g", "c", 3), ("h", "q", 1)], "g string, label string, n int")
    top = top_n_per_group(counts, "g", "label", "n", 3)
    assert {(r.g, r.label, r["rank"], r.group_total, r.group_percent) for r in top.collect()} == {
        ("g", "z", 1, 14, 35.71),
        ("g", "a", 2, 14, 21.43),
        ("g", "b", 3, 14, 21.43),
        ("h", "q", 1, 1, 100.0),
    }
    assert top_n_with_ties(counts, "n", 2).count() == 4


def test_total_row_recomputes_ratios(spark):
    df = spark.createDataFrame([("a", 1, 2), ("a", 1, 2), ("b", 9, 10), (None, 1, 6)], "g string, x int, y int")
    got = with_total(df, "g", ["x", "y"], {"r": safe_ratio(F.col("x"), F.col("y"))})
    assert {(r.g, r.x, r.y, r.r) for r in got.collect()} == {("a", 2, 4, 0.5), ("b", 9, 10, 0.9), (None, 1, 6, 1 / 6), ("Total", 12, 20, 0.6)}


def test_one_row(spark):
    left, right = spark.range(1).select(F.lit(1).alias("a")), spark.range(1).select(F.lit("x").alias("b"))
    assert tuple(one_row(left, right).first()) == (1, "x")


def test_checks_and_gates(spark, model):
    checks = [
        NotNull("fact", "id"),
        Check("fact", "small", F.col("v") < 6),
        Check("fact", "known id", F.col("id") != "x", null_passes=True),
        Check("fact", "known id, strictly", F.col("id") != "x"),
        RowCount("fact", 6),
        RowCount("other", 5),
        Unique("fact", ("id",)),
        ForeignKey("fact", "id", "dim", "id"),
    ]
    report = run_checks(model.tables, checks)
    assert {(r.table, r.check): r.issues for r in report.collect()} == {
        ("fact", "not null id"): 1,
        ("fact", "small"): 1,
        ("fact", "known id"): 1,
        ("fact", "known id, strictly"): 2,
        ("fact", "row count 6"): 0,
        ("other", "row count 5"): 3,
        ("fact", "unique id"): 1,
        ("fact", "id in dim"): 2,
    }
    with pytest.raises(QualityError, match="id in dim: 2 issue rows"):
        raise_on_issues(report)
    raise_on_issues(report.where("issues = 0"))


def test_reconcile(spark, model):
    report = reconcile(table_counts({"fact": model["fact"], "other": model["other"]}), {"fact": 6, "other": 3, "gone": 0})
    assert {r.name: (r.actual, r.ok) for r in report.collect()} == {"fact": (6, True), "other": (2, False), "gone": (None, False)}
    with pytest.raises(QualityError, match="other: expected 3, found 2"):
        raise_on_mismatch(report)


def test_null_flags_belong_to_neither_side(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, flag boolean")
    kept, out = split_on_flag(df, F.col("flag"), "because")
    assert [r.id for r in kept.collect()] == [2]
    assert [(r.id, r._quarantine_reason) for r in out.collect()] == [(1, "because")]
    assert {tuple(r) for r in rejection_summary({"x": out, "none": out.where("false")}).collect()} == {("x", 1), ("none", 0)}


def test_snapshot_hash_ignores_order_and_volatile_columns(spark):
    df = spark.range(100).select("id", F.col("id").cast("string").alias("s"), F.rand().alias("noise"))
    again = df.repartition(7).orderBy(F.col("id").desc()).withColumn("noise", F.rand())
    assert snapshot_hash(df, ["noise"]).first() == snapshot_hash(again, ["noise"]).first()
    assert snapshot_hash(df, ["noise"]).first() != snapshot_hash(df.where("id > 0"), ["noise"]).first()


def test_publish_and_read_back(spark, tmp_path, model):
    publish(model["fact"], f"{tmp_path}/fact.parquet")
    publish(model["dim"], f"{tmp_path}/dim.parquet", partition_by=["region"])
    (tmp_path / "fact.parquet" / "notes.txt").write_text("not a table")
    back = read_model(spark, str(tmp_path), ["fact", "dim"], {"fact": {"v": "bigint"}})
    assert dict(back["fact"].dtypes)["v"] == "bigint" and back["fact"].count() == 6
    assert back["dim"].where("region = 'north'").count() == 2
    assert all(".zstd." in p.name for p in (tmp_path / "fact.parquet").glob("*.parquet"))
    publish(back["fact"].limit(2).select("v"), f"{tmp_path}/copy.parquet", table="copy_of_fact")
    assert spark.table("copy_of_fact").count() == 2
    spark.sql("drop table copy_of_fact")


def test_published_view_allows_listed_columns_only(spark, model):
    assert published_view(model["fact"], ["v"], "shown").columns == ["v"]
    assert spark.table("shown").columns == ["v"]
    with pytest.raises(ValueError, match="secret"):
        published_view(model["fact"], ["secret"])


def test_null_groups_are_one_group(spark):
    """A dimension member without a label is one row, with all its measures."""
    dims = spark.createDataFrame([(1, "north"), (2, None), (3, None)], "id int, area string")
    days = spark.createDataFrame([(1, dt.date(2025, 1, 1), 5), (2, dt.date(2025, 1, 1), 3), (3, dt.date(2025, 1, 2), 1)], "id int, date date, n int")
    hits = spark.createDataFrame([(2, dt.date(2025, 1, 2), "a"), (1, dt.date(2025, 1, 1), "b"), (1, dt.date(2025, 1, 1), "b")], "id int, date date, who string")
    calendar = spark.createDataFrame([(dt.date(2025, 1, 1),), (dt.date(2025, 1, 2),)], "date date")
    relations = tuple(Relation(fact, key, dim, dim_key) for fact in ("days", "hits") for key, dim, dim_key in (("id", "dim", "id"), ("date", "dim_date", "date")))
    model = StarModel({"dim": dims, "dim_date": calendar, "days": days, "hits": hits}, relations)
    below = Amount("days", "date", "n")
    rate = Rate(Amount("hits", "date"), below)
    got = {r.area: r.rate for r in evaluate(model, {"rate": rate}, ("dim.area",), "dim_date").collect()}
    assert got == {"north": 0.4, None: 0.25}
    for distinct in (False, True):
        rolling = Rate(Amount("hits", "date", "who", distinct=True) if distinct else Amount("hits", "date"), below)
        rows = trailing_series(model, rolling, "dim_date", 2, ("dim.area",)).collect()
        assert sorted(((r.area, r.date.day, r.event_count, r.day_count) for r in rows), key=repr) == sorted(
            [("north", 1, 1 if distinct else 2, 5), ("north", 2, 1 if distinct else 2, 5), (None, 1, 0, 3), (None, 2, 1, 4)], key=repr
        )


def test_facts_without_a_member_are_a_group(spark, model):
    """They have no label, and groups add up to the total; under a filter of the dimension they are gone."""
    total = Total(Amount("fact", "v", "v"))
    got = {r.region: r.v for r in evaluate(model, {"v": total}, ("dim.region",), total="Total").collect()}
    assert got == {"north": 6, "south": 4, None: 11, "Total": 21}
    north = model.filtered({"dim": F.col("region") == "north"})
    assert {r.region: r.v for r in evaluate(north, {"v": total}, ("dim.region",), total="Total").collect()} == {"north": 6, "Total": 6}
    with pytest.raises(ValueError, match="groups"):
        evaluate(model, {"v": total}, total="Total")


def test_blanks(spark, model):
    nothing = StarModel({**model.tables, "none": model.tables["fact"].where("v > 2 and v < 4")}, (*model.relations, Relation("none", "id", "dim", "id")))
    hits, seen = Amount("none", "v"), Amount("fact", "v")
    distinct = Amount("none", "v", "v", distinct=True)
    measures = {"zero": Rate(hits, seen), "blank": Rate(hits, seen, empty=None), "count": Total(distinct, empty=None), "odd": Rate(seen, hits)}
    got = {r.region: tuple(r)[1:] for r in evaluate(nothing, measures, ("dim.region",), total="Total").collect()}
    assert got["south"] == (0.0, None, None, None) and got["north"] == (1 / 3, 1 / 3, 1, 3.0)
    assert got["Total"] == (1 / 6, 1 / 6, 1, 6.0) and got[None] == (0.0, None, None, None)
    empty = StarModel({**model.tables, "fact": model.tables["fact"].where("false")}, model.relations)
    assert [tuple(r) for r in evaluate(empty, {"v": Total(seen)}, ("dim.region",), total="Total").collect()] == [("Total", 0)]


def test_bridged_facts(spark):
    raw = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "a"), (9, "a")], "who int, kind string")
    homes = spark.createDataFrame([(1, "n"), (2, "s"), (3, None)], "who int, id string")
    dim = mapping(spark, [("n", "north"), ("s", "south")], "id string, region string")
    fact = Bridged(raw, "who", homes, lambda rows: rows.groupBy("who", "kind").agg(F.count("*").alias("n")))
    model = StarModel({"dim": dim, "fact": fact}, (Relation("fact", "id", "dim", "id"),))
    assert sorted((r.who, r.n) for r in model["fact"].collect()) == [(1, 2), (2, 1), (3, 1)]
    north = model.filtered({"dim": F.col("region") == "north"})
    assert [(r.who, r.kind, r.n, r.id) for r in north["fact"].select("who", "kind", "n", "id").collect()] == [(1, "a", 2, "n")]
    assert north.table("fact", ignore=("dim",)).count() == 3


def test_ties_by_threshold(spark):
    rows = [("a", 5), ("b", 3), ("c", 3), ("d", 3), ("e", 1), ("f", None), ("g", None)]
    df = spark.createDataFrame(rows, "k string, n int").repartition(3)
    ranks = lambda n: {r.k: r["rank"] for r in top_n_with_ties(df, "n", n).collect()}
    assert ranks(1) == {"a": 1} and ranks(2) == ranks(4) == {"a": 1, "b": 2, "c": 2, "d": 2}
    assert ranks(5) == {"a": 1, "b": 2, "c": 2, "d": 2, "e": 5}
    assert ranks(6) == ranks(99) == {**ranks(5), "f": 6, "g": 6} and ranks(0) == {}
    assert top_n_with_ties(df.where("false"), "n", 3).count() == 0


def test_all_checks_in_one_pass(spark):
    """Keys of several columns, NULL keys, references to the table itself, and empty tables."""
    people = spark.createDataFrame([(1, None, "x"), (2, 1, "x"), (3, 7, None), (3, None, None)], "id long, boss int, team string")
    teams = spark.createDataFrame([("x",), (None,)], "team string")
    tables = {"people": people, "teams": teams, "none": teams.where("false")}
    checks = [Unique("people", ("id",)), Unique("people", ("boss", "team")), ForeignKey("people", "boss", "people", "id"), ForeignKey("people", "team", "teams", "team"),
              Unique("none", ("team",)), ForeignKey("none", "team", "teams", "team"), NotNull("none", "team"), RowCount("none", 2), RowCount("people", 4), NotNull("people", "team")]
    found = {(r.table, r.check): r.issues for r in run_checks(tables, checks).collect()}
    names = ["unique id", "unique boss, team", "boss in people", "team in teams", "row count 4", "not null team"]
    assert [found["people", name] for name in names] == [1, 0, 3, 2, 0, 2]
    assert [found["none", name] for name in ("unique team", "team in teams", "not null team", "row count 2")] == [0, 0, 0, 2]


def test_counts_without_a_job(spark):
    with pytest.raises(QualityError, match="a: expected 2, found 3; c: expected 1, found None"):
        raise_on_counts({"a": 3, "b": 1}, {"a": 2, "b": 1, "c": 1})
    raise_on_counts({"a": 3}, {})
    assert set(row_metrics([NotNull("t", "x"), Check("t", "small", F.col("x") < 3), NotNull("u", "y"), Unique("t", ("x",))], "t")) == {"not null x", "small"}
