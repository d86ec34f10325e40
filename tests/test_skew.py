"""Skew-safe joins and rankings give what the plain ones give, also when every key counts as hot."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestrata.operators.dedupe import best_supported, best_supported_one, drop_conflicts, latest_version, surplus_rows, with_version_count
from lodestrata.operators.skew import join_unique, ranked


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows on one key, a third on NULL, the rest spread out, with exact copies."""
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit("hot")).when(n % 3 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), (n % 17).cast("string")))
    return spark.range(600).select(
        key.alias("k"), (n % 5).alias("grade"), F.when(n % 11 != 0, n % 50).alias("v"), n.alias("seq")
    )


def content(df):
    columns = sorted(df.columns)
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_join_unique(spark, rows, how):
    right = rows.where("k is null or k <> 'k2'").groupBy("k").agg(F.sum("v").alias("total"))
    plain = rows.alias("l").join(right.alias("r"), F.expr("l.k <=> r.k"), how).select("l.*", "r.total")
    assert content(join_unique(rows, right, ["k"], how)) == content(plain)


def test_a_hot_key_is_split(spark, tmp_path):
    """Adaptive execution reads the hot partition in several parts."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    saved = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        left = spark.range(0, 300_000, 1, 16).select(
            F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 1000).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("text")
        )
        right = left.groupBy("k").agg(F.count("*").alias("n"))
        joined = join_unique(left, right, ["k"])
        joined.write.parquet(f"{tmp_path}/joined")
        rows = spark.read.parquet(f"{tmp_path}/joined")
        assert rows.where("k = 1").agg(F.count("*"), F.min("n")).first() == (100_200, 100_200)
        per_task = rows.groupBy("_metadata.file_name").count().agg(F.max("count")).first()[0]
        assert per_task < 60_000
    finally:
        for key, value in saved.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("spread", ["seq", "hash"])
def test_ranked_equals_a_window(spark, rows, spread):
    tie = F.col("seq") if spread == "seq" else F.xxhash64("seq")
    order = [F.col("grade").desc(), tie.asc()]
    group = Window.partitionBy("k", "v")
    plain = rows.withColumn("rank", F.row_number().over(group.orderBy(*order)).cast("long")).withColumn("count", F.count("*").over(group))
    assert content(ranked(rows, ["k", "v"], order)) == content(plain)
    one = Window.partitionBy(F.lit(1))
    plain = rows.withColumn("g", F.lit(1)).withColumn("rank", F.row_number().over(one.orderBy(*order)).cast("long")).withColumn("count", F.lit(600).cast("long"))
    got = ranked(rows.withColumn("g", F.lit(1)), ["g"], order)
    assert content(got) == content(plain)
    assert ranked(rows.limit(0), ["k"], order).count() == 0


def test_best_supported(spark):
    people = spark.createDataFrame(
        [
            ("r1", 1, "Ann", 1),
            ("r1", 2, "ANN", 5),
            ("r1", 2, "Bob", 2),
            ("r2", 1, "X", 7),
            ("r2", 1, "Y", 3),
            (None, 1, None, 4),
            (None, 2, None, 6),
        ],
        "who string, month int, name string, line int",
    )
    got = best_supported(people, ["who", "month"], {"who": F.col("who"), "name": F.lower("name")}, ["line"])
    assert {(r.who, r.month, r.name): (r.supporting_snapshot_count, r.candidate_rank, r.candidate_count) for r in got.collect()} == {
        ("r1", 1, "Ann"): (2, 1, 1),
        ("r1", 2, "ANN"): (2, 1, 2),
        ("r1", 2, "Bob"): (1, 2, 2),
        ("r2", 1, "Y"): (1, 1, 2),
        ("r2", 1, "X"): (1, 2, 2),
        (None, 1, None): (2, 1, 1),
        (None, 2, None): (2, 1, 1),
    }
    one = best_supported_one(people, ["who", "month"], {"who": F.col("who"), "name": F.lower("name")}, ["line"], ("s", "n"))
    assert sorted(((r.who, r.month, r.name, r.s, r.n) for r in one.collect()), key=repr) == sorted(
        [("r1", 1, "Ann", 2, 1), ("r1", 2, "ANN", 2, 2), ("r2", 1, "Y", 1, 2), (None, 1, None, 2, 1), (None, 2, None, 2, 1)], key=repr
    )


def test_latest_version_order_and_pushdown(spark):
    leases = spark.createDataFrame(
        [("a", "2025-02-01", "02", 9), ("a", None, "03", 1), ("b", "x", "01", 1), ("b", "x", "02", 1), ("c", None, "01", 1), ("c", None, "01", 2)],
        "id string, ended string, month string, line int",
    )
    order = [F.col("ended").isNotNull().desc(), F.col("month").desc(), F.col("line").desc()]
    got = latest_version(leases, ["id"], order)
    assert {(r.id, r.month, r.line) for r in got.collect()} == {("a", "02", 9), ("b", "02", 1), ("c", "01", 2)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan  # cut before the shuffle


def test_drop_conflicts_and_surplus(spark):
    leads = spark.createDataFrame([("a", 1), ("b", 1), ("b", 1), ("b", 2), (None, 1), (None, 2)], "id string, v int")
    kept, contending = drop_conflicts(leads, ["id"])
    assert content(kept) == [("a", 1)]
    assert content(contending) == sorted([("b", 1, 3), ("b", 1, 3), ("b", 2, 3), (None, 1, 2), (None, 2, 2)], key=repr)
    assert content(with_version_count(leads, ["id"], "n").where("id = 'a'")) == [("a", 1, 1)]
    assert tuple(surplus_rows(leads, ["id", "v"]).first()) == (6, 1)
    assert tuple(surplus_rows(leads.where("false"), ["id"]).first()) == (0, 0)
