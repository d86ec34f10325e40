"""Replacing tables: what readers see while a write runs, after it failed, and after it is released."""

import pytest
from pyspark.sql import functions as F

from lodestrata.sources import versions as v
from lodestrata.sources.tables import catalog_view, publish, published_catalog_view, read_model


def numbers(spark, n):
    return spark.range(n).select("id", (F.col("id") % 3).alias("part"))


def failing(spark, n=40):
    """Rows of which the last one cannot be written."""
    return spark.range(0, n, 1, 4).select(
        F.when(F.col("id") < n - 1, F.col("id")).otherwise(F.raise_error(F.lit("no")).cast("long")).alias("id"),
        (F.col("id") % 3).alias("part"),
    )


@pytest.mark.parametrize("parts", [(), ("part",)])
def test_a_failed_write_leaves_the_table_as_it_was(spark, tmp_path, parts):
    path = f"{tmp_path}/t.parquet"
    publish(numbers(spark, 5), path, parts)
    with pytest.raises(Exception, match="no"):
        publish(failing(spark), path, parts)
    assert v.read_published(spark, path).count() == 5 and len(v.versions(spark, path)) == 1
    assert read_model(spark, str(tmp_path), ["t"])["t"].count() == 5
    publish(numbers(spark, 7), path, parts)
    assert v.read_published(spark, path).count() == 7


def test_a_reader_keeps_the_version_it_opened(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    publish(numbers(spark, 5), path)
    opened = v.read_published(spark, path)
    publish(numbers(spark, 6), path)
    assert (opened.count(), v.read_published(spark, path).count()) == (5, 6)
    publish(opened.unionAll(v.read_published(spark, path)), path)  # over its own output
    assert v.read_published(spark, path).count() == 11
    assert len(v.versions(spark, path)) == 2


def test_an_unfinished_version_does_not_count(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    publish(numbers(spark, 5), path)
    folder = v.write_version(numbers(spark, 9), path)
    v.Files(spark).delete(f"{folder}/{v.MARK}")
    assert v.read_published(spark, path).count() == 5
    with pytest.raises(FileNotFoundError):
        v.read_published(spark, f"{tmp_path}/none")


def test_a_release_switches_all_tables_at_once(spark, tmp_path):
    root = str(tmp_path)

    def write(n):
        return {name: {"version": v.write_version(numbers(spark, n), f"{root}/{name}"), "columns": ["part", "id"]} for name in ("a", "b")}

    assert v.current_release(spark, root) == {}
    v.release(spark, root, write(1))
    second = write(2)
    assert [df.count() for df in v.read_release(spark, root).values()] == [1, 1]
    v.release(spark, root, second)
    found = v.read_release(spark, root)
    assert [df.count() for df in found.values()] == [2, 2] and found["a"].columns == ["part", "id"]
    with pytest.raises(FileNotFoundError, match="c"):
        v.read_release(spark, root, ["a", "c"])
    with pytest.raises(FileExistsError):
        v.Files(spark).write_once(v.releases(spark, root)[-1], "{}")


def test_old_versions_expire(spark, tmp_path):
    root = str(tmp_path)
    written = []
    for n in range(4):
        written.append(v.write_version(numbers(spark, n + 1), f"{root}/a"))
        v.release(spark, root, {"a": {"version": written[-1], "columns": ["id"]}})
    running = v.write_version(numbers(spark, 9), f"{root}/a")
    assert sorted(v.expire(spark, root)) == written[:2]
    assert v.versions(spark, f"{root}/a") == [*written[2:], running]
    assert len(v.releases(spark, root)) == 2 and v.read_release(spark, root)["a"].count() == 4


def test_catalog_tables_follow_their_version(spark, tmp_path):
    path, name = f"{tmp_path}/t.parquet", "versioned_numbers"
    publish(numbers(spark, 5), path, ["part"], table=name)
    publish(numbers(spark, 8), path, ["part"], table=name)
    assert spark.table(name).count() == 8 and spark.table(name).where("part = 1").count() == 3
    publish(numbers(spark, 4).withColumn("more", F.lit("x")), path, table=name)
    assert spark.table(name).columns == ["id", "part", "more"] and spark.table(name).count() == 4
    spark.sql(f"drop table {name}")


def test_views_last_and_are_read_by_other_sessions(spark, tmp_path):
    first = v.write_version(numbers(spark, 5), f"{tmp_path}/t")
    published_catalog_view(spark, "lasting.shown", first, ["part"])
    other = spark.newSession()
    assert other.table("lasting.shown").columns == ["part"] and other.table("lasting.shown").count() == 5
    published_catalog_view(spark, "lasting.shown", v.write_version(numbers(spark, 6), f"{tmp_path}/t"), ["id", "part"])
    catalog_view(spark, "lasting.counted", "SELECT count(*) AS n FROM lasting.shown")
    assert other.sql("SELECT n FROM lasting.counted").first()[0] == 6
    text = "".join(str(r) for r in other.sql("DESCRIBE EXTENDED lasting.counted").collect())
    assert "SELECT count(*) AS n FROM lasting.shown" in text
    with pytest.raises(ValueError, match="secret"):
        published_catalog_view(spark, "lasting.shown", "lasting.shown", ["secret"])
    spark.sql("drop database lasting cascade")


def test_a_partitioned_table_without_rows(spark, tmp_path):
    root, empty = str(tmp_path), numbers(spark, 3).where("id < 0")
    version = v.write_version(empty, f"{root}/a", ["part"])
    v.release(spark, root, {"a": v.versioned(version, empty)})
    found = v.read_release(spark, root)["a"]
    assert found.columns == ["id", "part"] and found.dtypes == empty.dtypes and found.count() == 0
