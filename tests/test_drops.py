import pytest
from pyspark.sql import functions as F

from lodestrata.sources.drops import MalformedDrop, drop_manifest, manifest_issues, read_drop, read_drop_parts


def put(folder, name, text):
    (folder / name).write_text(text)


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_columns_are_matched_by_name(spark, tmp_path):
    put(tmp_path, "pets_2025_01.csv", "id,name\n1,Rex\n2,\n")
    put(tmp_path, "pets_2025_02.csv", "size,name,id\nbig,Tom,3\n")
    df = read_drop(spark, str(tmp_path), "pets_*.csv", "pets", required=("id", "owner"))
    assert set(dict(df.drop("_row_number", "_ingested_at_utc").dtypes).values()) == {"string"}
    assert rows(df.fillna("-"), "id", "name", "size", "owner", "_source_file", "_source_table", "_source_month", "_row_number") == [
        ("1", "Rex", "-", "-", "pets_2025_01.csv", "pets", "2025_01", 1),
        ("2", "-", "-", "-", "pets_2025_01.csv", "pets", "2025_01", 2),
        ("3", "Tom", "big", "-", "pets_2025_02.csv", "pets", "2025_02", 1),
    ]


def test_short_rows_quotes_and_missing_final_newline(spark, tmp_path):
    put(tmp_path, "pets_2025_01.csv", 'id,name,size\n1\n2,"a, ""b""",x\n3,"",z')
    df = read_drop(spark, str(tmp_path), "pets_*.csv", "pets")
    got = {r["id"]: (r["name"], r["size"], r["_row_number"]) for r in df.collect()}
    assert got == {"1": (None, None, 1), "2": ('a, "b"', "x", 2), "3": (None, "z", 3)}


def test_line_ends_byte_order_mark_and_empty_files(spark, tmp_path):
    (tmp_path / "pets_2025_01.csv").write_bytes("\ufeffid,name\r\n1,Zo\u00eb\r\n\r\n2,\r\n".encode())
    put(tmp_path, "pets_2025_02.csv", "id,name\n")
    put(tmp_path, "pets_2025_03.csv", "")
    df = read_drop(spark, str(tmp_path), "pets_*.csv", "pets")
    assert rows(df.fillna("-"), "id", "name", "_source_month", "_row_number") == [("1", "Zo\u00eb", "2025_01", 1), ("2", "-", "2025_01", 2)]


def test_line_breaks_inside_quotes(spark, tmp_path):
    put(tmp_path, "pets_2025_01.csv", 'id,text\n1,"two\nlines"\n2,one\n')
    df = read_drop(spark, str(tmp_path), "pets_*.csv", "pets", multi_line=True)
    assert rows(df, "id", "text", "_row_number") == [("1", "two\nlines", 1), ("2", "one", 2)]


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_row_numbers_run_through_a_split_file(spark, tmp_path, broadcast):
    for month, count in (("2025_01", 5000), ("2025_02", 3)):
        put(tmp_path, f"log_{month}.csv", "id,text\n" + "".join(f"{i},{'x' * (i % 37)}\n" for i in range(1, count + 1)))
    saved = {key: spark.conf.get(key) for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
        spark.conf.set("spark.sql.files.openCostInBytes", "64")
        df = read_drop(spark, str(tmp_path), "log_*.csv", "log")
        # The stored rows keep their numbers when files would now be cut elsewhere.
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
        assert df.count() == 5003
        assert df.where(F.col("_row_number") != F.col("id").cast("long")).count() == 0
    finally:
        for key, value in saved.items():
            spark.conf.set(key, value)


def test_manifest(spark, tmp_path):
    for name in ("a_2025_01.csv", "a_2025_02.csv", "b_2025_01.csv", "README.md"):
        put(tmp_path, name, "id\n1\n")
    manifest = drop_manifest(spark, str(tmp_path), {"a": "a_*.csv", "b": "b_*.csv", "c": "c_*.csv"})
    assert manifest.agg(F.sum("length")).first()[0] == 15
    assert rows(manifest_issues(manifest, {"a": 2, "b": 2, "c": 1}), "domain", "expected", "actual", "ok") == [
        ("a", 2, 2, True),
        ("b", 2, 1, False),
        ("c", 1, 0, False),
    ]


def test_no_file_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_drop(spark, str(tmp_path), "pets_*.csv", "pets")


def test_odd_headers_and_one_header_job(spark, tmp_path):
    for i in range(30):
        put(tmp_path, f"pets_2025_{i:02d}.csv", f"\nid,unit.no,,Name,name\n{i},u{i},x,a,b\n")
    group = "headers of pets"
    spark.sparkContext.setJobGroup(group, group)
    df = read_drop(spark, str(tmp_path), "pets_*.csv", "pets")
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("", "")
    assert df.columns[:5] == ["id", "unit.no", "_c2", "Name3", "name4"]
    assert sorted(r["unit.no"] for r in df.collect()) == sorted(f"u{i}" for i in range(30))
    assert jobs < 20  # none for each file


def test_only_files_without_header(spark, tmp_path):
    put(tmp_path, "pets_2025_01.csv", "\n\n")
    df = read_drop(spark, str(tmp_path), "pets_*.csv", "pets", required=("id",))
    assert df.count() == 0 and df.columns[0] == "id"


def test_surplus_fields_are_set_aside(spark, tmp_path):
    (tmp_path / "pets_2024_01.csv").write_text('id,owner\n1,ann\n2,b,SURPLUS\n3\n"4,x","c ""q"", d"\n5,e,,\n6,"f,g",h,"i,j"\n')
    (tmp_path / "pets_2024_02.csv").write_text("owner,id,age\nzoe,7,3\ny,8,4,5\n")
    drop = read_drop_parts(spark, str(tmp_path), "pets_*.csv", "pets")
    assert drop.surplus == 4
    assert sorted((r.id, r.owner, r.age, r._source_month, r._row_number) for r in drop.rows.collect()) == sorted(
        [("1", "ann", None, "2024_01", 1), ("3", None, None, "2024_01", 3), ("4,x", 'c "q", d', None, "2024_01", 4), ("7", "zoe", "3", "2024_02", 1)]
    )
    aside = {(r._source_file, r._row_number): (r._line, r._delivered_fields, r._header_fields) for r in drop.malformed.collect()}
    assert aside == {
        ("pets_2024_01.csv", 2): ("2,b,SURPLUS", 3, 2),
        ("pets_2024_01.csv", 5): ("5,e,,", 4, 2),
        ("pets_2024_01.csv", 6): ('6,"f,g",h,"i,j"', 4, 2),
        ("pets_2024_02.csv", 2): ("y,8,4,5", 4, 3),
    }
    with pytest.raises(MalformedDrop, match="pets: 4 rows"):
        read_drop(spark, str(tmp_path), "pets_*.csv", "pets")
