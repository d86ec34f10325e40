"""The pipeline's stages against plain versions, each on what the stage before kept; and all queries on the sample."""

import math
import random
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
import corpus_pipeline
from lodestrata.llm.queries import ORACLES, QUERIES
from tests.llm.test_corpus import plain_classes, plain_leaks, words
from tests.llm.test_texts import plain_dedup
from tests.llm.test_tokens import check_packed, library_ids

ROOT = Path("/root/testdata/sf0.001")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score string"


def corpus(spark, folder, empty=False):
    """Good and junk documents, copies, shared lines and benchmark passages, with odd rows; `score` clashes on purpose."""
    rng = random.Random(4)
    shared = [" ".join(words(rng, 8)).capitalize() for _ in range(5)]
    items = [(i, " ".join(words(rng, 14))) for i in range(5)]
    docs, labels = [], []
    for i in range(400):
        body = words(rng, rng.randrange(10, 80))
        junk = i % 6 == 0
        text = " ".join(f"{w.upper()}!!" for w in body) if junk else " ".join(body)
        if not junk and i % 4 == 1:
            text += "\n" + rng.choice(shared)
        if not junk and i % 10 == 3:
            text += "\n" + rng.choice(items)[1]
        if not junk and i % 7 == 2 and (i - 1) % 6:
            text = docs[-1][1]
        docs.append((i, text))
        if i % 5:
            labels.append((i, 0 if junk else 1, 0))
    docs += [(1000, None), (1001, ""), (1002, docs[1][1] * 150), (None, docs[2][1]), (docs[4][0], docs[4][1])]
    rows = [(i, t, "en", "s", None if t is None else len(t), "clash") for i, t in docs]
    spark.createDataFrame([] if empty else rows, COLUMNS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([] if empty else labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([] if empty else items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return items


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages(spark, tmp_path):
    items = corpus(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    out = {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, str(tmp_path))
        if n < 4:
            assert made.columns == docs.columns and made.dtypes == docs.dtypes
        made.write.parquet(f"{tmp_path}/out-{n}")
        out[name] = docs = spark.read.parquet(f"{tmp_path}/out-{n}")
    good, lines, near, clean, packed = out.values()

    kept = {i for i, _ in rows_of(good)}
    assert all((i in kept) == bool(i % 6) for i in range(400))

    before = rows_of(good)
    want = sorted((i, b if n == 0 else kept_text) for (i, _, n, kept_text), (_, b) in zip(plain_dedup(before), sorted(before, key=repr)) if i is not None)
    got = sorted((i, t) for i, t in rows_of(lines) if i is not None)
    assert sorted((i, t or "") for i, t in got) == sorted((i, t or "") for i, t in want)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in lines.collect())

    classes = {d: c for d, c, _ in plain_classes(rows_of(lines))}
    stay = {d for d, c in classes.items() if d == c}
    found = rows_of(near)
    assert {d for d, _ in found if d is not None} == stay
    assert len(found) == len(set(found))

    leaking = {d for d, _, _ in plain_leaks(rows_of(near), items, 0.08)}
    assert {d for d, _ in rows_of(clean)} == {d for d, _ in rows_of(near)} - leaking

    pieces = packed.collect()
    tokens = {d: [*library_ids(t), 0] for d, t in rows_of(clean)}
    assert sorted((r.doc_id or -1, r.start, r.length) for r in pieces) == sorted(
        (d or -1, s, min(2048, len(ids) - s)) for d, ids in tokens.items() for s in range(0, len(ids), 2048)
    )
    for r in pieces:
        assert r.ids_crc32 == zlib.crc32(np.array(tokens[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())
    assert check_packed(pieces, 2048) <= math.ceil(sum(map(len, tokens.values())) / 2048) * 1.05 + 1


def test_run_is_its_stages(spark, tmp_path):
    corpus(spark, tmp_path)
    rows = corpus_pipeline.run(spark, str(tmp_path))
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert rows.count() > 100


def test_run_over_nothing(spark, tmp_path):
    corpus(spark, tmp_path, empty=True)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_query_is_registered():
    assert {int(name[2:].split("_")[0]) for name in QUERIES if name.startswith("op")} == set(range(1, 14))
    registered = entry_module.queries()
    assert set(QUERIES) | {"pipeline"} <= set(registered)
    assert set(ORACLES) <= set(entry_module.oracle_sql())


def plain(value):
    return float(f"{value:.9g}") if isinstance(value, float) else value


@pytest.mark.skipif(not ROOT.exists(), reason="sample tables are not here")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in ROOT.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = QUERIES[name](spark, str(ROOT))
    cursor = connection.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(plain(r[names.index(c)]) for c in df.columns) for r in cursor.fetchall()), key=repr)
    assert sorted((tuple(map(plain, r)) for r in df.collect()), key=repr) == want


@pytest.mark.skipif(not ROOT.exists(), reason="sample tables are not here")
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, str(ROOT)).agg(F.count("*")).first()[0] > 0
