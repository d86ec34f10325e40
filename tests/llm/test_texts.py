"""Line deduplication, the ring and licence digests against plain Python."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestrata.llm import license_whole_texts as whole
from lodestrata.llm import licenses, line_runs, ring, text_queries
from lodestrata.llm.common import ship
from lodestrata.llm.license_texts import KNOWN, MIT
from lodestrata.session import scratch_folder

SCHEMA = "doc_id long, text string, lang string, h1 string, last string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "clash", "clash") for i, t in rows], SCHEMA).repartition(3)


def key_of(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans(line_runs.UPPER, line_runs.LOWER))


def plain_dedup(rows, least=3, shortest=20):
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key_of(line)) >= shortest:
                holders[key_of(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [
            x for x in lines if i is None or len(holders[key_of(x)]) < least or len(key_of(x)) < shortest or max(holders[key_of(x)]) == i
        ]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def documents(seed, n=120):
    rng = random.Random(seed)
    pool = [f"a line that many documents hold, number {i}" for i in range(12)] + ["short", "", "   ", "x" * 19, "É" * 20, "é" * 20]
    rows = []
    for i in range(n):
        lines = [rng.choice(pool) for _ in range(rng.randint(0, 8))] + [f"a line of its own that is long enough {i}"] * (i % 3)
        lines = [rng.choice([x, x.upper(), f" {x}\t", f"{x}\r", x + " "]) for x in lines]
        rows.append((i, "\n".join(lines)))
    hot = "the hot line of a third of all rows"
    return rows + [(1000 + i, f"{hot}\nown line {i} with some more letters") for i in range(n // 2)]


@pytest.mark.parametrize("batches", [1, 4, 7])
def test_lines(spark, batches):
    rows = documents(batches) + [(None, "the hot line of a third of all rows"), (5000, None), (5001, ""), (1000, "the hot line of a third of all rows"), (3, documents(1)[3][1])]
    got = line_runs.dedup_lines(frame(spark, rows), batches=batches)
    assert "h1" in got.columns and "last" in got.columns
    assert sorted([(r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in got.collect()], key=repr) == plain_dedup(rows)


def test_no_lines(spark):
    assert line_runs.dedup_lines(frame(spark, [])).count() == 0


def test_runs_tell_new_keys_from_old(spark):
    runs = line_runs.LineRuns(spark, scratch_folder(spark))
    held = set()
    for batch in range(5):
        rows = [(100 - 10 * batch - i, f"this is the line with number {i * batch}") for i in range(6)]
        own = {key_of(t) for _, t in rows}
        fresh = runs.add(line_runs.line_keys(frame(spark, rows)))
        assert fresh.count() == len(own - held)
        held |= own
    assert len(runs.live) == 2  # five batches: a run of four and one of one
    assert runs.common(1).count() == len(held)


def test_ring(spark):
    ship(spark)
    rows = [(i, f"text {i % 50}") for i in range(700)] + [(10_000 + i, "the same text for a third") for i in range(400)]
    rows += [(None, None), (None, ""), (7, "again"), (7, "again")]
    got = ring.assign(frame(spark, rows), shards=7, nodes=16).collect()
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in got) == sorted(
        (i or -1, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows
    )
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(7)) and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))
    homes = defaultdict(set)
    for r in got:
        homes[r.text_crc32].add(r.shard)
    assert sum(len(s) == 1 for s in homes.values()) > 40  # copies stay together unless their shard is full
    assert ring.assign(frame(spark, []), shards=7).count() == 0
    assert {r.slot for r in ring.assign(frame(spark, rows[:3]), shards=7).collect()} == {0}


def test_a_cut_parts_one_group_of_copies(spark):
    ship(spark)
    rows = [(i, f"text {i % 200}") for i in range(1000)]
    homes = defaultdict(set)
    for r in ring.assign(frame(spark, rows), shards=3, nodes=1).collect():
        homes[r.text_crc32].add(r.shard)
    assert len(homes) == 200 and sum(len(s) > 1 for s in homes.values()) <= 4


def test_bounded_loads_move_clockwise_and_little():
    rng = np.random.default_rng(1)
    places, shard = ring.ring(8, 32)
    counts = rng.poisson(20, len(places))
    counts[5] += 3000
    taken = ring.bounded(counts, shard, 8, slack=0.5)
    load = np.bincount([t[3] for t in taken], [t[2] - t[1] for t in taken], 8)
    assert load.sum() == counts.sum() and load.max() <= int(counts.sum() * 1.5) // 8
    for place, n in enumerate(counts.tolist()):
        own = sorted((a, b) for p, a, b, _, _ in taken if p == place)
        assert [a for a, _ in own] + [n] == [0] + [b for _, b in own] if own else n == 0
    _, more = ring.ring(9, 32)
    assert set(places) <= set(ring.ring(9, 32)[0])


def test_licenses(spark):
    rows = [
        (1, MIT),
        (2, "MIT License\n\nCopyright (c) 2024 Someone\n\n" + MIT.replace("sublicense", "sub-license").upper()),
        (3, "© 1999 A\n(c) 2001 B\nAll rights reserved.\n" + MIT.replace("\n", "   ")),
        (4, MIT + " And one more word."),
        (5, "Prose.\n  * released UNDER the MIT Licence!\nLicensed under CC BY-NC 4.0."),
        (6, None),
        (7, ""),
        (7, ""),
        (None, "Licensed under the Apache License, Version 2.0."),
        (8, "word " * 60_000),
    ]
    got = licenses.license_scan(frame(spark, rows).withColumn("license_", F.lit("clash"))).collect()
    own = {(r.doc_id, r.license): list(r.notices) for r in got}
    assert len(got) == len(rows)
    assert own[(1, "MIT")] == [] and (2, "MIT") in own and (3, "MIT") in own and (4, None) in own
    assert own[(5, None)] == ["CC-BY-NC-4.0", "MIT"]
    assert own[(None, "Apache-2.0")] == ["Apache-2.0"]
    empty = hashlib.sha256(b"").hexdigest()
    assert {r.digest for r in got if r.doc_id in (6, 7)} == {empty}
    assert licenses.license_scan(frame(spark, [])).count() == 0
    assert licenses.known_digests(spark).count() == len({(i, t) for i, t in KNOWN})


def test_long_licenses_are_found_whole(spark):
    ids = {
        "Apache-2.0": whole.APACHE_2, "Artistic-1.0-Perl": whole.ARTISTIC, "CC-BY-SA-4.0": whole.CC_BY_SA_4, "CC0-1.0": whole.CC0,
        "GFDL-1.2-only": whole.GFDL_1_2, "GFDL-1.3-only": whole.GFDL_1_3, "GPL-1.0-only": whole.GPL_1, "GPL-2.0-only": whole.GPL_2,
        "GPL-3.0-only": whole.GPL_3, "LGPL-2.0-only": whole.LGPL_2, "LGPL-2.1-only": whole.LGPL_2_1, "LGPL-3.0-only": whole.LGPL_3,
        "MPL-1.1": whole.MPL_1_1, "MPL-2.0": whole.MPL_2, "Unlicense": whole.UNLICENSE,
    }
    texts = dict(enumerate(ids.values())) | {
        100: whole.APACHE_2.replace("Copyright [yyyy] [name of copyright owner]", "Copyright 2024 Someone"),
        101: whole.GPL_3[: whole.GPL_3.index("How to Apply")],
        102: " ".join(whole.MPL_2.split()),
        200: whole.GPL_3.replace("copyleft", "copyright", 1),
        201: whole.MPL_2[:-40],
    }
    got = {r.doc_id: r.license for r in licenses.license_scan(frame(spark, list(texts.items()))).collect()}
    want = dict(enumerate(ids)) | {100: "Apache-2.0", 101: "GPL-3.0-only", 102: "MPL-2.0", 200: None, 201: None}
    assert got == want


@pytest.mark.parametrize("listed", [10_000, 2])
def test_licenses_of_the_callers_list(spark, monkeypatch, listed):
    monkeypatch.setattr(licenses, "LISTED", listed)  # the second value joins the list
    rows = [(1, "Own  TERMS,\nof two lines."), (2, MIT), (3, "a\nOne line!\nb"), (4, None)]
    own = [("Own", "own terms: of two lines", 1), ("Line", "one line", 2), ("Other", "One line.", 3), ("Empty", "...", 4), ("None", None, 5), (None, "b", 6)]
    known = spark.createDataFrame(own, "license string, text string, more long")
    got = {r.doc_id: (r.license, list(r.notices)) for r in licenses.license_scan(frame(spark, rows), known=known).collect()}
    assert got == {1: ("Own", []), 2: (None, []), 3: (None, ["Line"]), 4: (None, [])}
    assert {(r.license, *r.notices) for r in licenses.license_scan(frame(spark, rows), known=known.limit(0)).collect()} == {(None,)}


PERMISSION = MIT[MIT.index("Permission") :]
FORMS = {
    0: ("Copyright (c) 2024 X. " + " ".join(PERMISSION.split()), "MIT"),
    1: ("Copyright (c) 2024 X. All rights reserved. " + " ".join(PERMISSION.split()), "MIT"),
    2: ("\ufeffMIT License\n\nCopyright The Demo Authors\n\n" + PERMISSION, "MIT"),
    3: ("MIT License\n\nCopyright Joyent, Inc. and other contributors.\n\n" + PERMISSION, "MIT"),
    4: ("MIT License\n\nCopyright (c) 2024 J. Random Hacker\n\n" + PERMISSION.replace(" ", "\u3000").replace(",", "\uff0c"), "MIT"),
    5: ("Copyright (c) 2024 X.\nAll rights reserved.", None),
    6: (whole.APACHE_2, "Apache-2.0"),
    7: (whole.GPL_3, "GPL-3.0-only"),
    8: ("Copyright Notice\nis kept", None),
    9: ("Prose that ends.\nCopyright Someone Else\nand goes on\u2014here.", None),
    10: ("Copyright (c) 2024 X. " + " ".join(dict(KNOWN)["ISC"].split()), "ISC"),
}


def test_forms_of_copyright_lines(spark):
    got = {r.doc_id: (r.license, r.digest) for r in licenses.license_scan(frame(spark, [(i, t) for i, (t, _) in FORMS.items()])).collect()}
    assert {i: x for i, (x, _) in got.items()} == {i: x for i, (_, x) in FORMS.items()}
    empty = hashlib.sha256(b"").hexdigest()
    assert [i for i, (_, digest) in got.items() if digest == empty] == [5]
    assert got[8][1] == hashlib.sha256(b"copyright notice is kept").hexdigest()
    assert got[9][1] == hashlib.sha256(b"prose that ends and goes on here").hexdigest()


def test_sql_says_the_same_of_all_texts(spark):
    duckdb = pytest.importorskip("duckdb")
    rows = [*((i, t) for i, (t, _) in FORMS.items()), *((100 + i, t) for i, (_, t) in enumerate(KNOWN)), (1000, None), (1001, "a\nLicensed under CC BY-NC 4.0.\nb")]
    scanned = licenses.license_scan(frame(spark, rows)).select("doc_id", "digest", "license", F.array_join("notices", ",").alias("notices"))
    documents = pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]})  # noqa: F841
    said = duckdb.sql(text_queries.LICENSE_SQL).fetchall()
    assert sorted(map(tuple, scanned.collect())) == sorted(said)


def walked(rows, shards, nodes):
    """Each row by itself: (text hash, id hash, id) -> shard, row after row and round after round clockwise."""
    places, owner = ring.ring(shards, nodes)
    places = [int(p) for p in places]
    low, more = divmod(len(rows), shards)
    home = {row: next((n for n, p in enumerate(places) if p >= row[0] % (1 << 64)), 0) for row in rows}
    demand = Counter(int(owner[n]) for n in home.values())
    ranked = sorted(range(shards), key=lambda s: (-demand[s], s))
    bound = {s: low + (s in ranked[:more]) for s in range(shards)}
    load, shard_of = Counter(), {}
    waiting = [(n, row) for row, n in home.items()]
    while waiting:
        left = []
        for n, row in sorted(waiting, key=lambda w: (w[0], home[w[1]], w[1])):
            s = int(owner[n])
            if load[s] < bound[s]:
                load[s] += 1
                shard_of[row] = s
            else:
                left.append((n, row))
        waiting = []
        for n, row in left:  # clockwise to the next place of a shard that is not full
            while load[int(owner[n])] >= bound[int(owner[n])]:
                n = (n + 1) % len(places)
            waiting.append((n, row))
    return shard_of


@pytest.mark.parametrize(("shards", "nodes"), [(5, 8), (7, 3)])
def test_rows_walk_clockwise(spark, shards, nodes):
    ship(spark)
    rows = [(i, f"text {i % 60}" if i % 3 else "the hot text") for i in range(400)]
    hashed = frame(spark, rows).select("doc_id", F.xxhash64("text").alias("hash"), F.xxhash64("doc_id").alias("order")).collect()
    want = walked([(r.hash, r.order, r.doc_id) for r in hashed], shards, nodes)
    got = ring.assign(frame(spark, rows), shards=shards, nodes=nodes).collect()
    counts = Counter(r.shard for r in got)
    assert counts == Counter(want.values()) and max(counts.values()) - min(counts.values()) <= 1
    moved = sum({k[2]: s for k, s in want.items()}[r.doc_id] != r.shard for r in got)
    assert moved == 0, f"{moved} rows elsewhere"


def test_a_further_shard_moves_few_rows(spark):
    """With one shard more a row stays unless its place is the new shard's or a bound pushes it."""
    ship(spark)
    rows = [(i, f"text {i}") for i in range(4000)]
    before, after = ({r.doc_id: r.shard for r in ring.assign(frame(spark, rows), shards=n, slack=0.5).collect()} for n in (10, 11))
    moved = [i for i in before if before[i] != after[i]]
    assert all(after[i] == 10 for i in moved) or len(moved) < 4000 * 2 / 11
    assert 0 < len(moved) < 4000 * 2 / 11
