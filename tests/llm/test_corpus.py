"""Decontamination, similarity join, neighbours, archives and the classifier against plain versions."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestrata.llm import components as graph
from lodestrata.llm import decontaminate, neighbours, ngram_join, quality, warc
from lodestrata.llm.common import ship
from lodestrata.llm.words import PUNCTUATION
from lodestrata.session import scratch_folder


@pytest.fixture(scope="module")
def spark(spark):
    ship(spark)
    return spark


def words(rng, n):
    syllables = ["ka", "lo", "mi", "ter", "un", "sta", "re", "vo", "gel", "and"]
    return [rng.choice(syllables) + rng.choice(syllables) + rng.choice(["", *syllables]) for _ in range(n)]


# --- decontamination


def semi_global(pattern, text):
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        before, row[0] = row[0], 0
        for i, p in enumerate(pattern, 1):
            before, row[i] = row[i], min(row[i] + 1, row[i - 1] + 1, before + (p != c))
        best = min(best, row[-1])
    return best


@settings(max_examples=150, deadline=None)
@given(st.text("abc ", min_size=1, max_size=80), st.text("abc ", max_size=120))
def test_myers_is_the_edit_distance(pattern, text):
    item = decontaminate.Item([1], pattern, len(pattern))
    assert decontaminate.distance_within(pattern, item.masks, text) == semi_global(pattern, text)


def plain_form(text):
    found = re.findall(r"[^\W_]+", (text or "").lower())
    return f" {' '.join(found)} " if found else " "


def plain_leaks(docs, items, share):
    out = []
    for d, text in docs:
        for i, item in items:
            form = plain_form(item)
            if form != " " and plain_form(text) != " ":
                distance = semi_global(form, plain_form(text))
                if distance <= int(share * (len(form) - 2)):
                    out.append((d, i, distance))
    return sorted(out, key=repr)


def damaged(rng, text, edits):
    for _ in range(edits):
        at = rng.randrange(len(text))
        text = rng.choice([text[:at] + text[at + 1 :], text[:at] + "q" + text[at:], text[:at] + "z" + text[at + 1 :]])
    return text


def leak_tables(spark, n=60):
    rng = random.Random(5)
    items = [(i, " ".join(words(rng, 12)).capitalize() + ".") for i in range(6)] + [(6, None), (7, "!!"), (None, "kalo mi"), (8, "Kalo, MI"), (9, "x")]
    docs = []
    for d in range(n):
        own = " ".join(words(rng, 40))
        passage = damaged(rng, rng.choice(items[:6])[1], rng.choice([0, 0, 2, 5, 9, 30])) if d % 2 else ""
        docs.append((d, f"{own}\n{passage.upper() if d % 3 else passage}, {own}"))
    docs += [(100, None), (100, ""), (None, items[0][1]), (101, "kalo... mi"), (102, "x"), (103, "xy"), (104, items[1][1] * 200)]
    return docs, items, spark.createDataFrame(docs, "doc_id long, text string").withColumn("form", F.lit("clash")), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("limit", [8_000_000, 150])
def test_leaks(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "PASS_CHARACTERS", limit)  # the second value takes several passes
    docs, items, frame, listed = leak_tables(spark)
    want = plain_leaks(docs, items, 0.08)
    assert sorted([tuple(r) for r in decontaminate.leaks(frame, listed).collect()], key=repr) == want
    kept = decontaminate.without_leaks(frame, listed)
    assert kept.columns == frame.columns
    gone = {(d, t) for d, t in docs} - {(r.doc_id, r.text) for r in kept.collect()}
    assert {d for d, _ in gone} == {d for d, _, _ in want}
    assert kept.count() == len(docs) - len(gone)


def test_nothing_leaks_from_or_into_nothing(spark):
    _, _, frame, listed = leak_tables(spark)
    assert decontaminate.leaks(frame.limit(0), listed).count() == 0
    assert decontaminate.leaks(frame, listed.limit(0)).count() == 0
    assert decontaminate.without_leaks(frame, listed.limit(0)).count() == frame.count()


# --- similarity join


def shingles(text):
    found = [w for w in (x.strip(PUNCTUATION) for x in (text or "").lower().split()) if w]
    if not found:  # texts without words are copies where they are equal
        return (text or "").strip(), frozenset()
    return tuple(found), frozenset(tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4)))


def plain_classes(rows):
    sets = [(d, *shingles(t)) for d, t in rows if d is not None]
    links, parent = Counter(), list(range(len(sets)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, w, s) in enumerate(sets):
        for j in range(i):
            _, v, z = sets[j]
            if w == v or (s and z and len(s & z) >= 0.8 * len(s | z) - 1e-9):
                links[i] += 1
                links[j] += 1
                parent[top(i)] = top(j)
    least = defaultdict(lambda: 1 << 60)
    for i, (d, _, _) in enumerate(sets):
        least[top(i)] = min(least[top(i)], d)
    return sorted((d, least[top(i)], links[i]) for i, (d, _, _) in enumerate(sets))


def near_copies(seed, n=150):
    rng = random.Random(seed)
    bases = [words(rng, rng.choice([3, 8, 40, 120])) for _ in range(25)]
    rows = []
    for d in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 20])):
            w[rng.randrange(len(w))] = rng.choice(words(rng, 1))
        rows.append((d * 3, " ".join(x.upper() if d % 2 else x for x in w) + "." * (d % 3)))
    hot = words(rng, 60)
    for d in range(120):  # one large group of copies of different texts
        w = list(hot)
        w[rng.randrange(60)] = f"own{d}"
        rows.append((10_000 + d, " ".join(w)))
    rows += [(20_000 + d, " ".join(hot)) for d in range(80)]
    return rows + [(30_000, None), (30_001, ""), (30_002, " ...\n"), (30_005, "..."), (30_006, "====="), (30_007, "$ $ $ $"), (30_008, "--- | ---"), (30_009, "\u3000\n"), (None, "a b c d e f"), (30_003, "one"), (30_004, "one"), (0, rows[0][1]), (3, "another text under an id that is taken")]


@pytest.mark.parametrize("block", [256, 7])
def test_classes(spark, block):
    rows = near_copies(3)
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("clash")).withColumn("size", F.lit("clash")).repartition(4)
    got = ngram_join.similarity_classes(frame, block=block).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in got) == plain_classes(rows)


def test_all_white_space_parts_words(spark):
    rng = random.Random(5)
    rows = []
    for n, space in enumerate(["\u00a0", "\u3000", "\u2003", "\u0085", "\u2028", "\x1f", " \u202f"]):
        w = words(rng, 40)
        rows += [(10 * n + d, gap.join([*w[:-d], *w[: d - 1]])) for d, gap in enumerate([" ", space, "\n", space], 1)]
        rows += [(1000 + n, "Attention" + space + "! " + " ".join(w)), (2000 + n, "attention ! " + space.join(w) + space)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = ngram_join.similarity_classes(frame).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in got) == plain_classes(rows)
    assert {r.class_id for r in got if r.doc_id < 1000} == {10 * n + 1 for n in range(7)}


def test_no_classes(spark):
    assert ngram_join.similarity_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_bands_reach_the_recall():
    for threshold in (0.5, 0.8, 0.9):
        bands, rows = ngram_join.bands_for(threshold)
        assert bands * rows <= 128 and 1 - (1 - threshold**rows) ** bands >= 0.9995


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(150)] + [(500, i) for i in range(501, 700)]
    parent = {n: n for e in edges for n in e}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    got = graph.components(spark.createDataFrame(edges, "a long, b long"), scratch_folder(spark)).collect()
    assert {r.node: r.label for r in got} == {n: top(n) for n in parent}


# --- neighbours


def vectors(seed, n=900, size=16):
    rng = np.random.default_rng(seed)
    some = rng.standard_normal((n, size)).astype(np.float32)
    rows = [(i, v.tolist(), i % 7) for i, v in enumerate(some)]
    rows += [(2000 + i, some[3].tolist(), 0) for i in range(400)]  # one very common vector
    rows += [(3000, [0.0] * size, 0), (3050, None, 0), (3100, [None] + [1.0] * (size - 1), 0), (3150, [float("nan")] * size, 0), (3200, [float("inf")] * size, 0), (3250, [], 0), (None, some[0].tolist(), 0)]
    rows += [(4000, [1.0, 2.0], 0), (4050, [2.0, 4.0], 0), (50, some[50].tolist(), 0)]
    return rows


def plain_nearest(rows, every, k):
    good = [(i, np.array(v, float)) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for i, v in dict(reversed(good)).items():
        if i % every == 0:
            scores = {}
            for j, w in good:
                if j != i and len(w) == len(v):
                    scores[j] = max(scores.get(j, -2), round(float(v @ w / np.linalg.norm(v) / np.linalg.norm(w)), 12))
            out[i] = sorted(((-s, j) for j, s in scores.items()))[:k]
    return out


@pytest.mark.parametrize("leaf", [2048, 100])
def test_neighbours(spark, monkeypatch, leaf):
    monkeypatch.setattr(neighbours, "LEAF", leaf)
    rows = vectors(1)
    want = plain_nearest(rows, 50, 5)
    got = defaultdict(list)
    for r in neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>, leaf int")).orderBy("query_id", "rank").collect():
        assert r.rank == len(got[r.query_id]) + 1
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) <= set(want) and all(got[q] or not want[q] for q in want)
    hits = sum(len({j for _, j in want[q]} & {j for j, _ in got[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    for q, found in got.items():
        assert found == sorted(found, key=lambda x: (-round(x[1], 12), x[0]))
    assert [j for j, _ in got[2000]] == [3, 2001, 2002, 2003, 2004]  # ties go to the smaller id
    assert [j for j, _ in got[4000]] == [4050]


@pytest.mark.parametrize("leaf", [2048, 4])
def test_rows_of_one_id_are_one_neighbour(spark, monkeypatch, leaf):
    """Eight rows of one candidate do not take the places of others, and its best row gives its score."""
    monkeypatch.setattr(neighbours, "LEAF", leaf)
    rows = [(0, [1.0, 0.0, 0.0])] + [(7, [1.0, 0.1 * i, 0.0]) for i in range(1, 9)] + [(10 + i, [1.0, 1.0, float(i)]) for i in range(6)]
    rows += [(100, [3.0, 0.0, 0.0])]  # a multiple of the first query
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)).collect()
    found = {q: [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] for q in (0, 100)}
    assert found == {0: [100, 7, 10, 11, 12], 100: [0, 7, 10, 11, 12]}
    assert [r.score for r in got if r.vec_id == 7] == pytest.approx([1 / np.sqrt(1.01)] * 2, abs=1e-15)


def test_no_neighbours(spark):
    assert neighbours.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert neighbours.nearest(spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")).count() == 0


def test_chi_square():
    assert neighbours.chi_square(neighbours.chi_square_point(0.95, 12), 12) == pytest.approx(0.95)
    assert neighbours.chi_square_point(0.95, 12) == pytest.approx(21.026, abs=1e-3)


# --- archives


def test_archives(spark, monkeypatch):
    rng = random.Random(2)
    pages = [(i, f"http://a.example/{i}", "<p>" + " ".join(words(rng, rng.randrange(400))) + "</p>") for i in range(150)]
    pages += [(1000 + i, "http://hot.example/ä b\r\nX: y", "the same page") for i in range(90)]
    pages += [(2000, None, None), (2001, None, ""), (None, "u", "the same page"), (1089, "again", "the same page"), (2002, "u", "é" * 300_000)]
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 200_000)  # several archives a task
    folder = scratch_folder(spark)
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).repartition(3)
    files = warc.write_archives(frame, folder)
    rows = warc.read_archives(files).collect()
    last = defaultdict(lambda: -1)
    for i, _, html in pages:
        last[html or ""] = max(last[html or ""], -1 if i is None else i)
    want = []
    for i, _, html in pages:
        raw = (html or "").encode()
        response = i == last[html or ""]
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if response else "revisit", None if response else last[html or ""], raw if response else None))
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload) for r in rows], key=repr) == sorted(
        [(*w[:5], None if w[5] is None else bytearray(w[5])) for w in want], key=repr
    )
    assert files.count() > 1 and files.agg(F.sum("records")).first()[0] == len(pages)
    assert warc.write_archives(frame.limit(0), scratch_folder(spark)).count() == 0


def test_records_shorter_than_the_limit_never_revisit(spark):
    frame = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    rows = warc.read_archives(warc.write_archives(frame, scratch_folder(spark), least=3)).collect()
    assert {r.page_id: r.refers_to for r in rows} == {1: None, 2: None, 3: 4, 4: None}


# --- quality


def test_isotonic_is_monotone_and_keeps_the_sums():
    rng = np.random.default_rng(1)
    counts = rng.integers(1, 9, 60)
    ones = (counts * rng.random(60)).astype(int)
    middle, share = quality.isotonic(np.arange(60.0), counts, ones)
    assert (np.diff(share) > 0).all() and (np.diff(middle) > 0).all()


def test_statistics_of_odd_texts():
    for text in ("", " ", "\n", "a", "\x00", "é" * 9, "!!!", "word " * 30_000):
        values = quality.statistics(text)
        assert len(values) == len(quality.NAMES) and np.isfinite(values).all()


def test_classifier(spark):
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(1200):
        bad = i % 5 == 0
        w = words(rng, rng.randrange(5, 120))
        docs.append((i, " ".join(x.upper() + "!!" for x in w) if bad else " ".join(w)))
        if i % 3:
            labels.append((i, 0 if bad else 1, 0))
    docs += [(5000, None), (5000, ""), (None, "kalo mi ter"), (5001, "x" * 200_000)]
    labels += [(5000, None, 0), (None, 1, 0), (7, 5, 0)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("stats", F.lit("clash")).repartition(4)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = quality.quality_scores(frame.drop("stats"), known, scratch_folder(spark)).collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.doc_id is not None and r.doc_id < 1200 and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert sum((r.score >= 0.7) == (r.doc_id % 5 != 0) for r in held) >= 0.99 * len(held)
    model = quality.model_of(frame, known, scratch_folder(spark))
    kept = quality.keep_good(frame, model)
    assert kept.columns == frame.columns
    assert abs(kept.count() - sum(r.score >= 0.7 for r in rows)) == 0


def test_classifier_without_labels(spark):
    frame = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in quality.quality_scores(frame, none, scratch_folder(spark)).collect()] == [1.0, 1.0]
    assert quality.keep_good(frame, quality.model_of(frame, none, scratch_folder(spark))).count() == 2
    assert quality.quality_scores(frame.limit(0), none, scratch_folder(spark)).count() == 0


def plain_scores(rows, labels):
    """Scores by plain numpy on rows (doc_id, text), all steps written out."""
    fold = lambda i: zlib.crc32(str(i).encode()) % 4
    stats = {i: np.array(quality.statistics(t or "")) for i, t in rows}
    known = [i for i in stats if labels.get(i) in (0, 1) and fold(i) != 2]
    x = np.array([stats[i] for i in known])
    mean, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    rng = np.random.default_rng(20240501)
    d = x.shape[1]
    directions, phases = rng.standard_normal((d, 256)) / (2 * np.sqrt(d)), rng.uniform(0, 2 * np.pi, 256)

    def lifted(values):
        return np.array([[*(np.sqrt(2 / 256) * np.cos(np.clip((v - mean) / spread, -8, 8) @ directions + phases)), 1.0] for v in values])

    for_weights = [i for i in known if fold(i) != 3]
    z, y = lifted([stats[i] for i in for_weights]), np.array([labels[i] for i in for_weights], float)
    penalty = np.diag([1e-3 * len(y) / 256] * 256 + [1e-12 * len(y)])
    weights = np.linalg.inv(z.T @ z + penalty) @ (z.T @ y)
    raw = {i: float((lifted([v]) @ weights)[0]) for i, v in stats.items()}

    steps = defaultdict(list)
    for i in known:
        if fold(i) == 3:
            steps[int(np.clip((raw[i] + 1) / 3, 0, 1) * 2048)].append(labels[i])
    blocks = [[(s + 0.5) / 2048 * 3 - 1, len(v), sum(v)] for s, v in sorted(steps.items())]
    merged = True
    while merged:  # neighbours that do not rise are pooled until all do
        merged = False
        for n in range(len(blocks) - 1):
            (a, p, k), (b, q, m) = blocks[n], blocks[n + 1]
            if k / p >= m / q:
                blocks[n : n + 2] = [[(a * p + b * q) / (p + q), p + q, k + m]]
                merged = True
                break
    knots, shares = [b[0] for b in blocks], [b[2] / b[1] for b in blocks]
    return {i: min(max(0.999 * float(np.interp(r, knots, shares)) + 0.001 * min(max((r + 1) / 3, 0), 1), 0), 1) for i, r in raw.items()}


def test_scores_as_plain_numpy(spark):
    rng = random.Random(8)
    rows, labels = [], {}
    for i in range(320):
        w = words(rng, rng.randint(5, 80))
        bad = rng.random() < 0.4
        rows.append((i, " ".join(x + "!!" * (rng.random() < 0.5) if bad else x for x in w)))
        labels[i] = int(not bad) if rng.random() < 0.9 else int(bad)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    known = spark.createDataFrame(list(labels.items()), "doc_id long, quality int")
    got = {r.doc_id: r.score for r in quality.quality_scores(frame, known, scratch_folder(spark)).collect()}
    want = plain_scores(rows, labels)
    assert got.keys() == want.keys() and max(abs(got[i] - want[i]) for i in want) < 1e-6
