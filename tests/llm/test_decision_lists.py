"""Decision lists against plain Python: statistics, the growth of rules, and what they say of held-out rows."""

import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lodestrata.llm import decision_lists as lists
from lodestrata.session import scratch_folder

SCHEMA = "doc_id long, text string, n_words string, _words string, label string"
WORD = re.compile("[^\x20\x09-\x0d]+")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", "clash", "clash") for i, t in rows], SCHEMA).repartition(3)


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    often = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(repeated)


ODD = [None, "", " ", "\n\n", "a", "a b", "a b c", "a a a a", "a b c a b c", "x\x0by\x0cz", "nbsp is a sign", "﻿a", "# * $%&|<>", "a\n a\na\n\n\na", "é é é é",
       "a b c d " * 2000, "z" * 50_000, "ab c x a bc x ab c x", "one two three four one two three five two three four"]


def random_texts(seed, n):
    rng = random.Random(seed)
    return [rng.choice([" ", "\n", "\t"]).join(rng.choices("abcde#", k=rng.randint(0, 60))) for _ in range(n)]


def test_counts(spark):
    rows = list(enumerate([*ODD, *random_texts(1, 80)]))
    got = {r.doc_id: tuple(r[c] for c in lists.COUNTS) for r in lists.counted(frame(spark, rows)).collect()}
    assert got == {i: plain_counts(t) for i, t in rows}


def fold(i):
    return zlib.crc32(str(i).encode()) % 4


def corpus(seed, n):
    """Good prose; noise with many signs or, of few, with short words on many lines."""
    rng = random.Random(seed)
    rows, labels = [], {}
    for i in range(n):
        kind = rng.random()
        length = rng.randint(60, 200)
        if kind < 0.15:
            words, labels[i] = ["".join(rng.choices("abcdefghij", k=rng.randint(3, 9))) + rng.choice(["", "$$", "#"]) for _ in range(length)], 0
        elif kind < 0.3:
            words, labels[i] = ["".join(rng.choices("abcdefghijklmnop", k=2)) for _ in range(length)], 0
        else:
            words, labels[i] = ["".join(rng.choices("abcdefghij", k=rng.randint(3, 9))) for _ in range(length)], 1
        rows.append((i, " ".join(words)))
    return rows, labels


def plain_learn(rows, cuts):
    """Sequential covering over (values, label, prune) row by row; cuts as given."""
    names = list(cuts)
    holds = lambda v, c: v[c.feature] > c.cut if c.above else v[c.feature] <= c.cut
    covers = lambda v, cs: all(holds(v, c) for c in cs)
    rules, default = [], True
    while True:
        grow, prune = [r for r in rows if not r[2]], [r for r in rows if r[2]]
        good = sum(r[1] for r in grow)
        if not good or good == len(grow):
            return rules, good * 2 >= len(grow) if grow or not rules else default
        default = good * 2 >= len(grow)
        keep, conditions, left = not default, [], grow
        while len(conditions) < lists.MOST_CONDITIONS:
            hits = sum(r[1] == keep for r in left)
            best = None
            for name in names:
                for cut in cuts[name]:
                    for above in (False, True):
                        c = lists.Condition(name, above, cut)
                        inside = [r for r in left if holds(r[0], c)]
                        hit = sum(r[1] == keep for r in inside)
                        if hit and len(inside) < len(left):
                            gain = hit * (math.log2(hit / len(inside)) - math.log2(hits / len(left)))
                            if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                                best = gain, c
            if best is None:
                break
            conditions.append(best[1])
            left = [r for r in left if holds(r[0], best[1])]
            if all(r[1] == keep for r in left):
                break

        def share(n, some):
            inside = [r for r in some if covers(r[0], conditions[:n])]
            return sum(r[1] == keep for r in inside) / len(inside) if inside else 0.0

        best = (0.0, 0)
        for some in (prune, grow):
            if not best[0]:
                best = max(((share(n, some), -n) for n in range(1, len(conditions) + 1)), default=(0.0, 0))
        if best[0] <= 0.5:
            return rules, default
        conditions = conditions[: -best[1]]
        rules.append((conditions, keep))
        rows = [r for r in rows if not covers(r[0], conditions)]


def test_learns_as_row_by_row(spark):
    rows, labels = corpus(2, 240)
    known = spark.createDataFrame([(i, y, 0) for i, y in labels.items()], "doc_id long, quality int, toxic int")
    counts = lists.counted(frame(spark, rows))
    training = lists.training_rows(counts, known).cache()
    cuts = lists.cuts_of(training, list(lists.features()))
    learned = lists.learn(training, scratch_folder(spark))
    plain_rows = [({n: r[n] for n in cuts}, r.label, r.prune) for r in training.collect()]
    rules, default = plain_learn(plain_rows, cuts)
    assert [(list(r.conditions), r.keep) for r in learned.rules] == rules and learned.default == default
    assert len(rules) >= 2 and default
    training.unpersist()


def test_verdicts_on_held_out_rows(spark):
    rows, labels = corpus(3, 600)
    rows += [(None, rows[0][1]), (1000, None), (1001, ""), (1002, "short text"), (1003, "one two three " * 40), rows[5]]
    known = spark.createDataFrame([(i, y) for i, y in labels.items()] + [(2, None), (3, 7), (None, 1)], "doc_id long, quality int")
    found, learned = lists.quality_rules(frame(spark, rows), known, scratch_folder(spark))
    got = found.collect()
    assert len(got) == len(rows) and str(learned).startswith("CASE")
    held = [r for r in got if r.doc_id in labels and fold(r.doc_id) == 2]
    assert sum(r.kept == bool(labels[r.doc_id]) for r in held) >= 0.97 * len(held)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    # the text of the list is the verdict as SQL
    text = str(learned)
    for name, column in (("word_length", "(word_chars / n_words)"), ("symbols_per_word", "(n_symbols / n_words)"), ("words_per_line", "(n_words / n_lines)"),
                         ("dup_line_share", "(n_dup_lines / n_lines)"), ("repeat_share", "(n_repeat_words / n_words)")):
        text = text.replace(name, column)
    assert found.filter(~F.col("base_failed")).filter(F.expr(text) != F.col("kept")).count() == 0


@pytest.mark.parametrize("labels", [[], [(0, 1), (1, 1)], [(0, None)]])
def test_nothing_to_learn(spark, labels):
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    rows = [(i, " ".join(f"word{k}" for k in range(60))) for i in range(4)]
    found, learned = lists.quality_rules(frame(spark, rows), known, scratch_folder(spark))
    assert not learned.rules and all(r.kept for r in found.collect())
    found, _ = lists.quality_rules(frame(spark, []), known, scratch_folder(spark))
    assert found.count() == 0


def test_no_python_in_the_plan(spark):
    rows, labels = corpus(4, 60)
    known = spark.createDataFrame(list(labels.items()), "doc_id long, quality int")
    plan = lists.counted(frame(spark, rows))._jdf.queryExecution().toString()
    found, _ = lists.quality_rules(frame(spark, rows), known, scratch_folder(spark))
    plan += found._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
