"""A quality classifier: ridge scores over random Fourier features of document statistics, calibrated isotonically."""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.common import stored

NAMES = [
    "log_chars", "log_words", "word_length", "word_spread", "distinct", "distinct_pairs", "most_common", "repeated_next",
    "upper", "lower", "digit", "space", "line_end", "beyond_ascii", "control", "sign", "upper_words", "signed_words",
    "distinct_lines", "line_words", *(f"sign_{i}" for i in range(8)),
]
WATCHED = b"!|%#&*$."
FEATURES = 256
#: Scores are counted in so many steps for calibration, whatever the number of rows.
STEPS = 2048
#: Groups in which the tasks' sums are added up first.
LANES = 256


def statistics(text: str) -> list[float]:
    """What is known of a whole text, an empty one too; all shares lie between 0 and 1."""
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    size = max(int(raw.sum()), 1)
    words = text.split()
    n = max(len(words), 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x]
    upper, lower, digit = int(raw[65:91].sum()), int(raw[97:123].sum()), int(raw[48:58].sum())
    beyond, control = int(raw[128:].sum()), int(raw[:32].sum() - raw[9:14].sum() + raw[127])
    signs = size - upper - lower - digit - beyond - int(raw[32] + raw[:32].sum() + raw[127]) if text else 0
    pairs = len(set(zip(words, words[1:])))
    return [
        np.log1p(len(text)),
        np.log1p(len(words)),
        np.log1p(lengths.mean()),
        np.log1p(lengths.std()),
        len(counts) / n,
        pairs / max(n - 1, 1),
        max(counts.values(), default=0) / n,
        sum(map(operator.eq, words, words[1:])) / n,
        upper / size,
        lower / size,
        digit / size,
        int(raw[32]) / size,
        int(raw[10]) / size,
        beyond / size,
        control / size,
        signs / size,
        sum(k for w, k in counts.items() if w.isupper()) / n,
        sum(k for w, k in counts.items() if not w[-1].isalnum()) / n,
        len(set(lines)) / max(len(lines), 1),
        np.log1p(len(words) / max(len(lines), 1)),
        *(int(raw[b]) / n for b in WATCHED),
    ]


def with_statistics(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The chosen columns of each row with `stats`, an array; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = [statistics(t or "") for t in batch.column("_text").to_pylist()]
            own = pa.array(stats, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), own], names=[*columns, "stats"])

    kinds = ", ".join(f"`{c}` {t}" for c, t in docs.select(*columns).dtypes)
    return docs.select(*columns, F.col("text").alias("_text")).mapInArrow(run, f"{kinds}, stats array<double>")


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; rows without id have none."""
    return (F.crc32(doc_id.cast("string").cast("binary")) % 4).cast("int")


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return features((stats - self.mean) / self.spread) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated chances of label 1. A thousandth of the raw score keeps the order within a step."""
        raw = self.raw(stats)
        return np.clip(0.999 * np.interp(raw, self.knots, self.values) + 0.001 * np.clip((raw + 1) / 3, 0, 1), 0, 1)


def features(scaled: np.ndarray) -> np.ndarray:
    """Random Fourier features of a Gaussian kernel, and a constant.

    The kernel is as wide as twice the root of the number of statistics: rare kinds of texts, such as very short ones,
    then still have neighbours to be judged by.
    """
    rng = np.random.default_rng(20240501)
    d = scaled.shape[1]
    directions = rng.standard_normal((d, FEATURES)) / (2 * np.sqrt(d))
    phases = rng.uniform(0, 2 * np.pi, FEATURES)
    waves = np.cos(np.clip(scaled, -8, 8) @ directions + phases) * np.sqrt(2 / FEATURES)
    return np.hstack([waves, np.ones((len(scaled), 1))])


def normal_equations(rows: DataFrame, mean: np.ndarray, spread: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y over `rows` (stats, label), summed within tasks, then row by row of the matrix on the executors.

    The tasks' sums of a row are added up in two levels, in `LANES` groups and then these, so that no group grows with the tasks.
    """
    size = FEATURES + 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            if batch.num_rows:
                stats = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
                z = features((stats - mean) / spread)
                total += z.T @ np.hstack([z, batch.column(1).to_numpy()[:, None]])
        lists = pa.ListArray.from_arrays(pa.array(np.arange(size + 1, dtype=np.int32) * (size + 1)), pa.array(total.ravel()))
        lane = np.full(size, TaskContext.get().partitionId() % LANES, np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(lane), lists], names=["i", "lane", "sums"])

    def summed(table: pa.Table) -> pa.Table:
        parts = table.column("sums").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
        own = {"i": table.column("i")[:1], "lane": table.column("lane")[:1]}
        return pa.table({**own, "sums": pa.array([parts.sum(axis=0)], pa.list_(pa.float64()))})

    kinds = "i int, lane int, sums array<double>"
    total = np.zeros((size, size + 1))
    each = rows.select("stats", F.col("label").cast("double").alias("label")).mapInArrow(partial, kinds)
    lanes = each.groupBy("i", "lane").applyInArrow(summed, kinds)
    for r in lanes.groupBy("i").applyInArrow(summed, kinds).collect():  # one row per feature
        total[r["i"]] = r["sums"]
    return total[:, :size], total[:, size]


def isotonic(scores: np.ndarray, counts: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the middle of each block of ascending scores and its share of ones."""
    blocks: list[list[float]] = []
    for s, n, k in zip(scores.tolist(), counts.tolist(), ones.tolist()):
        blocks.append([s * n, n, k])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[0] / b[1] for b in blocks]), np.array([b[2] / b[1] for b in blocks])


def fit(rows: DataFrame, ridge: float = 1e-3) -> Model | None:
    """The model of `rows` (doc_id, stats, label 0 or 1); None without rows. Weights come from the folds other than 3,
    the calibration from fold 3 (from all where it is empty)."""
    at = [F.col("stats")[i] for i in range(len(NAMES))]
    moments = rows.agg(F.count("*").alias("n"), *(f(x).alias(f"{k}{i}") for i, x in enumerate(at) for k, f in (("m", F.avg), ("s", F.stddev_pop)))).first()
    if not moments["n"]:
        return None
    mean = np.array([moments[f"m{i}"] for i in range(len(NAMES))])
    spread = np.maximum(np.array([moments[f"s{i}"] for i in range(len(NAMES))]), 1e-3)
    for_weights = rows.filter(fold(F.col("doc_id")) != 3)
    gram, target = normal_equations(for_weights, mean, spread)
    if not gram[-1, -1]:
        gram, target = normal_equations(rows, mean, spread)
    weights = np.linalg.solve(gram + ridge * gram[-1, -1] * np.diag([*np.ones(FEATURES) / FEATURES, 1e-9]), target)
    model = Model(mean, spread, weights, np.zeros(1), np.zeros(1))

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, len(NAMES)))
            step = np.floor(np.clip((model.raw(stats) + 1) / 3, 0, 1) * STEPS)
            yield pa.RecordBatch.from_arrays([pa.array(step.astype(np.int32)), batch.column(1)], names=["step", "label"])

    def counted(some: DataFrame) -> list:
        each = some.select("stats", F.col("label").cast("int").alias("label")).mapInArrow(steps, "step int, label int")
        return each.groupBy("step").agg(F.count("*").alias("n"), F.sum("label").alias("ones")).orderBy("step").collect()

    found = counted(rows.filter(fold(F.col("doc_id")) == 3)) or counted(rows)
    scores = (np.array([r["step"] for r in found]) + 0.5) / STEPS * 3 - 1
    model.knots, model.values = isotonic(scores, np.array([r["n"] for r in found]), np.array([r["ones"] for r in found]))
    return model


def scored(stats: DataFrame, model: Model | None) -> DataFrame:
    """`stats` with `score` in place of the statistics; without a model every score is 1, as nothing speaks against a row."""
    columns = [c for c in stats.columns if c != "stats"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.ones(batch.num_rows)
            if model is not None and batch.num_rows:
                own = model.score(batch.column("stats").flatten().to_numpy().reshape(batch.num_rows, -1))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(own)], names=[*columns, "score"])

    kinds = ", ".join(f"`{c}` {t}" for c, t in stats.select(*columns).dtypes)
    return stats.mapInArrow(run, f"{kinds}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, folder: str, learn: Column | None = None) -> DataFrame:
    """doc_id and score for every row of `docs` (doc_id, text).

    The model learns from the labelled rows (labels: doc_id, quality 0 or 1; other values and nulls teach nothing) whose
    fold `learn` admits, by default all but fold 2. Only the text is looked at. Null and empty texts are scored
    like others, by statistics of an empty text; rows of one id are scored each. Statistics are stored in `folder`.
    """
    stats = stored(with_statistics(docs.select("doc_id", "text"), ["doc_id"]), f"{folder}/statistics")
    return scored(stats, fit(stored(training(stats, labels, learn), f"{folder}/training")))


def keep_good(docs: DataFrame, model: Model | None, threshold: float = 0.7) -> DataFrame:
    """The rows of `docs` (text, any columns) that score `threshold` or more; all of them without a model."""
    if model is None:
        return docs
    kinds = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = kinds.fieldNames().index("text")
        for batch in batches:
            if batch.num_rows:
                stats = np.array([statistics(t or "") for t in batch.column(at).to_pylist()])
                yield batch.filter(pa.array(model.score(stats) >= threshold))

    return docs.mapInArrow(run, kinds)


def model_of(docs: DataFrame, labels: DataFrame, folder: str) -> Model | None:
    """The model that `quality_scores` fits, without the scores. Statistics meet the labels, as texts would be dealt with them."""
    stats = with_statistics(docs.select("doc_id", "text"), ["doc_id"])
    return fit(stored(training(stats, labels, None), f"{folder}/training"))


def training(rows: DataFrame, labels: DataFrame, learn: Column | None) -> DataFrame:
    """The labelled ones of `rows` (doc_id, more) that are to learn from, with `label`."""
    known = labels.filter(F.col("quality").isin(0, 1)).select(F.col("doc_id").alias("_doc"), F.col("quality").alias("label"))
    admitted = fold(F.col("doc_id")) != 2 if learn is None else learn
    return rows.filter(admitted).join(known, F.col("doc_id") == F.col("_doc")).drop("_doc")
