"""Whitening of embeddings by the covariance of distinct vectors weighted with how often each occurs.

Entries become integers, so that equal vectors are found exactly and means and deviations are sums of integers. Equal vectors
are grouped once; their covariance is a weighted centred matrix product per task, whose entries Spark sums. Each distinct vector
is whitened once and joined back to the rows that hold it by its digest.

Vectors of different lengths are separate lists with counts, means and components of their own.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.common import stored

SCALE = 1024
SHIFT = 100_000
#: Entries are held to this many units, where doubles still are integers one by one.
LARGEST = 1 << 52
LOW_BITS = 26


def integers(embedding: Column) -> Column:
    """floor(1024 c) + 100000 of every entry c as a double; what lies beyond 2^52 units stops there."""
    held = lambda c: F.greatest(F.least(c.cast("double") * SCALE, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))
    return F.transform(embedding, lambda c: F.floor(held(c)).cast("long") + SHIFT)


def usable(embedding: Column) -> Column:
    """Neither null nor empty, and all entries are finite."""
    finite = F.forall(embedding, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return embedding.isNotNull() & (F.size(embedding) > 0) & finite


def digest(x: Column) -> Column:
    return F.unhex(F.sha2(F.array_join(x.cast("array<string>"), ","), 256))


@dataclass
class Fit:
    """What is known of the vectors of one length: their number (with multiplicity), exact sums, eigenvalues and eigenvectors."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def sound(self) -> np.ndarray:
        """Components along which vectors differ by more than rounding."""
        return self.values > max(float(self.values.max(initial=0.0)), 0.0) * len(self.sums) * np.finfo(float).eps

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exactly: in 64-bit integers where these hold it, else in Python's."""
        if x.size and self.n * int(np.abs(x).max()) + int(np.abs(self.sums).max()) >= 1 << 62:
            x = x.astype(object)
        return self.n * x - (self.sums if x.dtype == object else self.sums.astype(np.int64))

    def deviations(self, centred: np.ndarray) -> list[int]:
        if centred.dtype != object and centred.size and int(np.abs(centred).max()) ** 2 * centred.shape[1] >= 1 << 62:
            centred = centred.astype(object)
        return [int(v) for v in (centred * centred).sum(axis=1)]


def distinct_vectors(vectors: DataFrame, weights: str = "counts") -> DataFrame:
    """key, size, x, weight of each distinct vector of `vectors` (x); `weights` is "counts", or "one" to fit each once."""
    if weights not in ("counts", "one"):
        raise ValueError(f"weights are counts or one, not {weights}")
    weight = F.count("*") if weights == "counts" else F.lit(1).cast("long")
    return vectors.groupBy("x").agg(weight.alias("weight")).select(
        digest(F.col("x")).alias("key"), F.size("x").alias("size"), "x", "weight"
    )


def _totals(distinct: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """Number and exact sums per length. Values are summed in two parts, so that no sum leaves 64 bits."""
    low = F.col("c").bitwiseAND(F.lit((1 << LOW_BITS) - 1))
    each = distinct.select("size", "weight", F.posexplode("x").alias("at", "c"))
    sums = each.groupBy("size", "at").agg(
        F.sum("weight").alias("n"),
        F.sum(F.col("weight") * F.shiftright("c", LOW_BITS)).alias("high"),
        F.sum(F.col("weight") * low).alias("low"),
    )
    found: dict[int, dict[int, tuple[int, int]]] = defaultdict(dict)
    for r in sums.collect():  # one row per dimension
        found[r["size"]][r["at"]] = (r["n"], (r["high"] << LOW_BITS) + r["low"])
    return {s: (of[0][0], np.array([of[i][1] for i in range(s)], object)) for s, of in found.items()}


def _matrix(batch: pa.RecordBatch, chosen: np.ndarray, size: int) -> np.ndarray:
    return batch.column("x").take(pa.array(chosen)).flatten().to_numpy().reshape(-1, size)


def _by_size(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    sizes = batch.column("size").to_numpy()
    for size in np.unique(sizes).tolist():
        yield size, np.flatnonzero(sizes == size)


def covariances(distinct: DataFrame, totals: dict[int, tuple[int, np.ndarray]]) -> dict[int, np.ndarray]:
    """Weighted centred products of the vectors of each length, divided by their number."""
    centre = {s: Fit(n, sums, np.zeros(0), np.zeros((0, 0)), 0.0) for s, (n, sums) in totals.items()}

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            weight = batch.column("weight").to_numpy()
            for size, rows in _by_size(batch):
                c = centre[size].centred(_matrix(batch, rows, size)).astype(np.float64) / centre[size].n
                own[size] = own.get(size, 0.0) + (c * weight[rows, None]).T @ c
        for size, total in own.items():
            i, j = np.triu_indices(size)
            columns = [np.full(len(i), size, np.int32), i.astype(np.int32), j.astype(np.int32), total[i, j]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["size", "i", "j", "v"])

    each = distinct.select("size", "x", "weight").mapInArrow(products, "size int, i int, j int, v double")
    found = {s: np.zeros((s, s)) for s in totals}
    for r in each.groupBy("size", "i", "j").agg(F.sum("v").alias("v")).collect():  # as many rows as half a matrix has entries
        found[r["size"]][r["i"], r["j"]] = found[r["size"]][r["j"], r["i"]] = r["v"] / totals[r["size"]][0]
    return found


def fitted(distinct: DataFrame) -> dict[int, Fit]:
    """Per length of vectors: the components of their covariance by falling eigenvalue."""
    totals = _totals(distinct)
    fits = {}
    for size, v in covariances(distinct, totals).items():
        values, vectors = np.linalg.eigh(v)
        fits[size] = Fit(*totals[size], values[::-1], vectors[:, ::-1], float(np.trace(v)))
    return fits


def whitened_vectors(distinct: DataFrame, fits: dict[int, Fit], components: int) -> DataFrame:
    """key, size, weight, deviation (exact, decimal) and whitened (up to `components` doubles) of each distinct vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, rows in _by_size(batch):
                fit = fits[size]
                centred = fit.centred(_matrix(batch, rows, size))
                kept = min(components, size)
                sound = fit.sound[:kept]
                root = np.sqrt(np.where(sound, fit.values[:kept], 1.0))
                out = centred.astype(np.float64) / fit.n @ fit.vectors[:, :kept] / root
                flat = pa.array(out.ravel(), mask=np.broadcast_to(~sound, out.shape).ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * kept), flat)
                at = pa.array(rows)
                exact = pa.array([str(d) for d in fit.deviations(centred)], pa.string())
                columns = [*(batch.column(c).take(at) for c in ("key", "size", "weight")), exact, lists]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "size", "weight", "exact", "whitened"])

    rows = distinct.select("key", "size", "weight", "x").mapInArrow(
        run, "key binary, size int, weight long, exact string, whitened array<double>"
    )
    return rows.withColumn("deviation", F.col("exact").try_cast("decimal(38,0)")).drop("exact")


def identity_errors(white: DataFrame, fits: dict[int, Fit], components: int) -> dict[int, float | None]:
    """Per length: the largest absolute entry of the whitened vectors' covariance minus the identity, over sound components."""
    weight = F.col("weight").cast("double")
    at = [F.get("whitened", F.lit(i)) for i in range(components)]
    means = {r["size"]: r for r in white.groupBy("size").agg(F.sum("weight").alias("n"), *(F.sum(weight * x).alias(f"m{i}") for i, x in enumerate(at))).collect()}
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    errors: dict[int, float | None] = {}
    for size, row in means.items():
        m = [(row[f"m{i}"] or 0.0) / row["n"] for i in range(components)]
        sums = [F.sum(weight * (at[i] - m[i]) * (at[j] - m[j])).alias(f"c{i}_{j}") for i, j in pairs]
        found = white.filter(F.col("size") == size).agg(*sums).first()
        sound = set(np.flatnonzero(fits[size].sound[:components]).tolist())
        inside = [abs(found[f"c{i}_{j}"] / row["n"] - (i == j)) for i, j in pairs if {i, j} <= sound]
        errors[size] = max(inside, default=None)
    return errors


def whiten(
    vectors: DataFrame, folder: str, components: int = 8, weights: str = "counts", id_column: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """One row per row of `vectors` that is usable and component: vec_id, component (from 1), n, deviation (decimal, exact),
    whitened, explained and identity_error.

    Rows whose vector is null, empty or holds null or non-finite entries are left out; null and repeated ids stay, other columns
    are not looked at. Along components in which the vectors do not differ (equal vectors, fewer vectors than dimensions)
    `whitened` is null and the identity is not asked for; `explained` is null where nothing varies. A deviation of more than 38
    digits is null. Distinct and whitened vectors are stored in `folder`.
    """
    own = F.col("_embedding")
    good = vectors.select(F.col(id_column).alias("vec_id"), F.col(embedding).alias("_embedding")).filter(usable(own))
    rows = good.select("vec_id", integers(own).alias("x"))
    distinct = stored(distinct_vectors(rows, weights), f"{folder}/distinct")
    fits = fitted(distinct)
    white = stored(whitened_vectors(distinct, fits, components), f"{folder}/whitened")
    errors = identity_errors(white, fits, components)

    # As many cases as there are lengths of vectors.
    known = F.lit(None).cast("struct<n:bigint,explained:array<double>,identity_error:double>")
    for size, fit in fits.items():
        shares = [float(v) / fit.trace if fit.trace > 0 else None for v in fit.values[:components]]
        own_values = F.struct(
            F.lit(fit.n).cast("long").alias("n"),
            F.array(*map(F.lit, shares)).cast("array<double>").alias("explained"),
            F.lit(errors.get(size)).cast("double").alias("identity_error"),
        )
        known = F.when(F.col("size") == size, own_values).otherwise(known)
    each = rows.select("vec_id", digest(F.col("x")).alias("key")).join(white.drop("weight"), "key")
    parted = each.select("vec_id", "deviation", known.alias("_of"), F.posexplode("whitened").alias("_at", "whitened"))
    return parted.select(
        "vec_id",
        (F.col("_at") + 1).alias("component"),
        "_of.n",
        "deviation",
        "whitened",
        F.get("_of.explained", F.col("_at")).alias("explained"),
        "_of.identity_error",
    )
