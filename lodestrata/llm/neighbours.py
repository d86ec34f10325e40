"""Nearest neighbours by cosine over stable projections that a kd-tree indexes.

Vectors are scaled to length one, where the cosine orders as the distance does, and projected to `DIMENSIONS` Gaussian
(2-stable) directions. Of a pair at distance d, the squared projected distance over d² has a chi-square distribution.
The kd-tree's median cuts are fitted on a bounded sample of projections; every vector lies in one leaf. A query first verifies
the nearest of its own leaf, which bounds its k-th distance. Then it goes on to the leaves, and within a leaf to the
vectors, in the order of projected distance, verifying true distances, until the chi-square test holds: what is still ahead
is, if it were as near as the k-th found, this near in projection with a chance of at least `confidence`.
Recall is about `confidence`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm.common import partitions, stored
from lodestrata.llm.ngram_join import groups_of
from lodestrata.session import scratch_folder

DIMENSIONS = 12
#: Bounds of the index: vectors that fit the cuts, leaves, vectors of a leaf in one task, queries of a leaf in one task.
SAMPLE = 20_000
LEAVES = 4096
LEAF = 2048
VISITS = 4096
PORTION = 256


def chi_square(x: float, freedom: int) -> float:
    """The chance that a chi-square variable of an even number of degrees of freedom is at most x."""
    half, term, total = x / 2, 1.0, 0.0
    for i in range(freedom // 2):
        total += term
        term *= half / (i + 1)
    return 1 - math.exp(-half) * total


def chi_square_point(p: float, freedom: int) -> float:
    """The x at which that chance is p."""
    low, high = 0.0, 1.0
    while chi_square(high, freedom) < p:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, freedom) < p else (low, middle)
    return high


def directions(size: int) -> np.ndarray:
    return np.random.default_rng(7 + size).standard_normal((size, DIMENSIONS))


@dataclass
class Tree:
    """Median cuts: node i sends what is below `cut` along `axis` to node 2i + 1, the rest to 2i + 2."""

    depth: int
    axis: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    cut: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @classmethod
    def fitted(cls, points: np.ndarray, depth: int) -> Tree:
        """Each node is cut at the median of its widest axis."""
        tree = cls(depth, np.zeros(2**depth - 1, np.int64), np.zeros(2**depth - 1))
        inside = [points]
        for node in range(2**depth - 1):
            own = inside[node]
            if len(own):
                tree.axis[node] = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
                tree.cut[node] = np.median(own[:, tree.axis[node]])
            below = own[:, tree.axis[node]] < tree.cut[node]
            inside += [own[below], own[~below]]
        return tree

    def leaf(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[np.arange(len(points)), self.axis[node]] >= self.cut[node])
        return node - (2**self.depth - 1)

    def boxes(self) -> tuple[np.ndarray, np.ndarray]:
        """The lower and upper corners of all leaves."""
        low = [np.full(DIMENSIONS, -np.inf)]
        high = [np.full(DIMENSIONS, np.inf)]
        for node in range(2**self.depth - 1):
            left, right = high[node].copy(), low[node].copy()
            left[self.axis[node]] = right[self.axis[node]] = self.cut[node]
            low += [low[node], right]
            high += [left, high[node]]
        first = 2**self.depth - 1
        return np.array(low[first:]), np.array(high[first:])


def projected(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id, size, unit (scaled to length one, 64-bit floats), projection; of the vectors that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                v = np.array(raw, np.float64)
                largest = np.abs(v).max()
                v = v / largest
                v /= np.linalg.norm(v)
                rows.append((key, len(v), v.tobytes(), (v @ directions_of(len(v))).tobytes()))
            columns = zip(*rows) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
                names=["vec_id", "size", "unit", "projection"],
            )

    cache: dict[int, np.ndarray] = {}

    def directions_of(size: int) -> np.ndarray:
        if size not in cache:
            cache[size] = directions(size)
        return cache[size]

    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    chosen = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
    good = chosen.filter(F.col("vec_id").isNotNull() & x.isNotNull() & finite & F.exists(x, lambda c: c != 0))
    return good.mapInArrow(run, "vec_id long, size int, unit binary, projection binary")


def matrix(column: pa.ChunkedArray, dtype=np.float64) -> np.ndarray:
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), dtype).reshape(len(raw), -1)


def nearer(found: list[tuple[float, int]], scores: np.ndarray, ids: np.ndarray, query: int, k: int) -> list[tuple[float, int]]:
    """The k best (-score, id) of those found and the new ones, each id once with its largest score, without the query's own."""
    best = {v: s for s, v in found}
    for s, v in zip((-scores).tolist(), ids.tolist()):
        if v != query and s < best.get(v, math.inf):
            best[v] = s
    return sorted((s, v) for v, s in best.items())[:k]


class _Leaf:
    """Vectors of a part of a leaf, against which queries are verified in portions."""

    def __init__(self, group: pa.Table):
        self.ids = group.column("vec_id").to_numpy()
        self.unit, self.projection = matrix(group.column("unit")), matrix(group.column("projection"))

    def nearest(self, group: pa.Table, k: int, point: float) -> list[tuple]:
        """For each query the k nearest verified ones as (query_id, vec_id, score); a bound is the squared k-th distance."""
        out: list[tuple] = []
        units, marks = matrix(group.column("unit")), matrix(group.column("projection"))
        queries, bounds = group.column("vec_id").to_numpy(), group.column("bound").to_numpy()
        ahead = (marks**2).sum(1)[:, None] + (self.projection**2).sum(1)[None, :] - 2 * marks @ self.projection.T
        for i, (query, bound) in enumerate(zip(queries.tolist(), bounds.tolist())):
            order = np.argsort(ahead[i], kind="stable")
            near = ahead[i][order]
            found: list[tuple[float, int]] = []
            at = 0
            # On with the next projected neighbours until the test holds for the nearest of them.
            while at < len(order) and near[at] <= point * bound + 1e-9:
                some = order[at : at + 64]
                at += 64
                scores = (self.unit[some] * units[i]).sum(axis=1)
                found = nearer(found, scores, self.ids[some], query, k)
                if len(found) == k:
                    bound = min(bound, max(2 + 2 * found[-1][0], 0.0))
                    while at < len(order) and near[at] <= near[at - 1] + 1e-9 and near[at] > point * bound + 1e-9:
                        more = order[at : at + 64]  # equally near in projection: ties are all looked at
                        at += 64
                        scores = (self.unit[more] * units[i]).sum(axis=1)
                        found = nearer(found, scores, self.ids[more], query, k)
            out += [(query, v, -s) for s, v in found]
        return out


def searcher(k: int, point: float):
    """Over rows sorted by part with a part's vectors before its queries: query_id, vec_id, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaf: _Leaf | None = None
        at: tuple | None = None
        for batch in batches:
            for group in groups_of(iter([batch]), 4):
                key = tuple(group.column(i)[0].as_py() for i in range(3))
                if not group.column(3)[0].as_py():
                    # A part's vectors may come in several batches.
                    own = _Leaf(group)
                    if leaf is not None and at == key:
                        own.ids = np.concatenate((leaf.ids, own.ids))
                        own.unit = np.vstack((leaf.unit, own.unit))
                        own.projection = np.vstack((leaf.projection, own.projection))
                    leaf, at = own, key
                elif leaf is not None and at == key:
                    for a in range(0, group.num_rows, PORTION):
                        rows = leaf.nearest(group.slice(a, PORTION), k, point)
                        columns = zip(*rows) if rows else ((), (), ())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))],
                            names=["query_id", "vec_id", "score"],
                        )

    return run


PART = ["leaf", "salt", "copy"]


def _search(index: DataFrame, visits: DataFrame, counts: dict, k: int, point: float, n: int) -> DataFrame:
    """Deals visits (leaf, and a query's columns) and the vectors of their leaves to parts and verifies them there.

    A leaf of many vectors is dealt into salts, each of which sees all its queries; where many queries visit, the vectors
    are copied for every `VISITS` of them. Both numbers come from counts per leaf, of which there are at most `LEAVES`.
    """
    asked = {r["leaf"]: r["count"] for r in visits.groupBy("leaf").count().collect()}
    salts = F.array(*[F.lit(max(1, math.ceil(counts.get(i, 0) / LEAF))) for i in range(max(counts) + 1)])
    copies = F.array(*[F.lit(max(1, math.ceil(asked.get(i, 0) / VISITS))) for i in range(max(counts) + 1)])
    columns = ["kind", "vec_id", "unit", "projection", "bound"]
    vectors = (
        index.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.get(salts, F.col("leaf"))).cast("int"))
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.get(copies, F.col("leaf")) - 1)))
        .select(*PART, F.lit(0).alias("kind"), "vec_id", "unit", "projection", F.lit(0.0).alias("bound"))
    )
    queries = (
        visits.withColumn("copy", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.get(copies, F.col("leaf"))).cast("int"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.get(salts, F.col("leaf")) - 1)))
        .select(*PART, F.lit(1).alias("kind"), "vec_id", "unit", "projection", "bound")
    )
    dealt = vectors.unionByName(queries).select(*PART, *columns).repartition(n, *PART).sortWithinPartitions(*PART, "kind", "vec_id")
    return dealt.mapInArrow(searcher(k, point), "query_id long, vec_id long, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest(
    vectors: DataFrame, every: int = 50, k: int = 5, confidence: float = 0.97, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found by cosine, ties to smaller vec_id.

    Queries are the vectors whose id is divisible by `every`, candidates all but the query itself (all rows of its id).
    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows without id; vectors of
    different lengths never meet. Repeated ids count once, with their largest score. Fewer candidates give fewer rows,
    an empty table none.
    """
    spark = vectors.sparkSession
    folder = scratch_folder(spark)
    n = partitions(spark)
    points = stored(projected(vectors, vec_id, embedding), f"{folder}/points")
    parts = []
    for size, total in sorted((r["size"], r["count"]) for r in points.groupBy("size").count().collect()):
        own = points.filter(F.col("size") == size)
        parts.append(_nearest_of(own, total, every, k, confidence, f"{folder}/{size}", n))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = parts[0]
    for more in parts[1:]:
        found = found.union(more)
    return found


def _nearest_of(points: DataFrame, total: int, every: int, k: int, confidence: float, folder: str, n: int) -> DataFrame:
    sample = points.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("projection").collect()
    depth = int(min(math.log2(LEAVES), max(0, math.ceil(math.log2(max(total, 1) / LEAF)))))
    tree = Tree.fitted(np.array([np.frombuffer(r["projection"]) for r in sample]), depth)
    low, high = tree.boxes()
    point = chi_square_point(confidence, DIMENSIONS)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = tree.leaf(matrix(batch.column("projection"))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(leaf), *batch.columns], names=["leaf", "vec_id", "unit", "projection"])

    index = stored(
        points.select("vec_id", "unit", "projection").mapInArrow(placed, "leaf int, vec_id long, unit binary, projection binary"),
        f"{folder}-index",
    )
    counts = {r["leaf"]: r["count"] for r in index.groupBy("leaf").count().collect()}
    queries = index.filter(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"]).withColumn("bound", F.lit(4.0))
    home = stored(_best(_search(index, queries, counts, k, 1e300, n), k), f"{folder}-home")
    bound = home.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    bounded = (
        queries.drop("bound")
        .join(bound, F.col("vec_id") == F.col("query_id"), "left")
        .withColumn("bound", F.when(F.col("n") == k, F.greatest(2 - 2 * F.col("least"), F.lit(0.0))).otherwise(4.0))
        .select("leaf", "vec_id", "unit", "projection", "bound")
    )
    full = np.array([i in counts for i in range(len(low))])

    def visited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, PORTION):
                part = batch.slice(a, PORTION)
                marks = matrix(part.column("projection"))
                outside = np.maximum(0, np.maximum(low[None] - marks[:, None], marks[:, None] - high[None]))
                ahead = (outside**2).sum(axis=2)
                go = (ahead <= point * part.column("bound").to_numpy()[:, None] + 1e-9) & full[None]
                go[np.arange(len(marks)), part.column("leaf").to_numpy()] = False  # done
                rows, leaves = np.nonzero(go)
                own = part.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([pa.array(leaves.astype(np.int32)), *own.columns[1:]], names=own.schema.names)

    visits = stored(
        bounded.mapInArrow(visited, "leaf int, vec_id long, unit binary, projection binary, bound double"), f"{folder}-visits"
    )
    found = home.select("query_id", "vec_id", "score").union(_search(index, visits, counts, k, point, n))
    return _best(found, k).select("query_id", "rank", "vec_id", "score")
