"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has `nodes` places on a ring of 64-bit hashes. A row belongs to the place that follows the hash of its key;
where the shard is full, rows continue clockwise to the next place of a shard that is not. A shard takes its share of
the rows, rounded up or down, and no more, so counts are at most one apart (`slack` above 0 allows each that much more).
Keys are texts: copies stand together as far as the bound allows. Rows of one place are ranked by the hash of their text, so
that a cut parts the copies of one text at most, and then by a hash of their id, so that a text that a third of all rows
share is ranked in as many partitions as it fills.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.common import ranked_by_range, with_position
from lodestrata.session import scratch_folder


def mixed(numbers: np.ndarray) -> np.ndarray:
    """A 64-bit mix of each number."""
    x = numbers.astype(np.uint64)
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ring(shards: int, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """The places in clockwise order and the shard of each; a further shard leaves the places of the others alone."""
    shard, node = np.divmod(np.arange(shards * nodes), nodes)
    places = mixed(mixed(shard) ^ node.astype(np.uint64))
    order = np.argsort(places, kind="stable")
    return places[order], shard[order]


def bounded(counts: np.ndarray, shard: np.ndarray, shards: int, slack: float = 0.0) -> list[tuple[int, int, int, int, int]]:
    """Ranges of rows (place, rank from, rank to, shard, first slot), given the rows that each place has.

    Round by round all that wait at a shard's places are taken up to its bound, in clockwise order of places and then
    by rank; the rest moves on to the next place of a shard that is not full. As many numbers as places are dealt with,
    whatever the number of rows.
    """
    total = int(counts.sum())
    low, more = divmod(total, shards)
    bound = np.full(shards, max(low, int(total * (1 + slack)) // shards), np.int64)
    demand = np.bincount(shard, counts, shards)
    bound[np.argsort(-demand, kind="stable")[:more]] = np.maximum(bound[np.argsort(-demand, kind="stable")[:more]], low + 1)
    load = np.zeros(shards, np.int64)
    waiting: dict[int, list[tuple[int, int, int]]] = {p: [(p, 0, int(n))] for p, n in enumerate(counts.tolist()) if n}
    taken: list[tuple[int, int, int, int, int]] = []
    while waiting:
        left: list[tuple[int, tuple[int, int, int]]] = []
        for place in sorted(waiting):
            own = int(shard[place])
            for origin, a, b in waiting[place]:
                fits = min(b - a, int(bound[own] - load[own]))
                if fits:
                    taken.append((origin, a, a + fits, own, int(load[own])))
                    load[own] += fits
                if a + fits < b:
                    left.append((place, (origin, a + fits, b)))
        waiting = {}
        open_places = np.flatnonzero(load[shard] < bound[shard])
        for place, rows in left:
            after = np.searchsorted(open_places, place, "right")
            waiting.setdefault(int(open_places[after % len(open_places)]), []).append(rows)
    return taken


def assign(docs: DataFrame, shards: int = 40, nodes: int = 128, slack: float = 0.0) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row of `docs` (doc_id, text).

    size is the bytes of the text plus 16 (a null text has none, and crc 0). Rows without an id and rows of one id are rows
    like others. An empty table gives an empty one. Other columns are left out. Slots of a shard run from 0 without gaps.
    """
    spark = docs.sparkSession
    places, shard = ring(shards, nodes)

    @F.pandas_udf("int")
    def place_of(hashes: pd.Series) -> pd.Series:
        at = np.searchsorted(places, hashes.to_numpy().view(np.uint64), "left")
        return pd.Series(at % len(places)).astype("int32")

    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"),
    )
    keyed = narrow.select("doc_id", "size", "text_crc32", place_of("hash").alias("place"), "hash", F.xxhash64("doc_id").alias("order"))
    rows, before = ranked_by_range(keyed, ["place", "hash", "order", "doc_id", "text_crc32", "size"], f"{scratch_folder(spark)}/rows")
    counts = np.zeros(len(places), np.int64)
    for r in rows.groupBy("place").count().collect():  # one row per place of the ring
        counts[r["place"]] = r["count"]
    first = np.cumsum(counts) - counts
    taken = sorted((int(first[p]) + a, s, slot) for p, a, _, s, slot in bounded(counts, shard, shards, slack))
    starts, owner, slots = (np.array(x, np.int64) for x in zip(*taken)) if taken else (np.zeros(0, np.int64),) * 3

    @F.pandas_udf("shard int, slot long")
    def home(position: pd.Series) -> pd.DataFrame:
        at = position.to_numpy()
        i = np.searchsorted(starts, at, "right") - 1
        return pd.DataFrame({"shard": owner[i].astype("int32"), "slot": slots[i] + at - starts[i]})

    placed = with_position(rows, before).select("doc_id", "size", "text_crc32", home("position").alias("home"))
    return placed.select("doc_id", "size", "text_crc32", "home.shard", "home.slot")
