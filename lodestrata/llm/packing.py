"""Bulk-synchronous best-fit packing of documents into sequences of a fixed number of tokens."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm.common import ranked_by_range, stored, with_position
from lodestrata.llm.tokens import binaries, encoded_portions
from lodestrata.session import scratch_folder

#: A round takes the documents from the largest one waiting down to this share of its length.
BAND = 0.5
#: New sequences are opened when the gaps take less than this share of a round's documents.
ENOUGH = 0.1


def pieces_of(docs: DataFrame, vocabulary: str, capacity: int = 2048, end: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids (binary u32) of all documents (doc_id, text).

    Each document's token ids and the `end` id are cut into pieces of `capacity`, the last one shorter; only longer
    documents have more than one. A null text is an empty one, repeated rows stay repeated, other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, flat, counts in encoded_portions(batches, vocabulary, end):
            pieces = -(-counts // capacity)
            row = np.repeat(np.arange(len(counts)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(counts[row] - start, capacity)
            columns = [ids.take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length)]
            own = binaries(flat.astype("<u4"), length)
            yield pa.RecordBatch.from_arrays([*columns, own], names=["doc_id", "piece", "start", "length", "ids"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return chosen.mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary")


class Gaps:
    """How many open sequences have each gap. Ranks within a gap count from 0; those taken first have the low ranks."""

    def __init__(self, capacity: int):
        self.count = np.zeros(capacity + 1, np.int64)

    def sweep(self, waiting: np.ndarray) -> tuple[list[tuple], list[tuple]]:
        """Matches lengths, longest first, to the smallest gaps that hold them, as the gaps stood when the round began.

        `waiting` has the number of documents of each length and keeps what found no gap. A gap takes as many
        documents of one length as fit. Conflicts are resolved by rank: of a length, the documents of low rank go to
        the sequences of low rank. Returns rank ranges, at most a few per length and gap:
        (length, rank from, rank to, per sequence, gap, rank of the first sequence) and
        (gap, rank from, rank to, new gap, new rank of the first).
        """
        free, taken = self.count.copy(), np.zeros_like(self.count)
        came: list[tuple[int, int, int, int]] = []
        matches: list[tuple] = []
        for length in np.flatnonzero(waiting)[::-1].tolist():
            rank = 0
            for gap in (length + np.flatnonzero(free[length:])).tolist():
                if not waiting[length]:
                    break
                left, per = int(waiting[length]), gap // length
                used = min(int(free[gap]), -(-left // per))
                placed = min(left, used * per)
                matches.append((length, rank, rank + placed, per, gap, int(taken[gap])))
                full, over = divmod(placed, per)
                if full:
                    came.append((gap, int(taken[gap]), int(taken[gap]) + full, gap - per * length))
                if over:
                    came.append((gap, int(taken[gap]) + full, int(taken[gap]) + full + 1, gap - over * length))
                free[gap] -= used
                taken[gap] += used
                waiting[length] -= placed
                rank += placed
        moves: list[tuple] = []
        for gap in np.flatnonzero(self.count).tolist():
            if free[gap]:
                moves.append((gap, int(taken[gap]), int(self.count[gap]), gap, 0))
        self.count = free
        for gap, low, high, new in came:
            moves.append((gap, low, high, new, int(self.count[new])))
            self.count[new] += high - low
        return matches, moves


def place(pieces: DataFrame, capacity: int) -> DataFrame:
    """Sequences for `pieces` (uid, unique, and length from 1 to `capacity`): uid, sequence_id, offset.

    Documents are range-sorted by length and ranked. Each round takes a band of lengths, sweeps the sorted lengths
    along the sorted gaps, joins documents and open sequences on (gap, rank), and rewrites the gaps; what found no gap
    waits for the next round. Where the gaps would take hardly any of the band, as many sequences are opened as its
    rest fills (at least one for each document beyond half the capacity) and join the sweep as gaps of the whole capacity.
    Lengths and gaps are integers up to `capacity`, so a sweep moves over that many numbers whatever the number of
    rows; documents and sequences stay tables. A band halves the lengths and takes a few rounds, so there are a few
    dozen rounds at any size; each leaves written tables.
    """
    spark = pieces.sparkSession
    folder = scratch_folder(spark)
    rows, before = ranked_by_range(pieces.select("uid", "length"), ["length", "uid"], f"{folder}/sorted")
    counted = rows.groupBy("length").count().collect()  # one row per length
    waiting = np.zeros(capacity + 1, np.int64)
    for r in counted:
        waiting[r["length"]] = r["count"]
    first = np.cumsum(waiting) - waiting
    ranked = with_position(rows, before)
    gaps = Gaps(capacity)
    state = _state(spark, f"{folder}/gaps-0", spark.range(0).select(F.lit(0).alias("gap"), F.col("id").alias("rank"), F.col("id").alias("sequence_id")))
    done: list[str] = []
    opened = 0
    taken = np.zeros_like(waiting)
    size = np.arange(capacity + 1)
    while waiting.any():
        top = int(np.flatnonzero(waiting)[-1])
        band = waiting.copy()
        band[: int(np.ceil(top * BAND))] = 0
        trial, rest = Gaps(capacity), band.copy()
        trial.count = gaps.count.copy()
        trial.sweep(rest)
        if (band - rest).sum() < ENOUGH * band.sum():
            new = max(int(rest[capacity // 2 + 1 :].sum()), -(-int((rest * size).sum()) // capacity))
            fresh = spark.range(opened, opened + new).select(
                F.lit(capacity).alias("gap"), (F.col("id") - opened + int(gaps.count[capacity])).alias("rank"), F.col("id").alias("sequence_id")
            )
            state = state.unionByName(fresh)
            gaps.count[capacity] += new
            opened += new
        rest = band.copy()
        matches, moves = gaps.sweep(rest)
        out = f"{folder}/placed-{len(done)}"
        _matched(spark, ranked, first + taken, matches, capacity).join(state, ["gap", "rank"]).select(
            "uid", "sequence_id", "offset"
        ).write.option("compression", "zstd").parquet(out)
        done.append(out)
        taken += band - rest
        waiting -= band - rest
        smallest = int(np.flatnonzero(waiting)[0]) if waiting.any() else capacity + 1
        moves = [m for m in moves if m[3] >= smallest]  # a sequence that takes nothing more is closed
        gaps.count[:smallest] = 0
        state = _state(spark, f"{folder}/gaps-{len(done)}", _moved(spark, state, moves))
    if not done:
        return spark.createDataFrame([], "uid long, sequence_id long, offset long")
    return spark.read.schema("uid long, sequence_id long, offset long").parquet(*done)


def _state(spark: SparkSession, folder: str, gaps: DataFrame) -> DataFrame:
    return stored(gaps.select(F.col("gap").cast("int"), F.col("rank").cast("long"), F.col("sequence_id").cast("long")), folder)


def _matched(spark: SparkSession, ranked: DataFrame, first: np.ndarray, matches: list[tuple], capacity: int) -> DataFrame:
    """The documents of a round with the gap, the rank of the sequence and the offset that the sweep gave them."""
    listed = [(l, int(first[l]) + a, int(first[l]) + b, p, g, r) for l, a, b, p, g, r in matches]
    table = spark.createDataFrame(listed, "_length long, _from long, _to long, _per long, gap int, _first long")
    low, high = min(m[0] for m in matches), max(m[0] for m in matches)
    nth = F.col("position") - F.col("_from")
    return (
        ranked.filter(F.col("length").between(low, high))
        .join(F.broadcast(table), (F.col("length") == F.col("_length")) & (F.col("position") >= F.col("_from")) & (F.col("position") < F.col("_to")))
        .select(
            "uid",
            "gap",
            (F.col("_first") + F.floor(nth / F.col("_per"))).alias("rank"),
            (F.lit(capacity) - F.col("gap") + (nth % F.col("_per")) * F.col("length")).alias("offset"),
        )
    )


def _moved(spark: SparkSession, state: DataFrame, moves: list[tuple]) -> DataFrame:
    table = spark.createDataFrame(moves, "_gap int, _from long, _to long, _new int, _first long")
    return state.join(
        F.broadcast(table), (F.col("gap") == F.col("_gap")) & (F.col("rank") >= F.col("_from")) & (F.col("rank") < F.col("_to"))
    ).select(F.col("_new").alias("gap"), (F.col("_first") + F.col("rank") - F.col("_from")).alias("rank"), "sequence_id")


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Adds sequence_id and offset to a table of pieces (any columns, `length` among them), which is stored first.

    An empty table gives an empty one; repeated rows are pieces of their own.
    """
    own = stored(pieces.withColumn("uid", F.monotonically_increasing_id()))
    placed = place(own, capacity).withColumnRenamed("uid", "_uid")
    return own.join(placed, F.col("uid") == F.col("_uid")).drop("uid", "_uid")
