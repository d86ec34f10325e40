"""Token ids in compressed binary files: Huffman-coded blocks that decode by themselves.

A file is a head and blocks. Head: `MAGIC`, u32 size, then that many bytes: zlib of one code length (u8) per id of the
vocabulary. Block: `BLOCK` fields (mark, documents, ids, checkpoints, bytes of index, bytes of bits); the index, zlib
of little-endian arrays: document ids (i64), a byte per document that is 1 where the id is null, ids per document
(i64), bytes of bits per document (i64), checkpoints (u32); then the bits, each document from a whole byte on.
A checkpoint is the first bit, within its document, of each run of `RUN` ids. All integers are little-endian, code
words are laid from the high bit on. Documents stand in ascending order of (doc_id, ids); a document is never cut.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.llm.common import file_system, partitions, stored
from lodestrata.llm.huffman import Code, code_lengths
from lodestrata.llm.tokens import id_type
from lodestrata.session import scratch_folder

MAGIC = b"LSTOKEN1"
BLOCK = struct.Struct("<4sIQIII")
MARK = b"BLCK"
RUN = 128
BLOCK_BYTES = 1 << 20
FILE_BYTES = 64 << 20
TOGETHER = 1 << 19
FILES = "part int, seq int, path string, documents long, ids long"


def id_counts(tokens: DataFrame) -> dict[int, int]:
    """How often each id occurs in all documents; the driver gets one number per id of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.int64)
        for batch in batches:
            if batch.num_rows:
                offsets = np.frombuffer(batch.column(1).buffers()[1], "<i4")[batch.column(1).offset :]
                ids = np.frombuffer(
                    memoryview(batch.column(1).buffers()[2])[offsets[0] : offsets[batch.num_rows]],
                    id_type(batch.column(0)[0].as_py()),
                )
                own = np.bincount(ids, minlength=len(seen))
                own[: len(seen)] += seen
                seen = own
        (ids,) = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(seen[ids])], names=["id", "n"])

    each = tokens.select("width", "ids").mapInArrow(run, "id long, n long")
    return {r["id"]: r["n"] for r in each.groupBy("id").agg(F.sum("n").alias("n")).collect()}


def encoded(tokens: DataFrame, code: Code, bounds: list[int]) -> DataFrame:
    """Each document's bits and checkpoints, with the part of the order that it belongs to."""
    edges = np.array(bounds, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = batch.column(1).to_numpy()
            group = (np.cumsum(counts) - counts) // TOGETHER
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if b == a:
                    continue
                rows = batch.slice(a, b - a)
                own = counts[a:b]
                raw = b"".join(rows.column(3).to_numpy(zero_copy_only=False).tolist())
                ids = np.frombuffer(raw, id_type(rows.column(2)[0].as_py()))
                bits, sizes, checkpoints = code.encode(ids, own, RUN)
                ends = np.concatenate(([0], np.cumsum(sizes)))
                runs = np.concatenate(([0], np.cumsum(-(-own // RUN)))) * 4
                marks = checkpoints.astype("<u4").tobytes()
                docs = rows.column(0)
                key = docs.fill_null(np.iinfo(np.int64).min).to_numpy()
                part = np.where(docs.is_null().to_numpy(zero_copy_only=False), 0, np.searchsorted(edges, key, "left"))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part.astype(np.int32)),
                        docs,
                        rows.column(1),
                        pa.array([marks[x:y] for x, y in zip(runs, runs[1:])], pa.binary()),
                        pa.array([bits[x:y] for x, y in zip(ends, ends[1:])], pa.binary()),
                    ],
                    names=["part", "doc_id", "n_tokens", "marks", "bits"],
                )

    return tokens.select("doc_id", "n_tokens", "width", "ids").mapInArrow(
        run, "part int, doc_id long, n_tokens long, marks binary, bits binary"
    )


def head(lengths: np.ndarray) -> bytes:
    packed = zlib.compress(lengths.astype(np.uint8).tobytes(), 9)
    return MAGIC + struct.pack("<I", len(packed)) + packed


class _File:
    """One file being written; blocks are flushed as they fill up."""

    def __init__(self, folder: str, part: int, seq: int, first: bytes):
        self.fs, base = file_system(folder)
        # Each attempt of a task writes names of its own; the list of files names those of the attempt that counted.
        self.path = f"{folder}/tokens-{part:06d}-{seq:06d}-{uuid.uuid4().hex}.lst"
        self.out = self.fs.open_output_stream(f"{base}/{self.path.rpartition('/')[2]}")
        self.out.write(first)
        self.part, self.seq, self.size, self.documents, self.ids = part, seq, 0, 0, 0
        self.rows: list[tuple] = []
        self.waiting = 0

    def add(self, doc_id: int | None, n: int, marks: bytes, bits: bytes) -> None:
        self.rows.append((doc_id, n, marks, bits))
        self.waiting += len(bits)
        if self.waiting >= BLOCK_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.rows:
            docs, counts, marks, bits = zip(*self.rows)
            all_marks, all_bits = b"".join(marks), b"".join(bits)
            index = zlib.compress(
                np.array([d or 0 for d in docs], "<i8").tobytes()
                + bytes(d is None for d in docs)
                + np.array(counts, "<i8").tobytes()
                + np.array(list(map(len, bits)), "<i8").tobytes()
                + all_marks,
                1,
            )
            fields = MARK, len(docs), sum(counts), len(all_marks) // 4, len(index), len(all_bits)
            self.out.write(BLOCK.pack(*fields))
            self.out.write(index)
            self.out.write(all_bits)
            self.size += BLOCK.size + len(index) + len(all_bits)
            self.documents += len(docs)
            self.ids += sum(counts)
            self.rows, self.waiting = [], 0

    def close(self) -> tuple:
        self.flush()
        self.out.close()
        return self.part, self.seq, self.path, self.documents, self.ids


def write_token_files(tokens: DataFrame, folder: str, vocabulary: int = 1 << 16) -> DataFrame:
    """Writes the files of `tokens` (as `tokenize` gives them) and returns the list of files.

    `tokens` is read three times (bounds, counts, ids), so pass a stored table. Documents are dealt to as many parts as
    there are shuffle partitions by quantiles of doc_id (null first); only coded bits are shuffled. Files hold
    about `FILE_BYTES`. An empty table gives no file. The folder is one that all executors share.
    """
    spark = tokens.sparkSession
    counts = id_counts(tokens)
    table = np.zeros(max(vocabulary, max(counts, default=0) + 1), np.int64)
    table[list(counts)] = list(counts.values())
    lengths = code_lengths(table)
    parts = partitions(spark)
    shares = [i / parts for i in range(1, parts)] or [0.5]
    found = tokens.agg(F.percentile_approx("doc_id", shares, 20 * parts).alias("q")).first()["q"] if counts else None
    fs, base = file_system(folder)
    fs.create_dir(base)
    first = head(lengths)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now: _File | None = None
        for batch in batches:
            for part, *row in zip(*(c.to_numpy(zero_copy_only=False).tolist() if i > 2 else c.to_pylist() for i, c in enumerate(batch.columns))):
                if now is None or now.part != part or now.size >= FILE_BYTES:
                    seq = 0
                    if now is not None:
                        done.append(now.close())
                        seq = now.seq + 1 if now.part == part else 0
                    now = _File(folder, part, seq, first)
                now.add(*row)
        if now is not None:
            done.append(now.close())
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done), (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()))],
                names=["part", "seq", "path", "documents", "ids"],
            )

    ordered = (
        encoded(tokens, Code(lengths), sorted(set(found or [])))
        .repartitionById(parts, F.col("part"))
        .sortWithinPartitions("part", "doc_id", "n_tokens", "bits")
    )
    return stored(ordered.mapInArrow(write, FILES), f"{folder.rstrip('/')}/files")


def _exactly(stream: BinaryIO, size: int) -> bytes:
    data = stream.read(size)
    if len(data) != size:
        raise ValueError("the token file ends within a block")
    return data


def read_head(stream: BinaryIO) -> Code:
    if _exactly(stream, len(MAGIC)) != MAGIC:
        raise ValueError("not a token file")
    (size,) = struct.unpack("<I", _exactly(stream, 4))
    return Code(np.frombuffer(zlib.decompress(_exactly(stream, size)), np.uint8))


class Block:
    """A block's index and bits; any of its ids can be decoded from the nearest checkpoint."""

    def __init__(self, fields: tuple, index: bytes, bits: bytes):
        _, n, _, marks, _, _ = fields
        raw = zlib.decompress(index)
        self.docs = np.frombuffer(raw, "<i8", n)
        self.null = np.frombuffer(raw, np.uint8, n, 8 * n).astype(bool)
        self.counts = np.frombuffer(raw, "<i8", n, 9 * n)
        sizes = np.frombuffer(raw, "<i8", n, 17 * n)
        self.bits = bits
        self.runs = -(-self.counts // RUN)
        base = np.repeat((np.cumsum(sizes) - sizes) * 8, self.runs)
        self.starts = np.frombuffer(raw, "<u4", marks, 25 * n).astype(np.int64) + base
        self.lengths = np.full(marks, RUN, np.int64)
        last = np.cumsum(self.runs) - 1
        self.lengths[last] = self.counts - (self.runs - 1) * RUN

    def all(self, code: Code) -> np.ndarray:
        return code.decode(self.bits, self.starts, self.lengths)

    def span(self, code: Code, first: int, count: int) -> np.ndarray:
        """`count` ids from `first` on, both counted over the block; only the runs that hold them are decoded."""
        ends = np.cumsum(self.lengths)
        a, b = np.searchsorted(ends, first, "right"), np.searchsorted(ends, first + count, "left") + 1
        ids = code.decode(self.bits, self.starts[a:b], self.lengths[a:b])
        skip = first - int(ends[a] - self.lengths[a]) if a < len(ends) else 0
        return ids[skip : skip + count]


def blocks(stream: BinaryIO) -> Iterator[Block]:
    while mark := stream.read(BLOCK.size):
        fields = BLOCK.unpack(mark)
        if fields[0] != MARK:
            raise ValueError("a block does not begin with its mark")
        yield Block(fields, _exactly(stream, fields[4]), _exactly(stream, fields[5]))


def read_ids(path: str, first: int, count: int) -> np.ndarray:
    """`count` ids of one file from its id number `first` on; blocks before it are skipped unread."""
    fs, at = file_system(path)
    found: list[np.ndarray] = []
    with fs.open_input_file(at) as stream:
        code = read_head(stream)
        while count > 0 and (mark := stream.read(BLOCK.size)):
            fields = BLOCK.unpack(mark)
            if first >= fields[2]:
                stream.seek(fields[4] + fields[5], 1)
                first -= fields[2]
                continue
            block = Block(fields, _exactly(stream, fields[4]), _exactly(stream, fields[5]))
            found.append(block.span(code, first, min(count, fields[2] - first)))
            count -= len(found[-1])
            first = 0
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


def with_starts(files: DataFrame) -> DataFrame:
    """Adds to each file how many ids stand before it; the sums over parts are as many rows as partitions."""
    parts = files.groupBy("part").agg(F.sum("ids").alias("_sum"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("part").alias("_part"), F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_ahead"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    joined = files.join(parts, F.col("part") == F.col("_part"))
    return joined.withColumn("start", F.col("_ahead") + F.coalesce(F.sum("ids").over(within), F.lit(0))).drop("_part", "_ahead")


def read_token_files(files: DataFrame) -> DataFrame:
    """Every document of the listed files: doc_id, start (ids of all documents before it), n_tokens, ids (binary u32)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, at = file_system(path)
                with fs.open_input_stream(at) as stream:
                    code = read_head(stream)
                    for block in blocks(stream):
                        ids = block.all(code)
                        ends = np.concatenate(([0], np.cumsum(block.counts)))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(block.docs, mask=block.null),
                                pa.array(start + ends[:-1]),
                                pa.array(block.counts),
                                pa.Array.from_buffers(
                                    pa.binary(), len(block.docs), [None, pa.py_buffer((ends * 4).astype("<i4")), pa.py_buffer(ids.astype("<u4"))]
                                ),
                            ],
                            names=["doc_id", "start", "n_tokens", "ids"],
                        )
                        start += int(ends[-1])

    listed = with_starts(files).select("path", "start").repartition(partitions(files.sparkSession))
    return listed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def round_trip(spark: SparkSession, tokens: DataFrame) -> DataFrame:
    """Stores, writes and reads back, all in a fresh shared folder."""
    folder = scratch_folder(spark)
    return read_token_files(write_token_files(stored(tokens, f"{folder}/tokens"), f"{folder}/out"))
