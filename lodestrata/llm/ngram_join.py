"""Similarity join of documents on the Jaccard similarity of their word shingles, by MinHash bands.

Documents of equal word sequences are one class, and classes are joined. Class signatures are cut into bands; classes with
an equal band meet in its bucket. A bucket is dealt into blocks of about `BLOCK` classes and each pair of blocks is a
group of its own, so no task gets a whole bucket, and pairs are never rows: a group passes on, for each class, the list of
those that it meets here first (in no earlier band). Groups are then verified on the full shingle sets, which
only the classes that meet another one bring along, and yield for each class the documents linked to it and one edge.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.common import partitions, stored
from lodestrata.llm.components import components
from lodestrata.llm.ring import mixed
from lodestrata.llm.shingles import shingle_hashes, word_hashes
from lodestrata.llm.words import in_portions
from lodestrata.session import scratch_folder

BLOCK = 256
GROUP = ["hash", "left", "right"]


def bands_for(threshold: float, recall: float = 0.9995, hashes: int = 128) -> tuple[int, int]:
    """(bands, rows): the most rows whose bands find a pair at the threshold with that chance within so many hashes."""
    best, rows = (hashes, 1), 1
    while (bands := math.ceil(math.log1p(-recall) / math.log1p(-(threshold**rows)))) * rows <= hashes:
        best, rows = (bands, rows), rows + 1
    return best


def signatures(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """doc_id, f1, f2 (hash of the word sequence), bands (array of band hashes; null where there is no word)."""
    odd = mixed(np.arange(bands * rows) + 1000) | np.uint64(1)
    flip = mixed(np.arange(bands * rows) + 5000)
    factor = mixed(np.arange(rows) + 9000) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_portions(batch):
                words, counts = word_hashes(part.column(1))
                hashes, each = shingle_hashes(words, counts, size)
                full = np.flatnonzero(each)
                starts = (np.cumsum(each) - each)[full]
                keys = np.zeros((len(full), bands), np.uint64)
                work = np.empty_like(hashes)
                with np.errstate(over="ignore"):
                    for b in range(bands if len(full) else 0):
                        for r in range(rows):
                            np.bitwise_xor(hashes, flip[b * rows + r], out=work)
                            np.multiply(work, odd[b * rows + r], out=work)
                            keys[:, b] += np.minimum.reduceat(work, starts) * factor[r]
                        keys[:, b] = mixed(keys[:, b] + np.uint64(b))
                f1, f2 = fingerprints(words, counts, part.column(1))
                lists = np.zeros(len(counts) + 1, np.int32)
                lists[full + 1] = bands
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(f1),
                        pa.array(f2),
                        pa.ListArray.from_arrays(pa.array(np.cumsum(lists, dtype=np.int32)), pa.array(keys.ravel().view(np.int64))),
                    ],
                    names=["doc_id", "f1", "f2", "bands"],
                )

    chosen = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return chosen.mapInArrow(run, "doc_id long, f1 long, f2 long, bands array<long>")


def groups_of(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows with equal first `keys` columns, of batches sorted by them; a run may span batches."""
    waiting: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy() for i in range(keys)]
        change = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(c[a] for c in columns)
            if waiting and key != last:
                yield pa.Table.from_batches(waiting)
                waiting = []
            waiting.append(batch.slice(a, b - a))
            last = key
    if waiting:
        yield pa.Table.from_batches(waiting)


def meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each group the classes with a partner that they meet in no earlier band: group, key, partners (higher ones)."""
    rows: list[tuple] = []
    for group in groups_of(batches, 3):
        if group.num_rows < 2:
            continue
        hash_, left, right = (group.column(i)[0].as_py() for i in range(3))
        keys = group.column(3).to_numpy()
        order = np.argsort(keys, kind="stable")
        keys, block = keys[order], group.column(4).to_numpy()[order]
        bands = group.column(5).combine_chunks().flatten().to_numpy().reshape(len(keys), -1)[order]
        at = int(np.flatnonzero((bands == hash_).all(axis=0))[0])
        new = np.triu(np.ones((len(keys), len(keys)), bool), 1)
        if left != right:
            new &= block[:, None] != block[None, :]
        for b in range(at):
            new &= bands[:, b][:, None] != bands[:, b][None, :]
        met = new.any(axis=0) | new.any(axis=1)
        rows.extend((hash_, left, right, int(keys[i]), keys[new[i]].tolist()) for i in np.flatnonzero(met).tolist())
        if len(rows) >= 2000:
            yield _meeting_rows(rows)
            rows = []
    yield _meeting_rows(rows)


def _meeting_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())
    columns = zip(*rows) if rows else ((),) * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[*GROUP, "key", "partners"])


def fingerprints(words: np.ndarray, counts: np.ndarray, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each text's word sequence as two numbers; of a text without words, 128 bits of itself without the white
    space around it (null is an empty text)."""
    ends = np.concatenate(([0], np.cumsum(counts)))
    prints = [xxhash.xxh3_128_intdigest(words[a:z].tobytes()) for a, z in zip(ends, ends[1:])]
    for i in np.flatnonzero(counts == 0).tolist():
        prints[i] = xxhash.xxh3_128_intdigest((texts[i].as_py() or "").strip().encode(), seed=1)
    low = np.array([p & (1 << 64) - 1 for p in prints], np.uint64)
    return low.view(np.int64), np.array([p >> 64 for p in prints], np.uint64).view(np.int64)


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """key, shingles: the sorted different shingles as 64-bit numbers, of the texts whose words have the hash (f1, f2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_portions(batch):
                words, counts = word_hashes(part.column(1))
                f1, f2 = fingerprints(words, counts, part.column(1))
                right = (f1 == part.column(2).to_numpy()) & (f2 == part.column(3).to_numpy())
                hashes, each = shingle_hashes(words, counts, size)
                ends = np.concatenate(([0], np.cumsum(each)))
                sets = [np.unique(hashes[ends[i] : ends[i + 1]]).tobytes() for i in np.flatnonzero(right).tolist()]
                keys = part.column(0).filter(pa.array(right))
                yield pa.RecordBatch.from_arrays([keys, pa.array(sets, pa.binary())], names=["key", "shingles"])

    return docs.select("key", "text", "f1", "f2").mapInArrow(run, "key long, shingles binary").dropDuplicates(["key"])


def verifier(threshold: float):
    """From groups with sets to key, links (documents linked), root (the least class that it hangs together with here)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for group in groups_of(batches, 3):
            rows.extend(_verified(group, threshold))
            if len(rows) >= 5000:
                yield _link_rows(rows)
                rows = []
        yield _link_rows(rows)

    return run


def _link_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["key", "links", "root"])


def _verified(group: pa.Table, threshold: float) -> list[tuple]:
    keys = group.column(3).to_numpy()
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    sizes = group.column(5).to_numpy()[order]
    partners = group.column(4).to_pylist()
    raw = group.column(6).to_pylist()
    sets = [np.frombuffer(raw[i], np.uint64) for i in order]
    length = np.array([len(s) for s in sets])
    links, root = np.zeros(len(keys), np.int64), np.arange(len(keys))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    flat = numbers = None
    starts = np.cumsum(length) - length
    for i in range(len(keys)):
        others = np.searchsorted(keys, partners[order[i]])
        if not len(others):
            continue
        if len(others) <= 2:
            shared = np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for j in others])
        else:
            if flat is None:
                numbers, flat = np.unique(np.concatenate(sets), return_inverse=True)
            mark = np.zeros(len(numbers), np.int32)
            mark[flat[starts[i] : starts[i] + length[i]]] = 1
            shared = np.add.reduceat(mark[flat], starts)[others]
        near = others[shared >= threshold * (length[i] + length[others] - shared) - 1e-9]
        if len(near):
            links[i] += sizes[near].sum()
            links[near] += sizes[i]
            for j in near.tolist():
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return [(int(keys[i]), int(links[i]), int(keys[top(i)])) for i in np.flatnonzero(links).tolist()]


def similarity_classes(
    docs: DataFrame, threshold: float = 0.8, size: int = 5, recall: float = 0.9995, block: int = BLOCK
) -> DataFrame:
    """doc_id, class_id, copy_id, n_links for every row of `docs` (doc_id, text) that has an id.

    n_links: how many other rows have at least `threshold` Jaccard similarity of their sets of `size`-word shingles,
    rows of the same words included; copy_id: the least doc_id of the same words; class_id: the least doc_id that is
    reached over links. Texts of one to `size` - 1 words have one shingle of them all; texts without words are
    copies where they are equal but for white space around them (null is an empty text), and near nothing else. Two different texts under one id are two rows of that id.
    A pair at the threshold is found with the chance `recall`, a nearer one more surely; a pair that is found
    is verified on its full sets.
    """
    spark = docs.sparkSession
    folder = scratch_folder(spark)
    bands, rows = bands_for(threshold, recall)
    seen = stored(signatures(docs, size, bands, rows), f"{folder}/signatures")
    classes = stored(
        seen.groupBy("f1", "f2")
        .agg(F.min("doc_id").alias("copy_id"), F.count("*").alias("size"), F.first("bands").alias("bands"))
        .withColumn("key", F.monotonically_increasing_id()),
        f"{folder}/classes",
    )
    exploded = classes.select("key", F.explode("bands").alias("hash"))
    buckets = exploded.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    member = (
        classes.select("key", "bands", F.explode("bands").alias("hash"))
        .join(buckets, "hash")
        .withColumn("blocks", blocks)
        .withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("hash", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), "key", "block", "bands")
    )
    n = partitions(spark)
    met = stored(
        member.repartition(n, *GROUP).sortWithinPartitions(*GROUP).mapInArrow(
            meetings, "hash long, left int, right int, key long, partners array<long>"
        ),
        f"{folder}/met",
    )
    wanted = met.select("key").distinct().join(classes.select("key", "copy_id", "size", "f1", "f2"), "key")
    texts = docs.select(F.col("doc_id").cast("long").alias("copy_id"), "text")
    sets = shingle_sets(texts.join(wanted.drop("size"), "copy_id"), size)
    sets = sets.join(wanted.select("key", "size"), "key")
    links = stored(
        met.join(sets, "key")
        .select(*GROUP, "key", "partners", "size", "shingles")
        .repartition(n, *GROUP)
        .sortWithinPartitions(*GROUP)
        .mapInArrow(verifier(threshold), "key long, links long, root long"),
        f"{folder}/links",
    )
    linked = links.groupBy("key").agg(F.sum("links").alias("links"))
    labels = components(links.filter("key <> root").select(F.col("key").alias("a"), F.col("root").alias("b")), f"{folder}/components")
    labelled = classes.select("key", "f1", "f2", "copy_id", "size").join(linked, "key", "left").join(
        labels.withColumnRenamed("node", "key"), "key", "left"
    )
    labelled = labelled.withColumn("label", F.coalesce("label", "key"))
    least = labelled.groupBy("label").agg(F.min("copy_id").alias("class_id"))
    answer = stored(
        labelled.join(least, "label").select(
            "f1", "f2", "copy_id", "class_id", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links")
        ),
        f"{folder}/answer",
    )
    return seen.select("doc_id", "f1", "f2").join(answer, ["f1", "f2"]).select("doc_id", "class_id", "copy_id", "n_links")
