"""Alignment of two tokenizers over the same bytes, with scores from inverted pair bitmaps.

A task encodes texts with both tokenizers and notes, per block of documents and pair of ids (a, b) that overlap, a posting: a
compressed bitmap of the documents that hold the pair, and bit planes of how often each does. Bitmaps of the portions of a
block are united there; blocks hold different documents, so a pair's documents and links over all blocks are sums of
popcounts. The postings then carry the pairs' scores back to the documents.

Both tokenizers part a text before white space that follows other signs, so most texts are taken apart there and the different
pieces of a portion are strung together, encoded and aligned at once; other texts are encoded whole.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from lodestrata.llm.common import stored
from lodestrata.llm.words import in_portions

#: A block ends at so many documents or bytes of text (a longer text is in a block with what its portion holds).
BLOCK_ROWS = 1 << 16
BLOCK_BYTES = 16 << 20
#: Bytes of text in a portion, pieces that a worker remembers between portions, signs of pieces that are encoded together.
PORTION_BYTES = 8 << 20
PIECES = 500_000
TOGETHER = 1 << 16

# The settings of a byte-level vocabulary whose tokens do not reach from other signs into white space.
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
#: Runs of signs with one space or a run of line ends between them; neither library takes any of these signs for white space.
PLAIN_TEXT = r"^[^\s\pZ\pC]+(?:(?: |\n+)[^\s\pZ\pC]+)*$"
FIRST = " a"
#: Letters and signs that all editions of Unicode class alike; pieces of these may be encoded by ranks.
LATIN = re.compile("[\n -~¡-ɏ]*")
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_values() -> dict[str, int]:
    """The bytes that the letters of a byte-level vocabulary stand for."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = sorted(set(range(256)) - set(own))
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(rest)}


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, … of each run, one run after another."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, and how often each occurs."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.concatenate((first, [len(keys)])))


TOTALS = ("n_a", "n_b", "n_groups", "n_links")


@dataclass
class Pieces:
    """What is known of pieces or whole texts, one after another: totals, groups as text (each ends with a semicolon), and the
    links of all of them as a << 32 | b. Those that do not `agree` in bytes have no tokens."""

    totals: dict[str, np.ndarray]
    agree: np.ndarray
    groups: pa.Array
    links: np.ndarray

    @classmethod
    def none(cls, n: int) -> Pieces:
        zeros = np.zeros(n, np.int64)
        return cls(dict.fromkeys(TOTALS, zeros), np.zeros(n, bool), pa.array([b""] * n, pa.binary()), zeros[:0])

    @classmethod
    def joined(cls, parts: list[Pieces]) -> Pieces:
        parts = parts or [cls.none(0)]
        return cls(
            {name: np.concatenate([p.totals[name] for p in parts]) for name in TOTALS},
            np.concatenate([p.agree for p in parts]),
            pa.concat_arrays([p.groups for p in parts]),
            np.concatenate([p.links for p in parts]),
        )

    def without_first(self) -> Pieces:
        links = self.links[int(self.totals["n_links"][0]) :]
        return Pieces({k: v[1:] for k, v in self.totals.items()}, self.agree[1:], self.groups.slice(1), links)


def _ending(ends: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """How many of the ascending `ends` lie between each limit and the one before."""
    return np.diff(np.searchsorted(ends, limits, side="right"), prepend=0)


class Aligner:
    """Two tokenizers and the pieces that were aligned with them lately."""

    def __init__(self, byte_vocabulary: str, piece_model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_vocabulary)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        value = byte_values()
        names = {i: t for t, i in self.a.get_vocab().items()}
        a_bytes = [self._letters(names.get(i, ""), value) for i in range(max(names) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        mark = "▁"
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(mark, " ").encode() for i, p in enumerate(pieces)]
        self.bytes = [pa.array(x, pa.binary()) for x in (a_bytes, b_bytes)]
        self.lengths = [np.array(list(map(len, x)), np.int64) for x in (a_bytes, b_bytes)]
        # A token as text, with what follows it: inside its side of a group, and last of it.
        sides = ((len(a_bytes), ",|"), (len(b_bytes), ",;"))
        self.texts = pa.array([f"{i}{end}".encode() for n, ends in sides for i in range(n) for end in ends], pa.binary())
        settings = json.loads(self.a.to_str())
        parted = not any(mark in p.lstrip(mark) or "\n" in p for p in pieces)
        self.by_piece = parted and settings["normalizer"] is None and settings["pre_tokenizer"] == BYTE_LEVEL
        self.ranks = self._by_rank(settings, a_bytes) if self.by_piece else None
        self.known: dict[str, int] = {}
        self.store = Pieces.none(0)

    @staticmethod
    def _by_rank(settings: dict, tokens: list[bytes]):
        """The same vocabulary for a faster encoder, if its merges stand in the order of their ids."""
        vocabulary, special = settings["model"]["vocab"], {t["id"] for t in settings["added_tokens"]}
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in settings["model"]["merges"]]
        ids = [vocabulary.get(m, -1) for m in merged]
        if ids != sorted(ids) or len(ids) + 256 + len(special) != len(tokens) or min(ids, default=0) < 256:
            return None
        import tiktoken

        ranks = {token: i for i, token in enumerate(tokens) if i not in special}
        return tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def _a_ids(self, text: str) -> list[int]:
        if self.ranks is not None and LATIN.fullmatch(text):
            return self.ranks.encode_ordinary(text)
        return self.a.encode(text, add_special_tokens=False).ids

    @staticmethod
    def _letters(token: str, value: dict[str, int]) -> bytes:
        return bytes(value[c] for c in token) if all(c in value for c in token) else token.encode()

    def aligned(self, text: str, limits: np.ndarray) -> Pieces | None:
        """The alignment of the pieces of a text that begins with a space, given the byte at which each ends; None where the
        tokens' bytes are not the text's or a token reaches over a limit."""
        raw = text.encode()
        ids = [np.array(self._a_ids(text), np.int64), np.array(self.b.encode(text[1:]), np.int64)]
        for own, table in zip(ids, self.bytes):
            told = table.take(pa.array(own)).buffers()
            if not len(own) or not told[2].slice(0, self._end(told, len(own))).equals(pa.py_buffer(raw)):
                return None
        (a, b), (a_ends, b_ends) = ids, [np.cumsum(n[own]) for n, own in zip(self.lengths, ids)]
        cuts = np.sort(np.concatenate((a_ends, b_ends)), kind="stable")
        cuts = cuts[np.concatenate((cuts[1:] != cuts[:-1], [True]))]
        at_a, at_b = np.searchsorted(a_ends, cuts), np.searchsorted(b_ends, cuts)
        both = (a_ends[at_a] == cuts) & (b_ends[at_b] == cuts)
        shared = cuts[both]
        if not len(shared) or not (shared[np.searchsorted(shared, limits).clip(max=len(shared) - 1)] == limits).all():
            return None
        # Between neighbouring cuts lies the overlap of just one pair.
        links = a[at_a] << 32 | b[at_b]
        group = [np.searchsorted(shared, ends) for ends in (a_ends, b_ends)]
        last = [shared[g] == ends for g, ends in zip(group, (a_ends, b_ends))]
        place = np.concatenate((2 * a + last[0], 2 * (len(self.lengths[0]) + b) + last[1]))
        order = np.argsort(np.concatenate((2 * group[0], 2 * group[1] + 1)), kind="stable")
        told = self.texts.take(pa.array(place[order]))
        totals = {"n_a": _ending(a_ends, limits), "n_b": _ending(b_ends, limits), "n_groups": _ending(shared, limits), "n_links": _ending(cuts, limits)}
        tokens = np.concatenate(([0], np.cumsum(totals["n_a"] + totals["n_b"])))
        offsets = np.frombuffer(told.buffers()[1], np.int32, len(told) + 1)[tokens]
        groups = pa.Array.from_buffers(pa.binary(), len(limits), [None, pa.py_buffer(offsets.tobytes()), told.buffers()[2]])
        return Pieces(totals, np.ones(len(limits), bool), groups, links)

    @staticmethod
    def _end(buffers: list[pa.Buffer], n: int) -> int:
        return int(np.frombuffer(buffers[1], np.int32, n + 1)[n])

    def alone(self, text: str) -> Pieces:
        """A text that begins with a space, as one piece."""
        found = self.aligned(text, np.array([len(text.encode())]))
        return Pieces.none(1) if found is None else found

    def strung(self, pieces: list[str]) -> Pieces:
        """Pieces encoded as one text. Where that does not hold them all, its halves are tried, down to the one that does not."""
        sizes = pc.binary_length(pa.array(pieces, pa.string())).to_numpy()
        limits = np.cumsum(np.concatenate(([len(FIRST)], sizes)), dtype=np.int64)
        found = self.aligned(FIRST + "".join(pieces), limits)
        if found is not None:
            return found.without_first()
        if len(pieces) == 1:
            return Pieces.none(1)
        half = len(pieces) // 2
        return Pieces.joined([self.strung(pieces[:half]), self.strung(pieces[half:])])

    def pieces(self, names: list[str]) -> np.ndarray:
        """The places of pieces in the store, to which those not known are added. A full store is begun anew."""
        new = [p for p in names if p not in self.known]
        if len(self.known) + len(new) > PIECES:
            self.known, self.store, new = {}, Pieces.none(0), names
        if new:
            new.sort(key=lambda p: LATIN.fullmatch(p) is None)  # so that few texts hold other letters
            size = np.cumsum(np.fromiter(map(len, new), np.int64, len(new))) // TOGETHER
            edges = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), len(new)]
            parts = [self.strung(new[i:j]) for i, j in zip(edges, edges[1:]) if j > i]
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.store = Pieces.joined([self.store, *parts])
        return np.fromiter(map(self.known.__getitem__, names), np.int64, len(names))


@functools.lru_cache(maxsize=1)
def aligner(byte_vocabulary: str, piece_model: str) -> Aligner:
    """One per worker."""
    return Aligner(byte_vocabulary, piece_model)


@dataclass
class Portion:
    """Documents of a portion: totals per document, and (pair, document, times) where times > 0, sorted."""

    totals: dict[str, np.ndarray]
    digests: list[str]
    pairs: np.ndarray
    at: np.ndarray
    times: np.ndarray


def in_pieces(texts: pa.Array, plain: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, list[str]]:
    """Of plain texts: piece numbers one after another, the texts' bounds in them, and the different pieces with the white space
    before them."""
    marked = pc.replace_substring_regex(texts.filter(pa.array(plain)), r"(\n+)", r" \1")
    lists = pc.split_pattern(marked, " ")
    words = lists.flatten().dictionary_encode()
    names = pc.replace_substring_regex(words.dictionary, r"^([^\n])", r" \1").to_pylist()
    return words.indices, lists.offsets.to_numpy(), np.flatnonzero(plain), names


def aligned_portion(coder: Aligner, texts: pa.Array) -> Portion:
    """What the texts of a portion hold. Empty texts and those whose bytes differ hold nothing."""
    rows = len(texts)
    texts = pc.fill_null(texts, "")
    empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
    plain = ~empty & pc.match_substring_regex(texts, PLAIN_TEXT).to_numpy(zero_copy_only=False) if coder.by_piece else np.zeros(rows, bool)
    indices, bounds, plain_rows, names = in_pieces(texts, plain)
    known = coder.pieces(names)
    whole_rows = np.flatnonzero(~plain & ~empty)
    whole = [coder.alone(" " + texts[int(i)].as_py()) for i in whole_rows]
    found = Pieces.joined([coder.store, *whole]) if whole else coder.store

    # Occurrences of pieces in the order of their documents, whole texts as one piece each. A piece that does not agree takes
    # its text out.
    at = np.concatenate((known[indices.to_numpy()], len(coder.store.agree) + np.arange(len(whole)))).astype(np.int64)
    doc = np.concatenate((np.repeat(plain_rows, np.diff(bounds)), whole_rows)).astype(np.int64)
    if len(whole):
        order = np.argsort(doc, kind="stable")
        at, doc = at[order], doc[order]
    bad = np.zeros(rows, bool)
    bad[doc[~found.agree[at]]] = True
    keep = ~bad[doc]
    at, doc = at[keep], doc[keep]

    starts = np.searchsorted(doc, np.arange(rows + 1))
    totals = {}
    for name, values in found.totals.items():
        sums = np.concatenate(([0], np.cumsum(values[at])))
        totals[name] = sums[starts[1:]] - sums[starts[:-1]]

    told = found.groups.take(pa.array(at))
    ends = np.frombuffer(told.buffers()[1], np.int32, len(told) + 1)[starts].tolist()
    text = memoryview(told.buffers()[2] or b"")
    digests = [hashlib.sha256(text[i : j - 1]).hexdigest() if j > i else "" for i, j in zip(ends, ends[1:])]

    lengths = found.totals["n_links"]
    first = np.cumsum(lengths) - lengths
    used = np.flatnonzero(np.bincount(at, minlength=len(lengths)))
    different, place = np.unique(found.links[spread(first[used], lengths[used])], return_inverse=True)
    own_first = np.zeros(len(lengths), np.int64)
    own_first[used] = np.cumsum(lengths[used]) - lengths[used]
    of_link = place[spread(own_first[at], lengths[at])].astype(np.int64)
    keys, times = counted(of_link * max(rows, 1) + np.repeat(doc, lengths[at]))
    return Portion(totals, digests, different[keys // max(rows, 1)], keys % max(rows, 1), times)


def postings(pairs: np.ndarray, slots: np.ndarray, times: np.ndarray, rows: int) -> dict[str, list | np.ndarray]:
    """Postings of a block of `rows` documents from (pair, slot, times), each pair and slot once: per pair its documents as a
    bitmap, dense (a bit for each slot) or sparse (16-bit slots), whichever is smaller, and the bit planes of `times` in the
    order of its documents, least significant first."""
    order = np.lexsort((slots, pairs))
    pairs, slots, times = pairs[order], slots[order], times[order]
    first = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1]))) if len(pairs) else np.zeros(0, np.int64)
    counts = np.diff(np.concatenate((first, [len(pairs)])))
    of = np.repeat(np.arange(len(first)), counts)
    rank = np.arange(len(pairs)) - first[of]
    most = np.maximum.reduceat(times, first) if len(first) else np.zeros(0, np.int64)
    planes = np.frexp(most.astype(np.float64))[1].astype(np.int64)
    width = (counts + 7) // 8
    base = np.cumsum(planes * width) - planes * width
    bits = np.zeros(int((planes * width).sum()) * 8, np.uint8)
    for k in range(int(planes.max(initial=0))):
        chosen = np.flatnonzero(times >> k & 1)
        bits[(base[of[chosen]] + k * width[of[chosen]]) * 8 + rank[chosen]] = 1
    packed = np.packbits(bits, bitorder="little").tobytes()
    dense = (rows + 7) // 8 < 2 * counts
    raw = slots.astype("<u2").tobytes()
    maps = []
    for n, is_dense in enumerate(dense.tolist()):
        a = int(first[n])
        if is_dense:
            own = np.zeros(rows, np.uint8)
            own[slots[a : a + counts[n]]] = 1
            maps.append(np.packbits(own, bitorder="little").tobytes())
        else:
            maps.append(raw[2 * a : 2 * (a + int(counts[n]))])
    ends = (base + planes * width).tolist()
    return {
        "a": (pairs[first] >> 32).astype(np.int32),
        "b": (pairs[first] & 0xFFFFFFFF).astype(np.int32),
        "documents": counts,
        "links": np.add.reduceat(times, first) if len(first) else np.zeros(0, np.int64),
        "dense": dense,
        "slots": maps,
        "planes": [packed[s:e] for s, e in zip(base.tolist(), ends)],
    }


def entries(slots: list[bytes], planes: list[bytes], dense: np.ndarray, documents: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The (slot, times) of postings one after another: the inverse of `postings`."""
    total = int(documents.sum())
    out = np.zeros(total, np.int64)
    ends = np.cumsum(documents)
    starts = ends - documents
    sparse = np.flatnonzero(~dense)
    if len(sparse):
        out[spread(starts[sparse], documents[sparse])] = np.frombuffer(b"".join(slots[i] for i in sparse.tolist()), "<u2")
    for i in np.flatnonzero(dense).tolist():
        out[starts[i] : ends[i]] = np.flatnonzero(np.unpackbits(np.frombuffer(slots[i], np.uint8), bitorder="little"))
    width = (documents + 7) // 8
    sizes = np.fromiter(map(len, planes), np.int64, len(planes))
    depth = np.where(width > 0, sizes // np.maximum(width, 1), 0)
    base = np.cumsum(sizes) - sizes
    bits = np.unpackbits(np.frombuffer(b"".join(planes), np.uint8), bitorder="little")
    times = np.zeros(total, np.int64)
    for k in range(int(depth.max(initial=0))):
        chosen = np.flatnonzero(depth > k)
        at = spread(starts[chosen], documents[chosen])
        times[at] += bits[spread((base[chosen] + k * width[chosen]) * 8, documents[chosen])].astype(np.int64) << k
    return out, times


_INT, _LONG, _TEXT, _RAW = pa.int32(), pa.int64(), pa.string(), pa.binary()
DOCUMENT = {
    "slot": _INT, "doc_id": _LONG, "n_a": _LONG, "n_b": _LONG, "n_groups": _LONG, "n_links": _LONG, "groups_sha256": _TEXT,
}
POSTING = {
    "a": _INT, "b": _INT, "documents": _LONG, "links": _LONG, "dense": pa.bool_(), "slots": _RAW, "planes": _RAW,
}
BOTH = pa.schema({"kind": _TEXT, "block": _LONG, **DOCUMENT, **POSTING})


@dataclass
class _Block:
    """Portions until they make a block."""

    number: int
    rows: int = 0
    size: int = 0
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def add(self, portion: Portion, size: int) -> None:
        self.parts.append((portion.pairs, portion.at + self.rows, portion.times))
        self.rows += len(portion.digests)
        self.size += size

    def record(self) -> pa.RecordBatch:
        """The bitmaps of all portions united, as rows."""
        united = [np.concatenate(x) for x in zip(*self.parts)]
        return _rows("posting", self.number, postings(*united, self.rows))


def _rows(kind: str, block: int, columns: dict) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    known = columns | {"kind": [kind] * n, "block": np.full(n, block, np.int64)}
    return pa.RecordBatch.from_arrays(
        [pa.array(known[f.name], f.type) if f.name in known else pa.nulls(n, f.type) for f in BOTH], schema=BOTH
    )


def aligned_documents(docs: DataFrame, byte_vocabulary: str, piece_model: str, folder: str) -> tuple[DataFrame, DataFrame]:
    """Documents (block, slot, doc_id, totals) and postings (block, a, b, …), both from one pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = aligner(byte_vocabulary, piece_model)
        number = TaskContext.get().partitionId() << 32
        block = _Block(number)
        for batch in batches:
            for part in in_portions(batch, most=PORTION_BYTES):
                for start in range(0, part.num_rows, BLOCK_ROWS):
                    some = part.slice(start, BLOCK_ROWS)
                    if block.rows + some.num_rows > BLOCK_ROWS or block.size >= BLOCK_BYTES:
                        yield block.record()
                        block = _Block(block.number + 1)
                    portion = aligned_portion(coder, some.column(1))
                    slots = np.arange(block.rows, block.rows + some.num_rows, dtype=np.int32)
                    known = {"slot": slots, "doc_id": some.column(0), **portion.totals, "groups_sha256": portion.digests}
                    yield _rows("document", block.number, known)
                    block.add(portion, some.column(1).nbytes)
        if block.rows:
            yield block.record()

    kinds = from_arrow_schema(BOTH)
    both = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(run, kinds)
    both.write.option("compression", "zstd").partitionBy("kind").parquet(folder)
    read = docs.sparkSession.read.schema(kinds).parquet(folder)
    documents, found = (read.filter(F.col("kind") == k) for k in ("document", "posting"))
    return documents.select("block", *DOCUMENT), found.select("block", *POSTING)


def pair_scores(postings_: DataFrame) -> DataFrame:
    """a, b, documents, links and best (no other a has more links with this b) of every pair."""
    pairs = postings_.groupBy("a", "b").agg(F.sum("documents").alias("documents"), F.sum("links").alias("links"))
    most = pairs.groupBy(F.col("b").alias("_b")).agg(F.max("links").alias("_most"))
    return pairs.join(most, F.col("b") == F.col("_b")).select("a", "b", "documents", "links", (F.col("links") == F.col("_most")).alias("best"))


def scored_documents(postings_: DataFrame, pairs: DataFrame) -> DataFrame:
    """block, slot, n_best, count_sum: what the postings of a block return for its documents; those without links are absent."""

    def score(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        documents = table.column("documents").to_numpy()
        dense = table.column("dense").to_numpy()
        slots, times = entries(table.column("slots").to_pylist(), table.column("planes").to_pylist(), dense, documents)
        sums = np.zeros((2, int(slots.max(initial=-1)) + 1), np.int64)
        for out, column in zip(sums, ("best", "links")):
            np.add.at(out, slots, times * np.repeat(table.column(column).to_numpy().astype(np.int64), documents))
        held = np.unique(slots)
        return pa.table(
            {
                "block": pa.array(np.full(len(held), table.column("block")[0].as_py(), np.int64)),
                "slot": pa.array(held.astype(np.int32)),
                "n_best": pa.array(sums[0][held]),
                "count_sum": pa.array(sums[1][held]),
            }
        )

    known = pairs.select(F.col("a").alias("_a"), F.col("b").alias("_b"), F.col("links").alias("_links"), "best")
    each = postings_.join(known, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")))
    chosen = each.select("block", "documents", "dense", "slots", "planes", F.col("_links").alias("links"), "best")
    return chosen.groupBy("block").applyInArrow(score, "block long, slot int, n_best long, count_sum long")


def align(docs: DataFrame, byte_vocabulary: str, piece_model: str, folder: str) -> tuple[DataFrame, DataFrame]:
    """Two tables: per row of `docs` (doc_id, text) its totals, scores and digest of groups; and the score of every pair.

    Null and empty texts, and texts whose tokens' bytes are not a space and the text (such as those that hold U+2581), have
    zeros and an empty digest. Rows of one id are aligned each; a null id stays null; other columns are not looked at. Special
    tokens' strings are plain text. Blocks hold at most 65,536 documents and some megabytes of text. Tables are stored in `folder`.
    """
    documents, found = aligned_documents(docs, byte_vocabulary, piece_model, f"{folder}/aligned")
    pairs = stored(pair_scores(found), f"{folder}/pairs")
    scores = scored_documents(found, pairs)
    sums = scores.select(F.col("block").alias("_block"), F.col("slot").alias("_slot"), "n_best", "count_sum")
    both = documents.join(sums, (F.col("block") == F.col("_block")) & (F.col("slot") == F.col("_slot")), "left")
    zero = F.lit(0).cast("long")
    rows = both.select(
        *("doc_id", "n_a", "n_b", "n_groups", "n_links"),
        F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256",
    )
    return rows, pairs
