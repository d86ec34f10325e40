"""Token files and packing against the tokenizers library and plain Python."""

import heapq
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodestrata.llm import packing, token_files
from lodestrata.llm.common import ship, stored
from lodestrata.llm.huffman import Code, code_lengths
from lodestrata.llm.tokens import tokenize
from lodestrata.llm.words import encoder
from lodestrata.session import scratch_folder

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ODD = ["", " ", "a", "It's 12 o'clock!!", "x\x1cy", "é É ß ÿ ª²", "İstanbul Σίσυφος ς", "a b c　d", "<|endoftext|> <|x", "語 é ́", "\n\n", "WE'LL we'll 'S"]


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30), st.text("aB'sl \t.é́<|>\x1c9ß", max_size=40)), max_size=8))
def test_words_encode_as_whole_texts(texts):
    flat, counts = encoder(PATH).encode(pa.array([*texts, *ODD], pa.string()))
    own = np.split(flat, np.cumsum(counts)[:-1])
    assert [o.tolist() for o in own] == [library_ids(t) for t in [*texts, *ODD]]


def plain_cost(counts):
    """Total bits of an unlimited Huffman code."""
    heap = [c for c in counts if c]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    return total


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=2, max_size=60))
def test_lengths_are_optimal_and_limited(counts):
    counts = np.array(counts)
    free = code_lengths(counts, limit=60)
    if (counts > 0).sum() > 1:
        assert (free * counts).sum() == plain_cost(counts.tolist())
    tight = code_lengths(counts, limit=6)
    used = tight[counts > 0].astype(float)
    assert tight.max() <= 6 and (tight[counts == 0] == 0).all() and (2.0**-used).sum() <= 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), min_size=1, max_size=300), min_size=1, max_size=6), st.integers(1, 70))
def test_bits_round_trip(docs, every):
    ids, counts = np.concatenate([np.array(d) for d in docs]), np.array([len(d) for d in docs])
    code = Code(code_lengths(np.bincount(ids, minlength=50)))
    bits, sizes, marks = code.encode(ids, counts, every)
    runs = -(-counts // every)
    starts = marks + np.repeat((np.cumsum(sizes) - sizes) * 8, runs)
    lengths = np.full(int(runs.sum()), every)
    lengths[np.cumsum(runs) - 1] = counts - (runs - 1) * every
    assert code.decode(bits, starts, lengths).tolist() == ids.tolist()


def some_documents(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (100, None), (100, None), (101, "word " * 5000), (7, "again"), (-5, "below zero")]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash")).repartition(3)


def test_files_give_back_every_document(spark):
    ship(spark)
    docs = some_documents(spark)
    folder = scratch_folder(spark)
    tokens = stored(tokenize(docs, PATH, end=1), f"{folder}/tokens")
    files = token_files.write_token_files(tokens, f"{folder}/out")
    back = token_files.read_token_files(files).orderBy("start").collect()
    want = sorted(
        ([r.doc_id, [*library_ids(r.text), 1]] for r in docs.collect()), key=lambda x: (x[0] is not None, x[0] or 0, len(x[1]))
    )
    assert sorted((r.doc_id is not None, r.doc_id or 0, np.frombuffer(r.ids, "<u4").tolist()) for r in back) == sorted(
        (d is not None, d or 0, i) for d, i in want
    )
    assert [r.doc_id for r in back] == [d for d, _ in want]
    starts = np.cumsum([0, *(len(np.frombuffer(r.ids, "<u4")) for r in back)])
    assert [r.start for r in back] == starts[:-1].tolist()
    assert all(r.n_tokens == len(r.ids) // 4 for r in back)
    long = next(r for r in files.collect() if r.ids > 4000)
    whole = token_files.read_ids(long.path, 0, long.ids).tolist()
    for first, count in ((0, 1), (127, 3), (1000, 257), (long.ids - 1, 5)):
        assert token_files.read_ids(long.path, first, count).tolist() == whole[first : first + count]


def test_no_documents_no_files(spark):
    ship(spark)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.round_trip(spark, tokenize(empty, PATH, end=1)).count() == 0
    assert packing.pack(packing.pieces_of(empty, PATH)).count() == 0


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


def check_packed(rows, capacity):
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


@pytest.mark.parametrize("seed", [1, 2])
def test_packing_is_gapless_and_near_best_fit(spark, seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(1 + rng.geometric(0.02, 900), 200).tolist() + [200] * 60 + [1] * 40 + [77] * 300
    pieces = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "sequence int, length long")
    rows = packing.pack(pieces, 200).collect()
    assert sorted(r.length for r in rows) == sorted(lengths)
    assert check_packed(rows, 200) <= best_fit_decreasing(lengths, 200) * 1.02 + 1


def test_pieces_hold_the_ids_of_whole_documents(spark):
    ship(spark)
    docs = some_documents(spark)
    rows = packing.pack(packing.pieces_of(docs, PATH, capacity=64), 64).collect()
    check_packed(rows, 64)
    want = sorted(zlib.crc32(np.array([*library_ids(r.text), 0], "<u4").tobytes()) for r in docs.collect() if r.doc_id != 100)
    own = {}
    for r in sorted(rows, key=lambda r: r.piece):
        assert r.length == len(r.ids) // 4 and (r.length == 64 or r.start + r.length >= 0)
        if r.doc_id != 100:
            own[r.doc_id] = own.get(r.doc_id, b"") + r.ids
    seven = [r for r in rows if r.doc_id == 7]
    assert len(seven) == 2  # two documents of one id
    assert sorted(zlib.crc32(v) for k, v in own.items() if k != 7) == sorted(
        zlib.crc32(np.array([*library_ids(r.text), 0], "<u4").tobytes()) for r in docs.collect() if r.doc_id not in (7, 100)
    )
    assert len(want) == len(own) + 1
