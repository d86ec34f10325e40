"""Alignment of two tokenizers against a plain version over whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lodestrata.llm import alignment
from lodestrata.llm.common import ship
from lodestrata.session import scratch_folder

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A = Tokenizer.from_file(BYTES)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PIECES)
NAMES = {i: t for t, i in A.get_vocab().items()}
VALUES = alignment.byte_values()
ODD = [
    "", " ", "\n", "a", " a", "a ", "a  b", "a\n\nb", "a\n\n\nb c", "a \n b", "tab\tand\r\nline", "nbsp x y　z", "▁", "a▁b c",
    "<|endoftext|> <s> </s> <unk> <0x41>", "語 漢字かな 🙂🙃", "\x00 \x1c a\x1cb", "It's 12 o'clock!!", "é é ß", "؟ نص", "x" * 300,
]


def tokens(text):
    """Ids and bytes of the tokens of both, or None where the bytes are not a space and the text."""
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    a_parts = [bytes(VALUES[c] for c in NAMES[i]) for i in a]
    b_parts = [bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode() for i in b]
    raw = (" " + text).encode()
    return (a, a_parts, b, b_parts) if b"".join(a_parts) == raw == b"".join(b_parts) else None


def plain(text):
    """(n_a, n_b, groups, links) by comparing all byte ranges."""
    found = tokens(text) if text else None
    if found is None:
        return 0, 0, [], []
    a, a_parts, b, b_parts = found
    a_ends, b_ends = (np.cumsum([len(p) for p in parts]).tolist() for parts in (a_parts, b_parts))
    links = []
    for i, (e, p) in enumerate(zip(a_ends, a_parts)):
        links += [(a[i], b[j]) for j, (f, q) in enumerate(zip(b_ends, b_parts)) if e - len(p) < f and f - len(q) < e]
    groups, before = [], 0
    for cut in sorted({*a_ends} & {*b_ends}):
        own = [[str(x) for x, e in zip(ids, ends) if before < e <= cut] for ids, ends in ((a, a_ends), (b, b_ends))]
        groups.append("|".join(map(",".join, own)))
        before = cut
    return len(a), len(b), groups, links


def plain_rows(rows):
    each = [(i, plain(t)) for i, t in rows]
    count = Counter(link for _, p in each for link in p[3])
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for i, (n_a, n_b, groups, links) in each:
        best, total = sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((i, n_a, n_b, len(groups), len(links), best, total, digest))
    documents = Counter(link for _, p in each for link in set(p[3]))
    pairs = [(a, b, documents[a, b], n, n == most[b]) for (a, b), n in count.items()]
    return sorted(out, key=repr), sorted(pairs)


SCHEMA = "doc_id long, text string, block string, slot string, links string, kind string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, *["clash"] * 4) for i, t in rows], SCHEMA).repartition(3)


def aligned(spark, rows):
    ship(spark)
    found, pairs = alignment.align(frame(spark, rows), BYTES, PIECES, scratch_folder(spark))
    return sorted(map(tuple, found.collect()), key=repr), sorted(map(tuple, pairs.collect()))


def texts(seed, n):
    rng = random.Random(seed)
    words = ["the", "straße", "naïve", "unbelievably", "x1y2", "…", "don't", "été", "hyperparameters", "Zürich,", "foo_bar()", "12345"]
    return [rng.choice([" ", "\n", " ", " ", "\n\n"]).join(rng.choices(words, k=rng.randint(1, 40))) for _ in range(n)]


def test_documents_and_pairs(spark):
    rows = [*enumerate(texts(1, 60)), *((100 + i, t) for i, t in enumerate(ODD)), (None, "the end"), (7, "again 7"), (7, "again 7"), (300, None)]
    rows += [(400 + i, "the hot text of a third of all rows") for i in range(50)]
    assert aligned(spark, rows) == plain_rows(rows)


def test_postings_and_back():
    """Bitmaps of either kind and their planes hold what the portions counted."""
    batch = pa.array([f"{t} rare{i}" for i, t in enumerate(texts(2, 320))])
    coder = alignment.aligner(BYTES, PIECES)
    whole = alignment.aligned_portion(coder, batch)
    found = Counter()
    for start in range(0, 320, 150):
        part = alignment.aligned_portion(coder, batch.slice(start, 150))
        block = alignment.postings(part.pairs, part.at, part.times, len(part.digests))
        slots, times = alignment.entries(block["slots"], block["planes"], block["dense"], block["documents"])
        ids = np.repeat(block["a"].astype(np.int64) << 32 | block["b"], block["documents"])
        found.update({(int(p), int(s) + start): int(t) for p, s, t in zip(ids, slots, times)})
        assert block["links"].sum() == times.sum() and set(block["dense"].tolist()) == {True, False}
    assert found == {(int(p), int(s)): int(t) for p, s, t in zip(whole.pairs, whole.at, whole.times)}


def test_nothing(spark):
    assert aligned(spark, []) == ([], [])
    assert aligned(spark, [(1, None), (2, "")]) == ([(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")], [])


def test_long_text(spark):
    text = " ".join(texts(3, 3000))
    rows = [(1, text), (2, "short")]
    got, _ = aligned(spark, rows)
    found = tokens(text)
    assert got[0][1:3] == (len(found[0]), len(found[2]))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=25), st.text("ab'sl \n\t.é▁<|>\x1c9語 ", max_size=40)), max_size=6))
def test_pieces_align_as_whole_texts(some):
    portion = alignment.aligned_portion(alignment.aligner(BYTES, PIECES), pa.array([*some, *ODD], pa.string()))
    expected = [plain(t) for t in [*some, *ODD]]
    assert portion.totals["n_a"].tolist() == [e[0] for e in expected]
    assert portion.totals["n_b"].tolist() == [e[1] for e in expected]
    assert portion.digests == [hashlib.sha256(";".join(e[2]).encode()).hexdigest() if e[2] else "" for e in expected]
    links = Counter((n, a << 32 | b) for n, e in enumerate(expected) for a, b in e[3])
    assert {(int(s), int(p)): int(t) for p, s, t in zip(portion.pairs, portion.at, portion.times)} == links
