"""Per-word caches used inside tasks: a text is split at white space and each word is looked up."""

from __future__ import annotations

import functools
import json
import os
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes that are taken apart together.
TOGETHER = 4 << 20


class WordCache(dict):
    """word -> bytes, computed on first use. Two generations of at most `size` words bound the memory."""

    def __init__(self, compute: Callable[[str], bytes], size: int):
        super().__init__()
        self.compute, self.size, self.old = compute, size, {}

    def __missing__(self, word: str) -> bytes:
        value = self.old.get(word)
        if value is None:
            value = self.compute(word)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[word] = value
        return value


# The settings under which words can be encoded one by one.
LOWERED_WORDS = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
# Words of printable ASCII and Latin-1 letters have pieces that a plain pattern finds; others go to the library whole.
PLAIN_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
POINTS = frozenset(".,;:!?")
PLAIN_WORD = re.compile("[!-~À-ÖØ-öø-ÿ]+")
PLAIN_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def byte_letters() -> dict[int, str]:
    """The letters that stand for the UTF-8 bytes of Latin-1 characters in a byte-level vocabulary."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter = {b: chr(b) for b in own}
    letter |= {b: chr(256 + n) for n, b in enumerate(sorted(set(range(256)) - set(own)))}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(256)}


class TextEncoder:
    """Token ids of whole texts, those that the library gives.

    Under the settings above no token crosses white space, so the different words of many texts are looked up together
    and only pieces not met before are encoded; under any other settings each text goes to the library whole.
    """

    def __init__(self, path: str, pieces: int = 250_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        settings = json.loads(self.tokenizer.to_str())
        self.by_word = all(settings[k] == v for k, v in LOWERED_WORDS.items()) and settings["model"]["type"] == "BPE"
        self.size = 1 + max(self.tokenizer.get_vocab().values())
        self.code = "H" if self.size <= 1 << 16 else "I"
        self.dtype = np.dtype("<u2" if self.code == "H" else "<u4")
        self.letters = byte_letters()
        self.pieces = WordCache(self._piece, pieces)

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _piece(self, piece: str) -> bytes:
        tokens = self.tokenizer.model.tokenize(piece.translate(self.letters) if not piece.isascii() else piece)
        return array(self.code, [t.id for t in tokens]).tobytes()

    def _word(self, word: str) -> bytes:
        if word.isalpha() and (word.isascii() or PLAIN_LETTERS.fullmatch(word)):
            return self.pieces[word.lower()]
        body, end = word[:-1], word[-1:]
        if end in POINTS and body.isalpha() and (body.isascii() or PLAIN_LETTERS.fullmatch(body)):
            return self.pieces[body.lower()] + self.pieces[end]
        if "<|" in word or not PLAIN_WORD.fullmatch(word):
            return self._library(word) if word else b""
        return b"".join(map(self.pieces.__getitem__, PLAIN_PIECES.findall(word.lower())))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has; null counts as empty."""
        if not self.by_word:
            each = [self._library(t or "") for t in texts.to_pylist()]
            flat = np.frombuffer(b"".join(each), self.dtype)
            return flat, np.array([len(e) // self.dtype.itemsize for e in each], np.int64)
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = lists.flatten().dictionary_encode()
        values = list(map(self._word, words.dictionary.to_numpy(zero_copy_only=False).tolist()))
        own = np.fromiter(map(len, values), np.int64, len(values)) // self.dtype.itemsize
        own_start = np.cumsum(own) - own
        ids = np.frombuffer(b"".join(values), self.dtype)
        at = words.indices.to_numpy(zero_copy_only=False)
        lengths = own[at]
        ends = np.cumsum(lengths)
        shift = (own_start[at] - (ends - lengths)).astype(np.int32)
        flat = ids[np.repeat(shift, lengths) + np.arange(int(lengths.sum()), dtype=np.int32)]
        ends = np.concatenate(([0], ends))[lists.offsets.to_numpy()]
        return flat, np.diff(ends)


def in_portions(batch: pa.RecordBatch, text: int = 1, most: int = TOGETHER) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts take about `most` bytes; a longer text is a run of its own.

    After the last run the memory that they took is given back, as the workers live on between tasks.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes, dtype=np.int64) // most
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)
    pa.default_memory_pool().release_unused()


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> TextEncoder:
    """One encoder per worker and vocabulary; its caches live as long as the worker."""
    return TextEncoder(path)


def plain_words(text: str) -> list[str]:
    """Lower-cased runs between white space, without punctuation at their ends."""
    return [w for w in (x.strip(PUNCTUATION) for x in text.lower().split()) if w]


PUNCTUATION = "".join(
    c for c in map(chr, range(0x2100)) if unicodedata.category(c)[0] in "PS"
)
