"""Word shingles of many texts at once, as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from lodestrata.llm.ring import mixed
from lodestrata.llm.words import PUNCTUATION


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words one after another, and how many each text has.

    Words are lower-case runs between white space of any script without signs at their ends; null is an empty text.
    """
    lists = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
    words = lists.flatten().dictionary_encode()
    bare = [w.strip(PUNCTUATION) for w in words.dictionary.to_numpy(zero_copy_only=False).tolist()]
    own = np.fromiter((xxhash.xxh3_64_intdigest(w) if w else 0 for w in bare), np.uint64, len(bare))
    real = np.fromiter(map(bool, bare), bool, len(bare))
    at = words.indices.to_numpy(zero_copy_only=False)
    keep = real[at]
    ends = np.concatenate(([0], np.cumsum(keep)))[lists.offsets.to_numpy()]
    return own[at][keep], np.diff(ends)


def shingle_hashes(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all runs of `size` words, in order, and how many each text has.

    A text of fewer words has one shingle of them all, one without words has none.
    """
    odd = mixed(np.arange(size)) | np.uint64(1)
    each = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    starts = np.cumsum(counts) - counts
    first = np.repeat(starts - (np.cumsum(each) - each), each) + np.arange(int(each.sum()))
    left = np.repeat(starts + counts, each) - first
    padded = np.concatenate((words, np.zeros(size, np.uint64)))
    total = np.zeros(len(first), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            total += np.where(left > j, padded[first + j], np.uint64(j)) * odd[j]
    return mixed(total), each
