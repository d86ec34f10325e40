"""Token ids of documents as a table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.words import encoder, in_portions


def id_type(width: int) -> np.dtype:
    return np.dtype("<u2" if width == 2 else "<u4")


def with_end(flat: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The end id after each text's ids."""
    return np.insert(flat, np.cumsum(counts), end), counts + 1


def encoded_portions(
    batches: Iterator[pa.RecordBatch], vocabulary: str, end: int
) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Of batches (id, text): the ids of the documents, all token ids one after another, and how many each document has."""
    coder = encoder(vocabulary)
    for batch in batches:
        for part in in_portions(batch):
            yield part.column(0), *with_end(*coder.encode(part.column(1)), end)


def binaries(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Runs of an array as binary values; a portion stays far below the two gigabytes that 32-bit offsets reach."""
    ends = (np.concatenate(([0], np.cumsum(counts))) * flat.itemsize).astype("<i4")
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(flat)])


def tokenize(
    docs: DataFrame, vocabulary: str, end: int, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: doc_id long, n_tokens long, width int, ids binary (little-endian, `width` bytes each).

    `vocabulary` is the path of a tokenizers file that every executor has. No special tokens are added; `end` is
    appended to each document. A null text is an empty one. Repeated rows stay repeated, other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs_, flat, counts in encoded_portions(batches, vocabulary, end):
            width = pa.array(np.full(len(counts), flat.itemsize, np.int32))
            yield pa.RecordBatch.from_arrays(
                [docs_, pa.array(counts), width, binaries(flat, counts)], names=["doc_id", "n_tokens", "width", "ids"]
            )

    chosen = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return chosen.mapInArrow(run, "doc_id long, n_tokens long, width int, ids binary")
