"""Queries over token files and packed sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm import alignment, packing, token_files
from lodestrata.llm.registry import query, table
from lodestrata.llm.tokens import tokenize
from lodestrata.session import scratch_folder

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


@query()
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through Huffman-coded files: doc_id, start, n_tokens, ids_crc32."""
    tokens = tokenize(table(spark, sf_dir, "documents"), VOCABULARY, end=1)
    back = token_files.round_trip(spark, tokens)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query()
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens; the ids are reduced to their digest before they move."""
    pieces = packing.pieces_of(table(spark, sf_dir, "documents"), VOCABULARY)
    narrow = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(narrow).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query()
def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents under two tokenizers: groups that cover the same bytes, and the scores of the ids that overlap."""
    docs = table(spark, sf_dir, "documents")
    return alignment.align(docs, BYTE_VOCABULARY, PIECE_MODEL, scratch_folder(spark))[0]
