"""From raw documents to packed sequences: five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of `docs`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm import decontaminate, line_runs, ngram_join, packing, quality
from lodestrata.llm.common import ship, stored
from lodestrata.session import scratch_folder

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.7 or more. Without a label all stay.

    The model learns from the labels of all folds but the held-out one. Null and empty texts are judged like others.
    """
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.model_of(docs, labels, scratch_folder(spark)))


def unrepeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that three or more documents hold, but for the largest id that holds them.

    `n_chars` follows the text. Rows that lose nothing stay as they are, null texts included; a text may become empty.
    """
    ship(spark)
    cleaned = line_runs.dedup_lines(docs.select("*", F.col("text").alias("_before")))
    lost = F.col("n_dropped") > 0
    new = {"text": F.when(lost, F.col("kept_text")).otherwise(F.col("_before"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(lost, F.char_length("kept_text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return cleaned.withColumns(new).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near duplicates (0.8 on five-word shingles, over links).

    Rows of one id stay or go together, and stay if one of them is the least of its group; rows that repeat id and text
    become one. Rows without an id stay.
    """
    ship(spark)
    classes = ngram_join.similarity_classes(docs.select("doc_id", "text"))
    gone = classes.groupBy("doc_id").agg(F.max("class_id").alias("_class")).filter(F.col("_class") < F.col("doc_id"))
    kept = docs.join(gone.select(F.col("doc_id").alias("_gone")), F.col("doc_id") == F.col("_gone"), "left_anti")
    repeated = kept.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"])
    return repeated.unionByName(kept.filter("doc_id IS NULL"))


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within its error budget; each row is judged by itself."""
    ship(spark)
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents in sequences of 2048: what `op8_best_fit_packing` returns."""
    ship(spark)
    pieces = packing.pieces_of(docs, VOCABULARY)
    narrow = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(narrow).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", unrepeated_lines),
    ("near duplicates", one_of_each),
    ("benchmark decontamination", uncontaminated),
    ("best-fit packing", packed),
]

#: SQL cannot say these stages; tests hold each against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; each leaves a table in the shared folder."""
    folder = scratch_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES[:-1]):
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/stage-{n}")
    return STAGES[-1][1](spark, docs, sf_dir)
