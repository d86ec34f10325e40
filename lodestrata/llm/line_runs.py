"""Line deduplication over levelled sorted runs of line hashes.

A line's key is the line without the white space of `STRIPPED` at its ends, A-Z in lower case; its hash has 128 bits.
A run is a bucketed, sorted table of (h1, h2, n_docs, last): how many documents of its batches hold the key, and the
largest doc_id among them if the run was the first to hold the key. Batches come in descending order of doc_id, so that
is the largest of all. Two runs of one level are merged into one of the next level, bucket by bucket; buckets
are those of the shuffle, so neither a merge nor the join of a new batch with the runs moves a run.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm.common import partitions, stored
from lodestrata.session import scratch_folder

STRIPPED = " \t\n\x0b\x0c\r"
KEY = ["h1", "h2"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    """The lines of a text; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of_line(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(STRIPPED)), UPPER, LOWER)


def hash_of_line(line: Column) -> Column:
    """128 bits of the key as two numbers."""
    key = key_of_line(line)
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(key, F.lit(1)).alias("h2"))


def line_keys(docs: DataFrame, shortest: int = 20) -> DataFrame:
    """doc_id, h1, h2: each document's different keys of at least `shortest` code points. Rows without id have none."""
    long = F.filter(lines_of(F.col("text")), lambda line: F.char_length(key_of_line(line)) >= shortest)
    keys = F.array_distinct(F.transform(long, hash_of_line))
    rows = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", F.explode(keys).alias("key"))
    return rows.select("doc_id", "key.h1", "key.h2")


class LineRuns:
    """The runs of one corpus. `fanout` runs of a level are merged into one of the next."""

    def __init__(self, spark: SparkSession, folder: str, fanout: int = 2):
        self.spark, self.folder, self.fanout = spark, folder, fanout
        self.buckets = partitions(spark)
        self.prefix = f"line_run_{uuid.uuid4().hex}"
        self.written = 0
        self.live: list[tuple[int, str]] = []

    def _write(self, rows: DataFrame, level: int) -> DataFrame:
        name = f"{self.prefix}_{self.written}"
        self.written += 1
        (
            rows.select(*KEY, "n_docs", "last")
            .write.bucketBy(self.buckets, *KEY)
            .sortBy(*KEY)
            .option("compression", "zstd")
            .option("path", f"{self.folder}/{name}")
            .saveAsTable(name)
        )
        self.live.append((level, name))
        return self.spark.table(name)

    def add(self, keys: DataFrame) -> DataFrame:
        """Joins a batch (`line_keys` of documents smaller than all before) with the runs and adds its own run.

        Returns the keys that no run held before: h1, h2, last.
        """
        own = keys.groupBy(*KEY).agg(F.countDistinct("doc_id").alias("n_docs"), F.max("doc_id").alias("own_last"))
        seen = []
        for i, (_, name) in enumerate(self.live):
            run = self.spark.table(name).select(
                F.col("h1").alias("r1"), F.col("h2").alias("r2"), F.lit(True).alias(f"seen_{i}")
            )
            own = own.join(run, (F.col("h1") == F.col("r1")) & (F.col("h2") == F.col("r2")), "left").drop("r1", "r2")
            seen.append(F.col(f"seen_{i}"))
        fresh = F.coalesce(*seen, F.lit(False)) == F.lit(False)
        run = self._write(own.withColumn("last", F.when(fresh, F.col("own_last"))), 0)
        self._compact()
        return run.filter(F.col("last").isNotNull()).select(*KEY, "last")

    def _merge(self, names: list[str], level: int) -> None:
        def two(a: DataFrame, b: DataFrame) -> DataFrame:
            b = b.select(*(F.col(c).alias(f"b_{c}") for c in b.columns))
            both = a.join(b, (F.col("h1") == F.col("b_h1")) & (F.col("h2") == F.col("b_h2")), "full")
            zero = F.lit(0)
            return both.select(
                *(F.coalesce(c, f"b_{c}").alias(c) for c in KEY),
                (F.coalesce("n_docs", zero) + F.coalesce("b_n_docs", zero)).alias("n_docs"),
                F.greatest("last", "b_last").alias("last"),  # one of both is null unless the key is in one run only
            )

        tables = [self.spark.table(n) for n in names]
        self.live = [x for x in self.live if x[1] not in names]
        self._write(reduce(two, tables), level)
        for name in names:
            self.spark.sql(f"DROP TABLE {name}")  # the name only; the files are where `folder` is

    def _compact(self) -> None:
        level = 0
        while (names := [n for at, n in self.live if at == level]) and len(names) >= self.fanout:
            self._merge(names, level + 1)
            level += 1

    def common(self, least: int) -> DataFrame:
        """The keys found in at least `least` documents, as a stored table: h1, h2, last.

        The runs are merged to one, whose name leaves the catalog; no batch can be added afterwards.
        """
        if len(self.live) > 1:
            self._merge([n for _, n in self.live], 1 + max(at for at, _ in self.live))
        name = self.live.pop()[1]
        held = self.spark.table(name).filter(F.col("n_docs") >= least)
        kept = stored(held.select(*KEY, "last"), f"{self.folder}/common-{name}")
        self.spark.sql(f"DROP TABLE {name}")
        return kept


def repeated_keys(docs: DataFrame, least: int = 3, shortest: int = 20, batches: int = 4) -> DataFrame:
    """doc_id, drop (array of h1, h2): the keys that each document loses, from runs over descending batches."""
    spark = docs.sparkSession
    folder = scratch_folder(spark)
    shares = [i / batches for i in range(1, batches)] or [0.5]
    found = docs.agg(F.percentile_approx("doc_id", shares, 1000).alias("q")).first()["q"] or []
    bounds = F.array(*[F.lit(b).cast("long") for b in sorted(set(found))]) if found else F.array().cast("array<long>")
    batch = F.size(F.filter(bounds, lambda b: b < F.col("doc_id"))).alias("batch")
    keyed = line_keys(docs, shortest).select("doc_id", *KEY, batch)
    keyed.write.partitionBy("batch").option("compression", "zstd").parquet(f"{folder}/keys")
    keys = spark.read.schema("doc_id long, h1 long, h2 long, batch int").parquet(f"{folder}/keys")
    runs = LineRuns(spark, f"{folder}/runs")
    for i in reversed(range(len(set(found)) + 1)):
        runs.add(keys.filter(F.col("batch") == i))
    common = runs.common(least).select(F.col("h1").alias("c1"), F.col("h2").alias("c2"), "last")
    lost = keys.join(common, (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2"))).filter(F.col("doc_id") != F.col("last"))
    return lost.groupBy("doc_id").agg(F.collect_set(F.struct(*KEY)).alias("drop"))


def dedup_lines(docs: DataFrame, least: int = 3, shortest: int = 20, batches: int = 4) -> DataFrame:
    """`docs` (doc_id, text, other columns) with `kept_text`, `n_lines` and `n_dropped`.

    Keys of at least `shortest` code points found in at least `least` documents lose all their lines except in the
    largest doc_id that holds them; there all of them stay. A null text counts as one empty line and is kept as an empty
    text. Rows without an id hold nothing and keep all their lines. Rows of one id are one document to the counts and
    are cleaned alike. An empty table gives an empty one.
    """
    lost = repeated_keys(docs, least, shortest, batches).select(F.col("doc_id").alias("_doc"), F.col("drop").alias("_drop"))
    joined = docs.join(lost, F.col("doc_id") == F.col("_doc"), "left")
    lines = lines_of(F.col("text"))

    def stays(line: Column) -> Column:
        short = F.char_length(key_of_line(line)) < shortest
        return short | ~F.array_contains(F.col("_drop"), hash_of_line(line))

    kept = F.when(F.col("_drop").isNull(), lines).otherwise(F.filter(lines, stays))
    return (
        joined.withColumn("_kept", kept)
        .withColumn("n_lines", F.size(lines).cast("long"))
        .withColumn("n_dropped", (F.size(lines) - F.size("_kept")).cast("long"))
        .withColumn("kept_text", F.array_join("_kept", "\n"))
        .drop("_doc", "_drop", "_kept")
    )
