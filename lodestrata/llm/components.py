"""Connected components of an edge table, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.common import stored


def components(edges: DataFrame, folder: str) -> DataFrame:
    """node, label for all nodes of `edges` (a, b): the least node that can be reached. Each round leaves a table.

    A node with very many edges is a key like others: its least label is found by partial minima, and its label goes to
    its edges by a join that adaptive execution splits.
    """
    spark = edges.sparkSession
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a")).distinct()
    both = stored(both, f"{folder}/edges")
    labels = stored(both.groupBy(F.col("u").alias("node")).agg(F.least(F.col("u"), F.min("v")).alias("label")), f"{folder}/labels-0")
    n = 0
    while True:
        n += 1
        around = both.join(labels, F.col("v") == F.col("node")).groupBy("u").agg(F.min("label").alias("least"))
        hooked = stored(
            labels.join(around, F.col("node") == F.col("u")).select("node", F.least("label", "least").alias("label"), F.col("label").alias("was")),
            f"{folder}/hooked-{n}",
        )
        up = hooked.select(F.col("node").alias("parent"), F.col("label").alias("higher"))
        jumped = hooked.join(up, F.col("label") == F.col("parent"), "left").select(
            "node", F.least("label", F.coalesce("higher", "label")).alias("label"), "was"
        )
        labels = stored(jumped, f"{folder}/labels-{n}")
        if labels.filter("label <> was").isEmpty():
            return spark.read.parquet(f"{folder}/labels-{n}").select("node", "label")
        labels = labels.select("node", "label")
