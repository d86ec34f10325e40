"""Parquet tables, published columns and small literal relations."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.sources.versions import Files, current_release, read_published, read_release, versions, write_version


def publish(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    codec: str = "zstd",
    table: str | None = None,
    keep: int = 2,
) -> str:
    """Replace a Parquet table in one step and return the new version's folder; `read_published` reads the newest.

    Until the last file of the new version is committed, and for good if the write fails, readers see the version before. The
    last `keep` versions stay. Partitioned output is rebalanced, so a large partition is written by many tasks. `table` is a
    catalog table that is then pointed at the new version (it is made anew where the schema has changed).
    """
    spark = df.sparkSession
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    folder = write_version(df, path, partition_by, codec)
    if table is not None:
        _point(spark, table, folder, df.schema, partition_by)
    files, complete = Files(spark), versions(spark, path)
    for old in complete[: -max(keep, 1)]:
        files.delete(old)
    return folder


def _point(spark: SparkSession, table: str, folder: str, schema: T.StructType, partition_by: Sequence[str]) -> None:
    known = spark.catalog.tableExists(table)
    stored = [*(f for f in schema if f.name not in partition_by), *(schema[name] for name in partition_by)]
    shape = [(f.name, f.dataType.simpleString()) for f in stored]
    if known and [(f.name, f.dataType.simpleString()) for f in spark.table(table).schema] != shape:
        spark.sql(f"DROP TABLE {table}")
        known = False
    if known:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
    else:
        columns = ", ".join(f"`{name}` {kind}" for name, kind in shape)
        parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {parts} LOCATION '{folder}'")
    if partition_by:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")


def read_model(
    spark: SparkSession,
    root: str,
    names: Iterable[str],
    casts: Mapping[str, Mapping[str, str]] | None = None,
) -> dict[str, DataFrame]:
    """Published tables by name: those of the newest release of `root`, else each table's newest version.

    Only Parquet files are considered. `casts` adjusts types after the load.
    """
    names = list(names)
    released = current_release(spark, root)
    if released:
        tables = read_release(spark, root, names)
    else:
        tables = {name: read_published(spark, f"{root}/{name}.parquet") for name in names}
    model = {}
    for name, table in tables.items():
        for column, kind in (casts or {}).get(name, {}).items():
            table = table.withColumn(column, F.col(column).cast(kind))
        model[name] = table
    return model


def mapping(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small literal relation. Handed over as Arrow it is a local relation of known size, which joins broadcast."""
    fields = T.StructType.fromDDL(schema)
    columns = zip(*rows) if rows else ([] for _ in fields)
    return spark.createDataFrame(pa.table(dict(zip(fields.names, map(list, columns)))), fields)


def published_view(df: DataFrame, allow: Sequence[str], name: str | None = None) -> DataFrame:
    """Only the allow-listed columns, also registered as a view when a name is given."""
    unknown = sorted(set(allow) - set(df.columns))
    if unknown:
        raise ValueError(f"not in the table: {', '.join(unknown)}")
    shown = df.select(*allow)
    if name:
        shown.createOrReplaceTempView(name)
    return shown


def quoted(name: str) -> str:
    """A dotted name with each part in back quotes."""
    return ".".join(f"`{part}`" for part in name.split("."))


def catalog_view(spark: SparkSession, name: str, query: str) -> None:
    """A lasting view under a qualified name. The catalog holds its text, so every session reads it; replacing is one step."""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name.rsplit('.', 1)[0])}")
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(name)} AS {query}")


def published_catalog_view(spark: SparkSession, name: str, source: str, allow: Sequence[str]) -> None:
    """A lasting view of the allow-listed columns of `source`, a table's name or the folder of a Parquet table."""
    relation = f"parquet.`{source}`" if "/" in source else quoted(source)
    unknown = sorted(set(allow) - set(spark.sql(f"SELECT * FROM {relation} LIMIT 0").columns))
    if unknown:
        raise ValueError(f"not in the table: {', '.join(unknown)}")
    catalog_view(spark, name, f"SELECT {', '.join(f'`{c}`' for c in allow)} FROM {relation}")
