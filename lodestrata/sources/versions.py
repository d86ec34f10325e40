"""Stored tables as immutable versions, and releases that name the versions that belong together.

A version is a folder beside earlier ones. It counts once Spark's job commit has left its `_SUCCESS` mark, the last file
written, so a write that fails or still runs changes nothing for readers. A release is one small file that appears complete or
not at all and maps tables to versions: readers see all tables of a run switch together.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MARK = "_SUCCESS"
RELEASES = "releases"


class Files:
    """Names and small files through the file system that Spark itself uses for a path."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        where = self._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self._conf), where

    def names(self, folder: str) -> list[str]:
        """Entries of a folder in order; a folder that is not there has none."""
        system, where = self._at(folder)
        return sorted(entry.getPath().getName() for entry in system.listStatus(where)) if system.exists(where) else []

    def exists(self, path: str) -> bool:
        system, where = self._at(path)
        return system.exists(where)

    def delete(self, path: str) -> None:
        system, where = self._at(path)
        system.delete(where, True)

    def read(self, path: str) -> str:
        system, where = self._at(path)
        stream = system.open(where)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_once(self, path: str, text: str) -> None:
        """The file under its name only when it is complete: written beside it and renamed."""
        folder, name = path.rsplit("/", 1)
        system, draft = self._at(f"{folder}/.{name}.draft")
        stream = system.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not system.rename(draft, self._at(path)[1]):
            raise FileExistsError(path)


def _stamp() -> str:
    """Names that sort by time; two of one instant are told apart."""
    return f"{time.time_ns() // 1000:017d}-{uuid.uuid4().hex[:8]}"


def write_version(df: DataFrame, path: str, partition_by: Sequence[str] = (), codec: str = "zstd") -> str:
    """Writes `df` as a new version of the table at `path` and returns the version's folder."""
    folder = f"{path.rstrip('/')}/v{_stamp()}"
    writer = df.write.mode("errorifexists").option("compression", codec)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(folder)
    return folder


def versions(spark: SparkSession, path: str) -> list[str]:
    """The complete versions of a table, oldest first."""
    files, path = Files(spark), path.rstrip("/")
    folders = [f"{path}/{name}" for name in files.names(path) if name.startswith("v")]
    return [folder for folder in folders if files.exists(f"{folder}/{MARK}")]


def current_version(spark: SparkSession, path: str) -> str:
    found = versions(spark, path)
    if not found:
        raise FileNotFoundError(f"no complete version of {path}")
    return found[-1]


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version of a table, as it stands now; only Parquet files are looked at."""
    return read_version(spark, current_version(spark, path))


def read_version(
    spark: SparkSession, folder: str, columns: Sequence[str] = (), schema: T.StructType | Mapping | None = None
) -> DataFrame:
    """A version, with its columns in the given order (partition columns are stored last).

    With its `schema` no file is opened to find it, and a partitioned table without rows, which has no files, is a table too.
    """
    reader = spark.read.option("pathGlobFilter", "*.parquet")
    if schema is not None:
        reader = reader.schema(schema if isinstance(schema, T.StructType) else T.StructType.fromJson(dict(schema)))
    table = reader.parquet(folder)
    return table.select(*columns) if columns else table


def versioned(version: str, df: DataFrame) -> dict:
    """What a release says of a table: its version, columns and types."""
    return {"version": version, "columns": df.columns, "schema": json.loads(df.schema.json())}


def release(spark: SparkSession, root: str, tables: Mapping[str, Mapping]) -> str:
    """Makes these versions the current ones of `root` in one step: name -> {"version": folder, "columns": names}, and a
    "schema" where it is known (see `versioned`)."""
    path = f"{root.rstrip('/')}/{RELEASES}/r{_stamp()}.json"
    Files(spark).write_once(path, json.dumps(tables, indent=1, sort_keys=True))
    return path


def releases(spark: SparkSession, root: str) -> list[str]:
    folder = f"{root.rstrip('/')}/{RELEASES}"
    return [f"{folder}/{name}" for name in Files(spark).names(folder) if name.startswith("r") and name.endswith(".json")]


def current_release(spark: SparkSession, root: str) -> dict[str, dict]:
    """The tables of the newest release; none where nothing was released."""
    found = releases(spark, root)
    return json.loads(Files(spark).read(found[-1])) if found else {}


def read_release(spark: SparkSession, root: str, names: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """The tables (all or the named ones) of the newest release."""
    tables = current_release(spark, root)
    missing = sorted(set(names or ()) - set(tables))
    if missing:
        raise FileNotFoundError(f"not in the release of {root}: {', '.join(missing)}")
    chosen = {name: tables[name] for name in (tables if names is None else names)}
    return {name: read_version(spark, t["version"], t["columns"], t.get("schema")) for name, t in chosen.items()}


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Deletes what the last `keep` releases of `root` do not name: older releases, and versions older than the oldest that is kept.

    Versions that are newer stay, complete or not: a run may be writing them. Readers of a kept release are not disturbed.
    """
    files = Files(spark)
    found = releases(spark, root)
    old, kept = found[:-keep], found[-keep:]
    named = [json.loads(files.read(path)) for path in kept]
    held = {table["version"] for tables in named for table in tables.values()}
    gone = []
    for folder in {version.rsplit("/", 1)[0] for version in held}:
        first = min(version.rsplit("/", 1)[1] for version in held if version.startswith(f"{folder}/"))
        for name in files.names(folder):
            if name.startswith("v") and name < first:
                gone.append(f"{folder}/{name}")
    for path in (*old, *gone):
        files.delete(path)
    return gone
