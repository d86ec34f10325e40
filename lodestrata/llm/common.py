"""What the operators share: scratch tables, files in shared folders, ranks in a range order."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.session import scratch_folder


def ship(spark: SparkSession) -> None:
    """Gives the executors this package, once per application, as `--py-files` would."""
    context = spark.sparkContext
    if getattr(context, "_lodestrata_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="lodestrata-py-")) / "lodestrata.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._lodestrata_shipped = True


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, folder: str | None = None, codec: str = "zstd") -> DataFrame:
    """The rows as a written table in the shared folder; what follows starts from there after a lost executor."""
    spark = df.sparkSession
    folder = folder or scratch_folder(spark)
    df.write.option("compression", codec).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a folder's address and the path in it; a plain path is local."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return pyarrow.fs.FileSystem.from_uri(uri)


def ranked_by_range(df: DataFrame, keys: list[str], folder: str | None = None) -> tuple[DataFrame, dict]:
    """Stores `df` sorted by `keys` with its place in that order as `position` (from 0).

    Equal keys are told apart by no one, so callers end `keys` with what is unique. The order is dealt by range, so a
    hot leading key is cut by the keys after it. The second value holds the rows before each partition; there are as
    many as shuffle partitions.
    """
    spark = df.sparkSession
    place = F.monotonically_increasing_id()
    sorted_rows = (
        df.repartitionByRange(partitions(spark), *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", place.bitwiseAND(F.lit((1 << 33) - 1)))
        .withColumn("_slice", F.shiftright(place, 33).cast("int"))
    )
    rows = stored(sorted_rows, folder)
    counts = {r["_slice"]: r["count"] for r in rows.groupBy("_slice").count().collect()}
    before, total = {}, 0
    for slice_ in sorted(counts):
        before[slice_] = total
        total += counts[slice_]
    return rows, before


def with_position(rows: DataFrame, before: dict) -> DataFrame:
    """Adds `position` to what `ranked_by_range` stored; the list of slices is as long as there are partitions."""
    if not before:
        return rows.withColumn("position", F.lit(None).cast("long")).drop("_slice", "_at")
    offsets = F.array(*[F.lit(before.get(i, 0)).cast("long") for i in range(max(before) + 1)])
    return rows.withColumn("position", F.get(offsets, F.col("_slice")) + F.col("_at")).drop("_slice", "_at")
