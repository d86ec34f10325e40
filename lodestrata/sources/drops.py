"""Periodic CSV drops into string-typed tables with lineage."""

from __future__ import annotations

import csv
from collections import defaultdict
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameReader, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.session import scratch_folder
from lodestrata.sources.tables import mapping

# ---------------------------------------------------------------------------------------------
# Fixed values. Results depend on them; they are data, not logic.
# ---------------------------------------------------------------------------------------------
PERIOD_PATTERN = r"([0-9]{4}_[0-9]{2})[.]csv$"
LINEAGE = ("_source_file", "_source_table", "_source_month", "_row_number", "_ingested_at_utc")
# ---------------------------------------------------------------------------------------------

_SPLIT = ("_path", "_block")
_LINE = "_line_as_delivered"


class MalformedDrop(ValueError):
    """A file has rows with more fields than its header."""


@dataclass(frozen=True)
class Drop:
    """The rows of a domain's files, the lines with more fields than their header, and how many of these there are."""

    rows: DataFrame
    malformed: DataFrame
    surplus: int


def drop_manifest(spark: SparkSession, root: str, patterns: dict[str, str]) -> DataFrame:
    """One row per delivered file: domain, path, length. File contents are not read."""
    listed = [
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .load(root)
        .select(F.lit(domain).alias("domain"), "path", "length")
        for domain, pattern in patterns.items()
    ]
    manifest = listed[0]
    for more in listed[1:]:
        manifest = manifest.unionAll(more)
    return manifest


def manifest_issues(manifest: DataFrame, expected: dict[str, int]) -> DataFrame:
    """Delivered against expected file counts per domain; a domain with no file counts zero."""
    wanted = mapping(manifest.sparkSession, list(expected.items()), "domain string, expected long")
    found = manifest.groupBy("domain").agg(F.count("*").alias("actual"))
    return wanted.join(found, "domain", "left").select(
        "domain",
        "expected",
        F.coalesce("actual", F.lit(0)).alias("actual"),
        (F.coalesce("actual", F.lit(0)) == F.col("expected")).alias("ok"),
    )


def _reader(spark: SparkSession, multi_line: bool) -> DataFrameReader:
    return (
        spark.read.option("header", True)
        .option("mode", "PERMISSIVE")
        .option("escape", '"')
        .option("multiLine", multi_line)
    )


def _plain_path(path: str) -> str:
    """One spelling of a local or remote path, whether a listing or a row names it."""
    return unquote(path).replace(":///", ":/")


def _column_names(line: str) -> tuple[str, ...]:
    """The names in a header line; nameless ones are numbered, repeated ones (in any case) get their place added."""
    names = next(csv.reader([line.removeprefix("\ufeff")]))
    folded = [name.lower() for name in names]
    return tuple(
        f"_c{i}" if not name else f"{name}{i}" if folded.count(name.lower()) > 1 else name for i, name in enumerate(names)
    )


def _headers(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Paths grouped by their header, the first line that is not blank; two jobs for all files. Empty files have none.

    The least place of a line is a number, which needs no sort of all lines as the line itself would; the same scan then
    gives the lines at these places.
    """
    lines = spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )
    places = lines.where((F.col("block") == 0) & (F.trim("value") != "")).groupBy("path").agg(F.min("place").alias("place"))
    first = lines.where(F.col("place").isin([row["place"] for row in places.toLocalIterator()])).select("path", F.col("value").alias("line"))
    listed = {_plain_path(path): path for path in paths}
    grouped: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for row in first.toLocalIterator():
        grouped[_column_names(row["line"])].append(listed[_plain_path(row["path"])])
    return grouped


def field_count(line: Column) -> Column:
    """Number of fields in a CSV line; commas inside quoted fields do not part."""
    bare = F.regexp_replace(line, r'(^|,)"(?:[^"]|"")*"', "$1")
    return F.char_length(bare) - F.char_length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def _read_strings(spark: SparkSession, columns: tuple[str, ...], paths: list[str], multi_line: bool) -> DataFrame:
    """Rows as strings with their place; `_delivered_fields` and the line itself where a row has more fields than the header."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in (*columns, _LINE)])
    reader = _reader(spark, multi_line).option("columnNameOfCorruptRecord", _LINE)
    # The reader keeps the line of every row whose number of fields is not the header's, too few or too many.
    rows = reader.schema(schema).csv(paths).withColumn("_delivered_fields", field_count(F.col(_LINE)))
    surplus = F.col("_delivered_fields") > len(columns)
    return rows.select(
        *(F.nullif(F.col(f"`{name}`"), F.lit("")).alias(name) for name in columns),
        F.when(surplus, F.col(_LINE)).alias(_LINE),
        F.when(surplus, F.col("_delivered_fields")).alias("_delivered_fields"),
        F.lit(len(columns)).alias("_header_fields"),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_name").alias("_source_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_position"),
    )


def _number_rows(rows: DataFrame) -> DataFrame:
    """Ordinal of each stored row in its file, from its place in the file split and the rows of the splits before.

    Only one row per split is ever windowed, so a single huge file does not end up in one task. Rows and splits are
    read from the same stored table: every row has its split, however the files were cut.
    """
    counted = rows.groupBy(*_SPLIT).agg(F.min("_position").alias("_first"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select(
        *_SPLIT, "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    )
    number = F.col("_position") - F.col("_first") + F.col("_before") + 1
    return rows.join(offsets, list(_SPLIT)).withColumn("_row_number", number)


def read_drop_parts(
    spark: SparkSession,
    root: str,
    pattern: str,
    domain: str,
    period_pattern: str = PERIOD_PATTERN,
    required: tuple[str, ...] = (),
    recursive: bool = False,
    multi_line: bool = False,
) -> Drop:
    """All files of a domain as strings, united by column name, with five lineage columns.

    The period is matched in a file's whole path. Columns a file lacks are NULL, and so are `required`
    columns that no file brings; rows that end early are filled with NULL. Rows with more fields than the header of
    their file are set aside as delivered: `_line`, `_delivered_fields`, `_header_fields` and lineage, with the row numbers they
    have among all rows. `multi_line` allows line breaks inside quotes (not in the header), at the price that a file is
    then read by one task. The rows are stored once in the shared folder, counted meanwhile, and numbered from there.
    """
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    listing = listing.option("recursiveFileLookup", recursive).load(root)
    paths = sorted(row.path for row in listing.select("path").toLocalIterator())
    if not paths:
        raise FileNotFoundError(f"no file matches {pattern} under {root}")

    staged = scratch_folder(spark)

    united: DataFrame | None = None
    surplus = 0
    for n, (columns, same_header) in enumerate(sorted(_headers(spark, paths).items()) or [((), [])]):
        if columns:
            read = _read_strings(spark, columns, sorted(same_header), multi_line)
            seen = Observation()
            read.observe(seen, F.count("_delivered_fields").alias("surplus")).write.parquet(f"{staged}/{n}")
            surplus += seen.get["surplus"]
            rows = spark.read.schema(read.schema).parquet(f"{staged}/{n}")
        else:  # no file has a header
            rows = spark.createDataFrame(
                [], f"{_LINE} string, _delivered_fields int, _header_fields int, _path string, _source_file string, _block long, _position long"
            )
        part = _number_rows(rows).drop("_block", "_position", "_first", "_before")
        united = part if united is None else united.unionByName(part, allowMissingColumns=True)

    for name in required:
        if name not in united.columns:
            united = united.withColumn(name, F.lit(None).cast("string"))
    data = [name for name in united.columns if name not in (*LINEAGE, "_path", _LINE, "_delivered_fields", "_header_fields")]
    lineage = [
        F.col("_source_file"),
        F.lit(domain).alias("_source_table"),
        F.regexp_extract("_path", period_pattern, 1).alias("_source_month"),
        F.col("_row_number"),
        F.current_timestamp().alias("_ingested_at_utc"),
    ]
    return Drop(
        united.where(F.col("_delivered_fields").isNull()).select(*(F.col(f"`{name}`") for name in data), *lineage),
        united.where(F.col("_delivered_fields").isNotNull()).select(F.col(_LINE).alias("_line"), "_delivered_fields", "_header_fields", *lineage),
        surplus,
    )


def read_drop(
    spark: SparkSession,
    root: str,
    pattern: str,
    domain: str,
    period_pattern: str = PERIOD_PATTERN,
    required: tuple[str, ...] = (),
    recursive: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """The rows of `read_drop_parts`, for files in which no row has more fields than the header; others raise MalformedDrop."""
    drop = read_drop_parts(spark, root, pattern, domain, period_pattern, required, recursive, multi_line)
    if drop.surplus:
        raise MalformedDrop(f"{domain}: {drop.surplus:,} rows have more fields than the header of their file")
    return drop.rows
