"""Data-quality checks evaluated to a report, and gates that stop a run."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.sources.tables import mapping


@dataclass(frozen=True)
class Unique:
    table: str
    columns: tuple[str, ...]
    name: str | None = None


@dataclass(frozen=True)
class ForeignKey:
    table: str
    column: str
    dim: str
    dim_column: str
    name: str | None = None


@dataclass(frozen=True)
class NotNull:
    table: str
    column: str


@dataclass(frozen=True)
class Check:
    """Rows that do not satisfy the predicate; a NULL outcome is an issue unless `null_passes`."""

    table: str
    name: str
    predicate: Column
    null_passes: bool = False


@dataclass(frozen=True)
class RowCount:
    table: str
    expected: int


class QualityError(RuntimeError):
    """A gate found issues."""


def _name(check) -> str:
    if isinstance(check, Unique):
        return check.name or f"unique {', '.join(check.columns)}"
    if isinstance(check, ForeignKey):
        return check.name or f"{check.column} in {check.dim}"
    if isinstance(check, NotNull):
        return f"not null {check.column}"
    return check.name if isinstance(check, Check) else f"row count {check.expected}"


def _issue(check) -> Column:
    """Whether a row counts for a check of single rows; every row counts for a row count."""
    if isinstance(check, NotNull):
        return F.col(check.column).isNull()
    if isinstance(check, Check):
        return ~F.coalesce(check.predicate, F.lit(check.null_passes))
    return F.lit(True)


def row_metrics(checks: Iterable, table: str) -> dict[str, Column]:
    """The checks of a table's single rows as named counts of issue rows, to be observed while it is written."""
    return {_name(c): F.count_if(_issue(c)) for c in checks if isinstance(c, (NotNull, Check)) and c.table == table}


def _key(parts: Iterable[Column]) -> Column:
    return F.array(*(part.cast("string") for part in parts))


def _entries(name: str, tables: Mapping[str, DataFrame], checks: list) -> DataFrame | None:
    """What a table's rows say, in one pass: (check, key, of_dim) for each key check that the table takes part in, and the
    outcomes of all its checks of single rows as one text."""
    table = tables[name]
    entry = lambda i, key, of_dim=False: F.struct(F.lit(i).alias("check"), key.alias("key"), F.lit(of_dim).alias("of_dim"))
    said = []
    for i, c in enumerate(checks):
        if isinstance(c, Unique) and c.table == name:
            said.append(entry(i, _key(map(F.col, c.columns))))
        if isinstance(c, ForeignKey) and c.table == name:
            kind = tables[c.dim].schema[c.dim_column].dataType
            own = F.col(c.column)
            said.append(entry(i, _key([own if table.schema[c.column].dataType == kind else own.cast(kind)])))
        if isinstance(c, ForeignKey) and c.dim == name:
            said.append(entry(i, _key([F.col(c.dim_column)]), True))
    per_row = [c for c in checks if isinstance(c, (NotNull, Check, RowCount)) and c.table == name]
    if per_row:
        flags = F.concat(*(F.when(_issue(c), F.lit("1")).otherwise(F.lit("0")) for c in per_row))
        said.append(entry(len(checks) + list(tables).index(name), F.array(flags)))
    return table.select(F.inline(F.array(*said))) if said else None


def run_checks(tables: Mapping[str, DataFrame], checks: Iterable) -> DataFrame:
    """Report with one row per check: table, check, issues.

    Each table is read once, whatever the number of its keys, references and row checks: its rows are expanded to (check,
    key) and counted per key before one shuffle. Keys are compared as text, NULL members included; a NULL reference is an
    issue. An entry that many rows share crosses the shuffle once per task.
    """
    checks = list(checks)
    said = [entries for name in tables if (entries := _entries(name, tables, checks)) is not None]
    spark = next(iter(tables.values())).sparkSession
    everything = said[0]
    for more in said[1:]:
        everything = everything.unionAll(more)
    rows = F.count_if(~F.col("of_dim"))
    per_key = everything.groupBy("check", "key").agg(rows.alias("rows"), F.max("of_dim").alias("known"))

    single = F.col("check") >= len(checks)
    known = F.col("known") & F.get("key", F.lit(0)).isNotNull()
    counted = per_key.groupBy("check", F.when(single, F.get("key", F.lit(0))).alias("flags")).agg(
        F.sum("rows").alias("rows"),
        F.sum(F.greatest(F.col("rows") - 1, F.lit(0))).alias("surplus"),
        F.sum(F.when(~known, F.col("rows")).otherwise(F.lit(0))).alias("orphans"),
    )
    # From here on there are a few rows per check.
    outcome = lambda i, n: F.struct(F.lit(i).alias("id"), n.alias("issues"))
    by_check = F.array().cast("array<struct<id:int,issues:bigint>>")
    for t, name in enumerate(tables):
        own = [i for i, c in enumerate(checks) if isinstance(c, (NotNull, Check, RowCount)) and c.table == name]
        flagged = [outcome(i, F.when(F.substring("flags", k + 1, 1) == "1", F.col("rows")).otherwise(F.lit(0))) for k, i in enumerate(own)]
        if own:
            by_check = F.when(F.col("check") == len(checks) + t, F.array(*flagged)).otherwise(by_check)
    for i, c in enumerate(checks):
        if isinstance(c, (Unique, ForeignKey)):
            issues = F.col("surplus" if isinstance(c, Unique) else "orphans")
            by_check = F.when(F.col("check") == i, F.array(outcome(i, issues))).otherwise(by_check)
    found = counted.select(F.inline(by_check)).groupBy("id").agg(F.sum("issues").alias("_issues"))

    lines = [(i, c.table, _name(c), c.expected if isinstance(c, RowCount) else -1) for i, c in enumerate(checks)]
    listed = mapping(spark, lines, "_id int, table string, check string, _expected long")
    issues = F.coalesce("_issues", F.lit(0).cast("long"))
    issues = F.when(F.col("_expected") < 0, issues).otherwise(F.abs(issues - F.col("_expected")))
    return listed.join(found, F.col("_id") == F.col("id"), "left").select("table", "check", issues.alias("issues"))


def raise_on_issues(report: DataFrame) -> None:
    """Stops with the failing checks by name and issue count. The report has one row per check."""
    failing = report.where(F.col("issues") != 0).orderBy("table", "check").collect()
    if failing:
        found = "; ".join(f"{r['table']}: {r['check']}: {r['issues']:,} issue rows" for r in failing)
        raise QualityError(f"quality gate failed: {found}")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table, computed in one job."""
    counts: DataFrame | None = None
    for name, df in tables.items():
        line = df.agg(F.count("*").alias("actual")).select(F.lit(name).alias("name"), "actual")
        counts = line if counts is None else counts.unionAll(line)
    return counts


def reconcile(actual: DataFrame, expected: Mapping[str, int]) -> DataFrame:
    """Expected against actual counts: name, expected, actual, ok. A name without a count is not ok."""
    wanted = mapping(actual.sparkSession, list(expected.items()), "name string, expected long")
    return wanted.join(actual, "name", "left").select(
        "name", "expected", "actual", F.coalesce(F.col("actual") == F.col("expected"), F.lit(False)).alias("ok")
    )


def raise_on_mismatch(report: DataFrame) -> None:
    wrong = report.where(~F.col("ok")).orderBy("name").collect()
    raise_on_counts({r["name"]: r["actual"] for r in wrong}, {r["name"]: r["expected"] for r in wrong})


def raise_on_counts(actual: Mapping[str, int | None], expected: Mapping[str, int]) -> None:
    """Stops where a count that was taken already is not the expected one; no job is run."""
    wrong = {name: n for name, n in sorted(expected.items()) if actual.get(name) != n}
    if wrong:
        found = "; ".join(f"{name}: expected {n:,}, found {actual.get(name)}" for name, n in wrong.items())
        raise QualityError(f"counts do not reconcile: {found}")


def snapshot_hash(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Row count and an order-free content hash, leaving out volatile columns. NULLs count with their place."""
    columns = sorted(set(df.columns) - set(exclude))
    members = [part for c in columns for part in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    digest = F.sum(F.xxhash64(*members).cast("decimal(38,0)")).cast("string")
    return df.agg(F.count("*").alias("rows"), F.coalesce(digest, F.lit("0")).alias("hash"))
