"""Full refresh: drops to bronze, silver, quarantine and gold, with a gate after every layer, released in one step."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lodestrata.functions.sql import register_functions
from lodestrata.operators.quality import (
    Check,
    NotNull,
    QualityError,
    raise_on_counts,
    raise_on_issues,
    raise_on_mismatch,
    row_metrics,
    run_checks,
)
from lodestrata.operators.quarantine import rejected, rejection_summary, summary_query
from lodestrata.operators.star import StarModel
from lodestrata.plans import config, reports, silver
from lodestrata.plans.gold import base_tables, derived_tables, gold_gates, gold_model, schema_checks
from lodestrata.plans.quarantine import quarantine_tables
from lodestrata.sources.drops import Drop, drop_manifest, manifest_issues, read_drop_parts
from lodestrata.sources.tables import catalog_view, mapping, quoted, read_model
from lodestrata.sources.versions import current_release, expire, read_version, release, versioned, write_version

#: The day fact is stored by day: a month's end, a window or a role's dates are found by folder.
PARTITIONS = {"fact_resident_day": ("date",)}
SUMMARY = "rejection_summary"


def side_by_side(jobs: Mapping[str, Callable]) -> dict:
    """The results of independent jobs, run beside each other, so that small ones do not leave a cluster idle."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        running = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: job.result() for name, job in running.items()}


@dataclass(frozen=True)
class Written:
    """A stored table: its version, as a release names it, and what was counted while it was written."""

    entry: Mapping
    rows: int
    counts: Mapping[str, int]


@dataclass(frozen=True)
class Store:
    """Where the layers live: <root>/<layer>/<table>/<version>; a release of the root names the versions that are current.

    A run writes versions of its own and reads those. Nothing that others read changes before `commit`. With `catalog` the
    current tables are also lasting views <layer>.<table>.
    """

    spark: SparkSession
    root: str
    catalog: bool = False
    written: dict[tuple[str, str], Written] = field(default_factory=dict)

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def read(self, layer: str, name: str) -> DataFrame:
        """The table as this run wrote it, else as it was released last."""
        own = self.written.get((layer, name))
        table = own.entry if own is not None else current_release(self.spark, self.root).get(f"{layer}.{name}")
        if table is None:
            raise FileNotFoundError(f"{layer}.{name} was not released under {self.root}")
        return read_version(self.spark, table["version"], table["columns"], table["schema"])

    def write(
        self, layer: str, name: str, df: DataFrame, partition_by: Sequence[str] = (), counts: Mapping[str, Column] | None = None
    ) -> DataFrame:
        """Stores a table and returns the stored one, so later steps start from files and not from a long lineage.

        Its rows and `counts` are counted by the tasks that write it, so that gates need not read it again.
        """
        seen = Observation()
        watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), *(c.alias(n) for n, c in (counts or {}).items()))
        version = write_version(watched, self.path(layer, name), partition_by)
        found = seen.get
        self.written[layer, name] = Written(
            versioned(version, df), found.get("rows", 0), {n: found.get(n) or 0 for n in counts or {}}
        )
        return self.read(layer, name)

    def write_all(
        self,
        layer: str,
        tables: Mapping[str, Callable[[], DataFrame]],
        partitions: Mapping[str, Sequence[str]] | None = None,
        counts: Mapping[str, Mapping[str, Column]] | None = None,
    ) -> dict[str, DataFrame]:
        """Independent tables side by side."""

        def one(name: str, build: Callable[[], DataFrame]) -> DataFrame:
            return self.write(layer, name, build(), (partitions or {}).get(name, ()), (counts or {}).get(name))

        return side_by_side({name: partial(one, name, build) for name, build in tables.items()})

    def rows(self, layer: str) -> dict[str, int]:
        """Rows per table of a layer, as counted while they were written."""
        return {name: w.rows for (of, name), w in self.written.items() if of == layer}

    def commit(self) -> None:
        """Makes this run's tables the current ones, all at once; then points the catalog's views at them."""
        release(self.spark, self.root, {f"{layer}.{name}": w.entry for (layer, name), w in self.written.items()})
        if self.catalog:
            for (layer, name), w in self.written.items():
                columns = ", ".join(f"`{c}`" for c in w.entry["columns"])
                catalog_view(self.spark, f"{layer}.{name}", f"SELECT {columns} FROM parquet.`{w.entry['version']}`")
        expire(self.spark, self.root)


@dataclass(frozen=True)
class Refresh:
    """Stored tables per layer and the reports of the gates."""

    bronze: dict[str, DataFrame]
    silver: dict[str, DataFrame]
    quarantine: dict[str, DataFrame]
    gold: dict[str, DataFrame]
    rows: Mapping[str, int]

    def constraints(self) -> DataFrame:
        """The documented gold constraints as a report."""
        return run_checks(self.gold, schema_checks())

    @property
    def model(self) -> StarModel:
        return gold_model(self.gold)

    @property
    def rejections(self) -> DataFrame:
        return rejection_summary({name: self.quarantine[name] for name in config.REJECTION_REASONS})

    def summary(self) -> DataFrame:
        """Row count per layer and table, as counted while the tables were written."""
        spark = next(iter(self.gold.values())).sparkSession
        return mapping(spark, sorted(self.rows.items()), "name string, actual long")


def findings(store: Store) -> dict[str, int]:
    """The known anomalies and the move-out checkpoint, all of them counted during the writes."""
    counted = {name: n for w in store.written.values() for name, n in w.counts.items()}
    versions, kept = store.rows("bronze")["yardi_leases"], store.rows("silver")["yardi_leases"]
    return counted | {"lease versions removed": versions - kept}


def load_bronze(store: Store, source: str, expected: config.Expectations) -> dict[str, DataFrame]:
    """All domains as text. Lines with more fields than their header go to the quarantine as they were delivered."""
    if expected.files:
        manifest = drop_manifest(store.spark, source, config.manifest_patterns())
        raise_on_mismatch(manifest_issues(manifest, dict(expected.files)).withColumnRenamed("domain", "name"))
    parts: dict[str, Drop] = {}

    def load(d: config.Domain) -> DataFrame:
        parts[d.name] = read_drop_parts(store.spark, source, d.pattern, d.name, required=d.columns)
        return parts[d.name].rows

    bronze = store.write_all("bronze", {d.name: (lambda d=d: load(d)) for d in config.DOMAINS})
    malformed = reduce(DataFrame.unionByName, (parts[d.name].malformed for d in config.DOMAINS))
    store.write("quarantine", config.MALFORMED, rejected(malformed, F.lit(True), config.MALFORMED_REASON))
    raise_on_counts(store.rows("bronze"), expected.bronze)
    return bronze


def load_silver(
    store: Store, bronze: dict[str, DataFrame], expected: config.Expectations
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    # Candidates feed both the clean table and its quarantine, so they are stored once and read twice.
    candidates = store.write_all(
        "silver",
        {
            "_resident_candidates": lambda: silver.resident_candidates(bronze["pcc_residents"]),
            "_lead_candidates": lambda: silver.lead_candidates(bronze["hubspot_leads"]),
            "_lease_candidates": lambda: silver.lease_candidates(bronze["yardi_leases"]),
        },
    )
    people, prospects = candidates["_resident_candidates"], candidates["_lead_candidates"]
    clean = store.write_all(
        "silver",
        {
            "pcc_residents": lambda: silver.residents(people),
            "pcc_care_history": lambda: silver.care_history(bronze["pcc_care_history"]),
            "yardi_units": lambda: silver.units(bronze["yardi_units"]),
            "yardi_leases": lambda: silver.leases(bronze["yardi_leases"]),
            "adp_shifts": lambda: silver.shifts(bronze["adp_shifts"]),
            "gbp_reviews": lambda: silver.reviews(bronze["gbp_reviews"]),
            "hubspot_leads": lambda: silver.leads(prospects),
        },
        counts={
            "pcc_residents": {"invalid acuity": F.count_if("invalid_acuity_flag")},
            "adp_shifts": {"invalid hourly rates": F.count_if("hourly_rate_invalid_flag")},
        },
    )
    stays = store.write("silver", "_resident_stays", silver.resident_stays(clean["pcc_residents"]))
    clean["pcc_incidents"] = store.write("silver", "pcc_incidents", silver.incidents(bronze["pcc_incidents"], stays))
    rejects = quarantine_tables(people, clean["yardi_units"], prospects, clean["pcc_incidents"])
    held = store.write_all("quarantine", {name: (lambda df=df: df) for name, df in rejects.items()})
    held[config.MALFORMED] = store.read("quarantine", config.MALFORMED)
    raise_on_counts(store.rows("silver"), expected.silver)
    raise_on_counts(store.rows("quarantine"), expected.quarantine)
    return clean, held


def load_gold(store: Store, clean: dict[str, DataFrame], expected: config.Expectations) -> dict[str, DataFrame]:
    """Row checks are counted while the tables are written; keys and references take one more read of each table."""
    gates = gold_gates()
    per_row = [c for c in gates if isinstance(c, (Check, NotNull))]
    counts = {c.table: row_metrics(per_row, c.table) for c in per_row}
    counts["fact_lease"] = {"completed move-outs": F.count("move_out_date")}
    stays = store.read("silver", "_resident_stays")
    gold = store.write_all("gold", base_tables(store.spark, clean, stays), PARTITIONS, counts)
    gold |= store.write_all("gold", derived_tables(gold, clean), PARTITIONS, counts)
    raise_on_counts(store.rows("gold"), expected.gold)
    for c in per_row:
        for check, issues in store.written["gold", c.table].counts.items():
            if check == c.name and issues:
                raise QualityError(f"quality gate failed: {c.table}: {check}: {issues:,} issue rows")
    raise_on_issues(run_checks(gold, [c for c in gates if c not in per_row]))
    return gold


def export_gold(tables: Mapping[str, DataFrame], root: str) -> None:
    """One ZSTD Parquet artifact per table, with the columns of the table; readers see all of them change at once.

    The day fact keeps its folders by day: the stored files of a day are written as files of that day, without a shuffle.
    """
    spark = next(iter(tables.values())).sparkSession

    def one(name: str, df: DataFrame) -> dict:
        return versioned(write_version(df, f"{root}/{name}.parquet", PARTITIONS.get(name, ())), df)

    release(spark, root, side_by_side({name: partial(one, name, df) for name, df in tables.items()}))
    expire(spark, root)


def import_gold(spark: SparkSession, root: str) -> StarModel:
    """The exported tables as a model, with the column types its measures expect."""
    casts = {
        "fact_incident": {"severity": "bigint"},
        "fact_resident_day": {"resident_day_count": "bigint"},
        "fact_lease": {"monthly_rate": "decimal(19,4)"},
    }
    return gold_model(read_model(spark, root, config.PUBLISHED_COLUMNS, casts))


def refresh(
    spark: SparkSession,
    source: str,
    root: str,
    export: str | None = None,
    expected: config.Expectations = config.FULL_DROP,
    catalog: bool = False,
) -> Refresh:
    """Rebuilds every layer from the drops. A failing gate stops the run before anything is released or exported.

    Until the last gate has passed, readers of `root` and `export` see the tables of the run before, and they still do if this
    one fails. The releases before the last two are deleted.
    """
    store = Store(spark, root, catalog)
    bronze = load_bronze(store, source, expected)
    clean, held = load_silver(store, bronze, expected)
    gold = load_gold(store, clean, expected)
    raise_on_counts(findings(store), expected.findings)
    if catalog:
        model = gold_model(gold)
        for report in (reports.monthly_occupancy, reports.top_move_out_reasons, reports.incident_rate):
            store.write("reports", report.__name__, report(model))
    store.commit()
    if catalog:
        register_functions(spark, "silver")
        tables = {name: quoted(f"quarantine.{name}") for name in config.REJECTION_REASONS}
        catalog_view(spark, f"quarantine.{SUMMARY}", summary_query(tables))
    if export is not None:
        export_gold(gold, export)
    counted = {f"{layer}.{name}": w.rows for (layer, name), w in store.written.items()}
    return Refresh(bronze, clean, held, gold, counted)
