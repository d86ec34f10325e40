"""Star models: relations, filters that travel from dimensions to facts, dense spines, orphan keys."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Relation:
    """Many fact rows to one dimension row; filters travel from the dimension to the fact only."""

    fact: str
    fact_key: str
    dim: str
    dim_key: str


@dataclass(frozen=True)
class Bridged:
    """A fact made of raw rows, whose dimension keys stand in another table.

    `bridge` has `key`, once per row, and the dimension keys; `shape` turns raw rows into fact rows and keeps `key`. Filters of
    dimensions narrow the bridge, and its keys narrow the raw rows before `shape` aggregates them.
    """

    raw: DataFrame
    key: str
    bridge: DataFrame
    shape: Callable[[DataFrame], DataFrame]

    def table(self, keys: Mapping[str, DataFrame]) -> DataFrame:
        """Fact rows with their dimension keys, only of the given ones (one-column relations by the name of the key)."""
        bridge, raw = self.bridge, self.raw
        for name, chosen in keys.items():
            bridge = bridge.join(chosen, name, "left_semi")
        if keys:
            raw = raw.join(bridge.select(self.key), self.key, "left_semi")
        return self.shape(raw).join(bridge, self.key)


@dataclass(frozen=True)
class StarModel:
    """Tables, their relations, and the dimension filters of the current context.

    Filters are kept as predicates and applied where a table is read, so a measure can step out of one. A fact's filters
    stand as semi-joins right above its scan, where a fact that is partitioned by the key is pruned.
    """

    tables: Mapping[str, DataFrame | Bridged]
    relations: tuple[Relation, ...]
    filters: Mapping[str, Column] = field(default_factory=dict)

    def __getitem__(self, name: str) -> DataFrame:
        return self.table(name)

    def table(self, name: str, ignore: Sequence[str] = ()) -> DataFrame:
        """A table in context: a dimension under its filter, a fact semi-joined to its filtered dimensions."""
        table = self.tables[name]
        chosen = {
            r.fact_key: self.table(r.dim).select(F.col(r.dim_key).alias(r.fact_key))
            for r in self.relations
            if r.fact == name and r.dim in self.filters and r.dim not in ignore
        }
        if isinstance(table, Bridged):
            over = {key: chosen.pop(key) for key in list(chosen) if key in table.bridge.columns}
            table = table.table(over)
        if name in self.filters and name not in ignore:
            table = table.where(self.filters[name])
        for key, keys in chosen.items():
            table = table.join(keys, key, "left_semi")
        return table

    def filtered(self, predicates: Mapping[str, Column]) -> StarModel:
        """Model under further dimension filters."""
        filters = dict(self.filters)
        for dim, predicate in predicates.items():
            filters[dim] = filters[dim] & predicate if dim in filters else predicate
        return replace(self, filters=filters)

    def relation(self, fact: str, dim: str) -> Relation | None:
        return next((r for r in self.relations if r.fact == fact and r.dim == dim), None)

    def with_attributes(
        self, fact: str, columns: Sequence[str], ignore: Sequence[str] = (), unknown: bool = False
    ) -> DataFrame:
        """Fact rows in context with the named 'dimension.column' attributes.

        Rows without a dimension row drop out, or with `unknown` belong to the dimension's unknown member, whose
        attributes are all NULL. Under a filter of the dimension there are none.
        """
        table = self.table(fact, ignore)
        wanted: dict[str, list[str]] = {}
        for path in columns:
            dim, column = path.split(".")
            wanted.setdefault(dim, []).append(column)
        for dim, names in wanted.items():
            r = self.relation(fact, dim)
            if r is None:
                raise ValueError(f"{fact} has no relation to {dim}")
            attributes = self.tables[dim].select(
                F.col(r.dim_key).alias("_dim_key"), *(F.col(name).alias(f"{dim}.{name}") for name in names)
            )
            how = "left" if unknown else "inner"
            table = table.join(attributes, F.col(r.fact_key) == F.col("_dim_key"), how).drop("_dim_key")
        return table


def dense_spine(
    members: DataFrame,
    periods: DataFrame,
    facts: Sequence[tuple[DataFrame, Sequence[str]]],
    fill: Mapping[str, object],
) -> DataFrame:
    """Every member in every period, with aggregates joined on and missing counts filled in.

    `periods` is a small relation (one row per period); it is attached to the members as one array.
    """
    fields = periods.columns
    all_periods = periods.agg(F.sort_array(F.collect_set(F.struct(*fields)))).scalar()
    spine = members.withColumn("_period", F.explode(all_periods)).select(
        *members.columns, *(F.col(f"_period.{name}").alias(name) for name in fields)
    )
    for aggregate, keys in facts:
        spine = spine.join(aggregate, list(keys), "left")
    return spine.fillna(dict(fill))


def orphans(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Fact rows whose key has no dimension row; a NULL key counts as one."""
    keys = dim.select(F.col(dim_key).alias(fact_key))
    return fact.join(keys, fact_key, "left_anti")


def orphan_count(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Number of orphan rows. Counted per key first, so a frequent key crosses the shuffle as one row."""
    per_key = fact.groupBy(fact_key).agg(F.count("*").alias("_n"))
    return orphans(per_key, fact_key, dim, dim_key).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("issues"))


def one_row(*parts: DataFrame) -> DataFrame:
    """Several one-row results side by side, in one row."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    return merged.agg(*(F.max(name).alias(name) for name in merged.columns))
