"""Business measures over a star model: ratios of sums, evaluated at any grain and filter context.

A measure is a description. `evaluate` takes several of them and reads every fact once, whatever the
number of measures that draw on it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from lodestrata.functions import safe_ratio
from lodestrata.operators.skew import join_null_safe
from lodestrata.operators.star import StarModel, one_row
from lodestrata.operators.temporal import trailing, trailing_distinct


@dataclass(frozen=True)
class Amount:
    """An amount of a fact: the sum of an SQL expression, or its distinct values with a known date.

    `days` limits it to the trailing window that ends on the calendar's last day.
    """

    fact: str
    date: str
    value: str = "1"
    distinct: bool = False
    days: int | None = None

    def over(self, days: int) -> Amount:
        return Amount(self.fact, self.date, self.value, self.distinct, days)

    def aggregate(self, flag: str | None = None) -> Column:
        value = F.expr(self.value)
        if self.distinct:
            value = F.when(F.col(self.date).isNotNull(), value)
        if flag is not None:
            value = F.when(F.col(flag), value)
        return F.count_distinct(value) if self.distinct else F.sum(value)


@dataclass(frozen=True)
class Total:
    """The amount itself, `empty` where there is none (None leaves it blank)."""

    amount: Amount
    empty: int | None = 0

    @property
    def amounts(self) -> tuple[Amount, ...]:
        return (self.amount,)

    def value(self, parts: Mapping[Amount, Column], dates: Mapping[int, Column]) -> Column:
        return _filled(parts[self.amount], self.empty, self.amount)


def _filled(value: Column, empty: int | None, amount: Amount) -> Column:
    """A missing amount as `empty`. Where it is to stay blank, a distinct count of nothing is missing too."""
    if empty is not None:
        return F.coalesce(value, F.lit(empty))
    return F.nullif(value, F.lit(0)) if amount.distinct else value


@dataclass(frozen=True)
class Rate:
    """Numerator over denominator; a missing numerator counts as `empty` (None: the rate is blank), a missing denominator
    leaves it blank.

    With `daily` the denominator is the average per date that exists in its window.
    """

    numerator: Amount
    denominator: Amount
    scale: float = 1.0
    daily: bool = False
    empty: int | None = 0

    @property
    def amounts(self) -> tuple[Amount, ...]:
        return (self.numerator, self.denominator)

    def value(self, parts: Mapping[Amount, Column], dates: Mapping[int, Column]) -> Column:
        below = parts[self.denominator]
        if self.daily:
            below = safe_ratio(below, dates[self.denominator.days])
        return safe_ratio(_filled(parts[self.numerator], self.empty, self.numerator), below, self.scale)


@dataclass(frozen=True)
class Latest:
    """Ratio of sums at the latest period each group has."""

    fact: str
    numerator: str
    denominator: str
    period: str
    scale: float = 1.0


Measure = Total | Rate | Latest


def _names(by: Sequence[str]) -> list[str]:
    return [path.split(".")[1] for path in by]


def _grouped(table: DataFrame, by: Sequence[str], total: bool, *more: Column) -> tuple[GroupedData, list[Column]]:
    """Rows grouped by the attributes and `more`, with `total` once more by `more` alone in the same pass; and the group's
    columns under their names. `_total` tells the total from a group without a name."""
    marks = {f"_g{i}": F.col(f"`{path}`") for i, path in enumerate(by)}
    keys = [F.col(mark) for mark in marks]
    named = [F.col(mark).alias(path.split(".")[1]) for mark, path in zip(marks, by)]
    if not total:
        return table.withColumns(marks).groupBy(*keys, *more), named
    return table.withColumns(marks).groupingSets([[*keys, *more], [*more]], *keys, *more), [*named, F.col("_total")]


def _marked(total: bool) -> list[Column]:
    return [(F.grouping("_g0") == 1).alias("_total")] if total else []


def _window(model: StarModel, calendar: str, days: int) -> DataFrame:
    """The days that exist in the window ending on the last day in context, also those outside the context."""
    end = model[calendar].agg(F.max("date")).scalar()
    return model.tables[calendar].where(F.col("date").between(F.date_sub(end, days - 1), end)).select("date")


def _amounts(
    model: StarModel, calendar: str | None, fact: str, amounts: Mapping[str, Amount], by: Sequence[str], total: bool
) -> DataFrame:
    """All amounts of one fact in one aggregate, its total included."""
    lengths = sorted({amount.days for amount in amounts.values() if amount.days is not None})
    if not lengths:
        groups, named = _grouped(model.with_attributes(fact, by, unknown=True), by, total)
        sums = [amount.aggregate().alias(name) for name, amount in amounts.items()]
        return groups.agg(*sums, *_marked(total)).select(*named, *amounts)

    # A window reaches back past a selection of dates, so dates are flagged here instead of filtered.
    table = model.with_attributes(fact, by, ignore=(calendar,), unknown=True)
    date = next(iter(amounts.values())).date
    spans = {f"_last_{days}": _window(model, calendar, days) for days in lengths}
    everything = [amount for amount in amounts.values() if amount.days is None]
    if everything and calendar in model.filters:
        spans["_selected"] = model[calendar].select("date")
    elif not everything:  # nothing needs the rest of the fact: let the scan skip it
        end = model[calendar].agg(F.max("date")).scalar()
        table = table.where(F.col(date).between(F.date_sub(end, lengths[-1] - 1), end))
    for flag, days in spans.items():
        table = table.join(days.select(F.col("date").alias(date), F.lit(True).alias(flag)), date, "left")

    def flag_of(amount: Amount) -> str | None:
        flag = "_selected" if amount.days is None else f"_last_{amount.days}"
        return flag if flag in spans else None

    groups, named = _grouped(table, by, total)
    sums = [amount.aggregate(flag_of(amount)).alias(name) for name, amount in amounts.items()]
    return groups.agg(*sums, *_marked(total)).select(*named, *amounts)


def _latest(model: StarModel, measure: Latest, by: Sequence[str], total: bool, out: str) -> DataFrame:
    table = model.with_attributes(measure.fact, by, unknown=True).withColumn("_period", F.col(measure.period))
    groups, named = _grouped(table, by, total, F.col("_period"))
    per_period = groups.agg(F.sum(measure.numerator).alias("_num"), F.sum(measure.denominator).alias("_den"), *_marked(total))
    newest = F.max(F.struct("_period", "_num", "_den")).alias("_last")
    ratio = safe_ratio(F.col("_last._num"), F.col("_last._den"), measure.scale)
    kept = [*_names(by), *(["_total"] if total else [])]
    return per_period.select(*named, "_period", "_num", "_den").groupBy(*kept).agg(newest).select(*kept, ratio.alias(out))


def evaluate(
    model: StarModel,
    measures: Mapping[str, Measure],
    by: Sequence[str] = (),
    calendar: str | None = None,
    total: str | None = None,
) -> DataFrame:
    """One column per measure, one row per group of `by` ('dimension.column' paths), or one row in all.

    Facts without a dimension member are the group whose attributes are NULL. With `total` there is one more row, labelled so
    in the first attribute: its measures are evaluated over all rows, in the same pass over each fact. Trailing windows end on
    the last calendar day in context and are not cut by a selection of dates. For windows that end with each day or period, see
    `trailing_series` and `at_period_ends`.
    """
    wanted: dict[Amount, str] = {}
    for measure in measures.values():
        if not isinstance(measure, Latest):
            for amount in measure.amounts:
                wanted.setdefault(amount, f"_a{len(wanted)}")

    if any(amount.days for amount in wanted) and any(path.startswith(f"{calendar}.") for path in by):
        raise ValueError("a trailing window is not grouped by its own calendar; use trailing_series")
    if total is not None and not by:
        raise ValueError("a total row needs groups")

    with_total = total is not None
    parts = [_latest(model, m, by, with_total, name) for name, m in measures.items() if isinstance(m, Latest)]
    for fact in dict.fromkeys(amount.fact for amount in wanted):
        of_fact = {name: amount for amount, name in wanted.items() if amount.fact == fact}
        parts.append(_amounts(model, calendar, fact, of_fact, by, with_total))

    if with_total:  # grouping sets over no rows have no total
        kinds = dict(parts[0].dtypes)
        empty = [F.lit(None).cast(kinds[name]).alias(name) for name in _names(by)]
        parts.append(parts[0].sparkSession.range(1).select(*empty, (F.col("id") == 0).alias("_total")))
    if by:
        joined = parts[0]
        for part in parts[1:]:
            joined = join_null_safe(joined, part, [*_names(by), *(["_total"] if with_total else [])], "full")
    else:
        joined = one_row(*parts)

    dates = {
        days: _window(model, calendar, days).agg(F.count("*")).scalar()
        for days in {amount.days for amount in wanted if amount.days is not None}
    }
    columns = {amount: F.col(name) for amount, name in wanted.items()}
    names: list[Column] = [F.col(name) for name in _names(by)]
    if with_total:
        names[0] = F.when(F.col("_total"), F.lit(total)).otherwise(names[0]).alias(_names(by)[0])
    return joined.select(
        *names,
        *(
            F.col(name) if isinstance(m, Latest) else m.value(columns, dates).alias(name)
            for name, m in measures.items()
        ),
    )


def with_total_row(
    model: StarModel, measures: Mapping[str, Measure], by: str, calendar: str | None = None, label: str = "Total"
) -> DataFrame:
    """Measures per group and one more row for all of them: totals are evaluated, never added up."""
    return evaluate(model, measures, (by,), calendar, total=label)


def _groups(by: Sequence[str]) -> list[Column]:
    return [F.col(f"`{path}`").alias(path.split(".")[1]) for path in by]


def _daily(model: StarModel, calendar: str, amount: Amount, by: Sequence[str], out: str) -> DataFrame:
    return (
        model.with_attributes(amount.fact, by, ignore=(calendar,), unknown=True)
        .groupBy(*_groups(by), F.col(amount.date).alias("date"))
        .agg(amount.aggregate().alias(out))
    )


def trailing_series(
    model: StarModel, rate: Rate, calendar: str, length: int, by: Sequence[str] = ()
) -> DataFrame:
    """A rate over the trailing window at the end of every calendar day in context, with the amounts it is made of."""
    group = _names(by)
    days = model.tables[calendar]
    daily = _daily(model, calendar, rate.denominator, by, "day_count")
    if not rate.numerator.distinct:
        daily = join_null_safe(daily, _daily(model, calendar, rate.numerator, by, "event_count"), [*group, "date"], "full")
        rolled = trailing(daily, days, "date", length, ("event_count", "day_count"), group)
    else:
        groups = daily.select(*group).distinct() if group else None
        rows = model.with_attributes(rate.numerator.fact, by, ignore=(calendar,), unknown=True).select(
            *_groups(by), F.expr(rate.numerator.value).alias("_key"), F.col(rate.numerator.date).alias("date")
        )
        seen = trailing_distinct(rows, days, "_key", "date", length, "event_count", group, groups)
        below = trailing(daily, days, "date", length, ("day_count",), group, groups)
        rolled = join_null_safe(below, seen, [*group, "date"], "inner")
    if calendar in model.filters:
        rolled = rolled.join(model[calendar].select("date"), "date", "left_semi")
    below = F.col("day_count")
    if rate.daily:
        below = safe_ratio(below, F.col("dates_in_window"))
    events = F.col("event_count") if rate.empty is not None else F.nullif("event_count", F.lit(0))
    return rolled.withColumn("rate", safe_ratio(events, below, rate.scale))


def at_period_ends(series: DataFrame, calendar: DataFrame, period: str = "month_start") -> DataFrame:
    """The rows of a daily series that fall on the last calendar day of each period, with the period."""
    ends = calendar.groupBy(period).agg(F.max("date").alias("date"))
    return series.join(ends, "date")
