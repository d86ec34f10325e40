"""The three standing reports and the dashboard's data, over a gold model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.functions import safe_ratio
from lodestrata.operators.ranking import top_n_per_group, top_n_with_ties
from lodestrata.operators.star import StarModel
from lodestrata.plans import config
from lodestrata.plans.measures import (
    Amount,
    Latest,
    Rate,
    Total,
    at_period_ends,
    evaluate,
    trailing_series,
    with_total_row,
)
from lodestrata.sources.tables import published_view

RESIDENT_DAYS = Amount("fact_resident_day", "date", "resident_day_count")
INCIDENTS = Amount("fact_incident", "incident_date")
MOVE_OUTS = Amount("fact_lease", "move_out_date", "lease_id", distinct=True)

# Nothing to count is a blank, not a 0, in every measure of the dashboard.
CURRENT_OCCUPANCY = Latest("fact_occupancy_monthly", "occupied_resident_count", "valid_unit_count", "month_start")
MOVE_OUT_RATE = Rate(MOVE_OUTS.over(config.TRAILING_DAYS), RESIDENT_DAYS.over(config.TRAILING_DAYS), daily=True, empty=None)
INCIDENT_RATE = Rate(INCIDENTS, RESIDENT_DAYS, scale=100, empty=None)
ROLLING_INCIDENT_RATE = Rate(
    INCIDENTS.over(config.TRAILING_DAYS), RESIDENT_DAYS.over(config.TRAILING_DAYS), scale=100, empty=None
)
COMPLETED_MOVE_OUTS = Total(MOVE_OUTS, empty=None)

MEASURES = {
    "current_occupancy": CURRENT_OCCUPANCY,
    "move_out_rate": MOVE_OUT_RATE,
    "incident_rate": INCIDENT_RATE,
    "rolling_incident_rate": ROLLING_INCIDENT_RATE,
    "completed_move_outs": COMPLETED_MOVE_OUTS,
}
MATRIX = ("current_occupancy", "move_out_rate", "incident_rate")
COMMUNITY = "dim_community.community_name"


def _named(df: DataFrame, model: StarModel) -> DataFrame:
    return df.join(model["dim_community"].select("community_id", "community_name"), "community_id")


def monthly_occupancy(model: StarModel) -> DataFrame:
    """One row per community and month."""
    percent = safe_ratio(F.col("occupied_resident_count"), F.col("valid_unit_count"), 100, 2)
    return (
        _named(model["fact_occupancy_monthly"], model)
        .select(
            "community_id",
            "community_name",
            "month_start",
            "month_end",
            "occupied_resident_count",
            "valid_unit_count",
            percent.alias("occupancy_proxy_percent"),
        )
        .orderBy("month_start", "community_id")
    )


def top_move_out_reasons(model: StarModel, first=config.FIRST_DAY, last=config.LAST_DAY, n: int = 3) -> DataFrame:
    """The n most frequent reasons per community; ties are ordered by reason."""
    gone = model["fact_lease"].where(F.col("move_out_date").between(F.lit(first), F.lit(last)))
    counts = gone.groupBy("community_id", "move_out_reason").agg(F.count("*").alias("move_out_count"))
    top = top_n_per_group(
        counts,
        "community_id",
        "move_out_reason",
        "move_out_count",
        n,
        "reason_rank",
        "community_move_out_count",
        "community_move_out_percent",
    )
    return (
        _named(top, model)
        .select(
            "community_id",
            "community_name",
            "reason_rank",
            "move_out_reason",
            "move_out_count",
            "community_move_out_count",
            "community_move_out_percent",
        )
        .orderBy("community_id", "reason_rank")
    )


def incident_rate(model: StarModel) -> DataFrame:
    """Incidents per 100 resident-days by community and care level; groups without incidents stay at zero."""
    keys = ["community_id", "care_level"]
    days = model["fact_resident_day"].groupBy(*keys).agg(F.sum("resident_day_count").alias("resident_days"))
    hits = model["fact_incident"].groupBy(*keys).agg(F.count("*").alias("incident_count"))
    rated = days.join(hits, keys, "left").fillna({"incident_count": 0})
    rate = safe_ratio(F.col("incident_count"), F.col("resident_days"), 100, 4)
    return (
        _named(rated, model)
        .select(
            "community_id",
            "community_name",
            "care_level",
            "incident_count",
            "resident_days",
            rate.alias("incidents_per_100_resident_days"),
        )
        .orderBy("community_id", "care_level")
    )


def measures(model: StarModel, names: tuple[str, ...] = tuple(MEASURES), by: tuple[str, ...] = ()) -> DataFrame:
    """The named measures side by side, at the grain of `by`."""
    return evaluate(model, {name: MEASURES[name] for name in names}, by, "dim_date")


def kpi_cards(model: StarModel) -> DataFrame:
    return measures(model)


def move_out_rate_by_day(model: StarModel, by: tuple[str, ...] = ()) -> DataFrame:
    """The trailing move-out rate as it stood at the end of each day."""
    return trailing_series(model, Rate(MOVE_OUTS, RESIDENT_DAYS, daily=True, empty=None), "dim_date", config.TRAILING_DAYS, by)


def incident_rate_by_day(model: StarModel, by: tuple[str, ...] = ()) -> DataFrame:
    """The rolling incident rate as it stood at the end of each day."""
    return trailing_series(model, INCIDENT_RATE, "dim_date", config.TRAILING_DAYS, by)


def trailing_rates_by_month(model: StarModel, by: tuple[str, ...] = ()) -> DataFrame:
    """Both trailing measures as they stood at the end of each month."""
    group = [path.split(".")[1] for path in by]
    moved = move_out_rate_by_day(model, by).select(*group, "date", F.col("rate").alias("move_out_rate"))
    hurt = incident_rate_by_day(model, by).select(*group, "date", F.col("rate").alias("rolling_incident_rate"))
    return at_period_ends(moved.join(hurt, [*group, "date"]), model["dim_date"])


def occupancy_by_month(model: StarModel) -> DataFrame:
    return measures(model, ("current_occupancy",), ("dim_date.month_start",)).orderBy("month_start")


def occupancy_by_community(model: StarModel) -> DataFrame:
    return measures(model, ("current_occupancy",), (COMMUNITY,)).orderBy(F.col("current_occupancy").desc_nulls_last())


def incident_rate_by_care_level(model: StarModel) -> DataFrame:
    rates = measures(model, ("incident_rate",), ("dim_care_level.care_level",))
    return rates.join(model["dim_care_level"], "care_level").orderBy("display_order")


def leading_move_out_reasons(model: StarModel, n: int = 5) -> DataFrame:
    """Top reasons by completed move-outs; reasons level with the last one are kept."""
    done = model["fact_lease"].where(F.col("move_out_date").isNotNull())
    counted = done.groupBy("move_out_reason").agg(F.count_distinct("lease_id").alias("completed_move_outs"))
    return top_n_with_ties(counted, "completed_move_outs", n).orderBy(
        F.col("completed_move_outs").desc(), "move_out_reason"
    )


def community_matrix(model: StarModel) -> DataFrame:
    """Three measures per community and a total row, each evaluated at its own grain."""
    return with_total_row(model, {name: MEASURES[name] for name in MATRIX}, COMMUNITY, "dim_date")


def community_list(model: StarModel) -> DataFrame:
    return model["dim_community"].select("community_name").distinct().orderBy("community_name")


def published_tables(model: StarModel) -> dict[str, DataFrame]:
    """Every table without resident, lease and unit identifiers and without implementation flags."""
    return {name: published_view(model[name], columns) for name, columns in config.PUBLISHED_COLUMNS.items()}


def slicer(model: StarModel, region: str | None = None, community: str | None = None) -> StarModel:
    """Model under a region and/or community selection."""
    chosen = F.lit(True)
    if region is not None:
        chosen &= F.col("region") == region
    if community is not None:
        chosen &= F.col("community_name") == community
    return model.filtered({"dim_community": chosen})


def for_role(model: StarModel, role: str) -> StarModel:
    """Model as a role sees it: the role's dimension filter reaches every related fact."""
    dim, predicate = config.ROLES[role]
    return model.filtered({dim: F.expr(predicate)})
