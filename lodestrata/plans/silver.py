"""Typed, normalised and deduplicated tables, one function per domain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions import (
    blank_to_null,
    bounded_int,
    full_match,
    map_variants,
    month_from_period,
    out_of_order,
    out_of_range_or_null,
    outside_interval,
    parse_date,
    parse_keyed_value,
    parse_timestamp,
    try_int,
)
from lodestrata.operators.dedupe import best_supported, latest_version, with_version_count
from lodestrata.operators.skew import ranked
from lodestrata.operators.temporal import collapse_stays
from lodestrata.plans import config
from lodestrata.sources.drops import LINEAGE

_SUPPORT = ("supporting_snapshot_count", "candidate_rank", "candidate_count")


def _key(name: str) -> Column:
    return F.trim(F.col(name)).alias(name)


def _text(name: str) -> Column:
    return blank_to_null(F.col(name)).alias(name)


def _date(name: str) -> Column:
    return parse_date(F.col(name)).alias(name)


def _level(name: str) -> Column:
    return map_variants(F.col(name), config.CARE_LEVEL_SPELLINGS).alias(name)


def _money(name: str, kind: str = "decimal(12,2)") -> Column:
    return F.col(name).try_cast(kind).alias(name)


def resident_candidates(bronze: DataFrame) -> DataFrame:
    """Every typed resident snapshot with its support and its rank in the resident's month."""
    acuity, invalid = bounded_int(F.col("acuity_score"), *config.ACUITY_RANGE)
    typed = bronze.select(
        _key("resident_id"),
        _key("community_id"),
        _text("first_name"),
        _text("last_name"),
        _date("dob"),
        _text("gender"),
        _date("admit_date"),
        _date("discharge_date"),
        _level("care_level"),
        acuity.alias("acuity_score"),
        F.col("acuity_score").alias("acuity_score_raw"),
        invalid.alias("invalid_acuity_flag"),
        _text("mobility_status"),
        month_from_period(F.col("_source_month")).alias("snapshot_month"),
        *LINEAGE,
    )
    person = {name: F.col(name) for name in ("resident_id", "community_id", "dob", "gender", "admit_date")}
    person |= {name: F.lower(name) for name in ("first_name", "last_name")}
    return best_supported(typed, ["resident_id", "snapshot_month"], person, ["_row_number", "_source_file"], _SUPPORT)


def residents(candidates: DataFrame) -> DataFrame:
    return candidates.where(F.col("candidate_rank") == 1).drop(*_SUPPORT)


def care_history(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        _key("resident_id"), _date("change_date"), _level("previous_level"), _level("new_level"), _text("reason"), *LINEAGE
    )


def units(bronze: DataFrame) -> DataFrame:
    valid = full_match(F.trim("community_id"), config.COMMUNITY_PATTERN)
    return bronze.select(
        _key("unit_id"),
        _key("community_id"),
        _level("unit_type"),
        _money("monthly_rent"),
        _date("snapshot_date"),
        (~valid).alias("invalid_community_flag"),
        *LINEAGE,
    )


def typed_leases(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        *map(_key, ("lease_id", "resident_id", "unit_id", "community_id")),
        *map(_date, ("move_in_date", "move_out_date")),
        _text("move_out_reason"),
        _money("monthly_rate"),
        *LINEAGE,
    )


def _lease_order() -> list[Column]:
    return [
        F.col("move_out_date").isNotNull().desc(),
        F.col("_source_month").desc_nulls_last(),
        F.col("_row_number").desc_nulls_last(),
        F.col("_source_file").desc_nulls_last(),
    ]


def leases(bronze: DataFrame) -> DataFrame:
    """The current version of each lease: a recorded move-out wins, then the later month, then the later row."""
    return latest_version(typed_leases(bronze), ["lease_id"], _lease_order())


def lease_candidates(bronze: DataFrame) -> DataFrame:
    """Every lease version with its rank and the number of versions."""
    return ranked(
        typed_leases(bronze),
        ["lease_id"],
        _lease_order(),
        rank="lease_rank",
        count="lease_version_count",
    )


def shifts(bronze: DataFrame) -> DataFrame:
    rate = parse_keyed_value(F.col("hourly_rate"), F.col("role"))
    parsed = bronze.select(
        *map(_key, ("shift_id", "community_id", "employee_id", "role")),
        _date("shift_date"),
        _money("hours_worked", "decimal(10,2)"),
        F.col("hourly_rate").alias("hourly_rate_raw"),
        rate.alias("hourly_rate"),
        *LINEAGE,
    )
    return parsed.withColumns(
        {
            "hourly_rate_repaired_flag": F.lit(True),
            "hourly_rate_invalid_flag": out_of_range_or_null(F.col("hourly_rate"), *config.HOURLY_RATE_RANGE),
        }
    )


def reviews(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        _key("review_id"),
        _key("community_id"),
        _date("review_date"),
        try_int(F.col("rating")).alias("rating"),
        _text("review_text"),
        _text("response_text"),
        parse_timestamp(F.col("responded_at")).alias("responded_at"),
        *LINEAGE,
    )


def lead_candidates(bronze: DataFrame) -> DataFrame:
    """Every typed lead with the number of records that share its id, and flags for events out of order."""
    typed = bronze.select(
        _key("lead_id"),
        _key("community_id"),
        _text("lead_source"),
        *map(_date, ("created_date", "tour_date", "deposit_date", "move_in_date")),
        _text("status"),
        _text("lost_reason"),
        *LINEAGE,
    )
    tour, deposit, move_in = F.col("tour_date"), F.col("deposit_date"), F.col("move_in_date")
    return with_version_count(typed, ["lead_id"], "lead_version_count").withColumns(
        {
            "deposit_before_tour_flag": out_of_order(tour, deposit),
            "move_in_before_deposit_flag": out_of_order(deposit, move_in),
        }
    )


def leads(candidates: DataFrame) -> DataFrame:
    return candidates.where(F.col("lead_version_count") == 1).drop("lead_version_count")


def resident_stays(residents: DataFrame) -> DataFrame:
    """One stay per resident: first admission, last discharge, and the community last seen."""
    return collapse_stays(
        residents,
        "resident_id",
        "admit_date",
        "discharge_date",
        latest={"community_id": "community_id"},
        at="snapshot_month",
        tie=["_row_number"],
    )


def incidents(bronze: DataFrame, stays: DataFrame) -> DataFrame:
    """Incidents beside the resident's stay, flagged when they fall outside it or there is none.

    `stays` is a stored table: Spark knows its size and broadcasts it while small, and beyond that both
    sides of the join are plain shuffles, which adaptive execution splits where one resident is hot.
    """
    typed = bronze.select(
        *map(_key, ("incident_id", "resident_id", "community_id")),
        _date("incident_date"),
        _text("incident_type"),
        try_int(F.col("severity")).alias("severity"),
        _text("reported_by"),
        *LINEAGE,
    )
    placed = typed.join(stays.select("resident_id", "admit_date", "discharge_date"), "resident_id", "left")
    flag = outside_interval(F.col("incident_date"), F.col("admit_date"), F.col("discharge_date"))
    data = [name for name in typed.columns if name not in LINEAGE]
    return placed.select(*data, "admit_date", "discharge_date", *LINEAGE, flag.alias("outside_residency_flag"))
