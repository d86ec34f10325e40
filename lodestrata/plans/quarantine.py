"""The four rejection tables and their summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.operators.quarantine import rejected
from lodestrata.plans.config import REJECTION_REASONS


def quarantine_tables(
    resident_candidates: DataFrame, units: DataFrame, lead_candidates: DataFrame, incidents: DataFrame
) -> dict[str, DataFrame]:
    flagged = {
        "resident_conflicts": (resident_candidates, F.col("candidate_rank") > 1),
        "invalid_unit_communities": (units, F.col("invalid_community_flag")),
        "conflicting_leads": (lead_candidates, F.col("lead_version_count") > 1),
        "incidents_outside_residency": (incidents, F.col("outside_residency_flag")),
    }
    return {name: rejected(df, flag, REJECTION_REASONS[name]) for name, (df, flag) in flagged.items()}

