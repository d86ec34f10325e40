from lodestrata.functions.cleanse import (
    blank_to_null,
    bounded_int,
    full_match,
    join_text,
    map_variants,
    month_from_period,
    out_of_order,
    out_of_range_or_null,
    outside_interval,
    parse_date,
    parse_keyed_value,
    parse_timestamp,
    safe_ratio,
    try_int,
)

__all__ = [
    "blank_to_null",
    "bounded_int",
    "full_match",
    "join_text",
    "map_variants",
    "month_from_period",
    "out_of_order",
    "out_of_range_or_null",
    "outside_interval",
    "parse_date",
    "parse_keyed_value",
    "parse_timestamp",
    "safe_ratio",
    "try_int",
]
