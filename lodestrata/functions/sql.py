"""The cleansing functions under SQL names, for people who query the layers in SQL."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from lodestrata.functions.cleanse import MONTH_FIRST, YEAR_FIRST
from lodestrata.plans.config import CARE_LEVEL_SPELLINGS


def _text(value: str) -> str:
    """An SQL literal of any text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _variants(spellings: Mapping[str, str]) -> str:
    return ", ".join(_text(part) for pair in spellings.items() for part in pair)


def _definitions() -> dict[str, tuple[str, str, str]]:
    """name -> (parameters, result type, expression)."""
    year_first = f"""try_cast(regexp_replace(nullif(trim(value), ''), r'{YEAR_FIRST}', '000$1-$3-$4') AS DATE)"""
    month_first = f"""try_cast(regexp_replace(nullif(trim(value), ''), r'{MONTH_FIRST}', '000$3-$1-$2') AS DATE)"""
    document = """regexp_replace(replace(document, "'", '"'), r',\\s*}\\s*$', '}')"""
    elements = f"from_json(concat('[', {document}, ']'), 'array<map<string,string>>')"
    only = f"transform(array({elements}), found -> CASE WHEN size(found) = 1 THEN found[0] END)[0]"
    stored = f"try_element_at({only}, trim(key))"
    return {
        "parse_date": ("value STRING", "DATE", f"coalesce({year_first}, {month_first})"),
        "normalize_care_level": (
            "value STRING",
            "STRING",
            f"try_element_at(map({_variants(CARE_LEVEL_SPELLINGS)}), lower(trim(value)))",
        ),
        "keyed_rate": ("document STRING, key STRING", "DECIMAL(10,2)", f"try_cast({stored} AS DECIMAL(10,2))"),
    }


def register_functions(spark: SparkSession, database: str | None = None) -> list[str]:
    """Creates parse_date, normalize_care_level and keyed_rate, for the session or in a database."""
    names = []
    for name, (parameters, result, expression) in _definitions().items():
        if database is None:
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {expression}")
            names.append(name)
        else:
            spark.sql(f"CREATE OR REPLACE FUNCTION {database}.{name}({parameters}) RETURNS {result} RETURN {expression}")
            names.append(f"{database}.{name}")
    return names
