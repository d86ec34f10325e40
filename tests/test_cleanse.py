import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lodestrata.functions import (
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
from lodestrata.plans.config import CARE_LEVEL_SPELLINGS, COMMUNITY_PATTERN


def values(spark, texts, expression, kind="string"):
    """The expression over a column of texts, in the order given."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_blank_to_null(spark):
    assert values(spark, [" a ", "   ", "", None, "b"], blank_to_null) == ["a", None, None, None, "b"]


DATES = {
    "2025-03-17": dt.date(2025, 3, 17),
    "2025/03/17": dt.date(2025, 3, 17),
    "2025 3 7": dt.date(2025, 3, 7),
    "2025-3-7": dt.date(2025, 3, 7),
    " 2025-03-17 ": dt.date(2025, 3, 17),
    "2025-03-17 10:00:00": dt.date(2025, 3, 17),
    "2025-03-17T10:00:00": dt.date(2025, 3, 17),
    "03/17/2025": dt.date(2025, 3, 17),
    "3/7/2025": dt.date(2025, 3, 7),
    "2025-3/7": None,
    "2025-02-30": None,
    "2025": None,
    "2025-03": None,
    "20250317": None,
    "2025-03-17x": None,
    "2025-003-17": None,
    "13/01/2025": None,
    "003/17/2025": None,
    "3/17/2025 10:00": None,
    "03-17-2025": None,
    "03/17/25": dt.date(25, 3, 17),
    "03/07/25": dt.date(3, 7, 25),
    "2025/3/7\t\t\t": dt.date(2025, 3, 7),
    "2025-03-17 10:00:00 +02": dt.date(2025, 3, 17),
    "2025-03-17 10:61:00": None,
    "\t2025-03-17": dt.date(2025, 3, 17),
    "\t3/17/2025": dt.date(2025, 3, 17),
    "2025-03-1T": None,
    "2025-03-1x": None,
    "2025-3-017": None,
    "+025-03-17": None,
    "not-a-date": None,
    "": None,
    None: None,
}


def test_parse_date(spark):
    assert dict(zip(DATES, values(spark, list(DATES), parse_date))) == DATES


def test_parse_timestamp(spark):
    moments = {
        "2025-01-18": dt.datetime(2025, 1, 18),
        "2025-01-18 10:00": dt.datetime(2025, 1, 18, 10),
        "2025-1-8 1:2:3": dt.datetime(2025, 1, 8, 1, 2, 3),
        "2025/01/18 10:00:00": dt.datetime(2025, 1, 18, 10),
        "2025-01-18T10:00:00+02": dt.datetime(2025, 1, 18, 10),
        "2025": None,
        "2025-01-18 25:00:00": None,
        "01/18/2025": None,
        " ": None,
    }
    assert dict(zip(moments, values(spark, list(moments), parse_timestamp))) == moments


def test_try_int(spark):
    numbers = {"7": 7, "7.5": 8, "6.5": 7, "-1.5": -2, "1e1": 10, " 7 ": 7, ".5": 1, "7.4999999": 7, "abc": None, "5d": None,
               "NaN": None, "99999999999": None, "": None, "1,000": None}
    assert dict(zip(numbers, values(spark, list(numbers), try_int))) == numbers


def test_care_level_spellings(spark):
    labels = dict(CARE_LEVEL_SPELLINGS)
    labels |= {"IL": "Independent Living", " Assisted Living ": "Assisted Living", "attic": None, None: None, "": None}
    assert dict(zip(labels, values(spark, list(labels), lambda c: map_variants(c, CARE_LEVEL_SPELLINGS)))) == labels


@pytest.mark.parametrize(
    ("text", "value", "flag"),
    [("5", 5, False), ("0", None, True), ("11", None, True), ("", None, False), (None, None, False), ("high", None, False), ("7.5", 8, False), ("10.5", None, True)],
)
def test_bounded_int(spark, text, value, flag):
    row = spark.createDataFrame([(text,)], "v string").select(*bounded_int(F.col("v"), 1, 10)).first()
    assert tuple(row) == (value, flag)


def test_full_match_is_three_valued(spark):
    ids = {"C001": True, "C014": True, "C015": False, "C000": False, "c001": False, "C0010": False, "C001\n": False, None: None}
    assert dict(zip(ids, values(spark, list(ids), lambda c: full_match(c, COMMUNITY_PATTERN)))) == ids


@pytest.mark.parametrize(
    ("text", "key", "value"),
    [
        ("{'cook': 18.25, 'driver': 21}", "cook", Decimal("18.25")),
        ("{'cook': 18.25, 'driver': 21}", "  driver", Decimal("21.00")),
        ("{'night cook': 19.005}", "night cook", Decimal("19.01")),
        ("{'cook': 18.25} and more", "cook", None),
        ("{'cook': 18.25}{'cook': 7}", "cook", None),
        ("{'cook': 18.25}, {'cook': 7}", "cook", None),
        ("{'cook': 18.25 , }", "cook", Decimal("18.25")),
        ("{'cook': 18.25", "cook", None),
        ("['cook', 18.25]", "cook", None),
        ("   ", "cook", None),
        ("cook = 18.25", "cook", None),
        ("{'cook': 'by the hour'}", "cook", None),
        ("{'cook': 18 + 1}", "cook", None),
        ("{'cook': max(18, 19)}", "cook", None),
        ("{'driver': 21}", "cook", None),
        ("{'driver': 21}", None, None),
        (None, "cook", None),
    ],
)
def test_parse_keyed_value(spark, text, key, value):
    """Text that would be an expression elsewhere is no value here."""
    df = spark.createDataFrame([(text, key)], "t string, k string")
    assert df.select(parse_keyed_value(F.col("t"), F.col("k"))).first()[0] == value


def test_flags_keep_null_where_they_should(spark):
    row = spark.sql(
        "select date'2025-01-01' a, date'2025-01-05' b, cast(null as date) n, cast(null as double) x, 250.0 y"
    ).select(
        out_of_order(F.col("a"), F.col("b")),
        out_of_order(F.col("b"), F.col("a")),
        out_of_order(F.col("n"), F.col("a")),
        outside_interval(F.col("b"), F.col("a"), F.col("b")),
        outside_interval(F.col("b"), F.col("a"), F.col("n")),
        outside_interval(F.col("a"), F.col("b"), F.col("n")),
        outside_interval(F.col("a"), F.col("n"), F.col("n")),
        outside_interval(F.col("n"), F.col("a"), F.col("b")),
        out_of_range_or_null(F.col("x"), 0, 200),
        out_of_range_or_null(F.col("y"), 0, 200),
    ).first()
    assert tuple(row) == (False, True, False, False, False, True, True, None, True, True)


def test_ratio_period_and_text(spark):
    row = spark.range(1).select(
        safe_ratio(F.lit(1), F.lit(3), 100, 2),
        safe_ratio(F.lit(1), F.lit(0)),
        month_from_period(F.lit("2025_03")),
        join_text(F.lit("a"), F.lit(None).cast("string"), F.lit("b")),
    ).first()
    assert tuple(row) == (33.33, None, dt.date(2025, 3, 1), "ab")


def test_malformed_period_is_an_error(spark):
    with pytest.raises(Exception, match="CANNOT_PARSE|cannot be parsed|parse"):
        spark.range(1).select(month_from_period(F.lit("2025"))).collect()
