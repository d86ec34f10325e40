import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lodestrata.operators.temporal import (
    as_of_join,
    calendar,
    collapse_stays,
    date_spine,
    explode_interval,
    explode_segments,
    level_segments,
    trailing,
    trailing_distinct,
)

D = dt.date
LOW, HIGH = D(2025, 1, 1), D(2025, 3, 31)


def days(first, last):
    return [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]


def test_calendar(spark):
    rows = calendar(spark, "2025-01-01", "2025-06-30").collect()
    assert len(rows) == 181
    last = [r for r in rows if r.date == D(2025, 5, 31)][0]
    assert tuple(last) == (D(2025, 5, 31), 2025, 2, 5, "May", D(2025, 5, 1), D(2025, 5, 31))
    assert calendar(spark, "2025-01-02", "2025-01-01").count() == 0


def test_collapse_stays_takes_the_latest_known_value(spark):
    stays = spark.createDataFrame(
        [("a", D(2025, 1, 5), None, 1, "x"), ("a", D(2025, 1, 3), D(2025, 2, 1), 2, "y"), ("a", None, None, 3, None), ("b", D(2025, 1, 1), None, None, "z")],
        "k string, start date, end date, at int, home string",
    )
    got = collapse_stays(stays, "k", "start", "end", {"home": "home"}, "at")
    assert {tuple(r) for r in got.collect()} == {("a", D(2025, 1, 3), D(2025, 2, 1), "y"), ("b", D(2025, 1, 1), None, None)}


def test_explode_interval_edges(spark):
    stays = spark.createDataFrame(
        [
            ("open", D(2025, 3, 30), None),
            ("clipped", D(2024, 12, 1), D(2025, 1, 2)),
            ("past", D(2024, 1, 1), D(2024, 2, 1)),
            ("one", D(2025, 2, 2), D(2025, 2, 2)),
            ("future", D(2025, 4, 2), None),
            ("no start", None, D(2025, 1, 1)),
        ],
        "k string, start date, end date",
    )
    got = explode_interval(stays, "start", "end", F.lit(LOW), F.lit(HIGH))
    assert {tuple(r) for r in got.collect()} == {
        ("open", D(2025, 3, 30)),
        ("open", D(2025, 3, 31)),
        ("clipped", D(2025, 1, 1)),
        ("clipped", D(2025, 1, 2)),
        ("one", D(2025, 2, 2)),
        ("no start", D(2025, 1, 1)),
    }


@pytest.fixture(scope="module")
def history():
    rng = random.Random(3)
    changes = [(f"k{rng.randrange(8)}", D(2024, 12, 1) + dt.timedelta(days=rng.randrange(120)), i, rng.choice(["A", "B", "C", None])) for i in range(120)]
    return changes


def latest(changes, key, day):
    past = [(when, seq, value) for k, when, seq, value in changes if k == key and when <= day and value is not None]
    return max(past)[2] if past else None


@pytest.mark.parametrize("floor", [None, LOW])
def test_as_of_join(spark, history, floor):
    probes = [(f"k{i}", day) for i in range(10) for day in days(LOW, HIGH)[::4]]
    left = spark.createDataFrame(probes, "k string, day date")
    changes = spark.createDataFrame(history, "k string, changed date, seq int, value string")
    got = as_of_join(left, changes, "k", "day", "changed", "value", "level", ["seq"], F.lit("none"), None if floor is None else F.lit(floor))
    assert got.columns == ["k", "day", "level"]
    assert {(r.k, r.day): r.level for r in got.collect()} == {(k, d): latest(history, k, d) or "none" for k, d in probes}


def test_as_of_join_with_many_rows_per_day(spark, history):
    rows = [(i, f"k{i % 9}", LOW + dt.timedelta(days=i % 20)) for i in range(200)]
    left = spark.createDataFrame(rows, "id int, k string, day date")
    changes = spark.createDataFrame(history, "k string, changed date, seq int, value string")
    got = as_of_join(left, changes, "k", "day", "changed", "value", "level", ["seq"], unique=False)
    assert {r.id: r.level for r in got.collect()} == {i: latest(history, k, d) for i, k, d in rows}


@pytest.mark.parametrize("unit", ["MM", "week"])
def test_level_segments(spark, history, unit):
    rng = random.Random(5)
    stays = [(f"k{i}", f"home{i}", D(2024, 12, 15) + dt.timedelta(days=7 * i), None if i % 2 else D(2025, 2, 10) + dt.timedelta(days=i)) for i in range(10)]
    stays.append(("gone", "home", D(2024, 1, 1), D(2024, 2, 1)))

    def period(day):
        return day.replace(day=1) if unit == "MM" else day - dt.timedelta(days=day.weekday())

    shots = {(k, p): f"S{rng.randrange(3)}" for k, *_ in stays for p in {period(d) for d in days(LOW, HIGH)} if rng.random() < 0.6}
    news = {}
    for k, when, seq, value in history:
        if value is not None:
            news[(k, max(when, LOW))] = max(news.get((k, max(when, LOW)), (D.min, -1, "")), (when, seq, value))

    segments = level_segments(
        spark.createDataFrame(stays, "k string, home string, start date, end date"),
        "k",
        "start",
        "end",
        spark.createDataFrame([(k, d, v[2]) for (k, d), v in news.items()], "k string, d date, v string"),
        spark.createDataFrame([(k, p, v) for (k, p), v in shots.items()], "k string, p date, v string"),
        F.lit(LOW),
        F.lit(HIGH),
        unit,
    )
    got = [(r.k, r.home, r.date, r.level) for r in explode_segments(segments).collect()]
    want = [
        (k, home, d, latest(history, k, d) or shots.get((k, period(d))))
        for k, home, start, end in stays
        for d in days(max(start, LOW), min(end or HIGH, HIGH))
    ]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.fixture(scope="module")
def visits():
    rng = random.Random(11)
    return [(f"g{rng.randrange(3)}", f"u{rng.randrange(12)}", LOW + dt.timedelta(days=int(rng.random() ** 2 * 40))) for _ in range(150)]


CALENDAR = [d for d in days(LOW, D(2025, 2, 10)) if d.day != 20]  # with a gap


@pytest.mark.parametrize("grouped", [False, True])
def test_trailing_distinct(spark, visits, grouped):
    group = ["g"] if grouped else []
    calendar_df = spark.createDataFrame([(d,) for d in CALENDAR], "day date")
    df = spark.createDataFrame(visits, "g string, u string, day date")
    got = trailing_distinct(df, calendar_df, "u", "day", 9, "n", group)
    seen = {tuple(r[c] for c in [*group, "day"]): r.n for r in got.collect()}
    want = {}
    for g in {v[0] for v in visits} if grouped else [None]:
        for end in CALENDAR:
            inside = {u for gg, u, d in visits if (g is None or gg == g) and end - dt.timedelta(days=8) <= d <= end and d in CALENDAR}
            want[(g, end) if grouped else (end,)] = len(inside)
    assert seen == want


def test_trailing_sums_count_existing_dates(spark, visits):
    calendar_df = spark.createDataFrame([(d,) for d in CALENDAR], "day date")
    df = spark.createDataFrame(visits, "g string, u string, day date").groupBy("day").agg(F.count("*").alias("n"))
    got = {r.day: (r.n, r.dates_in_window) for r in trailing(df, calendar_df, "day", 9, ["n"]).collect()}
    for end in CALENDAR:
        window = [d for d in CALENDAR if end - dt.timedelta(days=8) <= d <= end]
        assert got[end] == (sum(1 for v in visits if v[2] in window), len(window))


def test_date_spine_has_every_day_for_every_group(spark):
    calendar_df = spark.createDataFrame([(d,) for d in CALENDAR], "day date")
    groups = spark.createDataFrame([("a",), ("b",)], "g string")
    assert date_spine(calendar_df, "day", groups).distinct().count() == 2 * len(CALENDAR)
