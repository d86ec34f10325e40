"""Random near-dates and near-numbers, read by the library and by a second engine."""

import random

import pytest
from pyspark.sql import functions as F

from lodestrata.functions import parse_date, try_int

duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(17)

    def date():
        year = rng.choice(["2025", "1999", "2024", "9999"])
        month, day = rng.choice(["1", "01", "12", "13", "2", "003"]), rng.choice(["1", "28", "29", "30", "31", "32", "007"])
        mark = rng.choice(["-", "/", " ", ".", ""])
        other = mark if rng.random() < 0.8 else rng.choice(["-", "/", " "])
        tail = rng.choice(["", "", "", " 10:00", "T1:2:3", " 10:61:00", "x", "Z", " ", " 10", " 09:00:00.5"])
        body = rng.choice([f"{year}{mark}{month}{other}{day}", f"{month}/{day}/{year}"])
        return rng.choice(["", "", " ", "x", "-"]) + body + tail if rng.random() < 0.9 else body

    def number():
        body = rng.choice(["0", "7", "007", "2147483647", "2147483648", "1.5", "2.5", ".5", "5.", "1e3", "1E-2", "1e", "0.4999999999", "NaN", ""])
        return rng.choice(["", "", " ", "-", "+", "--"]) + body + rng.choice(["", "", " ", "d", "%"])

    return sorted({date() for _ in range(2000)}), sorted({number() for _ in range(800)})


def spark_says(spark, values, expression):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return dict(df.select("v", expression(F.col("v")).cast("string")).collect())


def engine_says(values, *expressions):
    connection = duckdb.connect()
    rows = connection.execute(f"SELECT v, {', '.join(expressions)} FROM (SELECT unnest(?) AS v)", [values]).fetchall()
    return {v: next((r for r in rest if r is not None), None) for v, *rest in rows}


def test_dates(spark, texts):
    dates = [v for v in texts[0] if not v.startswith("-")]  # a leading minus is a year before the common era there
    want = engine_says(dates, "TRY_CAST(TRY_CAST(trim(v) AS DATE) AS VARCHAR)", "strftime(try_strptime(trim(v), '%m/%d/%Y'), '%Y-%m-%d')")
    assert spark_says(spark, dates, parse_date) == want


def test_whole_numbers(spark, texts):
    want = engine_says(texts[1], "CAST(TRY_CAST(v AS INTEGER) AS VARCHAR)")
    assert spark_says(spark, texts[1], try_int) == want
