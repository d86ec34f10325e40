from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lodestrata.functions import map_variants, parse_date, parse_keyed_value
from lodestrata.functions.sql import register_functions
from lodestrata.plans.config import CARE_LEVEL_SPELLINGS
from tests.test_cleanse import DATES


@pytest.mark.parametrize("database", [None, "silver_functions"])
def test_sql_names_agree_with_the_columns(spark, database):
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    parse, level, rate = register_functions(spark, database)
    texts = [*DATES, *CARE_LEVEL_SPELLINGS, " IL ", "other"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    df.createOrReplaceTempView("texts")
    columns = df.select("v", parse_date(F.col("v")), map_variants(F.col("v"), CARE_LEVEL_SPELLINGS))
    named = spark.sql(f"SELECT v, {parse}(v), {level}(v) FROM texts")
    assert sorted(map(tuple, named.collect()), key=repr) == sorted(map(tuple, columns.collect()), key=repr)

    sheets = [("{'cook': 18.25}", " cook "), ("{'cook': 18.25}", "driver"), ("no sheet", "cook")]
    df = spark.createDataFrame(sheets, "d string, k string")
    df.createOrReplaceTempView("rates")
    assert [r[0] for r in spark.sql(f"SELECT {rate}(d, k) FROM rates").collect()] == [Decimal("18.25"), None, None]
    assert [r[0] for r in df.select(parse_keyed_value(F.col("d"), F.col("k"))).collect()] == [Decimal("18.25"), None, None]
    if database:
        spark.sql(f"DROP DATABASE {database} CASCADE")
