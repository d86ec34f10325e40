"""python -m lodestrata.plans SOURCE ROOT [EXPORT]: one full refresh."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from lodestrata.plans.config import FULL_DROP, Expectations
from lodestrata.plans.refresh import refresh


def main() -> None:
    parser = argparse.ArgumentParser(description=main.__doc__)
    parser.add_argument("source", help="folder of the CSV drops")
    parser.add_argument("root", help="shared folder for the layers")
    parser.add_argument("export", nargs="?", help="folder for the published gold tables")
    parser.add_argument("--open", action="store_true", help="do not hold the run to the counts of the full drop")
    parser.add_argument("--catalog", action="store_true", help="register the layers as databases")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("lodestrata").getOrCreate()
    expected = Expectations() if args.open else FULL_DROP
    result = refresh(spark, args.source, args.root, args.export, expected, args.catalog)
    result.summary().orderBy("name").show(100, truncate=False)
    result.rejections.show(truncate=False)


if __name__ == "__main__":
    main()
