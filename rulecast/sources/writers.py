"""Tables and files that results go to."""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from rulecast.functions.dates import as_date
from rulecast.sources.schemas import PARTITION


def create_partitioned(spark: SparkSession, path: str, schema: str) -> None:
    """An empty Parquet table partitioned by day; replaces what is there."""
    empty = spark.createDataFrame([], schema)
    empty.write.mode("overwrite").partitionBy(*PARTITION).parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Snapshot: the result takes the place of the table."""
    df.write.mode("overwrite").parquet(path)


def write_day(df: DataFrame, path: str, day: dt.date | str, mode: str = "overwrite") -> None:
    """Write one day's partition.

    ``overwrite`` replaces that day alone, also by an empty result, so a repeated run leaves the
    table as it was; ``append`` adds to it.
    """
    d = as_date(day)
    target = f"{path}/year={d.year}/month={d.month}/day={d.day}"
    df.drop(*PARTITION).write.mode(mode).parquet(target)


def write_days(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write many days in one job, replacing exactly the days that occur in ``df``.

    Rows are brought together by day first, in several parts per day so that a heavy day is not
    one task; without that every task would open a file in every partition.
    """
    parts = F.pmod(F.xxhash64(*[c for c in df.columns if c not in PARTITION]), F.lit(8))
    (
        df.repartition(*PARTITION, parts)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITION)
        .parquet(path)
    )


def export_csv(df: DataFrame, path: str, order: list[str], titles: list[str]) -> None:
    """One ordered CSV file with its own title line.

    For small results only: a rules table has one row per channel and offer.
    """
    named = df.repartition(1).sortWithinPartitions(*order).toDF(*titles)
    (
        named.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
