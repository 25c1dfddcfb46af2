"""Delimited inputs and partition-filtered scans."""

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rulecast.functions.dates import as_date
from rulecast.sources.rejects import Check, CheckedFile, check_positional_csv
from rulecast.sources.schemas import DEVICE_CLUSTERS, OFFER_CONTROL


def read_positional_csv(spark: SparkSession, path: str, schema: str, title: tuple[str, str]):
    """Comma-separated text by position; fields that do not parse become NULL.

    Title rows are removed by value (``title`` is a column and its title text), so files with and
    without one can lie in the same folder. Rows without that column are removed too.
    """
    column, text = title
    rows = spark.read.schema(schema).option("mode", "PERMISSIVE").csv(path)
    return rows.where(F.col(column) != text)


def read_offer_control(spark: SparkSession, path: str) -> DataFrame:
    return read_positional_csv(spark, path, OFFER_CONTROL, ("offer", "Offer"))


def read_device_clusters(spark: SparkSession, path: str) -> DataFrame:
    return read_positional_csv(spark, path, DEVICE_CLUSTERS, ("vendor", "VENDOR"))


def check_offer_control(spark: SparkSession, path: str, checks: tuple[Check, ...] = ()) -> CheckedFile:
    return check_positional_csv(spark, path, OFFER_CONTROL, ("offer", "Offer"), checks)


def check_device_clusters(spark: SparkSession, path: str) -> CheckedFile:
    return check_positional_csv(spark, path, DEVICE_CLUSTERS, ("vendor", "VENDOR"))


def on_days(start: dt.date | str, end: dt.date | str | None = None) -> Column:
    """Partition predicate for the days ``start`` to ``end``, both included.

    The year bounds stand alone so that a catalogue can prune by them; the exact bound prunes the
    listed partitions.
    """
    first = as_date(start)
    last = as_date(end) if end is not None else first
    if first == last:
        year, month, day = (F.col(c) for c in ("year", "month", "day"))
        return (year == first.year) & (month == first.month) & (day == first.day)
    number = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
    return F.col("year").between(first.year, last.year) & number.between(
        int(first.strftime("%Y%m%d")), int(last.strftime("%Y%m%d"))
    )


def in_months(start: tuple[int, int], end: tuple[int, int]) -> Column:
    """Partition predicate for the ``(year, month)`` pairs ``start`` to ``end``, both included."""
    number = F.col("year") * 100 + F.col("month")
    return F.col("year").between(start[0], end[0]) & number.between(
        start[0] * 100 + start[1], end[0] * 100 + end[1]
    )


def one_day(df: DataFrame, day: dt.date | str) -> DataFrame:
    return df.where(on_days(day))


def date_window(df: DataFrame, start: dt.date | str, end: dt.date | str) -> DataFrame:
    return df.where(on_days(start, end))


def preview(df: DataFrame, rows: int = 10) -> DataFrame:
    """Any few rows, for looking at a table."""
    return df.limit(rows)
