"""What rules need to know of all feedback so far, kept as a table and advanced by days.

The state has one row per offer, channel and device, and one per offer and day; both grow with
devices and days, not with the rows of the history. Everything in it is a sum or a count, so the rows
of a day can be added, and taken out again when the day is written anew or leaves the history. For
that the state keeps what it has taken from each day.
"""

import datetime as dt
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from rulecast.functions.dates import as_date
from rulecast.sources.publishing import PART, Files, Published, changed_days, day_folder, decide, finish, part_of, staging
from rulecast.sources.readers import on_days
from rulecast.sources.schemas import PARTITION

MEASURES = ("imps", "clicks", "landings", "submits")
KEYS = ["offer", "source", "dvc_techname"]
COUNTS = ["rows", "conversions", *MEASURES, *(f"{m}_given" for m in MEASURES)]

TOTALS = "offer string, source string, dvc_techname string, " + ", ".join(f"{c} bigint" for c in COUNTS)
LAUNCHES = "offer string, sighted_date date, rows bigint"
DAYS = f"sighted_date date, {TOTALS}, year int, month int, day int"


@dataclass(frozen=True)
class FeedbackState:
    """The stored sums of a feedback history."""

    stored: DataFrame
    launches: DataFrame

    def totals(self) -> DataFrame:
        """What ``device_totals`` gives for the history: a sum of no values is NULL."""
        sums = [F.when(F.col(f"{m}_given") > 0, F.col(m)).alias(m) for m in MEASURES]
        converted = F.when(F.col("submits_given") > 0, F.col("conversions") > 0).alias("converted")
        return self.stored.select(*KEYS, *sums, converted)

    def launch_days(self) -> DataFrame:
        """Distinct days with feedback per offer; a row without a date is no day."""
        return self.launches.groupBy("offer").agg(F.count("sighted_date").alias("launch_days"))


def read_state(spark: SparkSession, path: str) -> FeedbackState:
    finish(spark, path)
    return FeedbackState(spark.read.schema(TOTALS).parquet(f"{path}/totals"), spark.read.schema(LAUNCHES).parquet(f"{path}/launches"))


def day_sums(feedback: DataFrame) -> DataFrame:
    """The contribution of each day (a partition of the table) per offer, channel and device.

    A feedback table has hardly a key twice on a day, so its rows are shuffled as they are, in the
    parts in which the days are staged; sums and staging need no shuffle of their own then.
    """
    given = [F.count(m).alias(f"{m}_given") for m in MEASURES]
    sums = [F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(m) for m in MEASURES]
    return (
        feedback.where(F.col("offer").isNotNull())
        .withColumn(PART, part_of("sighted_date", *KEYS))
        .repartition(*PARTITION, PART)
        .groupBy(*PARTITION, PART, "sighted_date", *KEYS)
        .agg(F.count("*").alias("rows"), F.count_if(F.col("submits") > 0).alias("conversions"), *sums, *given)
        .select("sighted_date", *KEYS, *COUNTS, *PARTITION, PART)
    )


def _added(parts: list[DataFrame], keys: list[str], counts: list[str]) -> DataFrame:
    """Parts added up; what has no row left is gone."""
    together = reduce(DataFrame.unionByName, (p.select(*keys, *counts) for p in parts))
    return together.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in counts)).where("rows > 0")


def advance(feedback: DataFrame, path: str, first: dt.date, last: dt.date, history_start: dt.date | str | None = None) -> Published:
    """Take the days ``first`` to ``last`` of the feedback table into the state at ``path``.

    Only these days are read, and only those are taken in whose sums differ from what the state has
    of them; a day without feedback leaves it. Days before ``history_start`` leave it too. The
    change of the state and of its days is one step.
    """
    spark = feedback.sparkSession
    finish(spark, path)
    files, run = Files(spark, path), uuid.uuid4().hex
    kept = F.lit(True) if history_start is None else ~_before(history_start)
    change = changed_days(day_sums(feedback.where(on_days(first, last) & kept)), path, run, first, last, "days")
    old_days = _stored_days(files, as_date(history_start)) if history_start is not None else []
    gone = sorted({*change.removed, *old_days})
    old = [*(d for d in change.written if files.exists(f"days/{day_folder(d)}")), *gone]
    new = spark.read.schema(DAYS).parquet(f"{staging(path, run)}/days").where(_on(change.written))
    delta = [new]
    if old:
        held = spark.read.schema(DAYS).option("basePath", f"{path}/days").parquet(*(f"{path}/days/{day_folder(d)}" for d in old))
        delta.append(held.withColumns({c: -F.col(c) for c in COUNTS}))
    taken = {f"days/{day_folder(d)}": change.digests[d] for d in change.written}
    if change.written or old or not files.exists("totals"):
        state = {"totals": (TOTALS, KEYS, COUNTS), "launches": (LAUNCHES, ["offer", "sighted_date"], ["rows"])}
        for name, (schema, keys, counts) in state.items():
            so_far = [spark.read.schema(schema).parquet(f"{path}/{name}")] if files.exists(name) else []
            _added([*so_far, *delta], keys, counts).write.parquet(f"{staging(path, run)}/{name}")
            taken[name] = None
    decide(files, run, taken, [f"days/{day_folder(d)}" for d in gone])
    return Published(change.written, gone, change.unchanged)


def _before(start: dt.date | str):
    d = as_date(start)
    return F.col("year") * 10000 + F.col("month") * 100 + F.col("day") < int(d.strftime("%Y%m%d"))


def _on(days: list[dt.date]):
    number = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
    return number.isin([int(d.strftime("%Y%m%d")) for d in days]) if days else F.lit(False)


def _stored_days(files: Files, before: dt.date) -> list[dt.date]:
    """Days of the state before a date, by the names of their folders."""
    found = []
    for year in files.names("days"):
        for month in files.names(f"days/{year}"):
            for day in files.names(f"days/{year}/{month}"):
                found.append(dt.date(*(int(part.split("=")[1]) for part in (year, month, day))))
    return [d for d in found if d < before]
