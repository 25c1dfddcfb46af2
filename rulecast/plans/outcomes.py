"""Devices an offer should target, judged by feedback."""

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from rulecast.functions.dates import as_date
from rulecast.functions.numbers import as_number, at_least_ratio, at_most_cost
from rulecast.operators.skew import salted_join

# Names of feedback devices as they read in user agents.
DEVICE_RENAMES = (("COMPUTER", "windows nt"), ("IPAD", "ipad"))
# Cost of impressions (3 per 1000) and the channel judged by submits alone.
COST, PER_IMPRESSIONS = 3, 1000
SUBMITS_ONLY_SOURCE = "fb"


@dataclass(frozen=True)
class Evidence:
    """How much feedback an offer needs."""

    launch_days: int = 3
    converting_devices: int = 20
    few_successes: int = 20


def device_totals(feedback: DataFrame, history_start: dt.date | str | None = None) -> DataFrame:
    """Feedback summed per offer, channel and device, over all days or since ``history_start``."""
    rows = feedback.where(F.col("offer").isNotNull())
    if history_start is not None:
        rows = rows.where(F.col("sighted_date") >= F.lit(as_date(history_start)))
    sums = [F.sum(m).alias(m) for m in ("imps", "clicks", "landings", "submits")]
    converted = F.max(F.col("submits") > 0).alias("converted")
    return rows.groupBy("offer", "source", "dvc_techname").agg(*sums, converted)


def launch_days(feedback: DataFrame) -> DataFrame:
    """Distinct days with feedback per offer."""
    days = feedback.where(F.col("offer").isNotNull()).groupBy("offer")
    return days.agg(F.countDistinct("sighted_date").alias("launch_days"))


def offer_activity(feedback: DataFrame, totals: DataFrame) -> DataFrame:
    """Launch days and converting devices per offer; each counts distinct values."""
    return activity(launch_days(feedback), totals)


def activity(days: DataFrame, totals: DataFrame) -> DataFrame:
    """The launch days of each offer with the number of its converting devices."""
    converting = totals.where("converted").groupBy("offer")
    converting = converting.agg(F.countDistinct("dvc_techname").alias("converting_devices"))
    return days.join(converting, "offer", "left").na.fill(0, ["converting_devices"])


def success_gate(source: Column, terms: Column, use_s2l: bool = False) -> Column:
    """Whether one device's totals meet one set of offer terms."""
    imps, clicks, landings, submits = (
        F.col(c) for c in ("imps", "clicks", "landings", "submits")
    )
    enough = submits >= terms["min_submits"]
    passed = (
        at_least_ratio(clicks, imps, terms["min_ctr"])
        & enough
        & at_most_cost(imps * COST, submits * PER_IMPRESSIONS, terms["max_cps"])
    )
    if use_s2l:
        passed = passed & at_least_ratio(submits, landings, terms["min_s2l"])
    return passed | ((source == SUBMITS_ONLY_SOURCE) & enough)


def offer_terms(
    offers: DataFrame, activity: DataFrame, evidence: Evidence = Evidence()
) -> DataFrame:
    """One row per offer launched long enough: all its terms, and whether enough devices convert.

    Terms of equally named offers travel together, so totals meet each offer once.
    """
    numbers = [
        as_number(F.col(c)).alias(c)
        for c in ("min_ctr", "min_submits", "min_s2l", "max_cps", "min_landings")
    ]
    launched = activity.where(F.col("launch_days") >= evidence.launch_days)
    convincing = F.col("converting_devices") >= evidence.converting_devices
    return (
        offers.select("offer", *numbers)
        .groupBy("offer")
        .agg(
            F.collect_set(F.struct("min_ctr", "min_submits", "min_s2l", "max_cps")).alias("terms"),
            F.min("min_landings").alias("min_landings"),
        )
        .join(launched, "offer")
        .select("offer", "terms", "min_landings", convincing.alias("convincing"))
    )


def device_outcomes(totals: DataFrame, terms: DataFrame, use_s2l: bool = False) -> DataFrame:
    """Per offer and device: is it a success, does it have enough landings."""
    judged = salted_join(totals, terms, ["offer"], F.col("dvc_techname"))
    passed = F.exists("terms", lambda t: success_gate(F.col("source"), t, use_s2l))
    enough_landings = F.sum("landings") >= F.max("min_landings")
    per_device = judged.groupBy("offer", "dvc_techname").agg(
        F.coalesce(F.max(F.col("convincing") & passed), F.lit(False)).alias("success"),
        F.coalesce(enough_landings, F.lit(False)).alias("landing"),
    )
    name = F.col("dvc_techname")
    for old, new in DEVICE_RENAMES:
        name = F.replace(name, F.lit(old), F.lit(new))
    return (
        per_device.where("success or landing")
        .groupBy("offer", name.alias("dvc_techname"))
        .agg(F.max("success").alias("success"), F.max("landing").alias("landing"))
    )


def success_devices(outcomes: DataFrame) -> DataFrame:
    """Devices that meet an offer's terms."""
    return outcomes.where("success").select("offer", "dvc_techname")


def offer_choices(outcomes: DataFrame, evidence: Evidence = Evidence()) -> DataFrame:
    """Per offer with a success: has it few of them, and do landing devices replace them."""
    few = F.count_if(F.col("success") & F.col("dvc_techname").isNotNull()) < evidence.few_successes
    return (
        outcomes.groupBy("offer")
        .agg(
            few.alias("few"),
            F.max("success").alias("any_success"),
            F.max("landing").alias("any_landing"),
        )
        .where("any_success")
        .select("offer", "few", (F.col("few") & F.col("any_landing")).alias("by_landing"))
    )


def landing_devices(outcomes: DataFrame, choices: DataFrame) -> DataFrame:
    """Fallback by landings, for offers with some but few successes."""
    few = choices.where("few").select("offer")
    rows = salted_join(outcomes.where("landing"), few, ["offer"], F.col("dvc_techname"))
    return rows.select("offer", "dvc_techname")


def feedback_devices(offers: DataFrame, outcomes: DataFrame, choices: DataFrame) -> DataFrame:
    """Devices per listed offer: its landing fallback if it has one, else its successes.

    An offer with neither keeps one row without a device.
    """
    listed = offers.select("offer").distinct()
    chosen = choices.join(listed, "offer", "left_semi")
    judged = salted_join(outcomes, chosen, ["offer"], F.col("dvc_techname"))
    picked = judged.where(F.when(F.col("by_landing"), F.col("landing")).otherwise(F.col("success")))
    none = listed.join(choices, "offer", "left_anti").withColumn(
        "dvc_techname", F.lit(None).cast("string")
    )
    return picked.select("offer", "dvc_techname").unionByName(none)
