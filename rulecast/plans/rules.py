"""Rule tables: one user-agent rule per channel and offer."""

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from rulecast.functions.dates import as_date, yesterday
from rulecast.functions.text import rule_text
from rulecast.operators.aggregates import ordered_concat
from rulecast.operators.lineage import materialize
from rulecast.plans.assignment import CHANNELS, assign_devices
from rulecast.plans.feedback_state import FeedbackState
from rulecast.plans.offers import active_offers, device_prices, offer_list, price_intervals
from rulecast.plans.outcomes import (
    Evidence,
    activity,
    device_outcomes,
    device_totals,
    feedback_devices,
    launch_days,
    offer_choices,
    offer_terms,
)

# Brand names too general for a rule, in daily runs and in one-day runs.
DAILY_EXCLUSIONS = ("asus", "huawei", "zte=blade", "vivo")
ONE_DAY_EXCLUSIONS = (
    "asus", "huawei", "zte-blade", "vivo", "smart", "iris", "lava", "true", "lenovo", "htc",
    "dtac", "i-mobile", "i-style", "smartphone", "i_mobile", "i_style",
)


def build_rules(tokens: DataFrame, exclusions=DAILY_EXCLUSIONS) -> DataFrame:
    """One rule per channel, offer and priority, its alternatives in ascending order."""
    kept = tokens.where(~F.col("dvc_techname").isin(*exclusions))
    joined = ordered_concat(
        kept, ["source", "offer", "uc1_priority"], F.trim("dvc_techname"), "|", "alternatives"
    )
    return joined.select("source", "offer", "uc1_priority", rule_text(F.col("alternatives")).alias("rule"))


def judged_offers(
    offers: DataFrame,
    feedback: DataFrame | FeedbackState,
    evidence: Evidence = Evidence(),
    history_start: dt.date | str | None = None,
    use_s2l: bool = False,
    materialized: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Outcomes per offer and device, and the choice per offer, of the offers in the list.

    ``materialized`` writes the totals and the outcomes, which several branches read, to the shared
    checkpoint folder, so that the history is read once for its totals and once, two columns wide,
    for launch days. A state of the feedback, which has both, takes the place of the history; what
    it starts with is decided when it is advanced.
    """
    keep = materialize if materialized else (lambda df: df)
    if isinstance(feedback, FeedbackState):
        if history_start is not None:
            raise ValueError("a feedback state has a history of its own")
        totals, days = feedback.totals(), feedback.launch_days()
    else:
        totals = keep(device_totals(feedback, history_start))
        if history_start is not None:
            feedback = feedback.where(F.col("sighted_date") >= F.lit(as_date(history_start)))
        days = launch_days(feedback)
    terms = keep(offer_terms(offers, activity(days, totals), evidence))
    outcomes = keep(device_outcomes(totals, terms, use_s2l))
    return outcomes, offer_choices(outcomes, evidence)


def rule_tokens(
    offer_control: DataFrame,
    properties: DataFrame,
    feedback: DataFrame | FeedbackState,
    run_date: dt.date | str,
    evidence: Evidence = Evidence(),
    history_start: dt.date | str | None = None,
    use_s2l: bool = False,
    channels=CHANNELS,
    materialized: bool = True,
) -> DataFrame:
    """From offer control, device properties and feedback history to tokens per channel and offer.

    Offers are intervals of the distinct prices in order and meet neither devices nor prices one by
    one. What several steps read is a table; those of offers are small, and known to be.
    ``materialized`` is explained at ``judged_offers``.
    """
    keep = materialize if materialized else (lambda df: df)
    prices = keep(device_prices(properties))
    intervals = price_intervals(active_offers(offer_control, run_date), prices)
    offers = keep(offer_list(intervals.offers))
    outcomes, choices = judged_offers(
        offers, feedback, evidence, history_start, use_s2l, materialized
    )
    chosen = keep(feedback_devices(offers, outcomes, keep(choices)))
    return assign_devices(intervals, chosen, offers, channels, prices)


def daily_rules(
    offer_control: DataFrame,
    properties: DataFrame,
    feedback: DataFrame | FeedbackState,
    run_date: dt.date | str | None = None,
    exclusions=DAILY_EXCLUSIONS,
    **options,
) -> DataFrame:
    """The rules of one day, with its partition columns; options are those of ``rule_tokens``."""
    day = as_date(run_date) if run_date is not None else yesterday()
    tokens = rule_tokens(offer_control, properties, feedback, day, **options)
    rules = build_rules(tokens, exclusions)
    return rules.select(
        "*", *(F.lit(getattr(day, part)).alias(part) for part in ("year", "month", "day"))
    )


def rules_one_day(
    offer_control: DataFrame,
    properties: DataFrame,
    feedback: DataFrame | FeedbackState,
    run_date: dt.date | str,
    exclusions=ONE_DAY_EXCLUSIONS,
    **options,
) -> DataFrame:
    """The rules for a given date with the longer exclusion list, as a table of its own."""
    rules = daily_rules(offer_control, properties, feedback, run_date, exclusions, **options)
    return rules.drop("year", "month", "day")
