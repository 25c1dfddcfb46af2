"""Daily feedback: impressions, clicks, landings and submits per offer, channel and device.

User agents repeat a lot and naming a device costs a chain of regular expressions. Each side is
therefore counted per raw user agent first; names are derived from the much fewer counted rows.
"""

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from rulecast.functions.dates import utc_date
from rulecast.functions.device_names import device_name
from rulecast.functions.offers import (
    CAMPAIGN_SOURCES,
    TACTIC_OFFERS,
    campaign_to_source,
    referrer_to_offer,
    referrer_to_source,
    tactic_to_offer,
)
from rulecast.functions.platform import fix_platform, platform_class
from rulecast.operators.merging import outer_merge
from rulecast.operators.nested import element_count, key_count
from rulecast.sources.readers import on_days
from rulecast.sources.schemas import PARTITION

# Which taps and events count.
IMPRESSION, CLICK = "impression", "click"
LANDING, SUBMIT_MARK = "undefined", "submit"
TAP_PARAM, TAP_HEADER = "ext_cat", "Referer"
LANDING_PROPERTY, LANDING_MARK = "2868", "specialoffer"
TAP_SOURCE = "kd"

KEYS = ["sighted_date", "offer", "source", "hl_platform", "dvc_techname"]


def _weight(combinations: Column, count_mode: str) -> Column:
    """How often one record counts: once per combination of its nested elements, or once."""
    if count_mode == "unnest":
        return combinations
    if count_mode == "event":
        return F.when(combinations > 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    raise ValueError(f"count_mode must be 'unnest' or 'event', not {count_mode!r}")


def _header_columns() -> list[Column]:
    agent = F.col("header.user_agent")
    return [
        utc_date(F.col("header.created_at")).alias("sighted_date"),
        fix_platform(F.col("header.platform"), agent).alias("platform"),
        agent.alias("user_agent"),
    ]


def _device_columns() -> list[Column]:
    platform, agent = F.col("platform"), F.col("user_agent")
    return [
        platform_class(platform).alias("hl_platform"),
        device_name(platform, agent).alias("dvc_techname"),
    ]


def _count_if(condition: Column) -> Column:
    return F.sum(F.when(condition, F.col("weight")).otherwise(F.lit(0)))


def _named_taps(taps, start, end, count_mode, tap_source, offers, campaigns) -> DataFrame:
    combinations = (
        element_count(taps, "header.incoming_ids").cast("bigint")
        * key_count(taps, "header.query_params", TAP_PARAM)
        * key_count(taps, "header.http_headers", TAP_HEADER)
    )
    action = F.col("action_id")
    by_campaign = tap_source == "campaign"
    source = campaign_to_source(F.col("campaign_id"), campaigns) if by_campaign else F.lit(tap_source)
    counted = (
        taps.where(
            on_days(start, end)
            & F.col("campaign_id").isin(*campaigns)
            & action.isin(IMPRESSION, CLICK)
        )
        .select(
            *PARTITION,
            *_header_columns(),
            "tactic_id",
            source.alias("source"),
            "action_id",
            _weight(combinations, count_mode).alias("weight"),
        )
        .where(F.col("weight") > 0)
        .groupBy(*PARTITION, "sighted_date", "platform", "user_agent", "tactic_id", "source")
        .agg(
            _count_if(action == IMPRESSION).alias("imps"),
            _count_if(action == CLICK).alias("clicks"),
        )
    )
    return counted.select(
        *PARTITION,
        "sighted_date",
        tactic_to_offer(F.col("tactic_id"), offers).alias("offer"),
        "source",
        *_device_columns(),
        "imps",
        "clicks",
    )


def _named_events(events, start, end, count_mode, property_id) -> DataFrame:
    action, url = F.col("action_id"), F.col("header.referrer_url")
    submitted = F.contains(action, F.lit(SUBMIT_MARK))
    combinations = element_count(events, "header.incoming_ids").cast("bigint")
    counted = (
        events.where(
            on_days(start, end)
            & (F.col("property_id").cast("string") == property_id)
            & (submitted | (action == LANDING))
            & F.contains(url, F.lit(LANDING_MARK))
        )
        .select(
            *PARTITION,
            *_header_columns(),
            url.alias("referrer_url"),
            "action_id",
            _weight(combinations, count_mode).alias("weight"),
        )
        .where(F.col("weight") > 0)
        .groupBy(*PARTITION, "sighted_date", "platform", "user_agent", "referrer_url")
        .agg(
            _count_if(action == LANDING).alias("landings"),
            _count_if(submitted).alias("submits"),
        )
    )
    return counted.select(
        *PARTITION,
        "sighted_date",
        referrer_to_offer(F.col("referrer_url")).alias("offer"),
        referrer_to_source(F.col("referrer_url")).alias("source"),
        *_device_columns(),
        "landings",
        "submits",
    )


def tap_feedback(
    taps: DataFrame,
    start: dt.date | str,
    end: dt.date | str | None = None,
    count_mode: str = "unnest",
    tap_source: str = TAP_SOURCE,
    offers: Mapping[int, str] = TACTIC_OFFERS,
    campaigns: Mapping[int, str] = CAMPAIGN_SOURCES,
) -> DataFrame:
    """Impressions and clicks per day, offer, channel, platform class and device.

    ``count_mode="unnest"`` counts a tap once per combination of its ids, matching parameters and
    matching headers; ``"event"`` counts it once. ``tap_source`` is the channel of all taps, or
    ``"campaign"`` to take it from the campaign.
    """
    named = _named_taps(taps, start, end, count_mode, tap_source, offers, campaigns)
    sums = [F.sum(m).alias(m) for m in ("imps", "clicks")]
    return named.groupBy(*KEYS, *PARTITION).agg(*sums).select(*KEYS, "imps", "clicks", *PARTITION)


def event_feedback(
    events: DataFrame,
    start: dt.date | str,
    end: dt.date | str | None = None,
    count_mode: str = "unnest",
    property_id: str = LANDING_PROPERTY,
) -> DataFrame:
    """Landings and submits per day, offer, channel, platform class and device."""
    named = _named_events(events, start, end, count_mode, property_id)
    sums = [F.sum(m).alias(m) for m in ("landings", "submits")]
    return (
        named.groupBy(*KEYS, *PARTITION).agg(*sums).select(*KEYS, "landings", "submits", *PARTITION)
    )


def daily_feedback(
    taps: DataFrame,
    events: DataFrame,
    start: dt.date | str,
    end: dt.date | str | None = None,
    count_mode: str = "unnest",
    tap_source: str = TAP_SOURCE,
    offers: Mapping[int, str] = TACTIC_OFFERS,
    campaigns: Mapping[int, str] = CAMPAIGN_SOURCES,
    property_id: str = LANDING_PROPERTY,
) -> DataFrame:
    """The feedback table for one day, or for every day from ``start`` to ``end`` in one job."""
    merged = outer_merge(
        _named_taps(taps, start, end, count_mode, tap_source, offers, campaigns),
        _named_events(events, start, end, count_mode, property_id),
        [*PARTITION, *KEYS],
    )
    return merged.select(*KEYS, "imps", "clicks", "landings", "submits", *PARTITION)
