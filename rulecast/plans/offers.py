"""Offer control: validity, thresholds and the devices in an offer's price range."""

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from rulecast.functions.dates import as_date, date_of_parts
from rulecast.functions.numbers import as_number
from rulecast.operators.lineage import materialize
from rulecast.operators.ordering import count_before
from rulecast.operators.ranges import first_in_range, range_join
from rulecast.sources.rejects import Check

# Open price bounds, and the factor from a release price to the bounds' currency.
OPEN_MIN, OPEN_MAX = -99999, 99999
PRICE_FACTOR = 40

FLAGS = ["active_flg_kd", "active_flg_fb", "active_flg_pt"]
THRESHOLDS = ["min_ctr", "min_landings", "min_submits", "min_s2l", "max_cps"]
TERMS = ["offer", "uc1_priority", *FLAGS, *THRESHOLDS]
# Cells of one price unit: 2**13 of them span both open bounds.
PRICE_BITS = 13


def shape_offer_control(raw: DataFrame) -> DataFrame:
    """Typed offer control: real dates, open bounds filled in."""

    def bound(name, default):
        return F.coalesce(F.col(name), F.lit(default)).alias(name)

    def day(prefix):
        parts = (F.col(f"{prefix}_{p}") for p in ("year", "month", "day"))
        return date_of_parts(*parts).alias(f"{prefix}_date")

    return raw.select(
        "offer",
        "uc1_priority",
        *FLAGS,
        "screen_size",
        "rrp",
        "apollo_price",
        "min_pack",
        "start_year",
        day("start"),
        day("end"),
        bound("target_rlp_min", OPEN_MIN),
        bound("target_rlp_max", OPEN_MAX),
        *THRESHOLDS,
    )


def offer_checks() -> tuple[Check, ...]:
    """Values of the file that shaping or a later gate would turn into NULL: days and thresholds."""

    def day(prefix):
        parts = [F.col(f"{prefix}_{p}") for p in ("year", "month", "day")]
        said = F.concat_ws("-", *(F.coalesce(p, F.lit("")) for p in parts))
        return Check(f"{prefix}_date", said, "no such day", (said != "--") & date_of_parts(*parts).isNull())

    def number(name):
        return Check(name, F.col(name), "not a number", F.col(name).isNotNull() & as_number(F.col(name)).isNull())

    return (day("start"), day("end"), *map(number, THRESHOLDS))


def active_offers(control: DataFrame, run_date: dt.date | str) -> DataFrame:
    """Offers valid on the day (end excluded) with a flag set for any channel."""
    day = F.lit(as_date(run_date))
    configured = F.coalesce(*FLAGS).isNotNull()
    return control.where((F.col("start_date") <= day) & (day < F.col("end_date")) & configured)


def device_prices(properties: DataFrame) -> DataFrame:
    """The prices of each device, in the currency of the offers' bounds."""
    price = (as_number(F.col("release_price")) * PRICE_FACTOR).alias("price")
    return properties.select("dvc_techname", price).distinct()


def price_offers(active: DataFrame, prices: DataFrame) -> DataFrame:
    """The terms of the offers whose range holds a price, per distinct price.

    Devices are told apart later, and only where an offer has won: many share a price, and pairs of
    offer and device would grow with the product of both.
    """
    ranges = active.select(*TERMS, "target_rlp_min", "target_rlp_max").distinct()
    points = prices.select("price").distinct()
    pairs = range_join(
        points, ranges, "price", "target_rlp_min", "target_rlp_max", cell=PRICE_FACTOR, bits=PRICE_BITS
    )
    return pairs.select(*TERMS, "price").distinct()


@dataclass(frozen=True)
class PriceIntervals:
    """Offers as ranges of numbered prices, in place of pairs of offer and price.

    ``offers`` has the terms with ``first`` and ``stop``, the number of the first price in the range
    and of the first one beyond it; ``prices`` has each distinct price and its ``number``.
    """

    offers: DataFrame
    prices: DataFrame


def price_intervals(active: DataFrame, prices: DataFrame) -> PriceIntervals:
    """The offers with a price in their range, found in one pass over prices and bounds in order.

    Rows are prices plus offers; the offers whose range holds a price are never listed with it.
    """
    terms = [*TERMS, "target_rlp_min", "target_rlp_max"]
    ranges = active.select(*terms).distinct().where("target_rlp_min <= target_rlp_max")

    def point(rows, column, kind):
        return rows.select(F.col(column).cast("double").alias("value"), F.lit(kind).alias("kind")).distinct()

    # At equal values a range begins before the price and ends after it.
    points = point(prices.where("price is not null"), "price", 1)
    points = points.unionByName(point(ranges, "target_rlp_min", 0)).unionByName(point(ranges, "target_rlp_max", 2))
    placed = materialize(count_before(points, ["value", "kind"], F.col("kind") == 1, "number"))

    def bound(kind, column, out):
        at = placed.where(F.col("kind") == kind)
        return at.select(F.col("value").alias(f"_{column}"), F.col("number").alias(out))

    low, high = bound(0, "target_rlp_min", "first"), bound(2, "target_rlp_max", "stop")
    found = ranges.join(low, F.col("target_rlp_min").cast("double") == F.col("_target_rlp_min"))
    found = found.join(high, F.col("target_rlp_max").cast("double") == F.col("_target_rlp_max"))
    numbered = placed.where("kind = 1").select(F.col("value").alias("price"), "number")
    return PriceIntervals(materialize(found.where("first < stop").select(*TERMS, "first", "stop")), numbered)


def feedback_condition() -> Column:
    """The thresholds as text, for people to read."""
    signs = {"min_ctr": "CTR>=", "min_submits": "submits>=", "min_s2l": "S2L>=", "max_cps": "CPS<="}
    return F.concat_ws(" and ", *(F.concat(F.lit(s), F.col(c)) for c, s in signs.items()))


def control_devices(active: DataFrame, properties: DataFrame) -> DataFrame:
    """Devices whose price lies in an offer's range, with the offer's terms.

    The result has a row per device and offer; nothing else grows like that. Only a name with several
    prices can meet an offer more than once. The ranges of equal terms are one set of ranges that do
    not touch each other, and a name is listed at the first of its prices in each of them. That leaves
    equal pairs only for terms with several ranges, and only those pairs are made distinct.
    """
    price = as_number(F.col("release_price")) * PRICE_FACTOR
    named = properties.groupBy("dvc_techname").agg(F.sort_array(F.collect_set(price)).alias("_prices"))
    places = F.transform("_prices", lambda p, i: F.struct(p.alias("price"), F.when(i > 0, F.get("_prices", i - 1)).alias("_previous")))
    prices = materialize(named.select("dvc_techname", F.inline(places)))
    # The text is made per offer, not per pair.
    ranges = materialize(_merged_ranges(active).withColumn("feedback_cond", feedback_condition()))
    apart, width = ranges.agg(F.max("_several"), F.percentile_approx(F.col("_high").cast("double") - F.col("_low"), 0.5)).first()

    def listed(some):
        pairs = first_in_range(
            prices, some, "price", "_previous", "_low", "_high", width=width or 0, cell=PRICE_FACTOR, bits=PRICE_BITS
        )
        # It has a value always, which the table does not say.
        return pairs.select(*TERMS, "dvc_techname", F.coalesce("feedback_cond", F.lit("")).alias("feedback_cond"))

    once = listed(ranges.where("not _several").drop("_several"))
    return once.unionByName(listed(ranges.where("_several").drop("_several")).distinct()) if apart else once


def _merged_ranges(active: DataFrame) -> DataFrame:
    """The terms of the offers with their ranges, ``_low`` to ``_high``, and whether they have ``_several``.

    Ranges of equal terms that share a number count as one.
    """
    low, high = F.col("target_rlp_min"), F.col("target_rlp_max")
    ranges = active.where(low <= high).select(*TERMS, low, high).distinct()
    ordered = Window.partitionBy(*TERMS).orderBy(low, high)
    reached = F.max(high).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    begins = ranges.withColumn("_begins", F.coalesce(low > reached, F.lit(True)).cast("int"))
    number = F.sum("_begins").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    merged = begins.withColumn("_number", number).groupBy(*TERMS, "_number").agg(F.min(low).alias("_low"), F.max(high).alias("_high"))
    return merged.withColumn("_several", F.count("*").over(Window.partitionBy(*TERMS)) > 1).drop("_number")


def offer_list(control: DataFrame) -> DataFrame:
    """The offers that have a device or a price, with their terms."""
    return control.select(*TERMS).distinct().withColumn("feedback_cond", feedback_condition())
