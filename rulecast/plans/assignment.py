"""Each device goes to the best offer of a channel."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from rulecast.functions.text import clean_token
from rulecast.operators.aggregates import best_rank
from rulecast.operators.ordering import blocks_of
from rulecast.operators.skew import salted_join
from rulecast.plans.offers import FLAGS, PriceIntervals

# How iPhones are named, and the shortest token that enters a rule is longer than this.
IOS_NAME = r"iphone os 1?[0-9]"
SHORT_TOKEN = 2


@dataclass(frozen=True)
class Channel:
    name: str
    flag: str
    ios_name: str | None = None


# The channels, their flag and the name iPhones have there.
CHANNELS = (
    Channel("kd", "active_flg_kd"),
    Channel("kd_app", "active_flg_kd", "iphone; ios"),
    Channel("fb", "active_flg_fb", "apple iphone"),
    Channel("pt", "active_flg_pt"),
)


def _best_per_flag(candidates: DataFrame, key: str, channels) -> DataFrame:
    """Lowest priority per key (a device or a price) and flag of the channels."""
    flags = sorted({c.flag for c in channels})
    return candidates.groupBy(key).agg(
        *(F.min(F.when(F.col(f) == 1, F.col("uc1_priority"))).alias(f) for f in flags)
    )


def _best_by_price(intervals: DataFrame, prices: DataFrame, channels) -> DataFrame:
    """Lowest priority per price and flag among the offers whose interval holds the price.

    Intervals split into aligned blocks of 1, 2, 4, … prices; each block keeps its best priorities,
    and a price takes the best of the blocks that it lies in, one per size.
    """
    highest = prices.agg(F.max("number")).first()[0]  # a number; the prices are a stored table
    size = F.explode(F.sequence(F.lit(0), F.lit((highest or 0).bit_length()))).alias("size")
    split = intervals.select("*", size).withColumn("block", F.explode(blocks_of(F.col("first"), F.col("stop"), F.col("size"))))
    flags = sorted({c.flag for c in channels})
    best = split.groupBy("size", "block").agg(
        *(F.min(F.when(F.col(f) == 1, F.col("uc1_priority"))).alias(f) for f in flags)
    )
    spread = prices.select("price", "number", size).withColumn("block", F.expr("shiftright(number, size)"))
    met = spread.join(best, ["size", "block"])
    return met.groupBy("price").agg(*(F.min(f).alias(f) for f in flags))


def _best_per_channel(reduced: DataFrame, channels) -> DataFrame:
    """Lowest priority per channel and device, from rows of lowest priorities per flag.

    Channels, which share flags and rename iPhones, are told apart on the few rows that remain.
    """
    flags = sorted({c.flag for c in channels})
    reduced = reduced.groupBy("dvc_techname").agg(*(F.min(f).alias(f) for f in flags))

    def entry(channel):
        name = F.col("dvc_techname")
        if channel.ios_name is not None:
            name = F.regexp_replace(name, IOS_NAME, channel.ios_name)
        return F.struct(
            F.lit(channel.name).alias("source"),
            name.alias("dvc_techname"),
            F.col(channel.flag).alias("uc1_priority"),
        )

    entries = reduced.select(F.inline(F.array(*(entry(c) for c in channels))))
    return best_rank(
        entries.where(F.col("uc1_priority").isNotNull()),
        ["source", "dvc_techname"],
        "uc1_priority",
    )


def _holders(offers: DataFrame, channels) -> DataFrame:
    """The offers of each channel."""
    entries = [
        F.struct(F.lit(c.name).alias("source"), (F.col(c.flag) == 1).alias("active"))
        for c in channels
    ]
    named = offers.select("offer", "uc1_priority", F.inline(F.array(*entries)))
    return named.where("active").select("source", "offer", "uc1_priority").distinct()


def assign_devices(
    control: DataFrame | PriceIntervals,
    feedback: DataFrame,
    offers: DataFrame | None = None,
    channels=CHANNELS,
    prices: DataFrame | None = None,
) -> DataFrame:
    """Device tokens per channel, offer and priority.

    Devices chosen by feedback replace an offer's control devices. In each channel a device keeps
    its lowest priority number; all offers with that number get it. ``offers`` is the offer list
    when it is at hand; otherwise it is taken from ``control``.

    ``control`` pairs the offers with their devices or, if ``prices`` has the prices of devices,
    with the prices in their range, or it has the offers' price intervals. A device with several
    prices takes the best of them.
    """
    key = "dvc_techname" if prices is None else "price"
    terms = ["offer", "uc1_priority", *FLAGS]
    intervals = control if isinstance(control, PriceIntervals) else None
    pairs = control if intervals is None else intervals.offers
    listed = (pairs if offers is None else offers).select(*terms).distinct()
    decided = (
        feedback.groupBy("offer")
        .agg(F.count_if(F.col("dvc_techname").isNull()).alias("unnamed"))
        .where("unnamed = 0")
        .select("offer")
    )
    if intervals is None:
        undecided = salted_join(
            control.select(*terms, key), decided, ["offer"], F.col(key), "left_anti"
        )
        by_price = _best_per_flag(undecided, key, channels)
    else:
        undecided = intervals.offers.join(decided, "offer", "left_anti")
        by_price = _best_by_price(undecided, intervals.prices, channels)
    if prices is not None:
        by_price = salted_join(prices, by_price, ["price"], F.col("dvc_techname")).drop("price")
    chosen = feedback.where(F.col("dvc_techname").isNotNull())
    by_feedback = salted_join(chosen, listed, ["offer"], F.col("dvc_techname"))
    by_feedback = _best_per_flag(by_feedback, "dvc_techname", channels)
    best = _best_per_channel(by_price.unionByName(by_feedback), channels)
    won = salted_join(
        best, _holders(listed, channels), ["source", "uc1_priority"], F.col("dvc_techname")
    )
    token = clean_token(F.col("dvc_techname")).alias("dvc_techname")
    return (
        won.select("source", "offer", "uc1_priority", token)
        .where(F.char_length("dvc_techname") > SHORT_TOKEN)
        .distinct()
    )
