"""Total orders over many ranges, prefix matches and price intervals against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from rulecast.operators.ordering import blocks_of, count_before, last_value
from rulecast.operators.prefixes import _with_heads
from rulecast.plans.assignment import CHANNELS, _best_by_price, _best_per_flag
from rulecast.plans.offers import TERMS, offer_list, price_intervals, price_offers
from frames import rows


@pytest.fixture(params=[1, 7])
def ranges(spark, request):
    old = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", old[0])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old[1])


def test_counts_and_last_values_over_ranges(spark, ranges):
    rnd = random.Random(1)
    said = [(rnd.randint(-50, 50) / 2, k, rnd.choice([None, f"v{k}"])) for k in range(400)]
    df = spark.createDataFrame(said, "x double, k int, v string").repartition(5)
    want_n, want_v, n, v = {}, {}, 0, None
    for x, k, value in sorted(said):
        v = value or v
        want_n[k], want_v[k] = n, v
        n += k % 3 == 0
    assert dict(rows(count_before(df, ["x", "k"], F.col("k") % 3 == 0, "n").select("k", "n"))) == want_n
    assert dict(rows(last_value(df, ["x", "k"], "v", "last").select("k", "last"))) == want_v
    assert count_before(df.limit(0), ["x"], F.lit(True), "n").collect() == []
    assert last_value(df.limit(0), ["x"], "v", "last").collect() == []


def test_names_meet_exactly_their_heads(spark, ranges):
    rnd = random.Random(2)

    def word(n):
        return "".join(rnd.choice("abé-") for _ in range(rnd.randint(0, n)))

    heads, names = {word(5) for _ in range(60)} | {"a" * k for k in range(1, 9)}, {word(9) for _ in range(300)} | {"a" * 40, "ab", ""}
    keys = spark.createDataFrame([(n,) for n in [*names, None]], "_name string")
    got = _with_heads(keys, spark.createDataFrame([(h,) for h in heads], "_head string"))
    assert rows(got) == sorted((n, h) for n in names for h in heads if n.startswith(h))


def test_blocks_hold_each_number_of_a_range_once(spark):
    sizes = F.explode(F.sequence(F.lit(0), F.lit(5))).alias("size")
    pairs = spark.range(33).select(F.col("id").alias("a")).join(spark.range(33).select(F.col("id").alias("b"))).where("a <= b")
    split = pairs.select("a", "b", sizes).select("a", "b", "size", F.explode(blocks_of(F.col("a"), F.col("b"), F.col("size"))).alias("block"))
    held = split.select("a", "b", F.explode(F.sequence(F.expr("shiftleft(block, size)"), F.expr("shiftleft(block + 1, size) - 1"))).alias("n"))
    assert sorted(map(tuple, held.collect())) == sorted((a, b, n) for a in range(33) for b in range(a, 33) for n in range(a, b))


CONTROL = "offer string, uc1_priority int, active_flg_kd int, active_flg_fb int, active_flg_pt int, target_rlp_min int, target_rlp_max int, min_ctr string, min_landings string, min_submits string, min_s2l string, max_cps string"


def offers_and_prices(spark, seed):
    rnd = random.Random(seed)

    def flag():
        return rnd.choice([None, 0, 1])

    offers = []
    for k in range(40):
        low = rnd.choice([-99999, rnd.randint(0, 4000), 2000])
        high = rnd.choice([99999, low + rnd.randint(-100, 1500), low])
        offers.append((f"o{k % 33}", rnd.choice([None, rnd.randint(1, 9)]), flag(), flag(), flag(), low, high, "0.1", "1", "2", None, "3"))
    prices = [None, 2000.0, float("inf"), -1e300, 1e300, float("nan"), -99999.0, 99999.0] + [rnd.randint(0, 8000) / 2 for _ in range(150)]
    devices = [(rnd.choice([None, f"d{k}"]), p) for k, p in enumerate(prices * 2)]
    return spark.createDataFrame(offers, CONTROL), spark.createDataFrame(devices, "dvc_techname string, price double")


@pytest.mark.parametrize("seed", range(2))
def test_intervals_stand_for_the_pairs_of_offers_and_prices(spark, ranges, seed):
    active, prices = offers_and_prices(spark, seed)
    pairs, intervals = price_offers(active, prices), price_intervals(active, prices)
    held = intervals.offers.select(*TERMS, F.explode(F.sequence(F.col("first"), F.col("stop") - 1)).alias("number"))
    assert rows(held.join(intervals.prices, "number").select(*TERMS, "price").distinct()) == rows(pairs)
    assert rows(offer_list(intervals.offers)) == rows(offer_list(pairs))
    best = _best_by_price(intervals.offers, intervals.prices, CHANNELS)
    assert rows(best) == rows(_best_per_flag(pairs, "price", CHANNELS).select(*best.columns))


def test_intervals_without_offers_or_prices(spark):
    active, prices = offers_and_prices(spark, 5)
    for a, p in ((active.limit(0), prices), (active, prices.limit(0))):
        intervals = price_intervals(a, p)
        assert rows(intervals.offers) == [] == rows(_best_by_price(intervals.offers, intervals.prices, CHANNELS))
