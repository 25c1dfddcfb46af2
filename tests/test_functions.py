import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from rulecast.functions.dates import date_of_parts, utc_date
from rulecast.functions.numbers import as_number, at_least_ratio, at_most_cost, whole_or_text
from rulecast.functions.offers import (
    TACTIC_OFFERS,
    campaign_to_source,
    referrer_to_offer,
    referrer_to_source,
    tactic_to_offer,
)
from rulecast.functions.text import clean_token, rule_pattern, rule_text
from rulecast.plans.catalog import impute_price


def one(spark, column, **values):
    kinds = {str: "string", int: "bigint", float: "double", type(None): "string"}
    schema = ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column).first()[0]


@pytest.mark.parametrize(
    "url, offer, source",
    [
        ("http://kaidee.com/specialoffer/MNP-Vivo-V5-lite.html", "mnp-vivo-v5", "kd"),
        ("http://pantip.com/specialoffer/sim-nice-number-v2.html?x=1", "sim-nice-number", "pt"),
        ("http://facebook.com/specialoffer/special-package.html", "tariff", "fb"),
        ("http://x.org/specialoffer/asus-zenfone-45-max.html", "mnp-asus-zenfone-45", "oth"),
        ("http://x.org/specialoffer/mnp-huawei-p9-plus.html", "mnp-huawei-p9", "oth"),
        ("http://x.org/page", "http://x.org/page", "oth"),
    ],
)
def test_referrer(spark, url, offer, source):
    assert one(spark, referrer_to_offer(F.col("u")), u=url) == offer
    assert one(spark, referrer_to_source(F.col("u")), u=url) == source


def test_codes(spark):
    assert len(TACTIC_OFFERS) == 71 and len(set(TACTIC_OFFERS.values())) == 23
    assert one(spark, tactic_to_offer(F.col("t")), t=241985) == "mgm"
    assert one(spark, tactic_to_offer(F.col("t")), t=1) is None
    assert one(spark, campaign_to_source(F.col("t")), t=5413) == "pt"


@pytest.mark.parametrize(
    "name, token",
    [
        ("sm-j700f", "sm-j700f"),
        ("www.shop.com x9", " x9"),
        ("sprd-b12", "b12"),
        ("en-1 z10", "z10"),
        ("th--1 lenny", "lenny"),
        ("x9 dual sim", "x9 "),
        ("a5 opera mini", "a5"),
        ("a5-orange uk", "a5"),
        ("iphone os 9", "iphone os 9"),
    ],
)
def test_clean_token(spark, name, token):
    assert one(spark, clean_token(F.col("n")), n=name) == token


@pytest.mark.parametrize("name, token", [("sprd- ab", "ab"), ("telecom-2 x1", "x1")])
def test_overlapping_marks_cut_the_longest_head(spark, name, token):
    assert one(spark, clean_token(F.col("n")), n=name) == token


@pytest.mark.parametrize(
    "mark, price",
    [("iris", "80"), ("lava", "80"), ("smart", "80"), ("true", "80"), ("dtac", "80"), ("joey", "80"), ("blade", "80"),
     ("eagle", "80"), ("i-mobile", "130"), ("i-style", "130"), ("vivo", "340"), ("asus", "125"), ("htc", "470"), ("lg", "270"),
     ("huawei", "300"), ("sm-", "370"), ("gt-", "370"), ("x9009", "400"), ("wiko", "130"), ("nokia", None)],
)
def test_price_by_mark(spark, mark, price):
    assert one(spark, impute_price(F.col("n"), F.lit(None).cast("string")), n=f"a {mark}1") == price
    assert one(spark, impute_price(F.col("n"), F.lit("7")), n=mark) == "7"


def test_rule_text_and_pattern(spark):
    rule = one(spark, rule_text(F.col("t")), t="a1|b2")
    assert rule == 'userAgent(".*(?i)(a1|b2).*")'
    assert one(spark, rule_pattern(F.col("r")), r=rule) == "(?i)(a1|b2)"
    assert one(spark, rule_text(F.col("t")), t=None) is None


@pytest.mark.parametrize(
    "clicks, imps, passes",
    [(1.0, 100.0, True), (1.0, 1000.0, False), (5.0, 0.0, True), (0.0, 0.0, False), (5.0, None, False)],
)
def test_ratio_gate_with_zero_impressions(spark, clicks, imps, passes):
    gate = F.coalesce(
        at_least_ratio(F.col("c").cast("double"), F.col("i").cast("double"), F.lit(0.005)),
        F.lit(False),
    )
    assert one(spark, gate, c=clicks, i=imps) is passes
    unknown = at_least_ratio(F.col("c"), F.col("i").cast("double"), F.lit(None).cast("double"))
    assert one(spark, F.coalesce(unknown, F.lit(False)), c=clicks, i=imps) is False


@pytest.mark.parametrize(
    "cost, units, passes", [(3.0, 1.0, True), (31.0, 1.0, False), (0.0, 0.0, False), (5.0, 0.0, False)]
)
def test_cost_gate_without_units(spark, cost, units, passes):
    gate = at_most_cost(F.col("c"), F.col("u"), F.lit(30.0))
    assert one(spark, gate, c=cost, u=units) is passes


def test_numbers_as_text(spark):
    assert one(spark, as_number(F.col("t")), t="null") is None
    assert one(spark, as_number(F.col("t")), t="0.05") == 0.05
    assert one(spark, whole_or_text(F.col("x")), x=3.0) == "3"
    assert one(spark, whole_or_text(F.col("x")), x=6.5) == "6.5"


@pytest.mark.parametrize(
    "parts, day",
    [
        (("2017", "1", "2"), dt.date(2017, 1, 2)),
        (("2017", "01", "02"), dt.date(2017, 1, 2)),
        (("2017", "2", "30"), None),
        (("2017", None, "2"), None),
        (("start_year", "start_month", "start_day"), None),
    ],
)
def test_date_of_parts(spark, parts, day):
    column = date_of_parts(F.col("y"), F.col("m"), F.col("d"))
    assert one(spark, column, **dict(zip("ymd", parts))) == day


def test_day_of_epoch_is_utc(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Bangkok")
        late = 1485993599999  # 2017-02-01 23:59:59.999 UTC
        assert one(spark, utc_date(F.col("ms")), ms=late) == dt.date(2017, 2, 1)
        assert one(spark, utc_date(F.col("ms")), ms=late + 1) == dt.date(2017, 2, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_rule_matches_its_tokens(spark):
    tokens = ["sm-j700f", "iphone; ios", "a1601"]
    rule = one(spark, rule_pattern(rule_text(F.col("t"))), t="|".join(tokens))
    assert all(re.search(rule.replace("(?i)", ""), t) for t in tokens)
