import datetime as dt

import pytest

from rulecast.plans.assignment import assign_devices
from rulecast.plans.offers import (
    active_offers,
    control_devices,
    offer_list,
    shape_offer_control,
)
from rulecast.plans.outcomes import (
    Evidence,
    device_outcomes,
    device_totals,
    feedback_devices,
    landing_devices,
    offer_activity,
    offer_choices,
    offer_terms,
    success_devices,
)
from rulecast.plans.rules import build_rules, daily_rules, rules_one_day
from rulecast.sources.readers import read_offer_control
from frames import CONTROL, FEEDBACK, PROPERTIES, control_row, history, rows

DAY = dt.date(2017, 2, 1)
SMALL = Evidence(launch_days=3, converting_devices=2, few_successes=3)

CSV = """Offer,UC1_priority,Active_flg_kd,Active_flg_fb,Active_flg_pt,Screen,RRP,Price,Pack,y,m,d,y,m,d,lo,hi,a,b,c,d,e
first,1,1,1,1,5.5,4990,0,599,2017,1,2,2017,2,13,,6000,0.005,1,1,0.05,30
second,x,,,,5.5,4990,,,2016,12,5,2017,2,1,12000,,0.005,1,1,0.05,30
third,3,0,,1,,,,,2017,02,01,2017,3,1,,,0.005,1,1,0.05,30
fourth,,,,,5,,,,2017,1,1,2017,3,1,,,0.005,1,1,0.05,30
fifth,5,1,,,5,,,,,1,1,2017,3,1,,,0.005,1,1,0.05,30
"""


@pytest.fixture
def control_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text(CSV)
    (tmp_path / "b.csv").write_text("no-title,2,1,1,1,5,1,1,1,2017,1,2,2017,2,28,,12000,0.005,1,1,0.05,30\n")
    return shape_offer_control(read_offer_control(spark, str(tmp_path)))


def test_offer_control_file(control_csv):
    read = {r.offer: r for r in control_csv.collect()}
    assert set(read) == {"first", "second", "third", "fourth", "fifth", "no-title"}
    assert (read["first"].target_rlp_min, read["first"].target_rlp_max) == (-99999, 6000)
    assert (read["second"].uc1_priority, read["second"].target_rlp_max) == (None, 99999)
    assert (read["third"].start_date, read["third"].end_date) == (dt.date(2017, 2, 1), dt.date(2017, 3, 1))
    assert read["fifth"].start_date is None


def test_active_offers(control_csv):
    def on(day):
        return {r.offer for r in active_offers(control_csv, day).collect()}

    assert on("2017-02-01") == {"first", "third", "no-title"}
    assert on("2017-01-31") == {"first", "no-title"}
    assert on("2017-02-13") == {"third", "no-title"}
    assert on("2017-01-01") == set()


def control(spark, *items):
    return spark.createDataFrame(list(items), CONTROL)


def properties(spark, **prices):
    return spark.createDataFrame(list(prices.items()), PROPERTIES)


def feedback(spark, *parts):
    return spark.createDataFrame([r for p in parts for r in p], FEEDBACK)


def test_price_range_is_inclusive_and_ignores_unknown_prices(spark):
    offers = control(spark, control_row("a", low=4000, high=6000), control_row("b", 2, high=3999))
    props = properties(spark, x="100", y="150", z="150.5", n="null", m=None, w="99.9")
    pairs = control_devices(offers, props)
    assert rows(pairs.select("offer", "dvc_techname")) == [("a", "x"), ("a", "y"), ("b", "w")]
    listed = offer_list(control_devices(offers, properties(spark, x="100")))
    assert [r.offer for r in listed.collect()] == ["a"]
    assert listed.first().feedback_cond == "CTR>=0.005 and submits>=1 and S2L>=0.05 and CPS<=30"


def test_names_with_several_prices_are_listed_once(spark, monkeypatch):
    compared = []

    def counted(df):
        if {"offer", "dvc_techname"} <= set(df.columns):
            compared.append(df.count())
        return df.dropDuplicates()

    prices = [("x", str(p)) for p in range(100, 140)] + [("y", "100"), ("y", "110"), (None, "120"), (None, "121"), ("z", "null")]
    props = spark.createDataFrame(prices, PROPERTIES)
    one = [control_row("open"), control_row("a", low=4000, high=4400), control_row("a", low=4100, high=4800)]
    two = [control_row("b", low=4000, high=4010), control_row("b", low=4400, high=4400), control_row("c", low=9, high=8)]
    monkeypatch.setattr(type(props), "distinct", counted)
    listed = rows(control_devices(control(spark, *one), props).select("offer", "dvc_techname"))
    assert listed == sorted([(o, d) for o in ("open", "a") for d in ("x", "y", None)], key=repr)
    # Equal pairs come of terms with ranges apart only, not of every price of a name.
    assert sum(compared) == 0
    listed = rows(control_devices(control(spark, *one, *two), props).select("offer", "dvc_techname"))
    assert listed == sorted([(o, d) for o in ("open", "a") for d in ("x", "y", None)] + [("b", "x"), ("b", "y")], key=repr)


def test_prices_of_a_name_do_not_multiply_its_offers(spark, monkeypatch):
    met, join = [], type(spark.range(0)).join

    def counted(df, other, *args, **kwargs):
        joined = join(df, other, *args, **kwargs)
        if {"offer", "dvc_techname"} <= set(joined.columns):
            met.append(joined.count())
        return joined

    monkeypatch.setattr(type(spark.range(0)), "join", counted)
    names = [f"d{k}" for k in range(5)]
    props = spark.createDataFrame([(d, str(p)) for d in names for p in range(100, 140)], PROPERTIES)
    items = [control_row("open"), *(control_row(f"o{k}", low=4000, high=5000 + k) for k in range(9))]
    listed = rows(control_devices(control(spark, *items), props).select("offer", "dvc_techname"))
    assert listed == sorted((o, d) for o in ["open", *(f"o{k}" for k in range(9))] for d in names)
    # Pairs are made once, not for each of the 40 prices.
    assert 0 < sum(met) < 3 * len(listed)


def outcomes(spark, offers, fb, evidence=SMALL, **options):
    totals = device_totals(fb)
    terms = offer_terms(offers, offer_activity(fb, totals), evidence)
    return device_outcomes(totals, terms, **options)


def test_success_needs_days_devices_and_ratios(spark):
    offers = control(spark, *(control_row(o) for o in ("good", "short", "lonely", "zero")))
    fb = feedback(
        spark,
        history("good", ["a", "b", "COMPUTER", "IPAD"]),
        history("good", ["lowctr"], clicks=0),
        history("good", ["nosub"], submits=0),
        history("good", ["fbonly"], source="fb", imps=None, clicks=None),
        history("good", ["noimps"], imps=None, clicks=None),
        history("good", ["free"], imps=0, clicks=4),
        history("short", ["a", "b", "c", "d"], days=2),
        history("lonely", ["a", "a", "a"]),
        history("unknown", ["a", "b", "c"]),
    )
    got = rows(success_devices(outcomes(spark, offers, fb)))
    assert got == [("good", d) for d in ("a", "b", "fbonly", "free", "ipad", "windows nt")]


def test_s2l_gate_is_optional(spark):
    offers = control(spark, control_row("o", s2l="0.9"))
    fb = feedback(spark, history("o", ["a", "b", "c"]), history("o", ["d"], landings=2))
    assert len(rows(success_devices(outcomes(spark, offers, fb)))) == 4
    assert rows(success_devices(outcomes(spark, offers, fb, use_s2l=True))) == [("o", "d")]


def test_equally_named_offers_count_landings_once(spark):
    offers = control(spark, control_row("o", landings="9"), control_row("o", 2, landings="12", submits="9"))
    fb = feedback(spark, history("o", ["a", "b"]), history("o", ["a", "b", "c"], source="pt"))
    judged = outcomes(spark, offers, fb)
    assert rows(judged.where("landing").select("dvc_techname")) == [("a",), ("b",)]


def test_landings_replace_few_successes(spark):
    offers = control(spark, control_row("few"), control_row("many", 2), control_row("none", 3))
    weak = dict(clicks=0, submits=0)
    fb = feedback(
        spark,
        history("few", ["a", "b", "c"], submits=1, clicks=10),
        history("few", ["a", "b", "c"], source="pt", **weak),
        history("many", list("abcde")),
        history("none", ["x", "y", "z"], clicks=0),
        history("few", ["land"], **weak),
    )
    judged = outcomes(spark, offers, fb, Evidence(3, 2, 4))
    choices = offer_choices(judged, Evidence(3, 2, 4))
    assert rows(success_devices(judged)) == [(o, d) for o, ds in (("few", "abc"), ("many", "abcde")) for d in ds]
    assert rows(landing_devices(judged, choices)) == [("few", d) for d in ("a", "b", "c", "land")]
    assert rows(feedback_devices(offers, judged, choices)) == sorted(
        [("few", d) for d in ("a", "b", "c", "land")] + [("many", d) for d in "abcde"] + [("none", None)],
        key=repr,
    )


PAIR = """offer string, uc1_priority int, active_flg_kd int, active_flg_fb int, active_flg_pt int,
dvc_techname string"""
CHOSEN = "offer string, dvc_techname string"


def assigned(spark, pairs, chosen):
    got = assign_devices(spark.createDataFrame(pairs, PAIR), spark.createDataFrame(chosen, CHOSEN))
    return rows(got.select("source", "offer", "uc1_priority", "dvc_techname"))


def test_feedback_devices_replace_control_devices(spark):
    pairs = [("o", 1, 1, None, None, "aaa"), ("o", 1, 1, None, None, "bbb"), ("p", 2, 1, None, None, "ccc")]
    got = assigned(spark, pairs, [("o", "xxx"), ("p", None)])
    expected = [("o", 1, "xxx"), ("p", 2, "ccc")]
    assert got == sorted((c, *e) for c in ("kd", "kd_app") for e in expected)


def test_an_unnamed_feedback_device_keeps_the_control_devices(spark):
    pairs = [("o", 1, None, None, 1, "aaa")]
    assert assigned(spark, pairs, [("o", "xxx"), ("o", None)]) == [
        ("pt", "o", 1, "aaa"), ("pt", "o", 1, "xxx"),
    ]


def test_lowest_priority_wins_per_channel_and_ties_share(spark):
    pairs = [
        ("a", 2, None, 1, 0, "dev1"), ("b", 1, None, 1, 1, "dev1"), ("c", 1, None, 1, 1, "other"),
        ("d", None, None, 1, 1, "lost"), ("e", 3, None, 0, 1, "dev1"),
    ]
    got = assigned(spark, pairs, [])
    assert got == sorted(
        [(s, o, 1, d) for s in ("fb", "pt") for o in ("b", "c") for d in ("dev1", "other")]
    )
    winners = {}
    for source, _, priority, device in got:
        winners.setdefault((source, device), set()).add(priority)
    assert all(len(p) == 1 for p in winners.values())


def test_iphones_are_renamed_per_channel(spark):
    pairs = [("o", 1, 1, 1, 1, d) for d in ("iphone os 9", "iphone os 10", "a1")]
    got = assigned(spark, pairs, [])
    assert got == sorted(
        [("kd", "o", 1, "iphone os 9"), ("kd", "o", 1, "iphone os 10"),
         ("pt", "o", 1, "iphone os 9"), ("pt", "o", 1, "iphone os 10"),
         ("kd_app", "o", 1, "iphone; ios"), ("fb", "o", 1, "apple iphone")]
    )


def test_rules_are_sorted_and_exclude_brands(spark):
    tokens = spark.createDataFrame(
        [("kd", "o", 1, t) for t in ("vivo", "vivo v5", "b2 ", "a10")] + [("kd", "p", 2, "asus")],
        "source string, offer string, uc1_priority int, dvc_techname string",
    )
    assert rows(build_rules(tokens)) == [("kd", "o", 1, 'userAgent(".*(?i)(a10|b2|vivo v5).*")')]


def test_daily_and_one_day_rules(spark):
    offers = control(spark, control_row("o", 1, kd=1, fb=None, pt=None), control_row("old", 1, end="2017-02-01"))
    props = properties(spark, smart="80", a1601="100", htc="50")
    fb = feedback(spark, history("other", ["x"]))
    rule = 'userAgent(".*(?i)({}).*")'
    assert rows(daily_rules(offers, props, fb, DAY)) == [
        (c, "o", 1, rule.format("a1601|htc|smart"), 2017, 2, 1) for c in ("kd", "kd_app")
    ]
    assert rows(daily_rules(offers, props, fb, DAY, materialized=False)) == rows(
        daily_rules(offers, props, fb, DAY)
    )
    assert rows(rules_one_day(offers, props, fb, DAY)) == [
        (c, "o", 1, rule.format("a1601")) for c in ("kd", "kd_app")
    ]


def test_history_start_limits_feedback(spark):
    offers = control(spark, control_row("o", 1, fb=None, pt=None))
    fb = feedback(spark, history("o", ["aaa", "bbb", "ccc"]))
    props = properties(spark, zzz="80")
    chosen = daily_rules(offers, props, fb, DAY, evidence=SMALL)
    assert {r.rule for r in chosen.collect()} == {'userAgent(".*(?i)(aaa|bbb|ccc).*")'}
    later = daily_rules(offers, props, fb, DAY, evidence=SMALL, history_start="2017-01-02")
    assert {r.rule for r in later.collect()} == {'userAgent(".*(?i)(zzz).*")'}
