import datetime as dt

from rulecast.plans.feedback import daily_feedback, event_feedback, tap_feedback
from frames import ANDROID_UA, EVENTS, TAPS, event, rows, tap

DAY = dt.date(2017, 2, 1)
KEY = (DAY, "mgm", "kd", "ANDROID", "sm-j700f")


def taps(spark, *items):
    return spark.createDataFrame(list(items), TAPS)


def events(spark, *items):
    return spark.createDataFrame(list(items), EVENTS)


def test_counts_multiply_over_nested_elements(spark):
    df = taps(spark, tap(ids=2, cats=3, refs=2), tap("click", ids=2), tap(ids=0), tap(cats=0), tap(refs=0))
    assert rows(tap_feedback(df, "2017-02-01")) == [(*KEY, 12, 2, 2017, 2, 1)]
    assert rows(tap_feedback(df, "2017-02-01", count_mode="event")) == [(*KEY, 1, 1, 2017, 2, 1)]


def test_only_campaign_taps_of_the_day_count(spark):
    df = taps(
        spark, tap(), tap(campaign=1), tap("view"), tap(day="2017-02-02"), tap(day="2016-02-01"),
        tap(day="2017-02-01", sighted="2017-01-31"),
    )
    assert rows(tap_feedback(df, DAY)) == [
        (dt.date(2017, 1, 31), *KEY[1:], 1, 0, 2017, 2, 1),
        (*KEY, 1, 0, 2017, 2, 1),
    ]


def test_channel_of_taps(spark):
    df = taps(spark, tap(), tap(campaign=5413))
    assert [r[2] for r in rows(tap_feedback(df, DAY))] == ["kd"]
    assert [r[2] for r in rows(tap_feedback(df, DAY, tap_source="campaign"))] == ["kd", "pt"]


def test_user_agents_of_one_device_add_up(spark):
    other = "Mozilla/5.0 (Linux; Android 6.0; SM-J700F Build/MMB29K) Chrome"
    df = taps(spark, tap(), tap(agent=other), tap(tactic=238642), tap(tactic=7))
    assert rows(tap_feedback(df, DAY)) == [
        (*KEY, 3, 0, 2017, 2, 1),
        (DAY, None, "kd", "ANDROID", "sm-j700f", 1, 0, 2017, 2, 1),
    ]


def test_event_filters_and_flags(spark):
    df = events(
        spark, event(ids=2), event("form-submit"), event("click"), event(prop="1"),
        event(url="http://kaidee.com/x"), event(url=None), event(ids=0),
    )
    assert rows(event_feedback(df, DAY)) == [(*KEY, 2, 1, 2017, 2, 1)]


def test_sides_meet_by_all_keys_but_not_by_null(spark):
    t = taps(spark, tap(), tap(tactic=7), tap(agent=None))
    e = events(spark, event(), event(url="http://pantip.com/specialoffer/mgm.html"), event(agent=None))
    assert rows(daily_feedback(t, e, DAY)) == sorted(
        [
            (*KEY, 1, 0, 1, 0, 2017, 2, 1),
            (DAY, None, "kd", "ANDROID", "sm-j700f", 1, 0, None, None, 2017, 2, 1),
            (DAY, "mgm", "pt", "ANDROID", "sm-j700f", None, None, 1, 0, 2017, 2, 1),
            (DAY, "mgm", "kd", "ANDROID", None, 1, 0, None, None, 2017, 2, 1),
            (DAY, "mgm", "kd", "ANDROID", None, None, None, 1, 0, 2017, 2, 1),
        ],
        key=repr,
    )


def test_a_range_gives_the_days_of_single_runs(spark):
    days = ["2016-12-31", "2017-01-01", "2017-01-31", "2017-02-01"]
    t = taps(spark, *(tap(day=d) for d in days), tap(day="2017-02-02"))
    e = events(spark, *(event(day=d, agent=ANDROID_UA.format(a)) for d in days for a in ("X9", "SM-J700F")))
    single = [r for d in days for r in rows(daily_feedback(t, e, d))]
    assert rows(daily_feedback(t, e, days[0], days[-1])) == sorted(single, key=repr)
    assert len(single) == 8
