"""The state of the feedback after adding, replacing and removing days against the whole history."""

import datetime as dt
import random

import pytest

from rulecast.plans import jobs
from rulecast.plans.feedback_state import FeedbackState, advance, read_state
from rulecast.plans.outcomes import device_totals, launch_days
from rulecast.plans.rules import daily_rules, judged_offers
from rulecast.sources.readers import on_days
from rulecast.sources.schemas import FEEDBACK
from rulecast.sources.writers import write_days
from frames import CONTROL, PROPERTIES, control_row, rows

DAYS = [dt.date(2016, 12, 30) + dt.timedelta(days=k) for k in range(6)]


def feedback(spark, seed, days=DAYS, n=150):
    rnd = random.Random(seed)

    def row(day):
        measures = [rnd.choice([None, 0, 0, 1, 7]) for _ in range(4)]
        keys = rnd.choice([None, "o1", "o2", "o3"]), rnd.choice([None, "kd", "fb"]), rnd.choice(["ANDROID", "IPHONE"]), rnd.choice([None, "d1", "d2", "d3"])
        return (rnd.choice([day, day, None]), *keys, *measures, day.year, day.month, day.day)

    return spark.createDataFrame([row(d) for d in days for _ in range(rnd.randint(1, n))], FEEDBACK)


def state_equals(spark, path, history):
    state = read_state(spark, path)
    assert rows(state.totals()) == rows(device_totals(history))
    assert rows(state.launch_days()) == rows(launch_days(history))


@pytest.mark.parametrize("seed", range(2))
def test_days_enter_are_replaced_and_leave(spark, tmp_path, seed):
    path = str(tmp_path / "state")
    history = feedback(spark, seed)
    for day in DAYS[:3]:
        assert advance(history, path, day, day).written == [day]
    state_equals(spark, path, history.where(on_days(DAYS[0], DAYS[2])))
    # Two days at once, one of them known already.
    assert advance(history, path, DAYS[2], DAYS[5]).unchanged == [DAYS[2]]
    state_equals(spark, path, history)
    # Days 1 and 2 are written anew, day 3 has no feedback any more.
    later = history.where(~on_days(DAYS[1], DAYS[3])).unionByName(feedback(spark, seed + 50, DAYS[1:3]))
    done = advance(later, path, DAYS[0], DAYS[5])
    assert (done.written, done.removed) == (DAYS[1:3], [DAYS[3]]) and len(done.unchanged) == 3
    state_equals(spark, path, later)
    # The history begins later now; the days before it leave, and cannot enter.
    advance(later, path, DAYS[0], DAYS[5], DAYS[2])
    state_equals(spark, path, later.where(on_days(DAYS[2], DAYS[5])))
    advance(later.limit(0), path, DAYS[0], DAYS[5])
    assert rows(read_state(spark, path).totals()) == [] == rows(read_state(spark, path).launch_days())


def test_days_are_summed_and_staged_in_one_shuffle(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F
    from rulecast.plans.feedback_state import day_sums
    from rulecast.sources import publishing

    plans, finished = [], publishing._digests
    sums = day_sums(feedback(spark, 3))
    monkeypatch.setattr(type(sums), "repartition", lambda df, *by, f=type(sums).repartition: plans.append(by) or f(df, *by))
    publishing.stage_days(sums, str(tmp_path / "days"))
    assert not plans
    # The digest is the one that stored tables have.
    stored = spark.read.parquet(str(tmp_path / "days"))
    columns = [c for c in stored.columns if c not in publishing.PARTITION]
    second = F.xxhash64(F.lit("second"), *columns).cast("decimal(38,0)")
    days = stored.groupBy(*publishing.PARTITION).agg(F.sum(second).alias("s")).collect()
    assert {k: v[2] for k, v in finished(stored).items()} == {dt.date(r.year, r.month, r.day): str(r.s) for r in days}


def test_a_run_that_stops_leaves_or_finishes_the_state(spark, tmp_path, monkeypatch):
    from test_publishing import stop_at

    path = str(tmp_path / "state")
    history = feedback(spark, 9)
    advance(history, path, DAYS[0], DAYS[2])
    for method, after, decided in (("write", 0, False), ("move", 2, True)):
        with monkeypatch.context() as patch:
            stop_at(patch, method, after)
            with pytest.raises(RuntimeError, match="stopped"):
                advance(history, path, DAYS[3], DAYS[4])
        state_equals(spark, path, history.where(on_days(DAYS[0], DAYS[4] if decided else DAYS[2])))
    advance(history, path, DAYS[3], DAYS[4])
    state_equals(spark, path, history.where(on_days(DAYS[0], DAYS[4])))


def test_an_advance_reads_its_days_only(spark, tmp_path):
    table, path = str(tmp_path / "feedback"), str(tmp_path / "state")
    write_days(feedback(spark, 4), table)
    jobs.advance_feedback_state(spark, table, path, DAYS[0], DAYS[5])
    # Whatever else is not readable does not matter.
    for broken in (tmp_path / "feedback").glob("year=2017/month=1/day=1/*.parquet"):
        broken.write_bytes(b"no parquet")
    assert jobs.advance_feedback_state(spark, table, path, DAYS[5]).unchanged == [DAYS[5]]
    state_equals(spark, path, feedback(spark, 4))


def test_rules_from_the_state_equal_rules_from_the_history(spark, tmp_path):
    p = {n: str(tmp_path / n) for n in ("control", "props", "feedback", "state", "rules")}
    spark.createDataFrame([control_row("mgm", 1, fb=None, pt=None), control_row("tariff", 2, kd=None, fb=None)], CONTROL).write.parquet(p["control"])
    spark.createDataFrame([("asus", "80"), ("htc 1", "90")], PROPERTIES).write.parquet(p["props"])
    good = [(d, "mgm", "kd", "ANDROID", f"dev{i}", 10, 9, 8, 7, d.year, d.month, d.day) for d in DAYS[2:5] for i in range(22)]
    write_days(spark.createDataFrame(good, FEEDBACK), p["feedback"])
    jobs.advance_feedback_state(spark, p["feedback"], p["state"], DAYS[2], DAYS[4])
    jobs.init_rules(spark, p["rules"])
    jobs.run_daily_rules_from_state(spark, p["control"], p["props"], p["state"], p["rules"], "2017-01-14")
    history = spark.read.parquet(p["feedback"])
    control, props = spark.read.parquet(p["control"]), spark.read.parquet(p["props"])
    want = daily_rules(control, props, history, "2017-01-14")
    got = rows(spark.read.parquet(p["rules"]))
    assert got == rows(want) and any("dev21" in r[3] for r in got)
    with pytest.raises(ValueError, match="history"):
        judged_offers(control, read_state(spark, p["state"]), history_start="2017-01-01")
    plan = daily_rules(control, props, read_state(spark, p["state"]), "2017-01-14", materialized=False)
    files = plan.inputFiles()
    assert files and not any("/feedback/" in f or "/days/" in f for f in files)


def test_state_of_nothing(spark, tmp_path):
    path = str(tmp_path / "state")
    assert advance(spark.createDataFrame([], FEEDBACK), path, DAYS[0], DAYS[1]).written == []
    state = read_state(spark, path)
    assert isinstance(state, FeedbackState) and rows(state.totals()) == []
    only_null = spark.createDataFrame([(DAYS[0], None, "kd", "ANDROID", "d", 1, 1, 1, 1, 2016, 12, 30)], FEEDBACK)
    assert advance(only_null, path, DAYS[0], DAYS[0]).written == []
