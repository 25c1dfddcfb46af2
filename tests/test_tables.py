import datetime as dt
import glob

from pyspark.sql import functions as F

from rulecast.plans import feedback, jobs
from rulecast.plans.rules import build_rules
from rulecast.sources.readers import date_window, in_months, on_days, one_day, preview
from rulecast.sources.writers import replace_table, write_day, write_days
from frames import CONTROL, EVENTS, PROPERTIES, TAPS, control_row, event, rows, tap


def read(spark, path):
    return spark.read.parquet(str(path))


def days(spark, *items):
    return spark.createDataFrame(list(items), "v int, year int, month int, day int")


def test_one_day_overwrites_only_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    write_days(days(spark, (1, 2017, 1, 31), (2, 2017, 2, 1)), path)
    write_day(days(spark, (3, 2017, 2, 1)), path, "2017-02-01")
    write_day(days(spark, (3, 2017, 2, 1)), path, dt.date(2017, 2, 1))
    assert rows(read(spark, path)) == [(1, 2017, 1, 31), (3, 2017, 2, 1)]
    write_day(days(spark, (4, 2017, 2, 1)), path, "2017-02-01", mode="append")
    assert len(rows(one_day(read(spark, path), "2017-02-01"))) == 2
    write_day(days(spark, (4, 2017, 2, 1)).where("v < 0"), path, "2017-02-01")
    assert rows(read(spark, path)) == [(1, 2017, 1, 31)]


def test_many_days_replace_the_days_they_hold(spark, tmp_path):
    path = str(tmp_path / "t")
    write_days(days(spark, (1, 2016, 12, 31), (2, 2017, 1, 1)), path)
    write_days(days(spark, (5, 2017, 1, 1), (6, 2017, 1, 2)), path)
    table = read(spark, path)
    assert rows(table) == [(1, 2016, 12, 31), (5, 2017, 1, 1), (6, 2017, 1, 2)]
    assert rows(date_window(table, "2016-12-31", "2017-01-01").select("v")) == [(1,), (5,)]
    assert rows(table.where(in_months((2016, 12), (2016, 12))).select("v")) == [(1,)]
    assert preview(table, 2).count() == 2


def test_replace_table(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(3), path)
    replace_table(spark.range(1), path)
    assert read(spark, path).count() == 1


def test_jobs_end_to_end(spark, tmp_path):
    p = {n: str(tmp_path / n) for n in ("taps", "events", "fb", "control", "props", "rules", "one", "csv")}
    agents = [f"Mozilla (Linux; Android 6.0; DEV{i} Build/M) Safari" for i in range(22)]
    spark.createDataFrame(
        [tap(a, day=f"2017-01-{10 + i % 4}", agent=g) for i, g in enumerate(agents) for a in ("impression", "click")],
        TAPS,
    ).write.partitionBy("year", "month", "day").parquet(p["taps"])
    spark.createDataFrame(
        [event(a, day=f"2017-01-{10 + i % 4}", agent=g) for i, g in enumerate(agents) for a in ("undefined", "submit")],
        EVENTS,
    ).write.partitionBy("year", "month", "day").parquet(p["events"])
    jobs.init_feedback(spark, p["taps"], p["events"], p["fb"], start="2017-01-10", end="2017-01-12")
    jobs.run_feedback(spark, p["taps"], p["events"], p["fb"], "2017-01-13")
    before = rows(read(spark, p["fb"]))
    assert len(before) == 22 and all(r[5:9] == (1, 1, 1, 1) for r in before)
    jobs.run_feedback(spark, p["taps"], p["events"], p["fb"], "2017-01-13")
    assert rows(read(spark, p["fb"])) == before

    spark.createDataFrame(
        [control_row("mgm", 1, fb=None, pt=None), control_row("tariff", 2, kd=None, fb=None)], CONTROL
    ).write.parquet(p["control"])
    spark.createDataFrame([("asus", "80"), ("htc 1", "90")], PROPERTIES).write.parquet(p["props"])
    inputs = (p["control"], p["props"], p["fb"])
    jobs.init_rules(spark, p["rules"])
    jobs.run_daily_rules(spark, *inputs, p["rules"], "2017-01-14")
    jobs.run_daily_rules(spark, *inputs, p["rules"], "2017-01-15")
    jobs.run_daily_rules(spark, *inputs, p["rules"], "2017-01-15")
    devices = "|".join(sorted(f"dev{i}" for i in range(22)))
    expected = [(c, "mgm", 1, f'userAgent(".*(?i)({devices}).*")') for c in ("kd", "kd_app")]
    expected.append(("pt", "tariff", 2, 'userAgent(".*(?i)(htc 1).*")'))
    table = jobs.rules_of_day(spark, p["rules"], "2017-01-15")
    assert [tuple(r)[:4] for r in table.collect()] == expected
    assert read(spark, p["rules"]).count() == 6

    jobs.run_rules_one_day(spark, *inputs, p["one"], "2017-01-15")
    assert rows(read(spark, p["one"])) == expected

    jobs.export_rules(spark, p["rules"], p["csv"], "2017-01-15")
    (part,) = glob.glob(p["csv"] + "/part-*.csv")
    lines = open(part).read().splitlines()
    assert lines[0] == "CHANNEL, OFFER, PRIORITY ORDER, RULE, YEAR, MONTH, DAY"
    assert lines[1].startswith('kd,mgm,1,"userAgent("".*(?i)(dev0|') and lines[1].endswith(',2017,1,15')
    assert [line.split(",")[0] for line in lines[1:]] == ["kd", "kd_app", "pt"]


def test_feedback_scan_reads_only_what_it_counts(spark, tmp_path):
    from rulecast.plans.feedback import tap_feedback

    path = str(tmp_path / "taps")
    spark.createDataFrame([tap(), tap(day="2017-02-02")], TAPS).write.partitionBy("year", "month", "day").parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", 10000)
    plan = tap_feedback(read(spark, path), "2017-02-01")._jdf.queryExecution().executedPlan().toString()
    assert "query_params:array<struct<key:string>>" in plan and "http_headers:array<struct<key:string>>" in plan
    assert "PartitionFilters: [isnotnull(year" in plan and "Generate" not in plan
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_build_rules_survives_an_empty_input(spark):
    empty = spark.createDataFrame([], "source string, offer string, uc1_priority int, dvc_techname string")
    assert rows(build_rules(empty)) == []


def test_backfill_leaves_what_daily_runs_would(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "feedback")
    monkeypatch.setattr(
        feedback, "daily_feedback", lambda taps, events, start, end=None: taps.where(on_days(start, end))
    )
    first = str(tmp_path / "first")
    days(spark, (1, 2017, 1, 9), (2, 2017, 1, 10), (3, 2017, 1, 11)).write.parquet(first)
    jobs.backfill_feedback(spark, first, first, out, "2017-01-09", "2017-01-11")
    second = str(tmp_path / "second")
    days(spark, (7, 2017, 1, 11), (8, 2017, 1, 12)).write.parquet(second)
    jobs.backfill_feedback(spark, second, second, out, "2017-01-10", "2017-01-11")
    assert rows(spark.read.parquet(out).select("v", "day")) == [(1, 9), (7, 11)]
