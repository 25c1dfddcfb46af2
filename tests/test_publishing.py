"""Days of a table replaced as one step: unchanged days, crashes at every point, later writers."""

import datetime as dt
import glob
import os

import pytest

from rulecast.sources import publishing
from rulecast.sources.publishing import Files, Published, finish, replace_days
from rulecast.sources.writers import write_day
from frames import rows

JAN = [dt.date(2017, 1, d) for d in range(1, 32)]


def days(spark, *items):
    return spark.createDataFrame([(v, 2017, 1, d) for v, d in items], "v int, year int, month int, day int")


def held(spark, path):
    return [(r.v, r.day) for r in spark.read.schema("v int, year int, month int, day int").parquet(path).orderBy("day", "v").collect()]


def parts(path):
    return set(glob.glob(f"{path}/year=*/month=*/day=*/part-*"))


def left_over(path):
    return os.path.exists(f"{path}/_publish") and os.listdir(f"{path}/_publish")


def test_only_days_with_other_rows_are_written(spark, tmp_path):
    path = str(tmp_path / "t")
    first = replace_days(days(spark, (1, 1), (2, 2), (3, 3), (3, 3), (9, 20)), path, JAN[0], JAN[3])
    assert first == Published(JAN[:3]) and held(spark, path) == [(1, 1), (2, 2), (3, 3), (3, 3)]
    before = parts(path)
    again = replace_days(days(spark, (3, 3), (1, 1), (3, 3), (2, 2)).coalesce(1), path, JAN[0], JAN[3])
    assert again == Published(unchanged=JAN[:3]) and parts(path) == before
    # One repetition less, a day gone, a day new; the first day lies outside the range.
    third = replace_days(days(spark, (3, 3), (4, 4), (7, 1)), path, JAN[1], JAN[3])
    assert third == Published([JAN[2], JAN[3]], [JAN[1]]) and held(spark, path) == [(1, 1), (3, 3), (4, 4)]
    assert {p for p in before if "day=1/" in p} <= parts(path) and not left_over(path)


def test_a_day_written_by_others_is_compared_as_it_is(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_days(days(spark, (1, 1), (2, 2)), path, JAN[0], JAN[1])
    write_day(days(spark, (5, 1)), path, JAN[0])
    assert replace_days(days(spark, (1, 1), (2, 2)), path, JAN[0], JAN[1]) == Published([JAN[0]], [], [JAN[1]])
    write_day(days(spark, (2, 2)), path, JAN[1])
    assert replace_days(days(spark, (1, 1), (2, 2)), path, JAN[0], JAN[1]) == Published(unchanged=JAN[:2])
    assert held(spark, path) == [(1, 1), (2, 2)]


def stop_at(monkeypatch, method, after):
    """Let the n-th call of a file operation fail, as if the driver had died there."""
    calls, real = [0], getattr(Files, method)

    def failing(self, *args):
        calls[0] += 1
        if calls[0] > after:
            raise RuntimeError("stopped")
        return real(self, *args)

    monkeypatch.setattr(Files, method, failing)


@pytest.mark.parametrize("method, after, decided", [("write", 0, False), ("move", 0, False), ("move", 1, True), ("move", 2, True), ("remove", 1, True), ("remove", 2, True), ("remove", 3, True), ("write", 1, True)])
def test_a_run_that_stops_is_undone_or_finished(spark, tmp_path, monkeypatch, method, after, decided):
    path = str(tmp_path / "t")
    replace_days(days(spark, (1, 1), (2, 2), (3, 3)), path, JAN[0], JAN[3])
    with monkeypatch.context() as patch:
        stop_at(patch, method, after)
        with pytest.raises(RuntimeError, match="stopped"):
            replace_days(days(spark, (1, 1), (7, 2), (8, 4)), path, JAN[0], JAN[3])
    finish(spark, path)
    assert held(spark, path) == ([(1, 1), (7, 2), (8, 4)] if decided else [(1, 1), (2, 2), (3, 3)])
    assert not left_over(path)
    assert replace_days(days(spark, (1, 1), (7, 2), (8, 4)), path, JAN[0], JAN[3]).removed == ([] if decided else [JAN[2]])
    assert held(spark, path) == [(1, 1), (7, 2), (8, 4)]


def test_a_failing_job_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_days(days(spark, (1, 1)), path, JAN[0], JAN[0])
    broken = days(spark, (2, 1)).selectExpr("cast(raise_error('no') as int) as v", "year", "month", "day")
    with pytest.raises(Exception, match="no"):
        replace_days(broken, path, JAN[0], JAN[0])
    assert held(spark, path) == [(1, 1)]
    replace_days(days(spark), path, JAN[0], JAN[0])
    assert held(spark, path) == [] and not left_over(path)


def test_finishing_keeps_what_was_written_since(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    replace_days(days(spark, (1, 1), (2, 2), (3, 3)), path, JAN[0], JAN[2])
    with monkeypatch.context() as patch:
        patch.setattr(publishing, "_apply", lambda *args: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            replace_days(days(spark, (7, 1), (8, 2)), path, JAN[0], JAN[2])
    write_day(days(spark, (50, 1)), path, JAN[0])
    write_day(days(spark, (60, 3)), path, JAN[2])
    finish(spark, path)
    assert held(spark, path) == [(50, 1), (8, 2), (60, 3)]


def test_days_across_years_and_rows_with_nulls(spark, tmp_path):
    path = str(tmp_path / "t")
    some = spark.createDataFrame([(None, "a", 2016, 12, 31), (1.5, None, 2017, 1, 1), (None, None, 2017, 1, 1)], "x double, y string, year int, month int, day int")
    both = dt.date(2016, 12, 31), dt.date(2017, 1, 1)
    assert replace_days(some, path, *both).written == list(both)
    assert replace_days(some, path, *both).unchanged == list(both)
    swapped = spark.createDataFrame([(None, None, 2017, 1, 1), (1.5, "", 2017, 1, 1)], some.schema)
    assert replace_days(swapped, path, both[1], both[1]).written == [both[1]]
    assert len(rows(spark.read.parquet(path))) == 3
