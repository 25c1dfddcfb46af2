"""Distinct counts merged from stored days against counting all rows again."""

import random

import pytest
from pyspark.sql import functions as F

from rulecast.operators import distinct_state
from rulecast.operators.distinct_state import (
    distinct_ids,
    distinct_ids_without,
    estimated_ids,
    id_blocks,
    id_sketches,
    merged,
    new_numbers,
)
from rulecast.plans import jobs
from rulecast.plans.audience import cluster_reach, model_reach
from rulecast.plans.reach_state import cluster_reach_of, model_reach_of
from rulecast.sources.readers import on_days
from frames import rows

DATASET = """device_id string, model string, vendor string, user_agent string, id_type string,
event_source string, carrier string, year int, month int, day int"""


def sightings(spark, seed, n=3000, ids=400):
    rnd = random.Random(seed)
    kinds, agents = ["HARDWARE_IDFA", "HARDWARE_ANDROID_AD_ID", "COOKIE"], ["SM-J700F x", "gt-9 y", "iris 405", None, "sm-a1 gt-9"]
    return spark.createDataFrame(
        [
            (
                rnd.choice([None, *(f"id{k}" for k in range(ids))]) if rnd.random() < 0.5 else "hot", rnd.choice(["m1", "m2", None]), rnd.choice(["v", "w"]),
                rnd.choice(agents), rnd.choice(kinds), rnd.choice(["app", "click"]), rnd.choice(["OWN", "A", "B", "Z", None]), 2017, 1 + k % 2, 1 + k % 9,
            )
            for k in range(n)
        ],
        DATASET,
    )


NUMBERS = "id string, number bigint"
WINDOWS = [("2017-01-01", "2017-12-31"), ("2017-01-03", "2017-02-04"), ("2017-02-09", "2017-02-09")]


def test_numbers_go_on_without_gaps_and_stay(spark):
    known = spark.createDataFrame([("a", 0), ("b", 1)], NUMBERS)
    ids = spark.createDataFrame([(None,), ("b",), *((f"x{k}",) for k in range(500)), ("x1",)], "device string").repartition(7)
    found = rows(new_numbers(ids, "device", known))
    assert sorted(n for _, n in found) == list(range(2, 502)) and {i for i, _ in found} == {f"x{k}" for k in range(500)}
    assert rows(new_numbers(ids.limit(0), "device", known)) == []
    assert sorted(n for _, n in rows(new_numbers(ids, "device", known.limit(0)))) == list(range(501))


@pytest.mark.parametrize("few", [0, 3, 10**6])
def test_merged_blocks_count_distinct_ids(spark, monkeypatch, few):
    monkeypatch.setattr(distinct_state, "FEW", few)
    seen = spark.range(200_000).select((F.col("id") % 70_001).alias("device"), (F.col("id") % 3).alias("day"), F.when(F.col("id") % 5 != 0, F.col("id") % 2).alias("g"))
    seen = seen.unionByName(spark.createDataFrame([(None, 0, 1)], "device bigint, day bigint, g bigint"))
    numbers = new_numbers(seen, "device", spark.createDataFrame([], "id bigint, number bigint"))
    blocks = id_blocks(seen, ["day", "g"], "device", distinct_state.materialize(numbers))
    assert blocks.where("(few is null) = (bits is null)").count() == 0
    for keep in ("true", "day < 2", "day = 5"):
        want = seen.where(keep).groupBy("g").agg(F.countDistinct("device").alias("reach"))
        assert rows(distinct_ids(blocks.where(keep), ["g"])) == rows(want)
    all_ = distinct_ids(blocks, [])
    assert all_.first()[0] == 70_001
    assert merged(blocks, ["g"]).groupBy("g", "block").count().where("count > 1").count() == 0
    less = distinct_ids_without(blocks, ["g"], F.col("day") == 0, F.col("day") == 1)
    sets = {}
    for device, day, g in seen.distinct().collect():
        sets.setdefault((g, day), set()).add(device)
    want = {g: len({d for d in sets.get((g, 0), set()) - sets.get((g, 1), set()) if d is not None}) for g in (0, 1, None)}
    assert dict(rows(less)) == {g: n for g, n in want.items() if n}


def test_stored_days_give_the_reach_of_any_window(spark, tmp_path):
    data, numbers, state = (str(tmp_path / n) for n in ("data", "numbers", "state"))
    all_ = sightings(spark, 1)
    all_.write.partitionBy("year", "month", "day").parquet(data)
    for day in ("2017-01-01", "2017-01-03", "2017-01-03"):
        jobs.update_reach_state(spark, data, numbers, state, day)
    jobs.update_reach_state(spark, data, numbers, state, "2017-01-01", "2017-03-01")
    known = spark.read.parquet(numbers)
    assert known.count() == known.select("id").distinct().count() == all_.select("device_id").where("device_id is not null").distinct().count()
    stored = spark.read.parquet(state)
    for window in WINDOWS:
        got = model_reach_of(stored, window, "HARDWARE_IDFA", "v", "click")
        want = model_reach(all_.where(on_days(*window)), "HARDWARE_IDFA", "v", "click", 2017).where("reach > 0")
        assert rows(got) == rows(want)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "device_id" not in plan and "carrier" not in plan
    reach = [r.reach for r in model_reach_of(stored, WINDOWS[0], "HARDWARE_IDFA", "v", "click").collect()]
    assert reach == sorted(reach, reverse=True)


def test_stored_clusters_give_the_reach_beyond_the_own_carrier(spark, tmp_path):
    data, numbers, state, rules = (str(tmp_path / n) for n in ("data", "numbers", "state", "rules"))
    all_ = sightings(spark, 2)
    all_.write.partitionBy("year", "month", "day").parquet(data)
    patterns = {"1": "(?i)(sm-j700f|iris 405+)", "2": "(?i)(gt-9)", "3": "(?i)(none such)"}
    spark.createDataFrame([(k, f'userAgent(".*{p}.*")') for k, p in patterns.items()], "cluster_brand string, rule string").write.parquet(rules)
    jobs.update_reach_state(spark, data, numbers, state, "2017-01-01", "2017-03-01", cluster_rules=rules)
    stored = spark.read.parquet(state)
    for window in WINDOWS:
        for other in (None, WINDOWS[1]):
            got = rows(cluster_reach_of(stored, ["OWN"], ["A", "B"], window, other))
            assert got == rows(cluster_reach(all_, patterns, ["OWN"], ["A", "B"], window, other))
    # A day that has gone from the data goes from the state.
    spark.createDataFrame([], DATASET).write.mode("overwrite").parquet(data)
    jobs.update_reach_state(spark, data, numbers, state, "2017-01-01", "2017-01-31", cluster_rules=rules)
    assert {r[0] for r in spark.read.parquet(state).select("month").distinct().collect()} == {2}


def test_sketches_come_close(spark):
    seen = spark.range(60_000).select((F.col("id") % 20_011).alias("device"), (F.col("id") % 4).alias("day"))
    sketches = id_sketches(seen, ["day"], "device")
    assert sketches.count() == 4
    assert abs(estimated_ids(sketches, []).first()[0] - 20_011) < 0.05 * 20_011
    assert estimated_ids(sketches.where("day > 9"), ["day"]).collect() == []
