import glob
import math
import random

import pytest
from pyspark.sql import functions as F

from rulecast.operators.aggregates import ordered_concat
from rulecast.operators.lineage import checkpoint_dir, materialize, scratch_tables
from rulecast.operators.merging import exclude, outer_merge, override
from rulecast.operators.nested import any_map_has_key, element_count, key_count, unnest, unnest_map
from rulecast.operators.prefixes import best_prefix_rank
from rulecast.operators.ranges import first_in_range, range_join
from rulecast.operators.skew import salted_join, tiled_join


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed, cell, bits", [(1, 1.0, 10), (2, 7.5, 6), (3, 1.0, 4), (4, 0.25, 18)])
def test_range_join_equals_nested_loop(spark, seed, cell, bits):
    rnd = random.Random(seed)
    points = [(i, rnd.choice([None, rnd.uniform(-300, 300), float(rnd.randint(-300, 300))])) for i in range(200)]
    ranges = []
    for j in range(40):
        low = rnd.randint(-350, 300)
        ranges.append((j, low, low + rnd.choice([0, 1, 5, 90, 500, -3])))
    points += [(900, math.inf), (901, -math.inf), (902, 1e300), (903, -1e300), (904, math.nan)]
    ranges += [(98, -99999, 99999), (99, None, 5)]
    p = spark.createDataFrame(points, "p int, x double")
    r = spark.createDataFrame(ranges, "r int, low int, high int")
    expected = sorted(
        (i, j)
        for i, x in points
        for j, low, high in ranges
        if x is not None and low is not None and low <= x <= high
    )
    got = range_join(p, r, "x", "low", "high", cell=cell, bits=bits).select("p", "r")
    assert rows(got) == sorted(expected, key=repr)


@pytest.mark.parametrize("seed, width, cell, bits", [(1, 0, 1.0, 10), (2, 20, 7.5, 6), (3, 9999, 1.0, 4), (4, 90, 0.25, 18)])
def test_first_in_range_equals_nested_loop(spark, seed, width, cell, bits):
    rnd = random.Random(seed)
    points = [(900, None, None), (901, math.inf, 1.0), (902, 1e300, -1e300), (903, -math.inf, None), (904, math.nan, math.inf)]
    for i in range(60):
        own = sorted({rnd.choice([rnd.uniform(-300, 300), float(rnd.randint(-300, 300))]) for _ in range(rnd.randint(1, 6))})
        points += [(i, x, before) for x, before in zip(own, [None, *own])]
    ranges = [(98, -99999, 99999), (99, None, 5)]
    for j in range(40):
        low = rnd.randint(-350, 300)
        ranges.append((j, low, low + rnd.choice([0, 1, 5, 90, 500, -3])))
    p = spark.createDataFrame(points, "p int, x double, before double")
    r = spark.createDataFrame(ranges, "r int, low int, high int")
    expected = [
        (i, x, j)
        for i, x, before in points
        for j, low, high in ranges
        if x is not None and low is not None and low <= x <= high and (before is None or before < low)
    ]
    got = first_in_range(p, r, "x", "before", "low", "high", width=width, cell=cell, bits=bits).select("p", "x", "r")
    assert rows(got) == sorted(expected, key=repr)


def like(name, pattern):
    """LIKE with the wildcards ``_`` and ``%`` and the escape ``\\``, by recursion."""
    if not pattern:
        return not name
    head = pattern[0]
    if head == "%":
        return any(like(name[i:], pattern[1:]) for i in range(len(name) + 1))
    if head == "\\" and len(pattern) > 1:
        return name[:1] == pattern[1] and like(name[1:], pattern[2:])
    return bool(name) and (head == "_" or name[0] == head) and like(name[1:], pattern[1:])


def test_prefix_match_equals_like(spark):
    rnd = random.Random(5)
    letters = "abc_%"
    names = {"".join(rnd.choice("abc_%-") for _ in range(rnd.randint(0, 7))) for _ in range(120)}
    patterns = [("".join(rnd.choice(letters) for _ in range(rnd.randint(0, 5))), i) for i in range(60)]
    patterns += [("a\\_b", -1), ("\\%", -2), ("\\c", 0), ("ab\\", -3), (None, -9), ("ab", None)]
    n = spark.createDataFrame([(x,) for x in names] + [(None,)], "name string")
    patterns += [("_b%c", 70), ("a_%", 71), ("ab%", 72), ("%", 73), ("a\\%_", 74), ("ab\\_", 75)]
    for chosen in (patterns, patterns[:7], [p for p in patterns if p[0] and not set(p[0]) & set("_%\\")]):
        p = spark.createDataFrame(chosen, "pat string, rank int")
        got = dict(rows(best_prefix_rank(n, p, "name", "pat", "rank")))
        for name in names:
            hits = [r for q, r in chosen if q is not None and r is not None and like(name, q + "%")]
            assert got[name] == (min(hits) if hits else None), name
        assert got[None] is None and len(got) == len(names) + 1


def test_patterns_with_one_short_head_do_not_meet_all_its_names(spark, monkeypatch):
    from rulecast.operators import prefixes

    n, met = 200, []

    def counted(facts, lookup, on, *rest):
        met.append((joined := salted_join(facts, lookup, on, *rest)).count())
        return joined

    monkeypatch.setattr(prefixes, "salted_join", counted)
    names = spark.createDataFrame([(f"ab-{k:03}z",) for k in range(n)], "name string")
    patterns = spark.createDataFrame([(f"ab_{k:03}", k) for k in range(n)], "pat string, rank int")
    assert rows(best_prefix_rank(names, patterns, "name", "pat", "rank")) == [(f"ab-{k:03}z", k) for k in range(n)]
    assert max(met) <= 2 * n


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_join(spark, how):
    facts = spark.createDataFrame([("hot", i) for i in range(50)] + [("cold", 1), (None, 2)], "k string, v int")
    lookup = spark.createDataFrame([("hot", 1), ("hot", 2), ("warm", 3)], "k string, w int")
    plain = facts.join(lookup, "k", how)
    assert rows(salted_join(facts, lookup, ["k"], F.col("v"), how)) == rows(plain)


def test_salted_join_spreads_a_hot_key(spark):
    facts = spark.range(1000).select(F.lit("hot").alias("k"), "id")
    lookup = spark.createDataFrame([("hot", 1)], "k string, w int")
    joined = salted_join(facts.repartition(4), lookup, ["k"], F.col("id"))
    assert joined.count() == 1000


@pytest.mark.parametrize("tile", [1, 7, 512])
def test_tiled_join_equals_join(spark, tile):
    facts = spark.createDataFrame([("hot", i % 40) for i in range(50)] + [("cold", 1), (None, 2)], "k string, v int")
    lookup = spark.createDataFrame([("hot", i // 2) for i in range(20)] + [("warm", 3), (None, 4)], "k string, w int")
    joined = tiled_join(facts, lookup, ["k"], tile)
    assert rows(joined.select("k", "v", "w")) == rows(facts.join(lookup, "k").select("k", "v", "w"))


def test_tiled_join_divides_the_pairs_of_one_key(spark):
    facts = spark.createDataFrame([("hot", i) for i in range(1000)], "k string, v int")
    lookup = spark.createDataFrame([("hot", i) for i in range(100)], "k string, w int")
    joined = tiled_join(facts, lookup, ["k"], tile=10)
    parts = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(parts) == 100_000
    assert len(parts) == 4 and max(parts) < 2 * min(parts)


def test_salted_join_rejects_other_joins(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        salted_join(df, df, ["id"], F.col("id"), "full_outer")


def test_outer_merge_equals_full_join(spark):
    left = spark.createDataFrame([("a", "x", 1), ("a", None, 2), ("b", "y", None)], "k string, j string, m int")
    right = spark.createDataFrame([("a", "x", 5), ("a", None, 6), ("c", "z", 7), ("c", "z", 1)], "k string, j string, n int")
    assert rows(outer_merge(left, right, ["k", "j"])) == sorted(
        [("a", "x", 1, 5), ("a", None, 2, None), ("a", None, None, 6), ("b", "y", None, None),
         ("c", "z", None, 8)],
        key=repr,
    )
    with pytest.raises(ValueError):
        outer_merge(left, left, ["k", "j"])


def test_override_replaces_known_keys_only(spark):
    base = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    other = spark.createDataFrame([("a", 9), ("z", 8)], "k string, v int")
    assert rows(override(base, other, "k")) == [("a", 9), ("b", 3)]


def test_exclude_keeps_null_keys(spark):
    base = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, v int")
    other = spark.createDataFrame([("a",), (None,)], "k string")
    assert rows(exclude(base, other, "k")) == [("b", 3), (None, 2)]


@pytest.mark.parametrize("lead", [1, 3, 50])
def test_ordered_concat_equals_sorted_join(spark, lead):
    rnd = random.Random(lead)
    data = [(g, "".join(rnd.choice("abé ") for _ in range(rnd.randint(0, 6)))) for g in "xy" for _ in range(80)]
    data += [("x", None), ("n", None)]
    df = spark.createDataFrame(data, "g string, v string")
    got = dict(rows(ordered_concat(df, ["g"], F.col("v"), "|", "out", lead)))
    for g in "xy":
        assert got[g] == "|".join(sorted(v for k, v in data if k == g and v is not None))
    assert got["n"] is None


NESTED = """id int, h struct<ids: array<struct<value: string>>, q: array<struct<key: string, value: string>>,
            m: array<struct<s: map<string, int>>>>"""


def nested(spark):
    return spark.createDataFrame(
        [
            (1, ([("a",), ("b",), None], [("k", "1"), ("k", "2"), ("z", "3")], [({"A": 1, "B": 2},)])),
            (2, ([], [("k", "1")], [({"B": 1},), (None,)])),
            (3, (None, None, None)),
            (4, ([("a",)], [("z", "1"), None], [])),
        ],
        NESTED,
    )


def test_counting_equals_unnesting(spark):
    df = nested(spark)
    weight = element_count(df, "h.ids") * key_count(df, "h.q", "k")
    counted = {r.id: r.n for r in df.select("id", weight.alias("n")).collect()}
    exploded = unnest(df, b="h.ids", q="h.q").where("q.key = 'k'").groupBy("id").count()
    assert {k: v for k, v in counted.items() if v} == {r["id"]: r["count"] for r in exploded.collect()}
    assert counted == {1: 6, 2: 0, 3: 0, 4: 0}


def test_map_keys_inside_arrays(spark):
    df = nested(spark)
    found = df.where(any_map_has_key("h.m", "s", "A")).select("id")
    assert rows(found) == [(1,)]
    entries = unnest_map(unnest(df, e="h.m"), "e.s").where("key = 'B'").select("id").distinct()
    assert rows(entries) == [(1,), (2,)]


def test_materialize_keeps_rows_and_schema(spark):
    df = spark.createDataFrame([(1, ["a"], None)], "i int, l array<string>, s string")
    kept = materialize(df)
    assert rows(kept) == rows(df) and kept.dtypes == df.dtypes


def test_scratch_tables_are_deleted(spark):
    folder = checkpoint_dir(spark)
    before = set(glob.glob(f"{folder}/rulecast-*"))
    with scratch_tables(spark):
        assert materialize(spark.range(5)).count() == 5
        assert len(set(glob.glob(f"{folder}/rulecast-*")) - before) == 1
    assert set(glob.glob(f"{folder}/rulecast-*")) == before


def test_range_join_with_one_hot_value(spark):
    points = spark.range(3000).select("id", F.lit(100.0).alias("x"))
    ranges = spark.createDataFrame([(1, 50, 150), (2, 100, 100), (3, 101, 200)], "r int, low int, high int")
    joined = range_join(points, ranges, "x", "low", "high")
    assert rows(joined.groupBy("r").count()) == [(1, 3000), (2, 3000)]


def test_counting_in_maps(spark):
    df = spark.createDataFrame([(1, {"k": "v", "z": None}), (2, {}), (3, None)], "id int, m map<string, string>")
    counted = df.select("id", element_count(df, "m").alias("n"), key_count(df, "m", "k").alias("k"))
    assert rows(counted) == [(1, 2, 1), (2, 0, 0), (3, 0, 0)]
