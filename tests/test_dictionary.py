"""Patterns found by their dictionary against each pattern tried on each text."""

import random
import re

import pytest
from pyspark.sql import functions as F

from rulecast.operators.dictionary import alternatives, containing


def brute(texts, patterns, literal):
    def regex(pattern):
        if literal:
            return re.compile("|".join(re.escape(t) for t in pattern.split("|")), re.I | re.A)
        return re.compile(pattern, re.A)

    ready = [(k, regex(p)) for k, p in patterns if p is not None]
    return sorted({(t, k) for t in texts if t is not None for k, p in ready if p.search(t)})


def found(spark, texts, patterns, literal=False):
    said = spark.createDataFrame([(t, "x", "y") for t in texts], "agent string, key string, gram string")
    rules = spark.createDataFrame(patterns, "cluster string, rule string")
    got = containing(said, "agent", rules, "cluster", "rule", literal)
    assert got.columns == ["agent", "cluster"]
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("seed", range(3))
def test_same_pairs_as_trying_all(spark, seed):
    rnd = random.Random(seed)

    def token():
        return "".join(rnd.choice("abAB12- _") for _ in range(rnd.randint(1, 7)))

    extra = ["a+b", "b.1", "ab(12)", "(a)b", "ab+", "a.+b", "x(a.b)1-", "b (1a)"]
    patterns = [(str(k), f"(?i)({'|'.join([token() for _ in range(rnd.randint(1, 60))] + rnd.sample(extra, 3))})") for k in range(6)]
    patterns += [("whole", "ab[12]+"), ("nested", "(?i)((a|b)1|2-2)"), ("none", None), ("odd", "(?i)(a)|(b1)"), ("anchored", "(?i)(^ab|1b$)"), ("maybe", "(?i)(ab?c|1{3})"), ("ahead", "(?i)(a(?=1)|zz)")]
    texts = ["".join(rnd.choice("abAB12-. _(cé\n") for _ in range(rnd.randint(0, 25))) for _ in range(250)] + [None, "", "ab"]
    assert found(spark, texts, patterns) == brute(texts, patterns, False)


def test_literal_tokens(spark):
    patterns = [("1", "fe171cg (k01n)|405+|4.0"), ("2", "SM-a1|x"), ("3", "é[1]"), ("4", None)]
    texts = ["FE171CG (K01N) b", "fe171cg k01n", "405+", "4055", "sm-A1", "4.0", "420", "É[1]", "é[1]", None, "X"]
    assert found(spark, texts, patterns, literal=True) == brute(texts, [p for p in patterns if p[0] != "3"], True) + [("é[1]", "3")]


def test_a_large_index_is_shuffled(spark, monkeypatch):
    texts, patterns = [f"ab{i} x{i % 3}" for i in range(50)], [("1", "(?i)(ab1|x2)"), ("2", "(?i)(b(4)|x0?)")]
    monkeypatch.setattr("rulecast.operators.dictionary.BROADCAST_BYTES", 0)
    said = spark.createDataFrame([(t,) for t in texts], "t string")
    got = containing(said, "t", spark.createDataFrame(patterns, "k string, p string"), "k", "p")
    assert sorted(map(tuple, got.collect())) == brute(texts, patterns, False)
    assert "SortMergeJoin" in got._jdf.queryExecution().executedPlan().toString()


def test_empty_sides_and_alternatives(spark):
    assert found(spark, [], [("1", "(?i)(a)")]) == []
    assert found(spark, ["a"], []) == []
    assert found(spark, ["a", ""], [("1", "(?i)(zzzz|)"), ("2", "(?i)(zzzzz)")]) == [("", "1"), ("a", "1")]
    assert found(spark, ["KELVIN K1", "k1"], [("1", "(?i)(k1)")]) == [("k1", "1")]


def test_pieces_are_text_that_a_match_needs(spark):
    rules = spark.createDataFrame([("r", "(?i)(sm-T111|iris 405+|a.bcd|fe17 (k01n)|x?abc|a|4.0)")], "k string, p string")
    got = {(r.said or r.regex): r.piece for r in alternatives(rules, "k", "p").collect()}
    assert got == {"sm-t111": "sm-t111", "(?i)iris 405+": "iris 405", "(?i)a.bcd": "bcd", "(?i)fe17 (k01n)": "fe17 ", "(?i)x?abc": "", "a": "a", "(?i)4.0": "4"}


def test_no_pair_of_texts_and_patterns_is_tried_without_a_piece(spark):
    texts = [(f"model-{i:05d} build",) for i in range(3000)]
    rules = [(str(k), "(?i)(" + "|".join(f"l-{i:05d}" for i in range(k, 3000, 10)) + ")") for k in range(10)]
    got = containing(spark.createDataFrame(texts, "t string"), "t", spark.createDataFrame(rules, "k string, p string"), "k", "p")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan and plan.count("Join Inner") == 1
    assert got.count() == 3000 and got.where(F.substring("t", 11, 1) != F.col("k")).count() == 0
