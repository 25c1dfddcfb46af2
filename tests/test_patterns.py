import random
import re

import pytest
from pyspark.sql import functions as F

from rulecast.functions.patterns import factored, quoted


def flat(pattern):
    """The pattern as Python reads it."""
    return re.compile(pattern)


@pytest.mark.parametrize("seed", range(8))
def test_factored_matches_the_same_texts(spark, seed):
    rnd = random.Random(seed)
    tokens = ["".join(rnd.choice("ab1-. ") for _ in range(rnd.randint(1, 5))) for _ in range(40)]
    tokens += rnd.sample(["a+b", "b (1a)", "[ab]1", "a?b-", "B-A", "É1"], 3)
    pattern = f"(?i)({'|'.join(tokens)})"
    small = f"(?i)({'|'.join(rnd.sample(tokens, 4))})"
    texts = ["".join(rnd.choice("aAbB1-. c(Éé") for _ in range(rnd.randint(0, 9))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for p in (pattern, small):
        both = df.select(F.rlike("t", F.lit(p)), F.rlike("t", F.lit(factored(p)))).collect()
        assert all(a == b for a, b in both)
        ascii_only = [(a, t) for (a, _), t in zip(both, texts) if t.isascii()]
        assert all(a == bool(flat(p).search(t)) for a, t in ascii_only)


@pytest.mark.parametrize(
    "pattern",
    ["(?i)((a|b)c|d)", "(?i)([a|b]c)", r"(?i)(a\|b|c)", r"(?i)(\d+|x)", "a|b", "(?i)(a|)", "(?i)a|b", "(?i)(a)|(b)"],
)
def test_other_patterns_keep_their_meaning(pattern):
    texts = ["", "a", "b", "c", "ac", "bc", "d", "a|b", "5", "|", "x", "D", "A"]
    for text in texts:
        assert bool(flat(pattern).search(text)) == bool(flat(factored(pattern)).search(text))


def test_common_beginnings_are_written_once():
    assert factored("(?i)(sm-j700f|sm-j710|sm-j7|a5)") == "(?i)((?:a5|sm-j7))"
    assert factored("(?i)(sm-a1|sm-b2|gt(x))") == "(?i)(sm-(?:a1|b2)|gt(x))"


def test_quoted_tokens_match_themselves(spark):
    pattern = quoted("fe171cg (k01n)|405+|4.0|sm-a1|SM-A2|b c")
    assert pattern == r"(?i)((?:b c|sm-a(?:1|2))|fe171cg\ \(k01n\)|405\+|4\.0)"
    df = spark.createDataFrame([("FE171CG (K01N)",), ("fe171cg k01n",), ("405+",), ("4055",)], "t string")
    assert [r[0] for r in df.select(F.rlike("t", F.lit(pattern))).collect()] == [True, False, True, False]
