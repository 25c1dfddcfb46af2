"""Fixtures for the text operators: documents with every awkward case, and plain counterparts."""

import random
import re

LETTERS = ["alpha", "beta", "gamma", "delta", "épsilon", "zeta", "eta,", "theta", "iota.", "kappa"]
#: Extra columns whose names the operators use themselves.
SCHEMA = "doc_id bigint, text string, sig string, key string, row string, kind string, spans string, rep string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "x", "x", "x", "x", "x", "x") for i, t in rows], SCHEMA)


def prose(rnd: random.Random, words: int) -> str:
    return " ".join(rnd.choice(LETTERS) + str(rnd.randint(0, 999)) for _ in range(words))


def corpus(seed: int = 7, n: int = 60) -> list[tuple[int, str | None]]:
    """Distinct texts, copies, near copies, shared passages, and empty, blank, null and long texts."""
    rnd = random.Random(seed)
    shared = prose(rnd, 40)
    base = prose(rnd, 120)
    out: list[tuple[int, str | None]] = [(1000, None), (1001, ""), (1002, " \n\t "), (1003, "one"), (1004, "One"), (1005, "a" * 3000)]
    for i in range(n):
        text = prose(rnd, rnd.randint(5, 150))
        if i % 5 == 0:
            text = f"{text}\n\n{shared}  {prose(rnd, 10)}"
        if i % 7 == 0:
            words = base.split()
            words[rnd.randint(0, 119)] = f"changed{i}"
            text = " ".join(words)
        if i % 11 == 0 and out[-1][1]:
            text = out[-1][1]
        out.append((i, text))
    out.append((2000, " ".join([shared] * 6)))
    rnd.shuffle(out)
    return out
