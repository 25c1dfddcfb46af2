"""Near-duplicate classes and components against brute force."""

import random
import re
import string

import corpus_pipeline
import numpy as np
import pytest
from helpers import WORD, corpus, documents, prose

from rulecast.llm import near_duplicates
from rulecast.llm.components import connected_components
from rulecast.llm.near_duplicates import linked_labels, near_duplicate_classes

FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def sets(rows, size):
    out = []
    for i, text in rows:
        words = WORD.findall((text or "").translate(FOLD))
        grams = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} or ({tuple(words)} if words else set())
        out.append((i, grams))
    return out


def classes(rows, size, percent):
    found = sets(rows, size)
    parent = {i: i for i, _ in found}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, one) in enumerate(found):
        for j, other in found[:a]:
            if one and other and 100 * len(one & other) >= percent * len(one | other):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return sorted((i, len(s), root(i), root(i) == i) for i, s in found)


@pytest.mark.parametrize("size", [2, 5])
def test_classes_equal_brute_force(spark, size):
    rows = corpus()
    got = near_duplicate_classes(documents(spark, rows), size, 80).collect()
    assert sorted(tuple(r) for r in got) == classes(rows, size, 80)


def test_large_group_of_near_copies(spark):
    rnd = random.Random(5)
    base = prose(rnd, 60).split()
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rnd.randint(0, 3)):
            words[rnd.randint(0, 59)] = f"other{rnd.randint(0, 10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, prose(rnd, 60)) for i in range(50)]
    got = near_duplicate_classes(documents(spark, rows), 2, 80).collect()
    assert sorted(tuple(r) for r in got) == classes(rows, 2, 80)


def test_rows_made_do_not_grow_with_the_pairs_of_a_group(spark, monkeypatch):
    rnd = random.Random(11)
    base = prose(rnd, 80).split()
    rows = []
    for i in range(500):
        words = list(base)
        for _ in range(rnd.randint(0, 6)):
            words[rnd.randint(0, 79)] = f"other{rnd.randint(0, 10**6)}"
        rows.append((i, " ".join(words)))
    made = []
    write = near_duplicates.materialize

    def counted(df):
        table = write(df)
        made.append(table.count())
        return table

    monkeypatch.setattr(near_duplicates, "materialize", counted)
    got = near_duplicate_classes(documents(spark, rows), 2, 80).collect()
    assert sorted(tuple(r) for r in got) == classes(rows, 2, 80)
    # Each set lies in at most 12 trees times 2 nodes a level.
    assert max(made) <= 12 * 2**3 * len(rows) / 2


def test_neighbourhoods_too_heavy_for_a_task(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK", 1500)
    monkeypatch.setattr(near_duplicates, "SMALL_NODE", 12)
    rnd = random.Random(3)
    line, base = prose(rnd, 300).split(), prose(rnd, 60).split()
    rows = [(500 + k, " ".join(line[3 * k : 3 * k + 60])) for k in range(80)]
    for i in range(80):
        words = list(base)
        for _ in range(rnd.randint(0, 8)):
            words[rnd.randint(0, 59)] = f"other{rnd.randint(0, 10**6)}"
        rows.append((i, " ".join(words)))
    rnd.shuffle(rows)
    got = near_duplicate_classes(documents(spark, rows), 2, 80).collect()
    assert sorted(tuple(r) for r in got) == classes(rows, 2, 80)


@pytest.mark.parametrize("percent", [50, 80, 100])
def test_labels_joined_by_links_equal_brute_force(percent):
    rnd = np.random.default_rng(4)
    for _ in range(40):
        base = np.arange(30, dtype=np.uint64)
        sets = [np.unique(np.concatenate([rnd.choice(base, rnd.integers(1, 31), replace=False), rnd.integers(100, 104, rnd.integers(0, 3)).astype(np.uint64)])) for _ in range(25)]
        label = rnd.integers(0, 20, len(sets)) * 7
        parent = {int(x): int(x) for x in label}
        for i, one in enumerate(sets):
            for j, other in enumerate(sets[:i]):
                common = len(np.intersect1d(one, other))
                if 100 * common >= percent * (len(one) + len(other) - common):
                    x, y = parent[int(label[i])], parent[int(label[j])]
                    parent = {k: x if v == y else v for k, v in parent.items()}
        want = [sorted(k for k, v in parent.items() if v == root) for root in set(parent.values())]
        assert sorted(linked_labels(sets, label, percent)) == sorted(w for w in want if len(w) > 1)


def test_null_ids_and_repeated_rows_stay(spark):
    text = prose(random.Random(1), 30)
    rows = [(3, text), (3, text), (None, text), (2, text), (None, None)]
    got = near_duplicate_classes(documents(spark, rows)).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in got), key=repr) == sorted([(2, 2, True), (3, 2, False), (3, 2, False), (None, None, True), (None, None, True)], key=repr)
    assert near_duplicate_classes(documents(spark, [])).collect() == []


def test_rows_that_share_an_id_are_linked_by_their_own_texts(spark):
    rnd = random.Random(9)
    one, other = prose(rnd, 60), prose(rnd, 60)
    near = lambda text: f"{text} more"
    rows = [(5, one), (5, other), (7, near(one)), (8, near(other)), (4, near(near(other))), (9, "alone"), (9, "alone"), (9, None), (9, None)]
    got = near_duplicate_classes(documents(spark, rows), 2, 80, rows=True).drop("row", "n_shingles").collect()
    want = [(5, 5, True), (5, 4, False), (7, 5, False), (8, 4, False), (4, 4, True), *[(9, 9, True)] * 4]
    assert sorted(tuple(r) for r in got) == sorted(want)
    docs = documents(spark, [*rows, (None, one), (None, one)]).drop("row")
    kept = corpus_pipeline.without_near_duplicates(spark, docs, "").select("doc_id", "text").collect()
    assert sorted(map(tuple, kept), key=repr) == sorted([(5, one), (4, near(near(other))), (9, "alone"), (9, None), (9, None), (None, one), (None, one)], key=repr)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(20, 60)] + [(5, k) for k in range(100, 130)] + [(7, 7), (130, 129), (130, 129)]
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert all(got[i] == 20 for i in range(20, 61)) and all(got[i] == 5 for i in [5, *range(100, 131)]) and 7 not in got
    assert re.match("DataFrame", repr(connected_components(spark.createDataFrame([], "a bigint, b bigint"))))
