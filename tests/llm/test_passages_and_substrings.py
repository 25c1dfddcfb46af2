"""Repeated passages and substrings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers import WORD, corpus, documents

from rulecast.llm.passage_repeats import WINDOWS, Segments, SuffixAutomaton, first_documents, remove_earlier_passages
from rulecast.llm.substring_repeats import remove_repeated_substrings, repeated_offsets
from rulecast.llm.suffix_runs import decode_run, front_code, merge_runs, shared, shared_end
from rulecast.llm.words import first_minima


def passages(rows, width):
    first: dict = {}
    said = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, words in said:
        for k in range(len(words) - width + 1 if i is not None else 0):
            window = tuple(words[k : k + width])
            first[window] = min(i, first.get(window, i))
    out = []
    for i, words in said:
        gone = set()
        for k in range(len(words) - width + 1 if i is not None else 0):
            if first[tuple(words[k : k + width])] < i:
                gone.update(range(k, k + width))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("width", "frequent"), [(13, None), (4, None), (13, 1), (4, 3)])
def test_passages_equal_brute_force(spark, width, frequent):
    rows = corpus()
    rows += [(5, rows[0][1]), rows[3], rows[3], (None, rows[4][1])]
    found = remove_earlier_passages(documents(spark, rows), width, frequent=frequent).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.digest.hex()) for r in found), key=repr)
    assert got == passages(rows, width)
    for r in found:
        if r.n_removed:
            assert hashlib.sha256(" ".join(WORD.findall(r.kept)).encode()).digest() == r.digest


def test_a_frequent_gram_is_spread_over_buckets(spark):
    rnd = random.Random(11)

    def around():
        return " ".join(f"w{rnd.randrange(10**6)}" for _ in range(8))

    phrase = "we use cookies on this"
    rows = [(i, f"{around()} {phrase} {around()}") for i in range(4000)]
    rows += [(i + 4000, f"{text} and more of it") for i, text in rows[::40]]
    held = Segments(64, 13)
    for i, text in rows:
        held.add(" ".join(text.split()[:21]).encode(), None, i, 0, 0, 9)
    dealt = Counter()
    for batch in held.flush():
        for bucket, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            dealt[bucket] += len(payload) if payload[:1] == WINDOWS else 0
    dealt = {k: n for k, n in dealt.items() if n}
    assert len(dealt) == 128 and max(dealt.values()) < 3 * sum(dealt.values()) / 128
    found = remove_earlier_passages(documents(spark, rows)).collect()
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.digest.hex()) for r in found)
    assert got == sorted(passages(rows, 13))


def test_passages_of_nothing(spark):
    assert remove_earlier_passages(documents(spark, [])).collect() == []


def test_automaton_knows_the_first_text():
    rnd = random.Random(2)
    texts = [[rnd.choice("ab") for _ in range(rnd.randint(1, 12))] for _ in range(40)]
    automaton = SuffixAutomaton()
    for i, words in enumerate(texts):
        automaton.add(words, i)
    for words in [[rnd.choice("abc") for _ in range(15)] for _ in range(40)]:
        for width in (1, 3, 5):
            want = []
            for k in range(len(words) - width + 1):
                window = words[k : k + width]
                holds = (i for i, t in enumerate(texts) if any(t[a : a + width] == window for a in range(len(t) - width + 1)))
                want.append(next(holds, None))
            assert automaton.first_texts(words, width) == want


def test_shards_give_what_one_automaton_gives(monkeypatch):
    segments = [(b" ".join(b"ab"[i : i + 1] for i in [(k >> j) & 1 for j in range(6)]), k) for k in range(64)]
    whole = first_documents(segments, 3)
    monkeypatch.setattr("rulecast.llm.passage_repeats.SHARD_WORDS", 20)
    assert first_documents(segments, 3) == whole


def substrings(rows, length):
    raws = [(i, (t or "").encode()) for i, t in rows]
    times = Counter(r[k : k + length] for _, r in raws for k in range(len(r) - length + 1))
    out = []
    for i, raw in raws:
        covered = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            if times[raw[k : k + length]] > 1:
                covered[k : k + length] = b"\1" * length
        spans = sum(1 for k, c in enumerate(covered) if c and not (k and covered[k - 1]))
        kept = bytes(b for b, c in zip(raw, covered, strict=True) if not c)
        out.append((i, len(raw), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("length", [400, 60])
def test_substrings_equal_brute_force(spark, length):
    rows = corpus()
    rows += [(5, rows[0][1]), rows[3], rows[3], (None, rows[4][1]), (None, None)]
    found = remove_repeated_substrings(documents(spark, rows), length).collect()
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.digest.hex()) for r in found), key=repr)
    assert got == substrings(rows, length)


def test_many_variants_of_one_passage(spark):
    rnd = random.Random(4)
    base = "".join(rnd.choice("abcdefgh") for _ in range(300))
    rows = [(i, base[: rnd.randint(0, 90)] + rnd.choice("xyz") + base[rnd.randint(60, 140) : rnd.randint(200, 300)]) for i in range(150)]
    got = remove_repeated_substrings(documents(spark, rows), 60).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.digest.hex()) for r in got), key=repr) == substrings(rows, 60)


def test_substrings_of_nothing(spark):
    assert remove_repeated_substrings(documents(spark, [])).collect() == []
    with pytest.raises(ValueError):
        remove_repeated_substrings(documents(spark, []), 3)


def test_runs_merge_with_their_shared_prefixes():
    rnd = random.Random(3)
    for _ in range(300):
        runs = [sorted({bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 6))) for _ in range(rnd.randint(0, 8))}) for _ in range(rnd.randint(0, 5))]
        merged = list(merge_runs([decode_run(*front_code(r)) for r in runs]))
        assert [m[0] for m in merged] == sorted(s for r in runs for s in r)
        for (a, _), (b, common) in zip(merged[:-1], merged[1:], strict=True):
            assert common == shared(a, b)
    assert shared_end(b"xxab", b"yab") == 2 and shared_end(b"", b"a") == 0 and shared_end(b"ab", b"ab") == 2


def test_large_stretch_equals_pairs():
    rnd = random.Random(9)
    rights = sorted(bytes(rnd.choice(b"ab") for _ in range(12)) for _ in range(60))
    members, before = [], b""
    for right in rights:
        members.append((right, shared(before, right), bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 8))), 1))
        before = right
    got = repeated_offsets(members, 14)
    for i, (right, _, left, _) in enumerate(members):
        want = {o for o in range(2, len(left) + 1) if any(j != i and len(m[2]) >= o and m[2][len(m[2]) - o :] == left[len(left) - o :] and m[0][: 14 - o] == right[: 14 - o] for j, m in enumerate(members))}
        assert {o for a, b in got[i] for o in range(a, b + 1)} == want


@pytest.mark.parametrize("bits", [1, 3, 64])
def test_first_minima_compare_whole_keys(bits):
    rnd = np.random.default_rng(bits)
    for total, width in [(0, 3), (2, 3), (3, 3), (700, 1), (700, 9), (3000, 25)]:
        keys = rnd.integers(0, 2**bits, total, np.uint64, endpoint=False) if bits < 64 else rnd.integers(0, 2**63, total).astype(np.uint64)
        want = [i + int(np.argmin(keys[i : i + width])) for i in range(total - width + 1)]
        assert first_minima(keys, width).tolist() == want
