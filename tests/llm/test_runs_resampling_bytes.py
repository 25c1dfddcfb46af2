"""Periodic runs, importance resampling and byte-level BPE against brute force and libraries."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from helpers import LETTERS, corpus, documents
from pyspark.sql import functions as F
from test_text_operators import windows

from rulecast.llm import ngram_table, word_runs
from rulecast.llm.byte_pairs import LONG_BLANK, STRETCH, decode_bytes, encode_bytes, encode_text, encoding, stretches
from rulecast.llm.op11_query import op11_periodic_runs, with_periodic_ends
from rulecast.llm.op13_query import RANKS, op13_byte_bpe
from rulecast.llm.periodic_runs import collapse_runs, find_runs, least_pair, word_ids
from rulecast.llm.target_resampling import Features, bucket_counts, resample_towards
from rulecast.llm.words import EXACT, PLAIN

SF = "/root/testdata/sf0.001"


def plain_runs(words, min_length=6, exponent=4):
    """Every period at every place."""
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > s and i - s + q >= max(min_length, exponent * q):
                found.setdefault((s, i - s + q), q)
            i += i == s
    return sorted((s, n, q) for (s, n), q in found.items())


def without_runs(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    rnd = random.Random(seed)
    for _ in range(250):
        said = []
        for _ in range(rnd.randint(0, 5)):
            letters = "abcd"[: rnd.randint(1, 4)]
            words = [rnd.choice(letters) for _ in range(rnd.randint(0, 40))]
            for _ in range(rnd.randint(0, 3)):
                period = [rnd.choice(letters) for _ in range(rnd.randint(1, 6))]
                words += (period * 7)[: rnd.randint(3, 40)]
            said.append(words)
        least, exponent = rnd.choice([(6, 4), (6, 3), (1, 3), (10, 5), (3, 4)])
        words = word_runs.join(*word_runs.column_bytes(pa.array([" ".join(w) for w in said], pa.string())), EXACT)
        got = [tuple(r) for r in find_runs(word_ids(words), words.first, least, exponent).tolist()]
        assert got == [(k, *run) for k, w in enumerate(said) for run in plain_runs(w, least, exponent)]


def test_shortest_pair_of_a_run():
    assert least_pair(6, 4) == 5 and least_pair(1, 3) == 2 and least_pair(100, 4) == 75


def test_collapsed_texts_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "a"), (5, "x y " * 50 + "z"), (5, "x y " * 50 + "z"), (None, "é " * 6), (7, "no runs in here"), (8, "w " * 300_000), (9, "a b a b a b"), (10, "one long " + "l" * 3_000_000)]
    got = {(r.doc_id, r.n_words, tuple(tuple(x) for x in r.runs), r.text) for r in collapse_runs(documents(spark, rows), 6, 4).collect()}
    want = set()
    for i, text in rows:
        words = (text or "").split()
        runs = ((0, 300_000, 1),) if i == 8 else tuple(plain_runs(words))
        want.add((i, len(words), runs, without_runs(words, runs)))
    assert got == want
    assert collapse_runs(documents(spark, rows), 6, 4).count() == len(rows)
    assert collapse_runs(documents(spark, [])).collect() == []
    with pytest.raises(ValueError, match="exponent"):
        collapse_runs(documents(spark, []), 6, 2)


def test_query_of_runs_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for i, text in rows:
        words = [w for w in (text or "").replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
        h = zlib.crc32(str(i).encode())
        if h % 10 == 0 and words:
            a = h // 10 % len(words)
            p = 1 + (len(words) - a) // (3 + h // 10 % 8)
            words = [words[k if k < a else a + (k - a) % p] for k in range(len(words))]
        runs = plain_runs(words)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        spelled = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want[i] = (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], hashlib.sha256(spelled.encode()).hexdigest(), hashlib.sha256(without_runs(words, runs).encode()).hexdigest())
    assert {r.doc_id: tuple(r)[1:] for r in op11_periodic_runs(spark, SF).collect()} == want
    assert any(w[0] for w in want.values())


def test_periodic_ends_of_odd_rows(spark):
    chosen = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    rows = [(chosen, None), (chosen, ""), (chosen, " "), (None, "kept  as it is"), (chosen, "one")]
    got = {(r.doc_id, r.text) for r in with_periodic_ends(documents(spark, rows)).collect()}
    assert got == set(rows)


def test_hashes_equal_the_libraries():
    rnd = random.Random(5)
    data = np.frombuffer(rnd.randbytes(4000), np.uint8)
    begin = np.array([rnd.randint(0, 3900) for _ in range(3000)])
    end = begin + np.array([rnd.randint(0, 60) for _ in begin])
    strings = [data[a:b].tobytes() for a, b in zip(begin, end, strict=True)]
    keys = ngram_table.hashed(ngram_table.short_xxhash, xxhash.xxh64_intdigest, data, begin, end)
    assert keys.tolist() == [xxhash.xxh64_intdigest(s) for s in strings]
    crc = ngram_table.hashed(ngram_table.short_crc32, zlib.crc32, data, begin, end)
    assert crc.tolist() == [zlib.crc32(s) for s in strings]


@pytest.mark.parametrize("colliding", [None, 1, 7])
def test_table_counts_strings_even_if_their_hashes_collide(colliding):
    rnd = random.Random(9)
    words = [("".join(rnd.choice("ab") for _ in range(rnd.randint(0, 20)))).encode() for _ in range(2000)]
    data = np.frombuffer(b"".join(words), np.uint8)
    size = np.array([len(w) for w in words])
    end = np.cumsum(size)
    keys = None if colliding is None else np.array([len(w) % colliding for w in words], np.uint64)
    table = ngram_table.NgramTable(data, end - size, end, 97, keys)
    assert {w: int(table.count[s]) for w, s in zip(words, table.slot, strict=True)} == Counter(words)
    assert all(table.bucket[s] == zlib.crc32(w) % 97 for w, s in zip(words, table.slot, strict=True))
    assert len(set(table.slot.tolist())) == len(set(words)) == (table.count > 0).sum()


def test_slices_keep_every_run_of_words():
    rnd = random.Random(3)
    said = ["", "one", " ".join(rnd.choice(LETTERS) for _ in range(400)), "x" * 900 + " y", "a b " * 30, " , ", "end"]
    for limit in (16, 100, 1000, 10**6):
        found = Counter()
        for k, part in word_runs.slices(pa.array(said), PLAIN, 1, limit):
            text = np.repeat(np.arange(len(part.first) - 1), np.diff(part.first)) + k
            spelled = [part.data[a:b].tobytes().decode() for a, b in zip(part.begin, part.end, strict=True)]
            own = len(spelled) - (not part.ends)
            found.update((text[i], spelled[i]) for i in range(own))
            found.update((text[i], spelled[i], spelled[i + 1]) for i in range(len(spelled) - 1) if text[i] == text[i + 1])
        want = Counter()
        for k, text in enumerate(said):
            words = windows(text)[0]
            want.update((k, w) for w in words)
            want.update((k, *pair) for pair in zip(words, words[1:], strict=False))
        assert found == want


def plain_resampling(rows, items, percent, seed, least_words, buckets=10_000):
    def features(text):
        words = windows(text)[0]
        return words, [*words, *(" ".join(p) for p in zip(words, words[1:], strict=False))]

    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    said = [features(text) for _, text in rows]
    s = Counter(bucket(f) for _, fs in said for f in fs)
    t = Counter(bucket(f) for text in items for f in features(text)[1])
    all_s, all_t = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    out = []
    for (i, _), (words, fs) in zip(rows, said, strict=True):
        weight = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append([i, len(words), len(fs), weight, score, None])
    among = sorted((r for r in out if r[1] >= least_words and r[4] is not None), key=lambda r: (-r[4], r[0]))
    for k, r in enumerate(among[: percent * len(among) // 100]):
        r[5] = k + 1
    return [tuple(r) for r in out]


def test_resampling_equals_brute_force(spark):
    rows = [*corpus(11, 150), (5000, "é" * 2_500_000 + " beta gamma"), (5001, "alpha beta " * 200_000), (None, "alpha beta gamma " * 10)]
    items = ["alpha1 beta gamma delta", None, "", "zeta eta theta " * 5, "ALPHA beta"]
    target = spark.createDataFrame([(str(k), t) for k, t in enumerate(items)], "item_id string, text string")
    for percent, least, seed in ((25, 20, 7), (100, 0, 1), (0, 5, 2)):
        got = sorted(map(tuple, resample_towards(documents(spark, rows), target, percent, seed, least).collect()), key=repr)
        assert got == sorted(plain_resampling(rows, items, percent, seed, least), key=repr)
    few = Features(longest=1, buckets=7)
    counted = {r.bucket: r.n for r in bucket_counts(documents(spark, rows), few).collect()}
    assert counted == Counter(zlib.crc32(w.encode()) % 7 for _, t in rows for w in windows(t)[0])


def test_resampling_without_documents_or_target(spark):
    rows, nothing = [(1, "a b c"), (1, "a b c"), (2, None)], spark.createDataFrame([], "text string")
    assert resample_towards(documents(spark, []), documents(spark, rows)).collect() == []
    got = resample_towards(documents(spark, rows), nothing, percent=100, least_words=1).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(plain_resampling(rows, [], 100, 7, 1), key=repr)


@pytest.fixture(scope="module")
def by():
    return encoding(public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def by_matches(by: tiktoken.Encoding, text: str) -> list[int]:
    """Every match of the pattern by itself, its lowest-ranked pair of neighbours merged again and again."""
    import regex

    out = []
    for match in regex.findall(public_tokenizers.PATTERN, text):
        parts = [bytes([b]) for b in match.encode()]
        while len(parts) > 1:
            ranked = [(by._mergeable_ranks.get(a + b, math.inf), k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            rank, k = min(ranked)
            if rank == math.inf:
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        out += [by._mergeable_ranks[p] for p in parts]
    return out


def test_encoding_equals_merging_by_rank(by):
    rnd = random.Random(1)
    pieces = ["the ", " house", "\n\n", "  ", "don't", "123", "é", "日本", "　", "\t", "!?", "'s", "<|endoftext|>", "\x1c", "​", "🙂"]
    for _ in range(300):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 25)))
        assert encode_text(by, text).tolist() == by_matches(by, text) == by.encode_ordinary(text)


def test_stretches_are_encoded_as_the_whole_text(by):
    rnd = random.Random(2)
    pieces = ["word", "don't", "'", " ", "  ", "   ", "\n", "\r\n", "1", "!", "é", "　", "\x85", "\x1c", " " * 25]
    for _ in range(400):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 80)))
        cut = list(stretches(text, rnd.randint(1, 9)))
        assert "".join(s for s, _ in cut) == text
        assert [i for s, _ in cut for i in by.encode_ordinary(s)] == by.encode_ordinary(text)
    for blanks in (LONG_BLANK - 1, LONG_BLANK, LONG_BLANK + 1):
        for text in (" " * blanks + "end", "a" + "\n" * blanks, "a" + " " * blanks + "\tb" + "\n" * blanks, "x " * STRETCH + " " * blanks + "'s"):
            assert encode_text(by, text).tolist() == by.encode_ordinary(text)


def test_a_million_blanks_before_a_word(by):
    # The library itself fails on the whole text.
    ids = encode_text(by, "x" + " " * 1_500_000 + "y" + "z " * STRETCH)
    assert by.decode_bytes(ids.tolist()) == b"x" + b" " * 1_500_000 + b"y" + b"z " * STRETCH
    assert ids[-1] == by.encode_ordinary(" ")[0]


def test_bytes_of_odd_rows(spark, by):
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    rows = [(1, None), (2, ""), (3, "one"), (3, "one"), (None, "two  three "), (4, "a" * 400_000), (5, "<|endoftext|> 日本\x00"), (6, "word " * 60_000)]
    encoded = encode_bytes(documents(spark, rows), path, pattern)
    got = sorted(((r.doc_id, r.ids) for r in encoded.collect()), key=repr)
    assert got == sorted(((i, by.encode_ordinary(t or "")) for i, t in rows), key=repr)
    decoded = sorted(((r.doc_id, bytes(r.bytes)) for r in decode_bytes(encoded, path, pattern).collect()), key=repr)
    assert decoded == sorted(((i, (t or "").encode()) for i, t in rows), key=repr)
    half = spark.createDataFrame([(1, by.encode_ordinary("é")[:1] if len(by.encode_ordinary("é")) > 1 else [by._mergeable_ranks[b"\xc3"]]), (2, None), (3, [])], "doc_id bigint, ids array<int>")
    assert {r.doc_id: bytes(r.bytes) for r in decode_bytes(half, path, pattern).collect()} == {1: b"\xc3", 2: b"", 3: b""}
    assert encode_bytes(documents(spark, []), path, pattern).collect() == []
    broken = spark.range(1).select("id", F.expr("cast(X'61FF62' as string)").alias("text"))
    assert encode_bytes(broken, path, pattern, doc_id="id").collect()[0].ids == by.encode_ordinary("a�b")


def test_query_of_bytes_equals_the_library(spark, by):
    want = {}
    for i, text in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        ids = by.encode_ordinary(text or "")
        want[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
    assert {r.doc_id: tuple(r)[1:] for r in op13_byte_bpe(spark, SF).collect()} == want
