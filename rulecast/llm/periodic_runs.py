"""Maximal periodic runs of words, found as maximal pairs of an LCP-interval tree.

A run with period q that starts at word s and has ``length`` words is the same as two equal stretches
of length - q words, at s and s + q, that differ in the word before them and in the word after them:
a maximal pair at distance q. So no run has to be extended once its pair is known. Suffixes of a
text are sorted by prefix doubling; the intervals of equal prefixes in that order form a tree, whose
leaves are suffixes, and a pair is maximal to the right exactly at the interval where its two
suffixes come together. Intervals are met bottom-up, each with its occurrences in order of place and
their classes by the word to the left; a pair within one class is not maximal to the left.

A pair at distance q has to be at least (exponent - 1) * q long, so its two occurrences overlap or
touch as neighbours: if a third occurrence lay between them, it would belong to a smaller period.
Joining two lists therefore looks at neighbours only, and what it finds has the smallest period.
"""

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rulecast.llm.common import ship, texts
from rulecast.llm.word_runs import Joined, column_bytes, join
from rulecast.llm.words import EXACT, mix, pieces

#: No word is to the left of a text's first one.
NO_WORD = -1


def least_pair(min_length: int, exponent: int) -> int:
    """The length of the shortest pair that can be a run."""
    return min(max((exponent - 1) * q, min_length - q) for q in range(1, min_length + 1))


def word_ids(words: Joined) -> np.ndarray:
    """Numbers of the words, equal exactly for equal words."""
    size = words.end - words.begin
    at = np.concatenate(([0], np.cumsum(size + 1))).astype(np.int32)
    spelled = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(at), pa.py_buffer(words.data)])
    return spelled.dictionary_encode().indices.to_numpy().astype(np.int64)


def texts_to_search(ids: np.ndarray, first: np.ndarray, least: int, exponent: int) -> np.ndarray:
    """Numbers of the texts in which ``least`` words in a row come again close enough to be in a run.

    Told by hashes; equal words have equal hashes, so no run is overlooked.
    """
    counts, total = np.diff(first), len(ids)
    if total < least:
        return np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(counts)), counts)
    gram = np.zeros(total - least + 1, np.uint64)
    for j in range(least):
        gram = gram * np.uint64(0x2545F4914F6CDD1D) + ids[j : total - least + 1 + j].astype(np.uint64)
    at = np.flatnonzero(text[: len(gram)] == text[least - 1 :])
    gram = mix(gram[at] + text[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(gram, kind="stable")
    a, b = at[order[:-1]], at[order[1:]]
    near = (gram[order[:-1]] == gram[order[1:]]) & (text[a] == text[b]) & (exponent * (b - a) <= counts[text[a]])
    return np.unique(text[a[near]])


def ranks_by_doubling(key: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in order, and for 1, 2, 4... words the rank of each suffix by as many.

    ``key`` orders single words so that words of different texts differ; ``end`` is where the text
    of each word ends. Only suffixes that are still tied are sorted again.
    """
    total = len(key)
    order = np.argsort(key, kind="stable")
    fresh = np.concatenate(([True], key[order[1:]] != key[order[:-1]]))
    rank = np.empty(total, np.int32)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(total), 0))
    levels, step = [rank], 1
    slots = np.flatnonzero(~fresh | ~np.concatenate((fresh[1:], [True])))
    while len(slots):
        suffix = order[slots]
        after = suffix + step
        beyond = np.where(after < end[suffix], rank[np.minimum(after, total - 1)], -1).astype(np.int64)
        mine = rank[suffix].astype(np.int64) * (total + 1) + beyond + 1
        again = np.argsort(mine, kind="stable")
        suffix, mine = suffix[again], mine[again]
        order[slots] = suffix
        fresh = np.concatenate(([True], mine[1:] != mine[:-1]))
        rank = rank.copy()
        rank[suffix] = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(slots)), 0))]
        levels.append(rank)
        step *= 2
        slots = slots[~fresh | ~np.concatenate((fresh[1:], [True]))]
    return order, levels


def common_prefixes(a: np.ndarray, b: np.ndarray, end: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """How many words the suffixes ``a`` and ``b`` of one text have in common at their beginning."""
    common, last = np.zeros(len(a), np.int64), len(end) - 1
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + common, b + common
        inside = (x < end[a]) & (y < end[b])
        same = inside & (levels[k][np.minimum(x, last)] == levels[k][np.minimum(y, last)])
        common += same.astype(np.int64) << k
    return common


def runs_in_interval(places: list[int], common: list[int], left: np.ndarray, exponent: int, min_length: int) -> Iterator[tuple[int, int, int]]:
    """``start, length, period`` of the runs among suffixes, given in order with their common prefixes."""

    def join_lists(a: list[int], b: list[int], size: int, found: list) -> list[int]:
        many, few = (a, b) if len(a) >= len(b) else (b, a)

        def pair(i: int, j: int) -> None:
            q = j - i
            if (exponent - 1) * q <= size and size + q >= min_length and left[i] != left[j]:
                found.append((i, size + q, q))

        for t, p in enumerate(few):
            k = bisect_left(many, p)
            if k and not (t and few[t - 1] > many[k - 1]):
                pair(many[k - 1], p)
            if k < len(many) and not (t + 1 < len(few) and few[t + 1] < many[k]):
                pair(p, many[k])
        if len(few) == 1:
            insort(many, few[0])
        else:
            many.extend(few)
            many.sort()
        return many

    found: list[tuple[int, int, int]] = []
    parents: list[tuple[int, list[int]]] = []
    open_ = [places[0]]
    for place, size in zip(places[1:], common, strict=True):
        while parents and parents[-1][0] >= size:
            deep, before = parents.pop()
            open_ = join_lists(before, open_, deep, found)
        parents.append((size, open_))
        open_ = [place]
    while parents:
        deep, before = parents.pop()
        open_ = join_lists(before, open_, deep, found)
    return iter(found)


def find_runs(ids: np.ndarray, first: np.ndarray, min_length: int, exponent: int) -> np.ndarray:
    """Rows ``text, start, length, period`` of all runs, by text, start and period."""
    least = least_pair(min_length, exponent)
    wanted = texts_to_search(ids, first, least, exponent)
    nothing = np.zeros((0, 4), np.int64)
    if not len(wanted):
        return nothing
    counts = np.diff(first)[wanted]
    text = np.repeat(wanted, counts)
    base = np.cumsum(counts) - counts
    place = np.arange(len(text)) - np.repeat(base, counts)
    mine = ids[first[text] + place]
    end = np.repeat(base + counts, counts)
    order, levels = ranks_by_doubling(text * (int(ids.max()) + 1) + mine, end)
    if len(levels) <= least.bit_length() - 1:
        return nothing
    # Neighbours in the order that share enough words; a stretch of them is a tree of its own.
    by = levels[least.bit_length() - 1]
    near = np.flatnonzero(by[order[:-1]] == by[order[1:]])
    common = np.zeros(len(order), np.int64)
    common[near + 1] = common_prefixes(order[near], order[near + 1], end, levels)
    tied = common >= least
    start = np.flatnonzero(~tied & np.concatenate((tied[1:], [False])))
    left = np.where(place > 0, mine[np.maximum(np.arange(len(mine)) - 1, 0)], NO_WORD)
    inner = np.flatnonzero(tied | np.concatenate((tied[1:], [False])))
    tree = np.searchsorted(start, inner, "right") - 1
    several, close = _promising(order[inner], tree, common[inner], left, exponent, len(start))
    stop = np.searchsorted(inner, start, "left"), np.searchsorted(inner, np.concatenate((start[1:], [len(order)])), "left")
    found = []
    for k in np.flatnonzero(several & close):
        here = inner[stop[0][k] : stop[1][k]]
        found += runs_in_interval(order[here].tolist(), common[here[1:]].tolist(), left, exponent, min_length)
    if not found:
        return nothing
    rows = np.array(found, np.int64)
    rows = np.column_stack((text[rows[:, 0]], place[rows[:, 0]], rows[:, 1:]))
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _promising(places: np.ndarray, tree: np.ndarray, common: np.ndarray, left: np.ndarray, exponent: int, trees: int) -> tuple[np.ndarray, np.ndarray]:
    """For each tree, whether it has several classes, and whether two of its occurrences are close."""
    head = np.searchsorted(tree, np.arange(trees))
    classes = left[places]
    several = np.minimum.reduceat(classes, head) != np.maximum.reduceat(classes, head)
    by_place = np.lexsort((places, tree))
    gap = np.diff(places[by_place], prepend=0)
    gap[head] = np.iinfo(np.int64).max // exponent
    inside = common.copy()
    inside[head] = 0
    return several, (exponent - 1) * np.minimum.reduceat(gap, head) <= np.maximum.reduceat(inside, head)


def collapsed(words: Joined, runs: np.ndarray) -> list[bytes]:
    """The texts without the words that any run has after its first period, joined by one space."""
    drop = np.zeros(len(words.begin) + 1, np.int64)
    at = words.first[runs[:, 0]] + runs[:, 1]
    np.add.at(drop, at + runs[:, 3], 1)
    np.add.at(drop, at + runs[:, 2], -1)
    keep = np.cumsum(drop[:-1]) == 0
    bytes_kept = words.data[np.repeat(keep, words.end - words.begin + 1)].tobytes()
    ends = np.concatenate(([0], np.cumsum(np.where(keep, words.end - words.begin + 1, 0))))[words.first]
    return [bytes_kept[a : max(b - 1, a)] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def collapse_runs(docs: DataFrame, min_length: int = 6, exponent: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, text``: each document's runs, and its text with one period of each.

    A run is a stretch of consecutive words with smallest period q, of at least ``min_length`` and
    ``exponent`` * q words, that no neighbouring word extends; ``exponent`` is 3 at least. ``runs``
    are structs of start (word number from 0), length and period, by start, then period. Every word
    that a run contains after its first q words is left out of ``text``, in which words are joined
    by one space. Null and empty texts have no words, no runs and the empty text. Rows stay as they
    come, repeated and null ids included; other columns are ignored; no rows give no rows. A text is
    searched whole, by some 150 bytes of memory a word, and 4 more for each doubling of its longest
    repetition.
    """
    if exponent < 3 or min_length < 1:
        raise ValueError("runs need an exponent of 3 at least and a positive length")
    ship(docs.sparkSession)
    struct = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def search(batches):
        for batch in batches:
            for piece in pieces(batch):
                words = join(*column_bytes(piece.column(1)), EXACT)
                runs = find_runs(word_ids(words), words.first, min_length, exponent)
                at = np.searchsorted(runs[:, 0], np.arange(piece.num_rows + 1)).astype(np.int32)
                fields = pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in (1, 2, 3)], fields=list(struct))
                kept = pa.array(collapsed(words, runs), pa.binary()).cast(pa.string())
                columns = [piece.column(0), pa.array(np.diff(words.first).astype(np.int64)), pa.ListArray.from_arrays(pa.array(at), fields), kept]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "text"])

    return texts(docs, doc_id, text).mapInArrow(search, "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, text string")
