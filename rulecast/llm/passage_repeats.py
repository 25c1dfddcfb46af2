"""Removal of passages that an earlier document has, by suffix automata of reference shards.

A window is ``width`` consecutive words. Each window chooses one of its 5-word grams by the
smallest hash; equal windows choose equally, so a passage can only repeat where a chosen gram
does. Around each gram that several documents chose, a document's windows make a segment. Equal
segments of a task are folded: all but the smallest document's are decided by that alone. The rest
is dealt by gram to reference shards of bounded size. A gram that more documents have than fit into a
shard is not dealt whole: its segments are cut into single windows, which are dealt by their own
words, so a frequent phrase with other words around it in each document is spread. Such a window
matches equal ones only and needs no automaton. A shard's segments become one suffix automaton over words, added in ascending order of
document, so that each state knows the first document of its strings. All segments of the shard's
grams are streamed through it: the matching statistics tell, for every window, the first document
that holds it. The whole corpus is reference and query at once, so automata are not broadcast to
all documents; a shard meets just the segments that can match it, and the work grows in line with
the input.
"""

import hashlib
from itertools import pairwise
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulecast.llm.common import ship, small_batches
from rulecast.llm.repeats import SCHEMA, keep_repeated, marked
from rulecast.llm.suffix_runs import pack, unpack
from rulecast.llm.words import EXACT, Words, cut, first_minima, pieces
from rulecast.operators.lineage import materialize

GRAM, SHARD_WORDS, HELD_BYTES = 5, 60_000, 40 << 20
SHARDS_PER_PARTITION, WINDOW_BUCKETS_PER_PARTITION = 64, 2


class SuffixAutomaton:
    """All word strings of the texts added so far; each state knows the first text that has its strings."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.size = [0]
        self.first = [-1]

    def _state(self, following: dict, link: int, size: int, first: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.size.append(size)
        self.first.append(first)
        return len(self.size) - 1

    def _split(self, before: int, word, state: int) -> int:
        """The state for the strings of ``state`` that end behind ``before``."""
        if self.size[before] + 1 == self.size[state]:
            return state
        copy = self._state(dict(self.next[state]), self.link[state], self.size[before] + 1, self.first[state])
        self.link[state] = copy
        while before >= 0 and self.next[before].get(word) == state:
            self.next[before][word] = copy
            before = self.link[before]
        return copy

    def add(self, words: list, text: int) -> None:
        following, link = self.next, self.link
        last = 0
        for word in words:
            known = following[last].get(word)
            if known is not None:
                last = self._split(last, word, known)
                continue
            new = self._state({}, 0, self.size[last] + 1, text)
            before = last
            while before >= 0 and word not in following[before]:
                following[before][word] = new
                before = link[before]
            if before >= 0:
                link[new] = self._split(before, word, following[before][word])
            last = new

    def first_texts(self, words: list, width: int) -> list[int | None]:
        """For each window of ``width`` words, the first text that holds it, if one does."""
        following, link, size, first = self.next, self.link, self.size, self.first
        out: list[int | None] = []
        state = length = 0
        for at, word in enumerate(words):
            while state and word not in following[state]:
                state = link[state]
                length = size[state]
            state = following[state].get(word, 0)
            length = length + 1 if state else 0
            if length >= width:
                while size[link[state]] >= width:
                    state = link[state]
                length = min(length, size[state])
            if at >= width - 1:
                out.append(first[state] if length >= width else None)
        return out


def choices(words: Words, width: int) -> tuple[np.ndarray, ...]:
    """(text, first window, last window, chosen gram's hash) of each run of windows with one choice."""
    gram = min(GRAM, width)
    counts = np.maximum(words.counts() - width + 1, 0)
    total = int(counts.sum())
    if not total:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    hashes, _ = words.grams(gram)
    text = np.repeat(np.arange(len(counts)), counts)
    window = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts) + words.first[:-1][text]
    chosen = first_minima(hashes, width - gram + 1)[window]
    first = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
    last = np.concatenate((first[1:], [total])) - 1
    begin = words.first[text[first]]
    return text[first], window[first] - begin, window[last] - begin, hashes[chosen[first]].view(np.int64)


def first_documents(segments: list[tuple[bytes, int]], width: int) -> list[list[int | None]]:
    """For the segments of one bucket, in ascending order of document, each window's first document.

    The segments are cut into reference shards of about ``SHARD_WORDS`` words, and all segments
    pass each shard's automaton.
    """
    said = [segment.split(b" ") for segment, _ in segments]
    found: list[list[int | None]] = [[None] * (len(words) - width + 1) for words in said]
    at = 0
    while at < len(said):
        automaton, words = SuffixAutomaton(), 0
        start = at
        while at < len(said) and (words < SHARD_WORDS or at == start):
            automaton.add(said[at], segments[at][1])
            words += len(said[at])
            at += 1
        for i in range(start, len(said)):
            if None in found[i]:
                new = automaton.first_texts(said[i], width)
                found[i] = [a if a is not None else b for a, b in zip(found[i], new, strict=True)]
    return found


def remove_earlier_passages(
    docs: DataFrame,
    width: int = 13,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: tuple[str, ...] | None = None,
    frequent: int | None = None,
) -> DataFrame:
    """``doc_id, n_words, n_removed, digest, kept`` of every document.

    Words are separated by white space and not changed. Removed is each word covered by a window of
    ``width`` words whose sequence also starts in a document with a smaller id; windows are judged
    on the input. ``kept`` is the text with the removed words and the white space before them taken
    out, null where nothing is removed, unless ``carry`` names columns to take along: then every row
    has its text there, and those columns follow; ``digest`` is the SHA-256 of the kept words, one blank
    between them. A null text has no words. Rows that share an id are one document, as none of them
    is smaller; a row with a null id is compared with nothing and stays whole. Other columns are
    ignored; no rows give no rows.

    A gram is ``frequent`` if more documents than that choose it, by default as many as have the words
    of one shard around it. It changes how the work is spread and never the result.
    """
    spark = docs.sparkSession
    ship(spark)
    small_batches(spark)
    frequent = SHARD_WORDS // (2 * width) if frequent is None else frequent
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    taken = [f"carried_{i}" for i in range(len(carry or ()))]
    carried = [F.col(name).alias(alias) for name, alias in zip(carry or (), taken, strict=True)]
    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), *carried)
    # Both joins below shuffle exactly these columns by the id, so Spark does it once.
    own = own.select("doc_id", F.xxhash64("text").alias("row"), "text", *taken)

    def chosen(batches):
        for batch in batches:
            for piece in pieces(batch):
                which, _, _, sig = choices(cut(piece.column(2), EXACT), width)
                yield marked(sig, piece.column(0).take(pa.array(which)), across_documents=True)

    repeated = materialize(keep_repeated(own.filter(F.col("doc_id").isNotNull()).select("doc_id", "row", "text").mapInArrow(chosen, SCHEMA)))
    often = materialize(repeated.groupBy("sig").agg(F.count("*").alias("n")).filter(F.col("n") > frequent).select("sig", F.col("sig").alias("often")))
    candidates = repeated.join(often, "sig", "left").groupBy(F.col("doc").alias("doc_id"))
    candidates = candidates.agg(F.collect_set("sig").alias("sigs"), F.collect_set("often").alias("often"))
    # Taken along so that the shuffled columns are the same as below.
    joined = own.join(candidates, "doc_id", "left").select("doc_id", "row", "text", "sigs", "often", *taken)

    def segment(batches):
        held = Segments(partitions, width)
        for batch in batches:
            for piece in pieces(batch):
                ids, row, sigs, often = (piece.column(i).to_pylist() for i in (0, 1, 3, 4))
                said = piece.column(2)
                which, first, last, sig = choices(cut(said, EXACT), width)
                begin = np.searchsorted(which, np.arange(len(ids) + 1))
                for i, wanted in enumerate(sigs):
                    if not wanted:
                        continue
                    words, spread = said[i].as_py().encode().split(), set(often[i])
                    here = slice(begin[i], begin[i + 1])
                    keep = np.flatnonzero(np.isin(sig[here], np.array(wanted, np.int64)))
                    for a, b, s in zip(first[here][keep].tolist(), last[here][keep].tolist(), sig[here][keep].tolist(), strict=True):
                        held.add(b" ".join(words[a : b + width]), None if s in spread else s, ids[i], row[i], a, b - a + 1)
                if held.size > HELD_BYTES:
                    yield from held.flush()
        yield from held.flush()

    def stream(batches):
        bucket, held = None, []
        for batch in batches:
            out = []
            for number, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if payload[:1] == KNOWN:
                    out.extend(_decided(payload))
                    continue
                if number != bucket and held:
                    out.extend(_streamed(held, width))
                    held = []
                bucket = number
                held.append(payload)
            yield from _hits(out)
        yield from _hits(_streamed(held, width))

    blocks = joined.mapInArrow(segment, "bucket bigint, payload binary")
    hits = blocks.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(stream, "doc_id bigint, row bigint, first int, last int")
    hits = hits.groupBy("doc_id").agg(F.collect_list(F.struct("row", "first", "last")).alias("hits"))
    found = own.join(hits, "doc_id", "left").select("doc_id", "row", "text", "hits", *taken)

    def remove(batches):
        for batch in batches:
            for piece in pieces(batch):
                out = []
                for row, said, hits_ in zip(*(piece.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                    words = said.encode().split()
                    spans = [(hit["first"], hit["last"]) for hit in hits_ or [] if hit["row"] == row]
                    if not spans:
                        out.append((len(words), 0, hashlib.sha256(b" ".join(words)).digest(), None if carry is None else said))
                        continue
                    change = np.zeros(len(words) + 1, np.int64)
                    first, last = np.array(spans).T
                    np.add.at(change, first, 1)
                    np.add.at(change, last + width, -1)
                    keep = np.cumsum(change[:-1]) == 0
                    kept = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
                    out.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).digest(), _without(said, keep)))
                types = (pa.int64(), pa.int64(), pa.binary(), pa.string())
                columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), types, strict=True)]
                more = [piece.column(4 + i) for i in range(len(taken))]
                yield pa.RecordBatch.from_arrays([piece.column(0), *columns, *more], names=["doc_id", "n_words", "n_removed", "digest", "kept", *taken])

    kinds = "".join(f", {name} {own.schema[name].dataType.simpleString()}" for name in taken)
    out = found.mapInArrow(remove, f"doc_id bigint, n_words bigint, n_removed bigint, digest binary, kept string{kinds}")
    return out.withColumnsRenamed(dict(zip(taken, carry or (), strict=True)))


#: What a block of rows is: occurrences that are decided, segments that ask the shard, or single windows of frequent grams.
KNOWN, ASKED, WINDOWS = b"k", b"a", b"w"


class Segments:
    """Segments that a task has met, each with the smallest document that it has been met in.

    An occurrence in another document is later than that one in all its windows, so it is decided
    here; only the smallest document's occurrences ask the shard. So a segment sends one document
    per task, however many have it. A segment without ``sig`` is one of a frequent gram.
    """

    def __init__(self, partitions: int, width: int):
        self.buckets = SHARDS_PER_PARTITION * partitions
        self.window_buckets = WINDOW_BUCKETS_PER_PARTITION * partitions
        self.width = width
        self.least: dict[bytes, tuple] = {}
        self.decided: list[tuple] = []
        self.size = 0

    def add(self, said: bytes, sig: int | None, doc: int, row: int, at: int, windows: int) -> None:
        known = self.least.get(said)
        if known is None:
            self.least[said] = (sig, doc, [(row, at)], windows)
            self.size += (len(said) + 300) * (windows if sig is None else 1)
        elif known[1] == doc:
            known[2].append((row, at))
        elif known[1] < doc:
            self.decided.append((doc, row, at, windows))
            self.size += 60
        else:
            self.decided.extend((known[1], r, k, windows) for r, k in known[2])
            self.least[said] = (sig, doc, [(row, at)], windows)

    def flush(self):
        compress = zstandard.ZstdCompressor(level=3).compress
        rows = []
        for a in range(0, len(self.decided), 2000):
            part = np.array(self.decided[a : a + 2000], np.int64).T
            body = pack([(part[0], "<i8"), (part[1], "<i8"), (part[2], "<i4"), (part[3], "<i4")])
            rows.append((hash((a, self.decided[a])) & (1 << 62) - 1, KNOWN + compress(body)))
        by_bucket: dict[int, list] = {}
        for said, (sig, doc, places, _) in self.least.items():
            if sig is not None:
                by_bucket.setdefault(sig % self.buckets, []).extend((said, doc, row, at) for row, at in places)
                continue
            words = said.split(b" ")
            for k in range(len(words) - self.width + 1):
                window = b" ".join(words[k : k + self.width])
                by_bucket.setdefault(self.buckets + crc32(window) % self.window_buckets, []).extend((window, doc, row, at + k) for row, at in places)
        for bucket, found in by_bucket.items():
            found.sort()
            said, doc, row, at = zip(*found, strict=True)
            body = pack([(np.array(doc), "<i8"), (np.array(row), "<i8"), (np.array(at), "<i4"), (np.frombuffer(b"\n".join(said), np.uint8), "u1")])
            rows.append((bucket, (ASKED if bucket < self.buckets else WINDOWS) + compress(body)))
        for a in range(0, len(rows), 200):
            keys, payloads = zip(*rows[a : a + 200], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(payloads, pa.binary())], names=["bucket", "payload"])
        self.least.clear()
        self.decided.clear()
        self.size = 0


def _decided(payload: bytes):
    body = zstandard.ZstdDecompressor().decompress(payload[1:])
    for doc, row, at, windows in zip(*(x.tolist() for x in unpack(body, ["<i8", "<i8", "<i4", "<i4"])), strict=True):
        yield doc, row, at, at + windows - 1


def _streamed(payloads: list[bytes], width: int):
    """``(doc, row, first, last)`` of the stretches of windows in one bucket that an earlier document has."""
    asked = []
    for payload in payloads:
        doc, row, at, said = unpack(zstandard.ZstdDecompressor().decompress(payload[1:]), ["<i8", "<i8", "<i4", "u1"])
        asked.extend(zip(said.tobytes().split(b"\n"), doc.tolist(), row.tolist(), at.tolist(), strict=True))
    least: dict[bytes, int] = {}
    for said, doc, _, _ in asked:
        least[said] = min(doc, least.get(said, doc))
    if payloads and payloads[0][:1] == WINDOWS:
        yield from ((doc, row, at, at) for said, doc, row, at in asked if least[said] < doc)
        return
    ordered = sorted(least.items(), key=lambda x: (x[1], x[0]))
    firsts = dict(zip((said for said, _ in ordered), first_documents(ordered, width), strict=True))
    for said, doc, row, at in asked:
        later = [False, *(first < doc for first in firsts[said]), False]
        edges = [at + k for k, (one, two) in enumerate(pairwise(later)) if one != two]
        for first, stop in zip(edges[::2], edges[1::2], strict=True):
            yield doc, row, first, stop - 1


def _hits(found):
    out = list(found)
    for a in range(0, len(out), 2000):
        doc, row, first, last = zip(*out[a : a + 2000], strict=True)
        columns = [pa.array(doc, pa.int64()), pa.array(row, pa.int64()), pa.array(first, pa.int32()), pa.array(last, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row", "first", "last"])


def _without(said: str, keep: np.ndarray) -> str:
    """The text without some words and the white space before each of them."""
    raw = said.encode()
    words = cut(pa.array([said], pa.string()), EXACT)
    parts, at = [], 0
    for edge in np.flatnonzero(np.diff(np.concatenate(([True], keep, [True])).astype(int)) < 0).tolist():
        after = edge
        while after < len(keep) and not keep[after]:
            after += 1
        parts.append(raw[at : int(words.end[edge - 1]) if edge else 0])
        at = int(words.end[after - 1])
    parts.append(raw[at:])
    return b"".join(parts).decode().lstrip() if not keep[0] else b"".join(parts).decode()
