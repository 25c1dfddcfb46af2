"""Benchmark decontamination by winnowing.

Of every window of ``width`` consecutive words, the smallest hash of its k-grams is the fingerprint:
equal windows have equal fingerprints, whatever stands around them, and neighbouring windows mostly
share theirs. Fingerprints of documents are joined with those of the test items; a document that has
some in common then spells its windows under these fingerprints, and the spelled windows are joined
with the items' distinct windows. So a hit is an equal sequence of words, and every shared span of
``width`` words is found. An item shorter than ``width`` is one window of its own length; for each
such length that occurs, documents get fingerprints of a family of that length.

A window is one row however many items have it, and documents that hit the same windows have their
items looked up once, so neither a common passage nor a common line multiplies documents by items.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulecast.llm.common import ship, small_batches, texts
from rulecast.llm.words import PLAIN, Words, cut, pieces, window_minima
from rulecast.operators.lineage import materialize
from rulecast.operators.skew import salted_join

WIDTH, GRAM = 13, 5
WINDOWS = "array<struct<at:bigint,width:int,said:string>>"


def window_prints(words: Words, width: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of the texts' windows of ``width`` words, and the windows' fingerprints."""
    k = min(gram, width)
    grams, _ = words.grams(k)
    _, inside = words.grams(width)
    least = window_minima(grams, width - k + 1)
    at = np.flatnonzero(inside)
    return at, (least[at] * np.uint64(2 * width + 1)).view(np.int64)


def _fingerprints(rows: DataFrame, widths: list[int], gram: int) -> DataFrame:
    """``key, fp`` of all windows of the given widths, each pair once."""

    def prints(batches):
        for batch in batches:
            for piece in pieces(batch):
                words = cut(piece.column(1), PLAIN)
                text = words.text_of_word()
                for width in widths:
                    at, fp = window_prints(words, width, gram)
                    pairs = np.stack([text[at], fp])
                    # Neighbours mostly share a fingerprint; few pairs are left to be sorted.
                    new = np.concatenate(([True], (pairs[:, 1:] != pairs[:, :-1]).any(axis=0)))[: len(at)]
                    pairs = np.unique(pairs[:, new], axis=1)
                    yield pa.RecordBatch.from_arrays([piece.column(0).take(pa.array(pairs[0])), pa.array(pairs[1])], names=["key", "fp"])

    return rows.mapInArrow(prints, "key bigint, fp bigint")


def item_windows(items: DataFrame, width: int, gram: int) -> DataFrame:
    """``window, said, width, fp, items``: the distinct windows of all items, and whose they are."""

    def windows(batches):
        for batch in batches:
            for piece in pieces(batch):
                words = cut(piece.column(1), PLAIN)
                said, n, text = spelled(words), words.counts(), words.text_of_word()
                found = []
                for own in sorted({min(int(c), width) for c in n} - {0}):
                    at, fp = window_prints(words, own, gram)
                    mine = np.minimum(n[text[at]], width) == own
                    found += [(int(text[i]), own, b" ".join(said[i : i + own]).decode(errors="replace"), f) for i, f in zip(at[mine].tolist(), fp[mine].tolist(), strict=True)]
                which = pa.array([f[0] for f in found], pa.int64())
                columns = [piece.column(0).take(which), pa.array([f[1] for f in found], pa.int32()), pa.array([f[2] for f in found], pa.string()), pa.array([f[3] for f in found], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["item", "width", "said", "fp"])

    rows = items.mapInArrow(windows, "item string, width int, said string, fp bigint")
    once = rows.groupBy("said", "width", "fp").agg(F.collect_set("item").alias("items"))
    return materialize(once.withColumn("window", F.monotonically_increasing_id()))


def spelled(words: Words) -> list[bytes]:
    data = PLAIN[1][words.data].tobytes()
    return [data[a:b] for a, b in zip(words.begin.tolist(), words.end.tolist(), strict=True)]


def find_contamination(docs: DataFrame, items: DataFrame, item_id: str = "item_id", width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, items`` (sorted strings), ``spans, key``.

    ``spans`` are the maximal runs of hit words, as [first, last) word numbers; ``key`` is
    ``document_key`` of the row. Null texts have no words and no hits, and items without words have
    no windows. Repeated item rows count once. Documents keep every row and are judged by their own
    texts, also rows with equal or null ids; an item without id has hits but is not listed. Other
    columns are ignored; without documents there are no rows, without items no hits.
    """
    spark = docs.sparkSession
    ship(spark)
    small_batches(spark)
    own = texts(docs).withColumn("key", document_key())
    tests = texts(items, item_id).select(F.col("doc_id").cast("string"), "text").distinct()
    windows = item_windows(tests, width, gram)
    widths = sorted(r.width for r in windows.select("width").distinct().collect())  # at most ``width`` numbers
    if not widths:
        windows, widths = windows.limit(0), [width]
    wanted = materialize(windows.select("fp").distinct())
    have = _fingerprints(own.select("key", "text"), widths, gram)
    met = have.join(wanted, "fp").groupBy("key").agg(F.collect_set("fp").alias("fps"))
    joined = own.join(met, "key", "left").select("key", "text", "doc_id", "fps")

    def spell(batches):
        for batch in batches:
            for piece in pieces(batch):
                words = cut(piece.column(1), PLAIN)
                found = [_spelled_windows(piece.column(1).slice(i, 1), fps, widths, gram) if fps else [] for i, fps in enumerate(piece.column(3).to_pylist())]
                kind = pa.list_(pa.struct([("at", pa.int64()), ("width", pa.int32()), ("said", pa.string())]))
                columns = [piece.column(0), piece.column(2), pa.array(words.counts(), pa.int64()), pa.array(found, kind)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "doc_id", "n_words", "windows"])

    spelled_ = materialize(joined.mapInArrow(spell, f"key bigint, doc_id bigint, n_words bigint, windows {WINDOWS}"))
    told = spelled_.select("key", F.explode("windows").alias("w")).select("key", "w.at", "w.width", "w.said").distinct()
    hits = salted_join(told, windows.select("said", "window"), ["said"], F.col("key"))
    by_key = hits.groupBy("key").agg(F.collect_list(F.struct("at", "width")).alias("hits"), F.array_sort(F.collect_set("window")).alias("set"))
    by_key = materialize(by_key)
    sets = by_key.select("set").distinct()
    named = sets.select("set", F.explode("set").alias("window")).join(windows.select("window", F.explode("items").alias("item")), "window")
    named = named.groupBy("set").agg(F.array_sort(F.collect_set("item")).alias("items"))
    runs = by_key.mapInArrow(_spans, "key bigint, set array<bigint>, n_hit bigint, spans array<array<bigint>>")
    found = salted_join(runs, named, ["set"], F.col("key"), "left")
    none = F.array().cast("array<string>"), F.array().cast("array<array<bigint>>")
    return spelled_.select("key", "doc_id", "n_words").join(found, "key", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"), F.coalesce("items", none[0]).alias("items"), F.coalesce("spans", none[1]).alias("spans"), "key"
    )


def document_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """What tells documents with different ids or texts apart."""
    return F.xxhash64(doc_id, F.coalesce(F.col(text), F.lit("")))


def _spelled_windows(text: pa.Array, fps: list[int], widths: list[int], gram: int) -> list[dict]:
    """The windows of one text that have one of the fingerprints."""
    words = cut(text, PLAIN)
    said, wanted, out = spelled(words), np.array(fps, np.int64), []
    for width in widths:
        at, fp = window_prints(words, width, gram)
        out += [{"at": i, "width": width, "said": b" ".join(said[i : i + width]).decode(errors="replace")} for i in at[np.isin(fp, wanted)].tolist()]
    return out


def _spans(batches):
    """The words covered by each document's hits: how many, and their runs."""
    for batch in batches:
        counts, spans = [], []
        for hits in batch.column(1).to_pylist():
            begin = np.array([h["at"] for h in hits])
            end = begin + np.array([h["width"] for h in hits])
            low = int(begin.min())
            delta = np.zeros(int(end.max()) - low + 1, np.int64)
            np.add.at(delta, begin - low, 1)
            np.add.at(delta, end - low, -1)
            hit = np.cumsum(delta[:-1]) > 0
            edges = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False]))))
            counts.append(int(hit.sum()))
            spans.append((edges + low).reshape(-1, 2).tolist())
        columns = [batch.column(0), batch.column(2), pa.array(counts, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64())))]
        yield pa.RecordBatch.from_arrays(columns, names=["key", "set", "n_hit", "spans"])
