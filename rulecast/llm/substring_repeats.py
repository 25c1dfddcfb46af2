"""Removal of byte strings that occur more than once, by a distributed sort of suffixes.

Which suffixes are sorted: every window of ``length`` bytes chooses the position with the smallest
hash of 16 bytes in its first part, so equal windows choose the same position, and only suffixes
that some window chose matter. A suffix whose first bytes (those every such window still has right
of the position) occur nowhere else is dropped after a test of their hashes: its distinguishing
prefix is too short for a repeat.

How they are sorted: each task sorts the suffixes of its documents, folds equal ones, and writes
front-coded runs, dealt by the hash of the first bytes. The task that gets a bucket merges its runs
by a loser tree that never compares bytes known to be equal. Suffixes that share ``length`` bytes,
some of them left of the position, stand in one stretch of the merged order; the stretch tells
which windows of each suffix occur again. All comparisons are of the bytes themselves.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulecast.llm.common import ship, small_batches
from rulecast.llm.repeats import SCHEMA, keep_repeated, marked
from rulecast.llm.suffix_runs import decode_run, front_code, merge_runs, pack, shared_end, unpack
from rulecast.llm.words import first_minima, mix, pieces
from rulecast.operators.lineage import materialize

SLICE_BYTES, RUN_BYTES, FEW = 1 << 20, 24 << 20, 24
DONE, PLACE, RUN, TEXT = range(4)
_BASE = 0x9E3779B97F4A7C15


def shape(length: int) -> tuple[int, int, int]:
    """(bytes of a hashed gram, bytes that the test of suffixes reads, grams a window chooses from)."""
    gram = 1
    while gram < 16 and gram * 8 <= length:
        gram *= 2
    tested = gram * max(1, length // 5 // gram)
    return gram, tested, length - tested + 1


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(text, position, first window, last window, hash of the tested bytes) of each choice.

    Positions and windows count from the beginning of ``data``. Windows of one choice are
    consecutive. Long texts are worked in slices that overlap by a window.
    """
    found = []
    for text in range(len(offsets) - 1):
        begin, end = int(offsets[text]), int(offsets[text + 1])
        if end - begin > 2 * SLICE_BYTES:
            for a in range(begin, end - length + 1, SLICE_BYTES):
                b = min(end, a + SLICE_BYTES + length - 1)
                part = _anchors(data[a:b], np.array([0, b - a]), length)
                found.append((np.full(len(part[1]), text), part[1] + a, part[2] + a, part[3] + a, part[4]))
    if not found:
        return _anchors(data, offsets, length)
    for text in range(len(offsets) - 1):
        begin, end = int(offsets[text]), int(offsets[text + 1])
        if length <= end - begin <= 2 * SLICE_BYTES:
            part = _anchors(data[begin:end], np.array([0, end - begin]), length)
            found.append((np.full(len(part[1]), text), part[1] + begin, part[2] + begin, part[3] + begin, part[4]))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    gram, tested, width = shape(length)
    size = np.maximum(np.diff(offsets) - length + 1, 0)
    total = int(size.sum())
    if not total:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    text = np.repeat(np.arange(len(size)), size)
    window = np.arange(total) - np.repeat(np.cumsum(size) - size, size) + offsets[:-1][text]
    rolled, reach, factor = data.astype(np.uint64) + np.uint64(1), 1, _BASE
    while reach < gram:
        rolled = rolled[:-reach] * np.uint64(factor) + rolled[reach:]
        reach, factor = 2 * reach, factor * factor & (1 << 64) - 1
    rolled = mix(rolled)
    chosen = first_minima(rolled, width)[window]
    first = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
    last = np.concatenate((first[1:], [total])) - 1
    at = chosen[first]
    test = np.zeros(len(at), np.uint64)
    for step in range(0, tested, gram):
        test = mix(test * np.uint64(_BASE) + rolled[at + step])
    return text[first], at, window[first], window[last], test.view(np.int64)


def _raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def repeated_offsets(members: list[tuple[bytes, int, bytes, int]], length: int) -> list[list[tuple[int, int]]]:
    """For each suffix of a sorted stretch, the windows that occur again, as ranges of offsets.

    A member is (bytes from the position on, prefix shared with the member before, bytes left of
    it, how often). A window at offset ``o`` begins ``o`` bytes left of the position; it is
    repeated if another member has the same ``o`` bytes on the left and ``length - o`` on the right.
    """
    spans: list[list[tuple[int, int]]] = []
    for right, _, left, times in members:
        spans.append([(length - len(right), len(left))] if times > 1 else [])
    if len(members) <= FEW:
        for i in range(len(members)):
            common = length
            for j in range(i + 1, len(members)):
                common = min(common, members[j][1])
                ends = shared_end(members[i][2], members[j][2])
                if length - common <= ends:
                    for k in (i, j):
                        if members[k][3] == 1:
                            spans[k].append((max(length - common, length - len(members[k][0])), min(ends, len(members[k][2]))))
        return [[s for s in x if s[0] <= s[1]] for x in spans]
    order = np.array(sorted(range(len(members)), key=lambda i: members[i][2][::-1]))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    near = np.array([0] + [shared_end(members[a][2], members[b][2]) for a, b in zip(order[:-1].tolist(), order[1:].tolist(), strict=True)])
    table = [near]
    while 2 ** len(table) <= len(near):
        half = 2 ** (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    table = [np.concatenate((t, np.zeros(len(near) - len(t), np.int64))) for t in table]
    levels = np.stack(table)
    common = np.array([0] + [m[1] for m in members[1:]])
    for depth in sorted(set(common[1:].tolist()), reverse=True):
        cluster = np.cumsum(common < depth)
        sequence = np.lexsort((rank, cluster))
        a, b = sequence[:-1], sequence[1:]
        same = np.flatnonzero(cluster[a] == cluster[b])
        if not len(same):
            continue
        low, high = rank[a[same]] + 1, rank[b[same]] + 1
        power = np.frexp((high - low).astype(float))[1] - 1
        ends = np.minimum(levels[power, low], levels[power, high - 2**power])
        best = np.full(len(members), -1)
        np.maximum.at(best, a[same], ends)
        np.maximum.at(best, b[same], ends)
        for i in np.flatnonzero(best >= length - depth).tolist():
            right, _, left, times = members[i]
            span = (max(length - depth, length - len(right)), min(int(best[i]), len(left)))
            if times == 1 and span[0] <= span[1] and (not spans[i] or spans[i][-1][0] > span[0] or spans[i][-1][1] < span[1]):
                spans[i].append(span)
    return spans


def _write_runs(classes: dict[bytes, list], buckets: int):
    """Front-coded runs of what a task holds, one per bucket, as RUN rows."""
    by_bucket: dict[int, list] = {}
    for cid, (test, right, left, times) in classes.items():
        by_bucket.setdefault(test % buckets, []).append((right, left, times, cid))
    rows = []
    for bucket, run in by_bucket.items():
        run.sort(key=lambda m: (m[0], m[1]))
        prefix, rests, sizes = front_code([m[0] for m in run])
        lefts = b"".join(m[1] for m in run)
        payload = pack(
            [
                (np.array(prefix), "<u2"),
                (np.array(sizes), "<u4"),
                (np.frombuffer(rests, np.uint8), "u1"),
                (np.array([len(m[1]) for m in run]), "<u4"),
                (np.frombuffer(lefts, np.uint8), "u1"),
                (np.array([m[2] for m in run]), "u1"),
                (np.frombuffer(b"".join(m[3] for m in run), np.uint8), "u1"),
            ]
        )
        rows.append((bucket, payload))
    return rows


def _read_run(payload: bytes):
    """(string, shared prefix, left bytes, times, id) entries of a run."""
    prefix, sizes, rests, left_sizes, lefts, times, ids = unpack(payload, ["<u2", "<u4", "u1", "<u4", "u1", "u1", "u1"])
    lefts, ids, at = lefts.tobytes(), ids.tobytes(), 0
    strings = decode_run(prefix.tolist(), rests.tobytes(), sizes.tolist())
    for k, ((string, common), left_size) in enumerate(zip(strings, left_sizes.tolist(), strict=True)):
        yield string, common, lefts[at : at + left_size], int(times[k]), ids[16 * k : 16 * k + 16]
        at += left_size


def _stretches(entries, tested: int):
    """Stretches of the merged order whose members share the tested bytes, equal members folded."""
    held: list[list] = []
    equal: dict[bytes, list] = {}  # members of the stretch that end with the same string
    for string, common, left, times, cid in entries:
        if held and common < tested:
            yield held
            held = []
        if not held or not common == len(string) == len(held[-1][0]):
            equal = {}
        if cid in equal:
            equal[cid][3] = 2
        else:
            equal[cid] = [string, common, left, times, cid]
            held.append(equal[cid])
    if held:
        yield held


def remove_repeated_substrings(docs: DataFrame, length: int = 400, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, digest`` (SHA-256 of what is kept) of every document.

    Removed is each byte covered by a string of ``length`` bytes (at most 65,535) that also starts
    at another place, in any document; overlaps count, and strings are judged on the input. A null
    text counts as empty. Every row is a document of its own: rows with equal texts repeat each
    other, whatever their ids, null ids included. Other columns are ignored; no rows give no rows.
    """
    if not 8 <= length < 1 << 16:
        raise ValueError("length must be from 8 to 65535 bytes")
    spark = docs.sparkSession
    ship(spark)
    small_batches(spark)
    _, tested, _ = shape(length)
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    own = own.select(F.xxhash64("doc_id", "text").alias("rid"), "doc_id", "text")

    def test(batches):
        for batch in batches:
            for piece in pieces(batch, limit=SLICE_BYTES):
                which, _, _, _, tests = anchors(*_raw(piece.column(1)), length)
                yield marked(tests, piece.column(0).take(pa.array(which)), across_documents=False)

    tests = keep_repeated(own.select("rid", "text").mapInArrow(test, SCHEMA))
    candidates = tests.groupBy("doc").agg(F.collect_set("sig").alias("sigs")).select(F.col("doc").alias("rid"), "sigs")
    joined = own.join(candidates, "rid", "left").select("rid", "doc_id", "text", "sigs")
    kinds = {"kind": pa.int32(), "rid": pa.int64(), "doc_id": pa.int64(), "at": pa.int64(), "cid": pa.binary(), "text": pa.string()}

    def rows_of(kind, rid, doc, at, cid, said):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(([kind] * len(rid), rid, doc, at, cid, said), kinds.values(), strict=True)], names=list(kinds))

    def sort(batches):
        classes: dict[bytes, list] = {}
        held = 0

        def flush():
            runs = _write_runs(classes, buckets)
            classes.clear()
            for bucket, payload in runs:
                yield rows_of(RUN, [None], [None], [bucket], [payload], [None])

        for batch in batches:
            for piece in pieces(batch, limit=SLICE_BYTES):
                rids, ids, sigs = (piece.column(i).to_pylist() for i in (0, 1, 3))
                said = piece.column(2)
                done = [i for i, s in enumerate(sigs) if not s]
                if done:
                    raw = [said[i].as_py() for i in done]
                    digest = [hashlib.sha256(t.encode()).digest() for t in raw]
                    yield rows_of(DONE, [rids[i] for i in done], [ids[i] for i in done], [len(t.encode()) for t in raw], digest, [None] * len(done))
                for i, wanted in enumerate(sigs):
                    if not wanted:
                        continue
                    whole = said[i].as_py()
                    raw = whole.encode()
                    yield rows_of(TEXT, [rids[i]], [ids[i]], [len(raw)], [None], [whole])
                    _, position, first, last, tests_ = anchors(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), length)
                    here = np.flatnonzero(np.isin(tests_, np.array(wanted, np.int64)))
                    places, names = [], []
                    for q, a, b, t in zip(position[here].tolist(), first[here].tolist(), last[here].tolist(), tests_[here].tolist(), strict=True):
                        left, right = raw[a:q], raw[q : b + length]
                        cid = hashlib.blake2b(left, digest_size=16, key=len(left).to_bytes(4, "little"))
                        cid.update(right)
                        places.append(q)
                        names.append(cid.digest())
                        if names[-1] in classes:
                            classes[names[-1]][3] = 2
                        else:
                            classes[names[-1]] = [t, right, left, 1]
                            held += len(left) + len(right) + 200
                    if places:
                        yield rows_of(PLACE, [rids[i]] * len(places), [ids[i]] * len(places), places, names, [None] * len(places))
                    if held > RUN_BYTES:
                        yield from flush()
                        held = 0
        if classes:
            yield from flush()

    made = materialize(joined.mapInArrow(sort, "kind int, rid bigint, doc_id bigint, at bigint, cid binary, text string"))

    def merge(batches):
        bucket, payloads = None, []

        def merged():
            out = []
            for stretch in _stretches(merge_runs([_read_run(p) for p in payloads]), tested):
                if len(stretch) == 1 and stretch[0][3] == 1:
                    continue
                for member, spans in zip(stretch, repeated_offsets([tuple(m[:4]) for m in stretch], length), strict=True):
                    if spans:
                        out.append((member[4], [s[0] for s in spans], [s[1] for s in spans]))
            for a in range(0, len(out), 5000):
                part = list(zip(*out[a : a + 5000], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(part[0], pa.binary()), *(pa.array(c, pa.list_(pa.int32())) for c in part[1:])], names=["cid", "least", "most"])

        for batch in batches:
            for number, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if number != bucket and payloads:
                    yield from merged()
                    payloads = []
                bucket = number
                payloads.append(payload)
        if payloads:
            yield from merged()

    runs = made.filter(F.col("kind") == RUN).select(F.col("at").alias("bucket"), F.col("cid").alias("payload"))
    offsets = runs.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(merge, "cid binary, least array<int>, most array<int>")
    places = made.filter(F.col("kind") == PLACE).select("rid", "doc_id", "at", "cid").join(offsets, "cid")
    spans = places.select("rid", "doc_id", F.explode(F.arrays_zip("least", "most")).alias("o"), "at")
    spans = spans.groupBy("rid", "doc_id").agg(F.collect_list(F.struct((F.col("at") - F.col("o.most")).alias("a"), (F.col("at") - F.col("o.least") + length).alias("b"))).alias("spans"))
    whole = made.filter(F.col("kind") == TEXT).select("rid", "doc_id", "text").alias("t")
    cut = whole.join(spans.alias("s"), (F.col("t.rid") == F.col("s.rid")) & F.col("t.doc_id").eqNullSafe(F.col("s.doc_id")), "left").select("t.doc_id", "t.text", "s.spans")

    def remove(batches):
        for batch in batches:
            out = []
            for said, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw = said.encode()
                removed, runs_, at, kept = 0, 0, 0, []
                for a, b in _union(found or []):
                    kept.append(raw[at:a])
                    removed, runs_, at = removed + b - a, runs_ + 1, b
                kept.append(raw[at:])
                out.append((len(raw), removed, runs_, hashlib.sha256(b"".join(kept)).digest()))
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)] if out else [pa.array([], k) for k in (pa.int64(), pa.int64(), pa.int64(), pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_bytes", "n_removed", "n_spans", "digest"])

    changed = cut.mapInArrow(remove, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, digest binary")
    none = F.lit(0).cast("bigint")
    same = made.filter(F.col("kind") == DONE).select("doc_id", F.col("at").alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"), F.col("cid").alias("digest"))
    return same.unionByName(changed)


def _union(spans: list) -> list[tuple[int, int]]:
    """Maximal covered runs; runs that touch are one."""
    out: list[list[int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]
