"""Toxicity by compression distance.

Two zstandard dictionaries are trained. The ordinary one is trained on windows of ordinary text.
The toxic one holds the same plus the words and word beginnings of toxic text that stand out from
ordinary text: each counts once per context (so copies of a passage count once), and enters if its
counts in the two classes differ by a G-test. A window of ``window`` words is compressed with either
dictionary, with a tail that both know so that the frame is compressed at any length. The toxic
dictionary saves bytes where toxic text occurs and nothing elsewhere, because all else is common to
both. How many windows save at least 2, 3, 4 or 5 bytes, and how many windows there are, goes into
a logistic model fitted on the training documents, which sets the thresholds.

A one-word window is the default: such windows repeat, so each distinct one of a chunk of documents
is compressed once.
"""

import string
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulecast.llm.common import ship, small_batches, texts
from rulecast.llm.words import BLANKS, _classes, cut, mix, pieces
from rulecast.operators.lineage import materialize

MARKS = string.punctuation
SEPARATED = _classes(BLANKS + MARKS, fold=True)
SAVED = (2, 3, 4, 5)
BEGINNINGS = (5,)
LEVEL, DICTIONARY_BYTES, TAIL_BYTES, G_LIMIT, WORDS_LIMIT = 6, 4096, 64, 30.0, 1500
SAMPLES = 60_000
CHUNK_BYTES, CACHE_WINDOWS = 1 << 20, 200_000
#: The offsets that a trained dictionary ends its tables with; its content follows.
_REPEATS = b"\1\0\0\0\4\0\0\0\x08\0\0\0"


@dataclass
class ToxicityModel:
    """What scoring needs: two dictionaries, the shared tail, and the logistic model."""

    ordinary: bytes
    toxic: bytes
    raw: bool
    tail: bytes
    window: int
    weights: list[float]
    known: dict[str, int] = field(default_factory=dict)

    def _compressor(self, content: bytes) -> zstandard.ZstdCompressor:
        kind = zstandard.DICT_TYPE_RAWCONTENT if self.raw else zstandard.DICT_TYPE_FULLDICT
        return zstandard.ZstdCompressor(
            level=LEVEL,
            dict_data=zstandard.ZstdCompressionDict(content, dict_type=kind),
            write_content_size=False,
            write_checksum=False,
            write_dict_id=False,
        )

    def start(self) -> "ToxicityModel":
        self.compressors = self._compressor(self.ordinary), self._compressor(self.toxic)
        return self

    def saved(self, windows: list[str]) -> np.ndarray:
        """Bytes that the toxic dictionary saves on each window."""
        raw = [b" " + w.encode() + b" " + self.tail for w in windows]
        size = np.fromiter(map(len, raw), np.uint64, len(raw))
        places = np.stack([np.cumsum(size) - size, size], axis=1).astype("<u8").tobytes()
        held = zstandard.BufferWithSegments(b"".join(raw), places)
        one, other = (c.multi_compress_to_buffer(held) for c in self.compressors)
        return np.fromiter((len(one[i]) - len(other[i]) for i in range(len(raw))), np.int64, len(raw))

    def _saved_by_distinct(self, windows: list[str]) -> np.ndarray:
        """As ``saved``, through a bounded cache."""
        found = np.fromiter((self.known.get(w, -9999) for w in windows), np.int64, len(windows))
        missing = np.flatnonzero(found == -9999)
        for a in range(0, len(missing), 20_000):
            part = missing[a : a + 20_000]
            new = [windows[i] for i in part]
            found[part] = self.saved(new)
            if len(self.known) < CACHE_WINDOWS:
                self.known.update((w, s) for w, s in zip(new, found[part].tolist(), strict=True) if len(w) <= 32)
        return found

    def features(self, column: pa.Array) -> np.ndarray:
        """Per text: how many windows save at least each of ``SAVED`` bytes, and how many there are."""
        parts = pc.ascii_split_whitespace(column)
        offsets = parts.offsets.to_numpy().astype(np.int64)
        offsets = offsets - offsets[0]
        numbered = parts.flatten().dictionary_encode()
        words = [w.lower().strip(MARKS) for w in numbered.dictionary.to_pylist()]
        if self.window == 1:
            gain = self._saved_by_distinct(words)[numbered.indices.to_numpy()]
        else:
            said = [words[i] for i in numbered.indices.to_pylist()]
            starts = [(i, min(i + self.window, b)) for a, b in zip(offsets[:-1], offsets[1:], strict=True) for i in range(a, b, self.window)]
            gain = self._saved_by_distinct([" ".join(said[i:j]) for i, j in starts])
            offsets = np.concatenate(([0], np.cumsum(-(-np.diff(offsets) // self.window))))
        total = [np.concatenate(([0], np.cumsum(gain >= least))) for least in SAVED]
        counts = [np.diff(t[offsets]) for t in total] + [np.diff(offsets)]
        return np.log1p(np.stack(counts, axis=1).astype(float))

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ np.array(self.weights[1:]) + self.weights[0], -60, 60)))


def _units(column: pa.Array):
    """Per piece of the texts: hashes of words and word beginnings, of their contexts, and the words."""
    for batch in pieces(pa.RecordBatch.from_arrays([column], names=["text"]), limit=1 << 20):
        words = cut(batch.column(0), SEPARATED)
        h = words.hashes
        if not len(h):
            continue
        around = np.concatenate(([np.uint64(1)], h[:-1])) * np.uint64(0x9E3779B97F4A7C15) + np.concatenate((h[1:], [np.uint64(2)]))
        context = mix(around + mix(h))
        folded = SEPARATED[1][words.data]
        units, begins, ends, contexts = [h], [words.begin], [words.end], [context]
        for length in BEGINNINGS:
            longer = np.flatnonzero(words.end - words.begin > length)
            beginning = np.full(len(longer), length, np.uint64)
            for j in range(length):
                beginning = beginning * np.uint64(0x2545F4914F6CDD1D) + folded[words.begin[longer] + j]
            units.append(mix(beginning))
            begins.append(words.begin[longer])
            ends.append(words.begin[longer] + length)
            contexts.append(context[longer])
        yield (*map(np.concatenate, (units, contexts, begins, ends)), folded)


def _contexts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of words and word beginnings, how many distinct contexts each has)."""
    pairs = np.zeros((2, 0), np.uint64)
    for unit, context, *_ in _units(column):
        both = np.concatenate((pairs, np.stack((mix(unit + context), unit))), axis=1)
        pairs = both[:, np.unique(both[0], return_index=True)[1]]
    return np.unique(pairs[1], return_counts=True)


def standing_out(toxic: pa.Array, ordinary: pa.Array) -> list[bytes]:
    """Words and beginnings with significantly more contexts in toxic than in ordinary text, rarest first."""
    hashes, a = _contexts(toxic)
    others, counts = _contexts(ordinary)
    if not len(hashes) or not len(others):
        return []
    at = np.minimum(np.searchsorted(others, hashes), len(others) - 1)
    b = np.where(others[at] == hashes, counts[at], 0)
    share = a.sum() / (a.sum() + counts.sum())
    n = a + b
    g = 2 * (a * np.log(a / (n * share)) + np.where(b > 0, b * np.log(np.maximum(b, 1) / (n * (1 - share))), 0))
    chosen = np.flatnonzero((a / n > (1 + share) / 2) & (g > G_LIMIT))
    chosen = chosen[np.argsort(a[chosen], kind="stable")][-WORDS_LIMIT:]
    said: dict[int, bytes] = {}
    for unit, _, begin, end, folded in _units(toxic):
        for i in np.flatnonzero(np.isin(unit, hashes[chosen])).tolist():
            said.setdefault(int(unit[i]), folded[begin[i] : end[i]].tobytes())
    return [said[int(h)] for h in hashes[chosen]]


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1) -> list[float]:
    """Logistic regression by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -60, 60)))
        slope = x.T @ (weight * (p - y)) + penalty * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def windows_of(said: list[str], window: int, most: int) -> list[bytes]:
    """At most about ``most`` windows of the texts, evenly spread over all their words."""
    step = max(1, -(-sum(-(-len(text.split()) // window) for text in said) // most))
    out, at = [], 0
    for text in said:
        words = text.split()
        starts = range(0, len(words), window)
        for a in starts[-at % step :: step]:
            out.append((" " + " ".join(w.lower().strip(MARKS) for w in words[a : a + window]) + " ").encode())
        at += len(starts)
    return [s for s in out if s.strip()]


def train(toxic: list[str], ordinary: list[str], share: float, window: int = 1) -> ToxicityModel:
    """A model from labelled texts; ``share`` is the part of toxic texts among all that have labels.

    Without toxic or without ordinary texts the score is ``share`` for every text.
    """
    one, other = pa.array(toxic, pa.string()), pa.array(ordinary, pa.string())
    samples = windows_of(ordinary, window, SAMPLES)
    try:
        common = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
        head, content, raw = *_split(common), False
    except (zstandard.ZstdError, ValueError):  # too few samples to train on
        head, content, raw = b"", b"".join(dict.fromkeys(samples))[-DICTIONARY_BYTES:] or b" " * 16, True
    out = b" " + b" ".join(standing_out(one, other)) + b" "
    tail = content[-TAIL_BYTES:]
    prior = float(np.log((share + 1e-9) / (1 - share + 1e-9)))
    model = ToxicityModel(head + content, head + out + content, raw, tail, window, [prior] + [0.0] * (len(SAVED) + 1))
    if toxic and ordinary:
        model.start()
        x = np.concatenate([model.features(column.slice(i, 300)) for column in (one, other) for i in range(0, len(column), 300)])
        y = np.concatenate([np.ones(len(toxic)), np.zeros(len(ordinary))])
        weight = np.where(y == 1, share / len(toxic), (1 - share) / len(ordinary)) * len(y)
        model.weights = _fit(x, y, weight)
        model.known.clear()
        del model.compressors
    return model


def _split(dictionary: bytes) -> tuple[bytes, bytes]:
    at = dictionary.index(_REPEATS) + len(_REPEATS)
    return dictionary[:at], dictionary[at:]


def held_out() -> Column:
    """The fold that is never learned from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def fit_toxicity(docs: DataFrame, labels: DataFrame, toxic_docs: int = 1500, ordinary_docs: int = 3000, window: int = 1) -> ToxicityModel:
    """Train on labelled documents that are not held out.

    ``toxic_docs`` and ``ordinary_docs`` bound the sample of each class; it is chosen by a hash of
    the id, so it is the same in every run. The class shares are counted over all labels. Rows
    with a null id, label or an id labelled both ways are not used.
    """
    marked = labels.select("doc_id", "toxic").filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
    marked = marked.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).filter("toxic = most").drop("most")
    counts = {r.toxic: r.n for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64("doc_id")
    chosen = marked.filter("toxic = 1").orderBy(order, "doc_id").limit(toxic_docs).unionByName(marked.filter("toxic = 0").orderBy(order, "doc_id").limit(ordinary_docs))
    sample = texts(docs).join(F.broadcast(materialize(chosen)), "doc_id").select("toxic", "doc_id", "text").distinct().orderBy("doc_id", "text")
    found: dict[int, list[str]] = {0: [], 1: []}
    for row in sample.toLocalIterator():
        found[row.toxic].append(row.text)
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    return train(found[1], found[0], share, window)


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, score, predicted`` of every document, from its text alone.

    The score is between 0 and 1, and ``predicted`` is 1 from 0.5 on. Null and empty texts have no
    windows and get the model's score for that. Rows with repeated or null ids all stay; other
    columns are ignored; no rows give no rows.
    """
    ship(docs.sparkSession)
    small_batches(docs.sparkSession)

    def score(batches):
        own = ToxicityModel(model.ordinary, model.toxic, model.raw, model.tail, model.window, model.weights).start()
        for batch in batches:
            for piece in pieces(batch, limit=CHUNK_BYTES):
                scores = own.scores(own.features(piece["text"]))
                yield pa.RecordBatch.from_arrays([piece["doc_id"], pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return texts(docs).mapInArrow(score, "doc_id bigint, score double, predicted int")


def keep_ordinary(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, that the model does not find toxic.

    A null text is scored as the empty one and stays as it is.
    """
    ship(docs.sparkSession)
    small_batches(docs.sparkSession)

    def keep(batches):
        own = ToxicityModel(model.ordinary, model.toxic, model.raw, model.tail, model.window, model.weights).start()
        for batch in batches:
            for piece in pieces(batch, text, CHUNK_BYTES):
                yield piece.filter(pa.array(own.scores(own.features(piece[text].fill_null(""))) < 0.5))

    return docs.mapInArrow(keep, docs.schema)
