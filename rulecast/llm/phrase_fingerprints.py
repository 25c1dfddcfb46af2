"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed as an incremental (LZ78) compressor does: a phrase is the longest phrase known so
far and one more character. The set of phrases stands for the text; texts that compress each other
well share phrases. Each phrase is hashed, and the ``SIZE`` smallest hashes are the fingerprint, so
the share of common hashes among the smallest of two fingerprints estimates the likeness of the
two phrase sets (exactly for sets of up to ``SIZE`` phrases).
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulecast.llm.common import ship, small_batches, texts
from rulecast.llm.words import mix

SIZE = 64
_MASK = (1 << 64) - 1
_FACTOR = 0x9E3779B97F4A7C15


class Phrases:
    """The phrase tree of a text; text can be added, and taken back to an earlier state."""

    def __init__(self) -> None:
        self.root: dict = {"": 0x5DEECE66D}
        self.node = self.root
        self.hashes: list[int] = []
        self.grown: list[tuple[dict, str]] = []

    def add(self, text: str) -> None:
        node, root, hashes, grown = self.node, self.root, self.hashes, self.grown
        for char in text:
            below = node.get(char)
            if below is None:
                value = (node[""] * _FACTOR + ord(char)) & _MASK
                node[char] = {"": value}
                hashes.append(value)
                grown.append((node, char))
                node = root
            else:
                node = below
        self.node = node

    def state(self) -> tuple[dict, int]:
        return self.node, len(self.hashes)

    def back_to(self, state: tuple[dict, int]) -> None:
        self.node, size = state
        for node, char in reversed(self.grown[size:]):
            del node[char]
        del self.hashes[size:], self.grown[size:]

    def fingerprint(self, size: int = SIZE) -> tuple[int, ...]:
        hashes = mix(np.array(self.hashes, np.uint64)) >> np.uint64(32)
        return tuple(np.unique(hashes)[:size].tolist())


def fingerprint(text: str, size: int = SIZE) -> tuple[int, ...]:
    phrases = Phrases()
    phrases.add(text)
    return phrases.fingerprint(size)


def likeness(a: tuple[int, ...], b: tuple[int, ...], size: int = SIZE) -> float:
    """Estimated share of common phrases, 0 to 1; texts without phrases are like each other only."""
    if a == b:
        return 1.0
    one, other = set(a), set(b)
    smallest = sorted(one | other)[:size]
    common = one & other
    return sum(x in common for x in smallest) / len(smallest)


def as_text(values: tuple[int, ...]) -> str:
    return "".join(f"{x:08x}" for x in values)


def from_text(text: str) -> tuple[int, ...]:
    return tuple(int(text[i : i + 8], 16) for i in range(0, len(text), 8))


def fingerprint_documents(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """``doc_id, n_chars, fingerprint`` of every row; null texts count as empty, with no hashes."""
    ship(docs.sparkSession)
    small_batches(docs.sparkSession)

    def prints(batches):
        for batch in batches:
            said = batch.column(1).to_pylist()
            found = [as_text(fingerprint(text, size)) for text in said]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(len, said), pa.int64()), pa.array(found, pa.string())], names=["doc_id", "n_chars", "fingerprint"])

    return texts(docs).mapInArrow(prints, "doc_id bigint, n_chars bigint, fingerprint string")


def in_order_with_next(docs: DataFrame) -> DataFrame:
    """Documents in ascending order in blocks of one partition each, with a sight of the next block.

    Block bounds are quantiles of the ids that occur, one block for each shuffle partition. Every
    row of a bound's id is also sent to the block before (``ahead`` is true), the rows of the first
    id to the last block, so each block knows what follows its last document.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / n for i in range(1, n)]
    found = docs.agg(F.min("doc_id").alias("least"), F.percentile_approx("doc_id", shares or [0.5], 100 * n).alias("cuts")).first()
    least = found.least
    cuts = sorted({c for c in found.cuts or [] if c > least}) if least is not None else []
    if n == 1:
        cuts = []

    def at(low: list[int]):  # how many cuts are not above the id
        return F.size(F.filter(F.array(*map(F.lit, low)), lambda c: c <= F.col("doc_id"))) if low else F.lit(0)

    step = max(1, int(len(cuts) ** 0.5))
    coarse = cuts[::step]
    block = F.lit(0)
    if cuts:
        groups = F.array(*[F.array(*map(F.lit, cuts[i : i + step])) for i in range(0, len(cuts), step)])
        inner = F.size(F.filter(F.get(groups, F.col("group") - 1), lambda c: c <= F.col("doc_id")))
        block = F.when(F.col("group") == 0, 0).otherwise((F.col("group") - 1) * step + inner)
    placed = docs.withColumn("group", at(coarse)).withColumn("block", block)
    own = F.struct(F.col("block").alias("block"), F.lit(False).alias("ahead"))
    before = F.struct((F.col("block") - 1).alias("block"), F.lit(True).alias("ahead"))
    last = F.struct(F.lit(len(cuts)).alias("block"), F.lit(True).alias("ahead"))
    where = F.when(F.col("doc_id") == least, F.array(own, last)).when(F.col("doc_id").isin(cuts), F.array(own, before)).otherwise(F.array(own))
    copies = placed.select("doc_id", "text", F.explode(where).alias("at")).select("doc_id", "text", "at.block", "at.ahead")
    return copies.repartitionById(n, F.col("block").cast("int")).sortWithinPartitions("ahead", "doc_id", "text")


def fingerprint_edits(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """Each document's fingerprint next to that of an edit and of the document that follows.

    The edit replaces the last quarter of the text (rounded down) by the beginning of the next
    document's, of the same length or as long as that is. Documents follow each other by ascending
    id, equal ids by text; the first follows the last. Rows with a null id are left out, as nothing
    follows them; null texts count as empty; repeated rows stay, and a lone document follows
    itself. Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``.
    """
    ship(docs.sparkSession)
    small_batches(docs.sparkSession, 1 << 20)
    rows = in_order_with_next(texts(docs).filter(F.col("doc_id").isNotNull()))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def compare(batches):
        before = None
        for batch in batches:
            out = []
            for doc_id, text, ahead in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
                if ahead and before is None:
                    continue  # the next block's first document has been seen already
                phrases = Phrases()
                kept = text[: len(text) - len(text) // 4]
                phrases.add(kept)
                state = phrases.state()
                phrases.add(text[len(kept) :])
                own = phrases.fingerprint(size)
                phrases.back_to(state)
                if before is not None:
                    out.append(_edit(*before, text, own, size))
                before = None if ahead else (doc_id, text, kept, phrases, own)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out, strict=True)) or [[]] * 7, kinds, strict=True)], names=names)

    return rows.mapInArrow(compare, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def _edit(doc_id: int, text: str, kept: str, phrases: Phrases, own: tuple[int, ...], following: str, after: tuple[int, ...], size: int) -> tuple:
    head = following[: len(text) - len(kept)]
    phrases.add(head)
    edited = phrases.fingerprint(size)
    digest = hashlib.sha256((kept + head).encode()).hexdigest()
    return doc_id, len(text), digest, as_text(own), as_text(edited), likeness(own, edited, size), likeness(own, after, size)
