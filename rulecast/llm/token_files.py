"""Token-id files: encode documents and store the ids as Parquet list columns.

A token table is a folder of shards, each a Parquet file of rows in ascending document order:

    shard int, doc_id bigint, first bigint, n_tokens bigint, tokens array<int>

``first`` counts the ids of the shard before the document; the base of a shard is the sum of the
ids of all shards before it, which a reader takes from the metadata columns alone. Ids are
dictionary encoded (a vocabulary's dictionary page is small and its indices are bit-packed), the
other columns are delta encoded. Row groups and pages are small and have page indexes, so a reader
that asks for some documents or for metadata only skips the pages of all other ids.
"""

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rulecast.llm.common import free_arrow, ship, small_batches, texts

SCHEMA = "shard int, doc_id bigint, first bigint, n_tokens bigint, tokens array<int>"
METADATA = ["shard", "doc_id", "first", "n_tokens"]
CHUNK_BYTES = 12 << 20
CACHE_WORDS = 150_000
CACHE_WORD_CHARS = 32
SLICE_WORDS = 5_000


class WordEncoder:
    """Encode many texts by encoding each distinct word once.

    The vocabulary's normalizer and pre-tokenizer drop white space and never join words across it,
    so the ids of a text are the ids of its words. Words are cut and numbered in Arrow. A word of
    Latin-1 letters, but for a last full stop or comma, is one pre-token, which the library's model
    encodes directly; any other word takes the library's whole way. A bounded cache keeps the ids
    of the words met first.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        letters = [chr(c) for c in range(128, 256) if chr(c).isalpha()]
        self.byte_level = str.maketrans({c: "".join(x for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(c)) for c in letters})
        self.known: dict[str, bytes] = {}
        self.marks = {mark: self._whole([mark])[0] for mark in ".,"}

    def _whole(self, words: list[str]) -> list[bytes]:
        return [array("i", x.ids).tobytes() for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _letters(self, word: str) -> bytes:
        ids = self.known.get(word)
        if ids is None:
            mapped = word if word.isascii() else word.translate(self.byte_level)
            ids = array("i", [token.id for token in self.model.tokenize(mapped)]).tobytes()
            if len(self.known) < CACHE_WORDS and len(word) <= CACHE_WORD_CHARS:
                self.known[word] = ids
        return ids

    def _ids(self, words: list[str]) -> list[bytes]:
        found: list[bytes] = []
        others = []
        for i, word in enumerate(words):
            mark = self.marks.get(word[-1:])
            letters = word if mark is None else word[:-1]
            if letters.isalpha() and (letters.isascii() or max(letters) < "\u0100"):
                ids = self._letters(letters.lower())
                found.append(ids if mark is None else ids + mark)
            else:
                found.append(b"")
                others.append(i)
        for a in range(0, len(others), SLICE_WORDS):
            part = others[a : a + SLICE_WORDS]
            for i, ids in zip(part, self._whole([words[i] for i in part]), strict=True):
                found[i] = ids
        return found

    def encode(self, column: pa.Array, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, how many belong to each text)."""
        words = pc.ascii_split_whitespace(column)
        numbered = words.flatten().dictionary_encode()
        ids = self._ids(numbered.dictionary.to_pylist())
        length = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), np.int32)
        start = np.cumsum(length) - length
        which = numbered.indices.to_numpy()
        size = length[which]
        before = np.concatenate(([0], np.cumsum(size)))
        per_text = np.diff(before[words.offsets.to_numpy() - words.offsets[0].as_py()])
        # One text has fewer ids than bytes, so places among the ids of a chunk fit 32 bits.
        place = np.repeat((start[which] - before[:-1]).astype(np.int32), size)
        place += np.arange(before[-1], dtype=np.int32)
        taken = flat[place]
        del words, numbered, ids, which, size, place
        if end_id is None:
            return taken, per_text
        ends = np.cumsum(per_text + 1) - 1
        out = np.full(len(taken) + len(per_text), end_id, np.int32)
        own = np.ones(len(out), bool)
        own[ends] = False
        out[own] = taken
        return out, per_text + 1


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= CHUNK_BYTES:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def encode_documents(docs: DataFrame, tokenizer_path: str, end_id: int | None, partitions: int | None = None) -> DataFrame:
    """Rows of a token table: documents in ascending order over the partitions and within them.

    Null texts count as empty and have the end id alone. Null ids come first; documents with equal
    ids keep all their rows, ordered by text. Other columns are ignored; no rows give no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    small_batches(spark)
    columns = texts(docs)
    placed = columns.repartitionByRange(partitions, "doc_id") if partitions else columns.repartitionByRange("doc_id")

    def encode(batches):
        encoder, shard, first = WordEncoder(tokenizer_path), TaskContext.get().partitionId(), 0
        for chunk in _chunks(batches):
            text = chunk["text"].combine_chunks() if chunk.num_rows else pa.array([], pa.string())
            ids, size = encoder.encode(text, end_id)
            at = np.concatenate(([0], np.cumsum(size)))
            for a in range(0, chunk.num_rows, 200):
                b = min(a + 200, chunk.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(b - a, shard, np.int32)),
                        chunk["doc_id"].slice(a, b - a).combine_chunks(),
                        pa.array(first + at[a:b]),
                        pa.array(size[a:b]),
                        pa.ListArray.from_arrays(pa.array((at[a : b + 1] - at[a]).astype(np.int32)), pa.array(ids[at[a] : at[b]])),
                    ],
                    names=["shard", "doc_id", "first", "n_tokens", "tokens"],
                )
            first += int(at[-1])
            del chunk, text, ids, size, at
            free_arrow()

    return placed.sortWithinPartitions("doc_id", "text").mapInArrow(encode, SCHEMA)


def write_tokens(encoded: DataFrame, path: str, row_group_bytes: int = 16 << 20, page_bytes: int = 256 << 10) -> None:
    (
        encoded.write.option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", page_bytes)
        .option("parquet.page.row.count.limit", 2000)
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary", "false")
        .option("parquet.enable.dictionary#tokens.list.element", "true")
        .option("compression", "zstd")
        .mode("overwrite")
        .parquet(path)
    )


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` and ``n_tokens`` of every document, without reading ids."""
    return _with_start(spark.read.schema(SCHEMA).parquet(path).select(*METADATA), spark, path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The documents with their ``start`` among all ids and their ``tokens``."""
    return _with_start(spark.read.schema(SCHEMA).parquet(path), spark, path)


def _with_start(rows: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """Add each shard's base: a sum over one row per shard, few enough for one task."""
    shards = spark.read.schema(SCHEMA).parquet(path).groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    bases = shards.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("base"))
    return rows.join(F.broadcast(bases), "shard").withColumn("start", F.col("base") + F.col("first")).drop("base", "first", "shard")


def with_checksum(tokens: DataFrame) -> DataFrame:
    """Replace ``tokens`` by ``ids_crc32``, of the ids as little-endian unsigned 32-bit integers."""
    ship(tokens.sparkSession)

    def checksums(batches):
        for batch in batches:
            lists = batch.column(2)
            offsets = lists.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(), "<u4")).cast("B")
            sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array(sums, pa.int64())],
                names=["doc_id", "n_tokens", "start", "ids_crc32"],
            )

    ordered = tokens.select("doc_id", "n_tokens", "tokens", "start")
    return ordered.mapInArrow(checksums, "doc_id bigint, n_tokens bigint, start bigint, ids_crc32 bigint")
