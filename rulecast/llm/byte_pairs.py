"""Byte-level BPE by the tiktoken library, on texts of any length, and decoding to raw bytes.

The library splits a text by its pattern and encodes each match by itself, so a text may be cut
wherever a match ends anyway and the matches before do not look past the cut. Two kinds of places
are safe: between a character and the white space after it, since only the beginning of a match can
be white space; and before the last character of a run of white space, since the pattern leaves that
one to the word that follows. Long texts are encoded in such stretches. A very long run of white
space is a single match, given to the library without its pattern, whose matcher fails on it.
"""

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulecast.llm.common import ship, texts

#: Characters of a stretch; a stretch ends at the first safe place after as many.
STRETCH = 50_000
#: Runs of white space from this length on are matches that the pattern need not find.
LONG_BLANK = 2_000
#: Ids of one Arrow batch of results, about.
BATCH_IDS = 500_000

_BLANKS = regex.compile(rf"\s{{{LONG_BLANK},}}")
_EDGE = regex.compile(r"(?<=\S)(?=\s)")


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The library's encoding of a rank file (base64 of a token and its rank, a line each)."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def stretches(text: str, limit: int = STRETCH) -> Iterator[tuple[str, bool]]:
    """The text in stretches that can be encoded one by one, and whether each is a single match."""
    a = 0
    for run in _BLANKS.finditer(text):
        yield from _between(text, a, run.start(), limit)
        # At the end of a text all of the run is one match, else all but its last character.
        a = run.end() if run.end() == len(text) else run.end() - 1
        yield text[run.start() : a], True
    yield from _between(text, a, len(text), limit)


def _between(text: str, a: int, b: int, limit: int) -> Iterator[tuple[str, bool]]:
    while b - a > limit:
        edge = _EDGE.search(text, a + limit, b)
        if edge is None:
            break
        yield text[a : edge.start()], False
        a = edge.start()
    if a < b:
        yield text[a:b], False


def encode_text(by: tiktoken.Encoding, text: str) -> np.ndarray:
    """Ids of a text, as the library gives them for the whole text at once."""
    if len(text) <= STRETCH:
        return np.array(by.encode_ordinary(text), np.int32)
    found = [by._encode_single_piece(s) if single else by.encode_ordinary(s) for s, single in stretches(text)]
    return np.concatenate([np.array(ids, np.int32) for ids in found])


def encode_bytes(docs: DataFrame, rank_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every document, without special tokens.

    Strings of special tokens are ordinary text. Null and empty texts have no ids. Rows stay as they
    come, repeated and null ids included; other columns are ignored; no rows give no rows. Texts are
    encoded whole, however long; bytes that are no UTF-8 count as U+FFFD.
    """
    ship(docs.sparkSession)

    def encode(batches):
        by = encoding(rank_path, pattern)
        for batch in batches:
            ids, held, since = [], 0, 0
            said = batch.column(1).cast(pa.binary())
            for k in range(batch.num_rows):
                ids.append(encode_text(by, said[k].as_py().decode(errors="replace")))
                held += len(ids[-1])
                if held >= BATCH_IDS or k + 1 == batch.num_rows:
                    at = pa.array(np.cumsum([0, *map(len, ids)]).astype(np.int32))
                    lists = pa.ListArray.from_arrays(at, pa.array(np.concatenate(ids)))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(since, k + 1 - since), lists], names=["doc_id", "ids"])
                    ids, held, since = [], 0, k + 1

    return texts(docs, doc_id, text).mapInArrow(encode, "doc_id bigint, ids array<int>")


def decode_bytes(encoded: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """``doc_id, ids, bytes``: the raw bytes that the ids stand for, whether or not they are UTF-8.

    Null or no ids give no bytes. An id without a rank, a null one included, raises an error that
    names it.
    """
    ship(encoded.sparkSession)

    def decode(batches):
        by = encoding(rank_path, pattern)
        for batch in batches:
            for a in range(0, batch.num_rows, 200):
                part = batch.slice(a, 200)
                lists = part.column(1).fill_null([]) if part.column(1).null_count else part.column(1)
                at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
                ids = lists.flatten().to_numpy(zero_copy_only=False).tolist()
                found = [by.decode_bytes(ids[b:c]) for b, c in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.binary())], names=["doc_id", "ids", "bytes"])

    return encoded.select(F.col("doc_id"), F.col("ids")).mapInArrow(decode, "doc_id bigint, ids array<int>, bytes binary")
