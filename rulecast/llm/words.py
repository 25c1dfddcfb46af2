"""Words of many texts at once: cut, hashed and combined into n-grams as numpy arrays.

Words are maximal runs of word bytes in UTF-8. Every class of word characters used here is told by
ASCII bytes alone (all other characters are word characters, or all are not), so bytes are enough.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from rulecast.llm.common import free_memory

PIECE_BYTES = 2 << 20
#: Words hashed at once; the hash of a word takes 8 bytes several times over for each of its bytes.
HASHED = 1 << 13


def _classes(separators: str, fold: bool) -> tuple[np.ndarray, np.ndarray]:
    is_word = np.ones(256, bool)
    is_word[[ord(c) for c in separators]] = False
    byte = np.arange(256, dtype=np.uint8)
    if fold:
        byte[ord("A") : ord("Z") + 1] += 32
    return is_word[byte], byte


BLANKS = " \t\n\v\f\r"
#: White space separates, case counts.
EXACT = _classes(BLANKS, fold=False)
#: White space separates, A-Z count as a-z.
FOLDED = _classes(BLANKS, fold=True)
#: Words of letters, digits and all characters beyond ASCII; A-Z count as a-z.
PLAIN = _classes("".join(chr(c) for c in range(128) if not (chr(c).isdigit() or chr(c).islower())), fold=True)

_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.cumprod(np.full(max(n, 4096), 0x9E3779B97F4A7C15 | 1, np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
    return _POWERS


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose every output bit depends on all input bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """Words of some texts: ``hashes``, byte ranges in ``data``, and ``first`` word of each text."""

    hashes: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray
    data: np.ndarray
    offsets: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the n consecutive words from each word on, and whether they lie in one text."""
        total = len(self.hashes)
        if total < n:
            return np.zeros(total, np.uint64), np.zeros(total, bool)
        gram = np.zeros(total, np.uint64)
        for j in range(n):
            gram[: total - j] = gram[: total - j] * np.uint64(0x2545F4914F6CDD1D) + self.hashes[j:]
        inside = np.arange(total) + n <= np.repeat(self.first[1:], self.counts())
        return mix(gram + np.uint64(n)), inside


def cut(column: pa.Array, classes: tuple[np.ndarray, np.ndarray]) -> Words:
    """Cut and hash the words of a string column without nulls."""
    is_word, byte = classes
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    inside = is_word[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    full = offsets[:-1] < offsets[1:]
    begins[offsets[:-1][full]] = inside[offsets[:-1][full]]
    ends[offsets[1:][full] - 1] = inside[offsets[1:][full] - 1]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    size = end - begin
    first = np.searchsorted(begin, offsets)
    if not len(begin):
        return Words(np.zeros(0, np.uint64), begin, end, first, data, offsets)
    powers, hashes = _powers(int(size.max())), np.empty(len(begin), np.uint64)
    for a in range(0, len(begin), HASHED):
        some = size[a : a + HASHED]
        span = slice(begin[a], end[a + len(some) - 1])
        at = np.cumsum(some) - some
        place = np.arange(int(some.sum())) - np.repeat(at, some)
        values = (byte[data[span][inside[span]]].astype(np.uint64) + np.uint64(1)) * powers[place]
        hashes[a : a + HASHED] = mix(np.add.reduceat(values, at) + some.astype(np.uint64))
    return Words(hashes, begin, end, first, data, offsets)


def pieces(batch: pa.RecordBatch, text: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about ``limit`` bytes; one long text makes its own slice.

    What the work on them has freed is given back behind the last one.
    """
    column = batch.column(batch.schema.get_field_index(text))
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int32)
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        b = min(b, batch.num_rows)
        yield batch.slice(a, b - a)
        a = b
    free_memory()


def window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of ``width`` consecutive keys."""
    reach, out = 1, keys
    while reach < width:
        step = min(reach, width - reach)
        out = np.minimum(out[:-step], out[step:]) if len(out) > step else out[:0]
        reach += step
    return out


def first_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """The first position of the minimum of each run of ``width`` consecutive keys.

    Keys are compared in full, so which place of a run it is depends on the run's content alone.
    """
    total = len(keys)
    if total < width:
        return np.zeros(0, np.int64)
    # One pass over keys whose low bits are the position; runs whose minimum those bits hid are looked through.
    bits = np.uint64(total.bit_length())
    least = window_minima(keys, width)
    placed = ((keys >> bits) << bits) | np.arange(total, dtype=np.uint64)
    out = (window_minima(placed, width) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    hidden = np.flatnonzero(keys[out] != least)
    for step in reversed(range(width if len(hidden) else 0)):
        at = hidden + step
        is_least = keys[at] == least[hidden]
        out[hidden[is_least]] = at[is_least]
    return out
