"""Words of documents as byte ranges, in slices of bounded size.

Unlike ``words.cut`` this hashes nothing and needs a few bytes of memory per byte of text. A slice
holds many documents or a stretch of a long one; a stretch ends between two words and the next one
begins with as many of its last words as asked for, so that no run of words is lost at the cut.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
SPACE = ord(" ")


@dataclass
class Joined:
    """Words of some texts, each followed by one space: ``data[begin:end]`` is a word.

    ``first`` has the number of the first word of each text, and the number of all words at its end.
    ``ends``: the texts end here, else the words after the last one are in the next slice.
    """

    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray
    ends: bool = True


def join(data: np.ndarray, offsets: np.ndarray, classes: tuple[np.ndarray, np.ndarray]) -> Joined:
    """Cut the texts ``data[offsets[k]:offsets[k + 1]]`` into words and lay these out anew."""
    is_word, byte = classes
    inside = is_word[data]
    starts, stops = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    full = offsets[:-1] < offsets[1:]
    starts[offsets[:-1][full]] = inside[offsets[:-1][full]]
    stops[offsets[1:][full] - 1] = inside[offsets[1:][full] - 1]
    start, stop = np.flatnonzero(starts), np.flatnonzero(stops) + 1
    first = np.searchsorted(start, offsets)
    size = stop - start
    end = np.cumsum(size + 1) - 1
    begin = end - size
    out = np.full(int(end[-1]) + 1 if len(end) else 0, SPACE, np.uint8)
    shift = np.repeat((begin - start).astype(np.int32), size)
    out[np.flatnonzero(inside) + shift] = byte[data[inside]]
    return Joined(out, begin, end, first)


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column without nulls."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(column: pa.Array, classes: tuple[np.ndarray, np.ndarray], overlap: int, limit: int = SLICE_BYTES) -> Iterator[tuple[int, Joined]]:
    """The words of a column in slices of about ``limit`` bytes, each with its first text's number.

    In a slice with ``ends`` False, its last ``overlap`` words are the first ones of the next slice.
    """
    data, offsets = column_bytes(column)
    is_word = classes[0]
    k = 0
    while k < len(column):
        stop = max(k + 1, int(np.searchsorted(offsets, offsets[k] + limit, "right")) - 1)
        if stop > k + 1 or offsets[k + 1] - offsets[k] <= limit:
            yield k, join(data[offsets[k] : offsets[stop]], offsets[k : stop + 1] - offsets[k], classes)
            k = stop
            continue
        a, end = int(offsets[k]), int(offsets[k + 1])
        while True:
            b = _edge(data, is_word, min(a + limit, end), end, limit)
            part = join(data[a:b], np.array([0, b - a]), classes)
            while b < end and len(part.begin) <= overlap:  # a few words longer than a slice
                b = _edge(data, is_word, min(b + limit, end), end, limit)
                part = join(data[a:b], np.array([0, b - a]), classes)
            part.ends = b == end
            yield k, part
            if part.ends:
                break
            a = _back(data, is_word, a, b, overlap)
        k += 1


def _edge(data: np.ndarray, is_word: np.ndarray, at: int, end: int, step: int) -> int:
    """The first place from ``at`` on that no word byte follows."""
    while at < end:
        found = np.flatnonzero(~is_word[data[at : at + step]])
        if len(found):
            return at + int(found[0])
        at = min(at + step, end)
    return end


def _back(data: np.ndarray, is_word: np.ndarray, a: int, b: int, words: int) -> int:
    """Where the last ``words`` words before ``b`` begin."""
    if not words:
        return b
    reach = 1 << 12
    while True:
        low = max(a, b - reach)
        inside = is_word[data[low:b]]
        starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
        if len(starts) >= words:
            return low + int(starts[-words])
        if low == a:
            return a
        reach *= 4
