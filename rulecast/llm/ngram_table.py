"""An open-addressed table of byte strings in numpy arrays, which numbers occurrences by slot.

Keys are xxhash64 of the bytes; a slot is taken for an occurrence only if the bytes are the same, so
strings whose hashes collide keep slots of their own. Probing is linear and runs for all occurrences
at once: in every round, those that are still without a slot look at their next one.
"""

import zlib
from collections.abc import Callable

import numpy as np
import xxhash

EMPTY = -1


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of ``data`` on as an integer; eight zeros follow the data."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    return np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))


def _turn(h: np.ndarray, bits: int) -> np.ndarray:
    return (h << np.uint64(bits)) | (h >> np.uint64(64 - bits))


# The constants of xxHash64 and the polynomial of CRC-32.
P1, P2, P3, P4, P5 = map(np.uint64, (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
POLYNOMIAL = np.uint32(0xEDB88320)


def _crc_table() -> np.ndarray:
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = (crc >> np.uint32(1)) ^ (POLYNOMIAL * (crc & np.uint32(1)))
    return crc


CRC = _crc_table()


def short_xxhash(eights: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
    """xxhash64 of strings of one size below 32."""
    h, at = np.full(len(begin), P5 + np.uint64(size), np.uint64), 0
    for at in range(0, size - 7, 8):
        h ^= _turn(eights[begin + at] * P2, 31) * P1
        h = _turn(h, 27) * P1 + P4
    at = size & ~7
    if size - at >= 4:
        h ^= (eights[begin + at] & np.uint64(0xFFFFFFFF)) * P1
        h = _turn(h, 23) * P2 + P3
        at += 4
    for k in range(at, size):
        h ^= (eights[begin + k] & np.uint64(255)) * P5
        h = _turn(h, 11) * P1
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    return h ^ (h >> np.uint64(32))


def short_crc32(eights: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
    """crc32 of strings of one size."""
    crc = np.full(len(begin), 0xFFFFFFFF, np.uint32)
    for at in range(0, size, 8):
        eight = eights[begin + at]
        for k in range(min(8, size - at)):
            crc = CRC[(crc ^ (eight >> np.uint64(8 * k)).astype(np.uint32)) & np.uint32(255)] ^ (crc >> np.uint32(8))
    return crc ^ np.uint32(0xFFFFFFFF)


def hashed(short: Callable, whole: Callable[[bytes], int], data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the strings ``data[begin:end]``: those of one size below 32 at once, others by ``whole``."""
    eights, size = _eights(data), end - begin
    order = np.argsort(np.minimum(size, 32).astype(np.uint8), kind="stable")
    bound = np.concatenate(([0], np.cumsum(np.bincount(np.minimum(size, 32), minlength=33))))
    out = np.zeros(len(size), np.uint64)
    for n in range(32):
        some = order[bound[n] : bound[n + 1]]
        if len(some):
            out[some] = short(eights, begin[some], n)
    for k in order[bound[32] :]:
        out[k] = whole(data[begin[k] : end[k]].tobytes())
    return out


class NgramTable:
    """Slots for the strings ``data[begin:end]``, each with a bucket and a count.

    ``slot`` has the slot of each string, ``bucket`` and ``count`` are by slot; a free slot counts 0.
    The bucket is the string's crc32 modulo ``buckets``.
    """

    def __init__(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray, buckets: int, keys: np.ndarray | None = None):
        self.keys = hashed(short_xxhash, xxhash.xxh64_intdigest, data, begin, end) if keys is None else keys
        size = 1 << max(4, int(2 * len(begin)).bit_length())
        self.owner = np.full(size, EMPTY, np.int32)
        self.slot = self._intern(_eights(data), begin, end - begin)
        self.count = np.bincount(self.slot, minlength=size)
        self.bucket = np.zeros(size, np.int32)
        taken = np.flatnonzero(self.owner != EMPTY)
        held = self.owner[taken]
        self.bucket[taken] = hashed(short_crc32, zlib.crc32, data, begin[held], end[held]) % np.uint64(buckets)

    def _intern(self, eights: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        mask = len(self.owner) - 1
        slot = (self.keys & np.uint64(mask)).astype(np.int32)
        left = np.arange(len(slot), dtype=np.int32)
        while len(left):
            at = slot[left]
            free = self.owner[at] == EMPTY
            # Of several that reach a free slot in one round, the first one has it.
            self.owner[at[free][::-1]] = left[free][::-1]
            holder = self.owner[at]
            other = holder != left
            other[other] = ~self._same(eights, begin, size, left[other], holder[other])
            left = left[other]
            slot[left] = (slot[left] + 1) & mask
        return slot

    def _same(self, eights: np.ndarray, begin: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the strings numbered ``a`` and ``b`` have equal keys and equal bytes, by eight bytes at a time."""
        same = (self.keys[a] == self.keys[b]) & (size[a] == size[b])
        open_, at = np.flatnonzero(same & (size[a] > 0)), 0
        while len(open_):
            rest = size[a[open_]] - at
            beyond = (8 * np.maximum(8 - rest, 0)).astype(np.uint64)
            differ = (eights[begin[a[open_]] + at] ^ eights[begin[b[open_]] + at]) << beyond != 0
            same[open_[differ]] = False
            at += 8
            open_ = open_[~differ & (rest > 8)]
        return same
