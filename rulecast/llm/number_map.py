"""A map of integers to small integers that is asked for many keys at once."""

import numpy as np

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class NumberMap:
    """Keys from 0 on to values from 0 on, in open addressing; it doubles before it is half full."""

    def __init__(self, bits: int = 10):
        self.count = 0
        self._clear(bits)

    def _clear(self, bits: int) -> None:
        self.bits = bits
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.zeros(1 << bits, np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * _FACTOR >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where there is none."""
        slots = self._slots(keys)
        there = self.keys[slots]
        found = np.where(there == keys, self.values[slots], np.int32(-1))
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & ((1 << self.bits) - 1)
            at, wanted = slots[open_], keys[open_]
            there = self.keys[at]
            hit = there == wanted
            found[open_[hit]] = self.values[at[hit]]
            open_ = open_[~hit & (there >= 0)]
        return found

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Adds keys that are different and not there yet."""
        self.count += len(keys)
        if 2 * self.count > len(self.keys):
            known = self.keys >= 0
            keys, values = np.concatenate((self.keys[known], keys)), np.concatenate((self.values[known], values))
            self._clear((2 * self.count).bit_length())
        slots = self._slots(keys)
        left = np.arange(len(keys))
        while len(left):
            at = slots[left]
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[left[free]]  # of several for one place the last one stays
            placed = self.keys[at] == keys[left]
            self.values[at[placed]] = values[left[placed]]
            left = left[~placed]
            slots[left] = (slots[left] + 1) & ((1 << self.bits) - 1)
