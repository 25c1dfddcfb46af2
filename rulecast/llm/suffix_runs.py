"""Sorted runs of strings that know their common prefixes: front coding and merging.

A run is a sorted list of distinct byte strings, each with the length of the prefix it shares with
the one before. Front coding stores only what follows that prefix. Runs are merged by a loser tree
whose entries carry the length of the prefix shared with the string given out last: of two entries
the one that shares more is the smaller, and only equal lengths are compared, from there on. So no
character that is known to be equal is looked at again.
"""

from collections.abc import Iterable, Iterator

import numpy as np


def shared(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, of which ``start`` bytes are known."""
    n = min(len(a), len(b))
    if a[start:n] == b[start:n]:
        return n
    differing = int.from_bytes(a[start:n]) ^ int.from_bytes(b[start:n])
    return n - (differing.bit_length() + 7) // 8


def shared_end(a: bytes, b: bytes) -> int:
    """Length of the common suffix."""
    n = min(len(a), len(b))
    if not n or a[-n:] == b[-n:]:
        return n
    differing = int.from_bytes(a[-n:]) ^ int.from_bytes(b[-n:])
    return ((differing & -differing).bit_length() - 1) // 8


def front_code(strings: list[bytes]) -> tuple[list[int], bytes, list[int]]:
    """(shared prefix, concatenated rests, length of each rest) of a sorted run."""
    prefix, rests = [], []
    before = b""
    for string in strings:
        prefix.append(shared(before, string))
        rests.append(string[prefix[-1] :])
        before = string
    return prefix, b"".join(rests), [len(r) for r in rests]


def decode_run(prefix: Iterable[int], rests: bytes, sizes: Iterable[int]) -> Iterator[tuple[bytes, int]]:
    """The (string, shared prefix) pairs of a front-coded run."""
    before, at = b"", 0
    for common, size in zip(prefix, sizes, strict=True):
        before = before[:common] + rests[at : at + size]
        at += size
        yield before, common


def merge_runs(runs: list[Iterator]) -> Iterator[tuple]:
    """Merge runs of ``(string, shared prefix, ...)`` entries into one sorted sequence of them.

    The shared prefix of each entry given out refers to the one given out before it. Entries of
    different runs that are equal come one after the other.
    """
    size = 1
    while size < len(runs):
        size *= 2
    ends = (b"", -1)
    iterators = [iter(r) for r in runs] + [iter(())] * (size - len(runs))
    heads = [list(next(it, ends)) for it in iterators]
    losers = [0] * size

    def loses(i: int, j: int) -> bool:
        """Whether head ``i`` comes after head ``j``; the later one's prefix is set to that shared."""
        a, b = heads[i], heads[j]
        if a[1] != b[1]:
            return a[1] < b[1]
        if a[1] < 0:
            return True
        common = shared(a[0], b[0], a[1])
        after = a[0][common : common + 1] > b[0][common : common + 1]
        (a if after else b)[1] = common
        return after

    def build(node: int) -> int:
        if node >= size:
            return node - size
        left, right = build(2 * node), build(2 * node + 1)
        if loses(left, right):
            losers[node] = left
            return right
        losers[node] = right
        return left

    for head in heads:
        head[1] = min(head[1], 0)
    winner = build(1) if size > 1 else 0
    while heads[winner][1] >= 0:
        yield tuple(heads[winner])
        heads[winner] = list(next(iterators[winner], ends))
        node = (winner + size) // 2
        while node:
            if loses(winner, losers[node]):
                winner, losers[node] = losers[node], winner
            node //= 2


def pack(arrays: list[tuple[np.ndarray, str]]) -> bytes:
    """Arrays as one byte string, each after its length."""
    return b"".join(len(a).to_bytes(4, "little") + np.asarray(a, kind).tobytes() for a, kind in arrays)


def unpack(raw: bytes, kinds: list[str]) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        n = int.from_bytes(raw[at : at + 4], "little")
        end = at + 4 + n * np.dtype(kind).itemsize
        out.append(np.frombuffer(raw[at + 4 : end], kind))
        at = end
    return out
