"""SentencePiece encoding and decoding of documents by a table of last tokens.

A merge-type (BPE) piece model gives every prefix of a text exactly one last token: the encoding of
the prefix ends with it, and cutting it off leaves the encoding of a shorter prefix. So one pass
fills a table with the last token of each prefix. An automaton of all reachable pieces reports the
pieces that end at a position; the one that may stand behind the last token of the prefix before it
(the pair, merged anew from its characters, comes out as the pair) is the entry. Reading the table
backwards gives the ids. Characters without a piece never merge and become byte pieces.

No piece of such a model joins a word to a blank behind it, so blanks cut a text into units whose
encodings are independent; each distinct unit is encoded once per chunk and the frequent ones once
per worker. The tables of many units are filled together, one position of all of them after the
other, as numpy arrays; there a trie of the reachable pieces stands for the automaton. Only units of
more than ``LONG`` characters pass the automaton alone. The model file is read here; the library
itself is not used.
"""

import re
import struct
from array import array
from functools import cached_property, lru_cache
from itertools import pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulecast.llm.common import free_memory, ship, small_batches, texts
from rulecast.llm.number_map import NumberMap
from rulecast.llm.words import pieces

BLANK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Bytes of text encoded at once, and rows decoded at once.
CHUNK_BYTES, DECODED = 1 << 20, 200
CACHE_UNITS, CACHE_UNIT_CHARS, CACHE_PAIRS = 150_000, 32, 1_000_000
#: Characters of units whose tables are filled together, and of the longest such unit.
TOGETHER, LONG = 1 << 16, 512
#: Ids whose bytes are put together at once.
STRETCH = 1 << 16


def _fields(raw: bytes):
    """(number, value) of a protocol buffer message's fields."""
    at = 0

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = raw[at]
            at, value, shift = at + 1, value | (byte & 127) << shift, shift + 7
            if byte < 128:
                return value, at

    while at < len(raw):
        key, at = varint(at)
        if key & 7 == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if key & 7 == 2 else (8 if key & 7 == 1 else 4, at)
            value, at = raw[at : at + size], at + size
        yield key >> 3, value


class PieceModel:
    """A piece model file of merge type with the identity normalizer."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            raw = file.read()
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        normalizer: dict = {}
        trainer: dict = {}
        for number, value in _fields(raw):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.kinds.append(piece.get(3, NORMAL))
                scores.append(struct.unpack("<f", piece.get(2, bytes(4)))[0])
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        if trainer.get(3) != 2 or normalizer.get(2) or normalizer.get(4, 1) or {USER_DEFINED, UNUSED} & set(self.kinds):
            raise ValueError("only merge models with the identity normalizer and plain pieces are read")
        self.dummy_prefix = bool(normalizer.get(3, 1))
        self.rank = {p: -s for p, s, k in zip(self.pieces, scores, self.kinds, strict=True) if k == NORMAL}
        self.id = {p: i for i, p in enumerate(self.pieces)}
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == BYTE}
        self.unknown = self.kinds.index(UNKNOWN)
        self.cut_at_blanks = not any(re.search(f"[^{BLANK}]{BLANK}", p) for p in self.rank)
        self.cut_at_lines = not any("\n" in p for p in self.rank)
        self.size = [len(p) for p in self.pieces]
        self.sizes = np.array(self.size, np.int64)
        self.pairs: dict[int, bool] = {}
        self.fitting = NumberMap()
        self.units: dict[str, bytes] = {}

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        """An automaton of the reachable pieces; only encoding needs it."""
        automaton = ahocorasick.Automaton()
        for piece in self.rank:
            if self.merged(piece) == [piece]:
                automaton.add_word(piece, self.id[piece])
        automaton.make_automaton()
        return automaton

    @cached_property
    def trie(self) -> tuple[np.ndarray, int, NumberMap, np.ndarray]:
        """The letter of each character, how many letters, (node, letter) to nodes, the piece that ends at a node."""
        reachable = sorted(self.automaton.keys())
        letters = {c: i for i, c in enumerate(sorted(set("".join(reachable))), 1)}
        letter, count = np.zeros(0x110000, np.min_scalar_type(len(letters))), len(letters) + 1
        letter[[ord(c) for c in letters]] = list(letters.values())
        nodes: dict[int, int] = {}
        ends = [-1]
        for piece in reachable:
            node = 0
            for c in piece:
                key = node * count + letters[c]
                if key not in nodes:
                    nodes[key] = len(ends)
                    ends.append(-1)
                node = nodes[key]
            ends[node] = self.id[piece]
        known = NumberMap()
        known.add(np.fromiter(nodes, np.int64, len(nodes)), np.fromiter(nodes.values(), np.int32, len(nodes)))
        return letter, count, known, np.array(ends, np.int32)

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by merging: the best pair first, the leftmost of equal ones."""
        symbols = list(text)
        known, none = self.rank.get, float("inf")
        ranks = [known(x + y, none) for x, y in pairwise(symbols)]
        while ranks and (best := min(ranks)) < none:
            where = ranks.index(best)
            symbols[where : where + 2] = [symbols[where] + symbols[where + 1]]
            del ranks[where]
            if where < len(ranks):
                ranks[where] = known(symbols[where] + symbols[where + 1], none)
            if where:
                ranks[where - 1] = known(symbols[where - 1] + symbols[where], none)
        return symbols

    def _fits(self, key: int) -> bool:
        a, b = self.pieces[key >> 20], self.pieces[key & (1 << 20) - 1]
        return a + b not in self.rank and self.merged(a + b) == [a, b]

    def compatible(self, before: int, token: int) -> bool:
        key = before << 20 | token
        known = self.pairs.get(key)
        if known is None:
            known = self._fits(key)
            if len(self.pairs) < CACHE_PAIRS:
                self.pairs[key] = known
        return known

    def _all_compatible(self, keys: np.ndarray) -> np.ndarray:
        """As ``compatible``, for many pairs ``before << 20 | token``."""
        known = self.fitting.get(keys)
        new = np.flatnonzero(known < 0)
        if len(new):
            pairs, which = np.unique(keys[new], return_inverse=True)
            fits = np.fromiter(map(self._fits, pairs.tolist()), np.int32, len(pairs))
            known[new] = fits[which]
            room = max(0, CACHE_PAIRS - self.fitting.count)
            self.fitting.add(pairs[:room], fits[:room])
        return known > 0

    def _matches(self, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(beginning, piece) of every piece in a sequence of letters; 0 is in none. Short ones come first."""
        _, letters, nodes, tokens = self.trie
        start = np.flatnonzero(letter[:-1])
        node, depth, found = np.zeros(len(start), np.int64), 0, []
        while len(start):
            inner = letter[np.minimum(start + depth, len(letter) - 1)]
            node = nodes.get(node * letters + inner)
            inside = (node >= 0) & (inner > 0)
            start, node, depth = start[inside], node[inside].astype(np.int64), depth + 1
            token = tokens[node]
            some = token >= 0
            found.append((start[some], token[some]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))

    def _tables(self, units: list[str]) -> list[bytes]:
        """Ids of short units, whose tables of last tokens are filled together."""
        length = np.fromiter(map(len, units), np.int64, len(units))
        end = np.cumsum(length + 1) - 1
        begin = end - length
        code = np.frombuffer("\n".join([*units, ""]).encode("utf-32-le"), np.uint32)
        letter = self.trie[0][code].astype(np.int64)
        letter[end] = 0
        # An entry below 0 stands for a character without a piece, or for the beginning.
        last = np.concatenate(([-1], -1 - code[:-1].astype(np.int64)))
        start, token = self._matches(letter)
        stop = start + self.sizes[token]
        place = (stop - np.repeat(begin, length + 1)[start]).astype(np.uint16)
        order = np.argsort(place, kind="stable")
        start, token, stop = start[order], token[order], stop[order]
        bound = np.concatenate(([0], np.cumsum(np.bincount(place, minlength=1)))).tolist()
        last[begin] = -1
        for a, b in pairwise(bound):
            if a < b:
                before, pieces_ = last[start[a:b]], token[a:b]
                fits = before < 0
                behind = np.flatnonzero(~fits)
                fits[behind] = self._all_compatible(before[behind] << 20 | pieces_[behind])
                last[stop[a:b][fits]] = pieces_[fits]  # the longest is written last
        chosen = np.zeros(len(last), bool)
        at, first = end, begin
        while len(at):
            chosen[at] = True
            entry = last[at]
            at = at - np.where(entry < 0, 1, self.sizes[np.maximum(entry, 0)])
            more = at > first
            at, first = at[more], first[more]
        ids, count = last[chosen], np.add.reduceat(chosen, begin + 1) if len(units) else length
        bare = np.flatnonzero(ids < 0)
        if len(bare):
            codes, which = np.unique(-1 - ids[bare], return_inverse=True)
            said = [np.array([self.bytes[b] for b in chr(c).encode()] if self.bytes else [self.unknown], np.int64) for c in codes.tolist()]
            width = np.ones(len(ids), np.int64)
            width[bare] = np.array([len(x) for x in said])[which]
            of_unit = np.repeat(np.arange(len(units)), count)
            count = np.bincount(of_unit, weights=width, minlength=len(units)).astype(np.int64)
            at = (np.cumsum(width) - width)[bare]
            ids = np.repeat(ids, width)
            for k, x in enumerate(said):
                ids[at[which == k][:, None] + np.arange(len(x))] = x
        raw = ids.astype(np.int32).tobytes()
        cut = np.concatenate(([0], 4 * np.cumsum(count))).tolist()
        return [raw[a:b] for a, b in pairwise(cut)]

    def encode_units(self, units: list[str]) -> list[bytes]:
        """Ids of each unit, as 32-bit integers."""
        known = list(map(self.units.get, units))
        missing = [i for i, ids in enumerate(known) if ids is None]
        found = dict.fromkeys([units[i] for i in missing], b"")
        new = sorted(found, key=len)
        while new and len(new[-1]) > LONG:
            unit = new.pop()
            found[unit] = self.unit(unit)
        held = np.cumsum(np.fromiter(map(len, new), np.int64, len(new)) + 1)
        a = 0
        while a < len(new):
            b = max(a + 1, int(np.searchsorted(held, (held[a - 1] if a else 0) + TOGETHER, "right")))
            found.update(zip(new[a:b], self._tables(new[a:b]), strict=True))
            a = b
        for i in missing:
            known[i] = found[units[i]]
        room = CACHE_UNITS - len(self.units)
        if room > 0:
            self.units.update([(u, ids) for u, ids in found.items() if len(u) <= CACHE_UNIT_CHARS][:room])
        return known

    def _unit(self, unit: str) -> bytes:
        last: list[int | None] = [None] * (len(unit) + 1)
        size, pairs = self.size, self.pairs
        for end, token in self.automaton.iter(unit):
            end += 1
            if last[end] is None:
                start = end - size[token]
                before = last[start]
                if before is None:  # the beginning, or a character without a piece
                    last[end] = token
                else:
                    fits = pairs.get(before << 20 | token)
                    if self.compatible(before, token) if fits is None else fits:
                        last[end] = token
        ids = array("i")
        at = len(unit)
        while at:
            token = last[at]
            if token is None:
                at -= 1
                raw = unit[at].encode()
                ids.extend([self.bytes[b] for b in reversed(raw)] if self.bytes else [self.unknown])
            else:
                ids.append(token)
                at -= size[token]
        ids.reverse()
        return ids.tobytes()

    def unit(self, unit: str) -> bytes:
        if "\n" in unit and self.cut_at_lines:
            line = array("i", [self.bytes[10]] if self.bytes else [self.unknown]).tobytes()
            return line.join([self.unit(part) if part else b"" for part in unit.split("\n")])
        ids = self.units.get(unit)
        if ids is None:
            ids = self._unit(unit)
            if len(self.units) < CACHE_UNITS and len(unit) <= CACHE_UNIT_CHARS:
                self.units[unit] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of one text, as 32-bit integers."""
        if not text:
            return b""
        text = (BLANK if self.dummy_prefix else "") + text.replace(" ", BLANK)
        units = re.findall(f"{BLANK}*[^{BLANK}]+|{BLANK}+", text) if self.cut_at_blanks else [text]
        return b"".join(self.encode_units(units))

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, how many belong to each text)."""
        parts = pc.split_pattern(column, " ")
        offsets = parts.offsets.to_numpy().astype(np.int64)
        offsets = offsets - offsets[0]
        flat = parts.flatten()
        empty = np.concatenate((pc.equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False), [False]))
        empty[offsets[1:] - 1] = False  # one blank at the end of a text is a unit of its own
        in_text = np.concatenate(([0], np.cumsum(empty)))
        odd = (in_text[offsets[1:]] > in_text[offsets[:-1]]) | pc.match_substring(column, BLANK).to_numpy(zero_copy_only=False)
        odd |= pc.equal(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        if not (self.cut_at_blanks and self.dummy_prefix):
            odd[:] = True
        numbered = flat.dictionary_encode()
        which = numbered.indices.to_numpy()
        used = np.zeros(len(numbered.dictionary), bool)
        used[which[np.repeat(~odd, np.diff(offsets))]] = True
        words = pc.binary_join_element_wise(BLANK, numbered.dictionary.filter(pa.array(used)), "")
        place = np.cumsum(used) - 1
        place[~used] = len(words)
        plain, size = spread([*self.encode_units(words.to_numpy(zero_copy_only=False).tolist()), b""], place[which])
        before = np.concatenate(([0], np.cumsum(size)))
        count = np.diff(before[offsets])
        if not odd.any():
            return plain, count
        out, at = [], 0
        for i in np.flatnonzero(odd).tolist():
            out.append(plain[before[offsets[at]] : before[offsets[i]]])
            own = np.frombuffer(self.encode(column[i].as_py()), np.int32)
            out.append(own)
            count[i], at = len(own), i + 1
        out.append(plain[before[offsets[at]] :])
        return np.concatenate(out), count

    def decode_tables(self) -> list[bytes]:
        kinds = {CONTROL: lambda p: b"", UNKNOWN: lambda p: " ⁇ ".encode(), BYTE: lambda p: bytes([int(p[3:5], 16)])}
        return [kinds.get(k, lambda p: p.replace(BLANK, " ").encode())(p) for p, k in zip(self.pieces, self.kinds, strict=True)]

    @cached_property
    def said(self) -> tuple[np.ndarray, ...]:
        """What the ids say as bytes in a row, where each begins, its size, and which are control and blank ids."""
        table = self.decode_tables()
        size = np.fromiter(map(len, table), np.int64, len(table))
        blank = np.array([self.dummy_prefix and p.startswith(BLANK) for p in self.pieces])
        return np.frombuffer(b"".join(table), np.uint8), np.cumsum(size) - size, size, np.array(self.kinds) == CONTROL, blank

    def decode_column(self, lists: pa.ListArray) -> pa.Array:
        """The text of each list of ids."""
        flat, begin, size, control, blank = self.said
        offsets = lists.offsets.to_numpy().astype(np.int64)
        ids = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy()
        offsets = offsets - offsets[0]
        start, length = begin[ids], size[ids]
        told = np.append(np.flatnonzero(~control[ids]), len(ids))
        first = told[np.searchsorted(told, offsets[:-1])]
        first = first[first < offsets[1:]]
        first = first[blank[ids[first]]]
        start[first] += 1
        length[first] -= 1
        parts = []
        for a in range(0, len(ids), STRETCH):
            some = length[a : a + STRETCH]
            out = np.cumsum(some) - some
            parts.append(flat[np.repeat(start[a : a + STRETCH] - out, some) + np.arange(int(some.sum()))].tobytes())
        raw = b"".join(parts)
        at = np.concatenate(([0], np.cumsum(length)))[offsets]
        whole = np.frombuffer(raw, np.uint8)
        try:
            raw.decode()
            if not ((whole[at[at < len(raw)]] & 0xC0) == 0x80).any():
                return pa.StringArray.from_buffers(len(lists), pa.py_buffer(at.astype(np.int32)), pa.py_buffer(raw))
        except UnicodeDecodeError:
            pass
        return pa.array([_text(raw[a:b]) for a, b in pairwise(at.tolist())], pa.string())


def _text(raw: bytes) -> str:
    """The text of bytes; those that are no UTF-8 give one U+FFFD each."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return re.sub("[\udc80-\udcff]", "�", raw.decode(errors="surrogateescape"))


def spread(ids: list[bytes], which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a sequence of numbered words, and how many each word has."""
    length = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    flat = np.frombuffer(b"".join(ids), np.int32)
    start = np.cumsum(length) - length
    size = length[which]
    out = np.cumsum(size) - size
    return flat[np.repeat(start[which] - out, size) + np.arange(int(size.sum()))], size


@lru_cache(maxsize=2)
def model(path: str) -> PieceModel:
    return PieceModel(path)


def encode_pieces(docs: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every document, without begin or end ids.

    Null and empty texts have no ids. Rows stay as they come, repeated and null ids included; other
    columns are ignored; no rows give no rows. Texts are encoded whole, however long.
    """
    ship(docs.sparkSession)
    small_batches(docs.sparkSession)

    def encode(batches):
        known = model(model_path)
        for batch in batches:
            for piece in pieces(batch, limit=CHUNK_BYTES):
                ids, count = known.encode_column(piece["text"])
                at = np.concatenate(([0], np.cumsum(count)))
                for a in range(0, piece.num_rows, 500):
                    b = min(a + 500, piece.num_rows)
                    lists = pa.ListArray.from_arrays(pa.array((at[a : b + 1] - at[a]).astype(np.int32)), pa.array(ids[at[a] : at[b]]))
                    yield pa.RecordBatch.from_arrays([piece["doc_id"].slice(a, b - a), lists], names=["doc_id", "ids"])

    return texts(docs, doc_id, text).mapInArrow(encode, "doc_id bigint, ids array<int>")


def decode_pieces(encoded: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, ids, text``: the text that the ids stand for.

    Control ids give nothing, the unknown id its surface, byte runs that are no UTF-8 one U+FFFD a
    byte; the blank that encoding puts before a text is taken off. Null or no ids give the empty
    text.
    """
    ship(encoded.sparkSession)

    def decode(batches):
        known = model(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, DECODED):
                some = batch.slice(at, DECODED)
                lists = some.column(1).fill_null([]) if some.column(1).null_count else some.column(1)
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), known.decode_column(lists)], names=["doc_id", "ids", "text"])
            free_memory()

    return encoded.select(F.col("doc_id"), F.col("ids")).mapInArrow(decode, "doc_id bigint, ids array<int>, text string")
