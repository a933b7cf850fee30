"""Splitting text into the pieces that a byte-level BPE vocabulary encodes separately."""

from __future__ import annotations

import re
import sys
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import regex

from leafwright.llm.common import SortedMemo, mix, powers

_PATTERN = regex.compile(public_tokenizers.PATTERN)
#: The same split for texts in which `\w`, `\d` and `\s` of the standard library mean what the pattern's classes mean.
_PLAIN = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
#: Characters on which the two differ or may differ: odd controls, numbers that are no decimal digits, anything outside the common alphabets.
_ODD = re.compile("[^\x09-\x0d\x20-\xb1\xb4-\xb8\xba\xbb\xbf-ʯΑ-ҁҊ-Ֆ‐-‧‰-⁞€]|\x85")


def split(text: str) -> list[str]:
    """All matches of the vocabulary's pattern, which together are the text."""
    return _PATTERN.findall(text) if _ODD.search(text) else _PLAIN.findall(text)


LETTER, NUMBER, BLANK, OTHER = 1, 2, 3, 4


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The pattern's class of every code point."""
    every = "".join(map(chr, range(0xD800))) + "\0" * 0x800 + "".join(map(chr, range(0xE000, sys.maxunicode + 1)))
    table = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, r"\s+")):
        for m in regex.finditer(pattern, every):
            table[m.start() : m.end()] = kind
    return table


@dataclass
class Pieces:
    """Pieces of several texts: bounds in their common run of code points, a hash of each, and each text's first piece."""

    text: str
    code: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def piece(self, k: int) -> str:
        return self.text[self.start[k] : self.end[k]]


def scan(texts: list[str]) -> Pieces:
    """The same pieces as split() for each text, found in numpy over all of them at once."""
    whole = "".join(texts)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    at = np.concatenate([[0], np.cumsum(size)])
    n = len(whole)
    if not n:
        empty = np.zeros(0, np.int64)
        return Pieces(whole, empty.astype(np.uint32), empty, empty, empty.view(np.uint64), np.zeros(len(texts) + 1, np.int64))
    code = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    kind = _classes()[code]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    begins = edge.copy()
    begins[1:n] |= kind[1:] != kind[:-1]
    blank, space = kind == BLANK, code == 0x20
    # The last blank before a text goes on belongs to what follows if it is a space, and stands alone otherwise.
    before = np.flatnonzero(blank[:-1] & begins[1:n] & ~edge[1:n])
    starts = begins
    starts[before] = True
    starts[before[space[before]] + 1] = False
    mark = np.flatnonzero(code[:-1] == 0x27)
    mark = mark[starts[mark] & starts[mark + 1] & (kind[mark + 1] == LETTER) & ~edge[mark + 1]]
    if len(mark):
        one = code[mark + 1]
        far = mark + 2
        two = np.where((far < n) & ~edge[np.minimum(far, n)], code[np.minimum(far, n - 1)], 0)
        length = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, 0)
        for a, b in ("re", "ve", "ll"):
            length[(one == ord(a)) & (two == ord(b))] = 2
        mark, length = mark[length > 0], length[length > 0]
        starts[mark + 1] = False
        starts[mark + 1 + length] = True
    start = np.flatnonzero(starts[:n])
    end = np.append(start[1:], n)
    up, down = powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((code + np.uint64(1)) * up[:n], out=total[1:])
    name = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    return Pieces(whole, code, start, end, name, np.searchsorted(start, at, "left"))


def _runs(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of runs of ``size`` values from each place on, one run after the other."""
    stop = np.cumsum(size)
    return np.repeat(at - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)


def _equal(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the runs of ``size`` values from each place of a and of b are equal, value by value; sizes are over 0."""
    if not len(size):
        return np.zeros(0, bool)
    return np.logical_and.reduceat(a[_runs(a_at, size)] == b[_runs(b_at, size)], np.cumsum(size) - size)


class Pool:
    """A run of values that grows at its end; ``used`` of them count."""

    def __init__(self, dtype: np.dtype):
        self.values, self.used = np.zeros(1 << 16, dtype), 0

    def put(self, more: np.ndarray) -> int:
        """Writes values at the end and returns their place."""
        need = self.used + len(more)
        if need > len(self.values):
            self.values = np.concatenate([self.values[: self.used], np.zeros(need - self.used + len(self.values) // 4, self.values.dtype)])
        self.values[self.used : need] = more
        self.used = need
        return need - len(more)


class PieceMemo:
    """Ids of pieces, found by a hash and then compared code point by code point, so no two pieces are ever mixed up.

    Sorted arrays of a few bytes an entry let a worker keep millions. Pieces of over ``LONG`` code points, and pieces
    whose hash belongs to another one, are encoded each time and not kept.
    """

    LONG = 64

    def __init__(self, dtype: np.dtype, limit: int):
        self.rows = SortedMemo(limit, at=np.dtype(np.int64), size=np.dtype(np.int32), code_at=np.dtype(np.int64), length=np.dtype(np.int32))
        self.ids, self.codes = Pool(dtype), Pool(np.dtype(np.uint32))

    def encode(self, pieces: Pieces, encode: Callable[[list[str]], list[list[int]]]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and n + 1 offsets of the texts; ``encode`` gets the pieces that are new."""
        length = pieces.end - pieces.start
        brief = np.flatnonzero(length <= self.LONG)
        order = brief[np.argsort(pieces.hash[brief], kind="stable")]
        ranked = pieces.hash[order]
        leads = np.ones(len(order), bool)
        leads[1:] = ranked[1:] != ranked[:-1]
        lead, keys = order[leads], ranked[leads]
        group = np.full(len(length), -1)
        group[order] = np.cumsum(leads) - 1
        rest = order[~leads]
        to = lead[group[rest]]
        same = length[rest] == length[to]
        same[same] = _equal(pieces.code, pieces.start[rest[same]], pieces.code, pieces.start[to[same]], length[rest[same]])
        group[rest[~same]] = -1

        at, size, keep = self._known(pieces, lead, keys, length, encode)
        place, count = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        own = np.flatnonzero(group >= 0)
        place[own], count[own] = at[group[own]], size[group[own]]
        alone = np.flatnonzero(group < 0)
        if len(alone):
            texts: dict[str, int] = {}
            which = np.array([texts.setdefault(pieces.piece(k), len(texts)) for k in alone.tolist()])
            at, size, flat = self._put(encode(list(texts)))
            self.ids.used -= len(flat)  # nothing refers to these after this batch
            place[alone], count[alone] = at[which], size[which]
        out = self.ids.values[_runs(place, count)]
        if not keep():
            self.ids.used = self.codes.used = 0
        return out, np.concatenate([[0], np.cumsum(count)])[pieces.first]

    def _put(self, ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place and number of each list's ids in the pool, and the ids."""
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for x in ids for i in x), self.ids.values.dtype, int(size.sum()))
        return self.ids.put(flat) + np.cumsum(size) - size, size, flat

    def _known(self, pieces: Pieces, lead: np.ndarray, keys: np.ndarray, length: np.ndarray, encode: Callable[[list[str]], list[list[int]]]) -> tuple[np.ndarray, np.ndarray, Callable[[], bool]]:
        """Place and number of each lead's ids, and what keeps the new ones; that is False if the memo was full and is empty now."""
        taken, found = self.rows.find(keys)
        known = taken & (found["length"] == length[lead])
        known[known] = _equal(pieces.code, pieces.start[lead[known]], self.codes.values, found["code_at"][known], length[lead[known]])
        at, size = found["at"].astype(np.int64), found["size"].astype(np.int64)
        fresh, kept = np.flatnonzero(~known), np.flatnonzero(~taken)
        at[fresh], size[fresh], _ = self._put(encode([pieces.piece(k) for k in lead[fresh].tolist()]))
        own = length[lead[kept]]
        code_at = self.codes.put(pieces.code[_runs(pieces.start[lead[kept]], own)]) + np.cumsum(own) - own
        return at, size, lambda: self.rows.add(keys[kept], at=at[kept], size=size[kept], code_at=code_at, length=own)
