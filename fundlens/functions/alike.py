"""Ratcliff-Obershelp ratios of many pairs of names at once, equal to ``difflib``'s.

Names are made of the signs of ``text.word_key``.  Pairs are ruled out by the letters that both have, then by their longest
common subsequence (a bit for each letter of the second name); only what is left is compared, in whole arrays.
"""

from __future__ import annotations

import difflib
from collections import Counter
from functools import cached_property

import numpy as np

SIGNS = " abcdefghijklmnopqrstuvwxyz0123456789"
_BITS = 64
_ALL = np.uint64(2**64 - 1)
_ONE = np.uint64(1)
#: Pairs compared at once; bounds memory only.
_CHUNK = 1 << 12
#: So few pairs are compared one by one.
_FEW = 6


class Names:
    """Distinct names with their letters as numbers, their counts of letters and the places of each letter as bits."""

    def __init__(self, names: list[str]):
        self.names = names
        self.length = np.array([len(n) for n in names], dtype=np.int64)
        width = int(self.length.max(initial=0))
        table = np.full(256, len(SIGNS), dtype=np.uint8)
        table[np.frombuffer(SIGNS.encode(), dtype=np.uint8)] = np.arange(len(SIGNS))
        letters = np.frombuffer(b"".join(n.encode("ascii").ljust(width) for n in names), dtype=np.uint8).reshape(len(names), width)
        self.codes = np.where(np.arange(width) < self.length[:, None], table[letters], len(SIGNS)).astype(np.uint8)
        signs = len(SIGNS) + 1
        self._cell = (self.codes + np.arange(len(names))[:, None] * signs).ravel()
        counts = np.bincount(self._cell, minlength=len(names) * signs).reshape(len(names), signs)
        self.counts = np.ascontiguousarray(counts.T).astype(np.uint8 if width < 256 else np.int32)
        self._least: dict[tuple[int, int], np.ndarray] = {}

    @cached_property
    def places(self) -> np.ndarray:
        """The first 64 places of each letter of each name; each bit is added once."""
        width = self.codes.shape[1]
        half = [np.where((np.arange(width) >= lo) & (np.arange(width) < lo + 32), 2.0 ** (np.arange(width) % 32), 0.0) for lo in (0, 32)]
        low, high = (np.bincount(self._cell, np.tile(h, len(self.names)), minlength=len(self.names) * (len(SIGNS) + 1)).astype(np.uint64) for h in half)
        out = (low | (high << np.uint64(32))).reshape(len(self.names), len(SIGNS) + 1)
        out[:, -1] = 0
        return out

    def shared(self, code: int, times: int) -> np.ndarray:
        """How often each name has a letter, counted up to ``times``."""
        if (code, times) not in self._least:
            self._least[code, times] = np.minimum(self.counts[code], times)
        return self._least[code, times]


def _needed(total: np.ndarray, least: np.ndarray | float) -> np.ndarray:
    """Fewest matched letters with which two names reach ``least``; one letter short of it at worst."""
    return np.ceil(least * total / 2.0 - 1e-9)


def _subsequence(a: Names, b: Names, ia: np.ndarray, ib: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence; second names have 64 letters at most."""
    v = np.full(len(ia), _ALL)
    codes = np.ascontiguousarray(a.codes[ia].T).astype(np.int64)
    places, row = b.places.ravel(), ib * b.places.shape[1]
    for i in range(int(a.length[ia].max(initial=0))):
        u = v & places.take(row + codes[i])
        v = (v + u) | (v - u)
    inside = np.where(b.length[ib] > 0, _ALL >> (_BITS - np.maximum(b.length[ib], 1)).astype(np.uint64), np.uint64(0))
    return np.bitwise_count(~v & inside).astype(np.int64)


def _matched(a: Names, b: Names, ia: np.ndarray, ib: np.ndarray, needed: np.ndarray) -> np.ndarray:
    """Letters in matching blocks; less than ``needed`` may be too few.

    The blocks of all pairs are found level by level.  The rows (letters of the first names) of all open stretches lie
    in one array, an empty row before each stretch; runs of 2k rows come from two runs of k.
    """
    found = np.zeros(len(ia), dtype=np.int64)
    pair = np.arange(len(ia))
    alo, ahi, blo, bhi = np.zeros_like(pair), a.length[ia], np.zeros_like(pair), b.length[ib]
    while True:
        rest = np.bincount(pair, weights=np.minimum(ahi - alo, bhi - blo), minlength=len(ia))
        keep = (ahi > alo) & (bhi > blo) & (found + rest >= needed)[pair]
        pair, alo, ahi, blo, bhi = (x[keep] for x in (pair, alo, ahi, blo, bhi))
        if not len(pair):
            return found
        rows = ahi - alo + 1
        start = np.cumsum(rows) - rows
        item = np.repeat(np.arange(len(pair)), rows)
        at = np.arange(len(item)) - start[item]
        row = alo[item] + at - 1
        window = ((_ALL >> (_BITS - bhi).astype(np.uint64)) >> blo.astype(np.uint64)) << blo.astype(np.uint64)
        run = b.places[ib[pair[item]], a.codes[ia[pair[item]], np.maximum(row, 0)]] & window[item]
        run[start] = 0
        runs, k = [], 1
        while run.any():
            runs.append(run)
            if k >= _BITS // 2:
                break
            longer = np.zeros_like(run)
            longer[k:] = run[k:] & (run[:-k] << np.uint64(k))
            run, k = longer, 2 * k
        size, ends = np.zeros(len(pair), dtype=np.int64), np.zeros_like(item, dtype=np.uint64)
        for level in range(len(runs) - 1, -1, -1):
            k = 1 << level
            more = np.zeros_like(ends)
            more[k:] = runs[level][k:] & (ends[:-k] << np.uint64(k))
            more = np.where((size == 0)[item], runs[level], more)
            hit = np.bitwise_or.reduceat(more, start) != 0
            size += k * hit
            ends = np.where(hit[item], more, ends)
        # of the longest runs the first in the first name, then in the second
        some = np.flatnonzero(ends)
        which, first = np.unique(item[some], return_index=True)
        some = some[first]
        low = ends[some]
        i, j = row[some] + 1, np.bitwise_count((low & (~low + _ONE)) - _ONE).astype(np.int64) + 1
        pair, alo, ahi, blo, bhi, size = (x[which] for x in (pair, alo, ahi, blo, bhi, size))
        np.add.at(found, pair, size)
        pair, alo, ahi, blo, bhi = np.r_[pair, pair], np.r_[alo, i], np.r_[i - size, ahi], np.r_[blo, j], np.r_[j - size, bhi]


def _long_ratio(x: str, y: str, least: float) -> float:
    """The ratio of two names of any length where their longest common subsequence allows ``least``, else 0."""
    places: dict[str, int] = {}
    for j, c in enumerate(y):
        places[c] = places.get(c, 0) | 1 << j
    full = v = (1 << len(y)) - 1
    for c in x:
        u = v & places.get(c, 0)
        v = ((v + u) | (v - u)) & full
    if len(y) - v.bit_count() < _needed(np.float64(len(x) + len(y)), least):
        return 0.0
    return difflib.SequenceMatcher(None, x, y).ratio()


def ratios(a: Names, b: Names, ia: np.ndarray, ib: np.ndarray, least: float) -> np.ndarray:
    """The ratio of each pair where it is ``least`` or more, else 0."""
    out = np.zeros(len(ia))
    short = (b.length[ib] <= _BITS) & (len(ia) > _FEW)
    long = np.flatnonzero(~short)
    turned = long[(a.length[ia[long]] <= _BITS) & (len(long) > _FEW)]  # a common subsequence is one from either side
    may = np.ones(len(ia), dtype=bool)
    for lo in range(0, len(turned), _CHUNK):
        at = turned[lo : lo + _CHUNK]
        may[at] = _subsequence(b, a, ib[at], ia[at]) >= _needed(a.length[ia[at]] + b.length[ib[at]], least)
    for k in long[may[long]]:
        out[k] = _long_ratio(a.names[ia[k]], b.names[ib[k]], least)
    some = np.flatnonzero(short)
    for lo in range(0, len(some), _CHUNK):
        at = some[lo : lo + _CHUNK]
        total = a.length[ia[at]] + b.length[ib[at]]
        needed = _needed(total, least)
        may = _subsequence(a, b, ia[at], ib[at]) >= needed
        at, total, needed = at[may], total[may], needed[may]
        found = _matched(a, b, ia[at], ib[at], needed)
        out[at] = np.where(found >= needed, np.where(total > 0, 2.0 * found / np.maximum(total, 1), 1.0), 0.0)
    out[out < least] = 0.0
    return out


def alike(a: Names, b: Names, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in a, place in b, ratio) of all pairs with a ratio of ``least`` or more."""
    got: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    kind = b.counts.dtype if a.counts.dtype == b.counts.dtype else np.dtype(np.int32)
    needs: dict[int, np.ndarray] = {}
    ia, ib, waiting = [], [], 0

    def settle() -> None:
        nonlocal ia, ib, waiting
        if waiting:
            x, y = np.concatenate(ia), np.concatenate(ib)
            r = ratios(a, b, x, y, least)
            got.append((x[r > 0], y[r > 0], r[r > 0]))
        ia, ib, waiting = [], [], 0

    for k, name in enumerate(a.names):
        if len(name) not in needs:
            needs[len(name)] = _needed(len(name) + b.length, least).astype(np.int32)
        both = np.zeros(len(b.names), dtype=kind)
        for sign, times in Counter(name).items():
            both += b.shared(SIGNS.index(sign), times)
        hits = np.flatnonzero(both >= needs[len(name)])
        if len(hits):
            ia.append(np.full(len(hits), k))
            ib.append(hits)
            waiting += len(hits)
        if waiting >= _CHUNK:
            settle()
    settle()
    if not got:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*got, strict=True))
