"""Words and their hashes straight from the UTF-8 buffers of Arrow string columns.

No Python string is made: white space, word borders and hashes are found for a few hundred kilobytes
of text at a time with numpy. A word's hash is the sum over its bytes of a random number for the byte
times a power for the place, scrambled; sums over words come from one running sum.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from quayside.llm.common import WHITE, mix

#: Bytes that go through numpy at once; a word longer than this is still taken whole.
SEGMENT = 1 << 19

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_IS_WORD = np.ones(256, bool)
_IS_WORD[[ord(c) for c in WHITE]] = False
with np.errstate(over="ignore"):
    _BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0xD1342543DE82EF95))
_powers = [np.ones(1, _U), np.ones(1, _U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base, and of its inverse, modulo 2 ** 64."""
    if len(_powers[0]) < n:
        n = max(n, SEGMENT + 1)
        for i, base in enumerate((_BASE, _INVERSE)):
            p = np.full(n, _U(base))
            p[0] = 1
            _powers[i] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


@dataclass
class Words:
    """Words of some texts: text i has those from ``first[i]`` to ``first[i + 1]``. ``start`` and
    ``end`` are places in ``data``; ``hash`` is None where only places were asked for."""

    data: np.ndarray
    offsets: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray | None

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def segments(data: np.ndarray, size: int = SEGMENT) -> Iterator[tuple[int, int]]:
    """Ranges that cover the data and end behind white space."""
    at, n = 0, len(data)
    while at < n:
        end = min(at + size, n)
        while end < n:
            gaps = np.flatnonzero(~_IS_WORD[data[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
                break
            end = min(at + 2 * (end - at), n)
        yield at, end
        at = end


def borders(data: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of one segment; ``cut``: places where a text begins."""
    word = _IS_WORD[data]
    change = np.flatnonzero(word[1:] != word[:-1]) + 1
    if len(data) and word[0]:
        change = np.concatenate([[0], change])
    if len(change) % 2:
        change = np.concatenate([change, [len(data)]])
    start, end = change[::2], change[1::2]
    inside = cut[(cut > 0) & (cut < len(data))]
    if len(inside):
        inside = inside[word[inside] & word[inside - 1]]  # a word would run from one text into the next
        if len(inside):
            inside = np.unique(inside)
            start, end = np.sort(np.concatenate([start, inside])), np.sort(np.concatenate([end, inside]))
    return start, end


def scan(column: pa.Array, hashes: bool = True) -> Words:
    data, offsets = buffers(column)
    starts, ends, hs = [], [], []
    for a, b in segments(data):
        part = data[a:b]
        cut = offsets[np.searchsorted(offsets, a) : np.searchsorted(offsets, b)] - a
        s, e = borders(part, cut)
        starts.append(s + a)
        ends.append(e + a)
        if hashes:
            up, down = powers(len(part) + 1)
            total = np.empty(len(part) + 1, _U)
            total[0] = 0
            np.cumsum(_BYTE[part] * up[: len(part)], out=total[1:])
            hs.append(mix((total[e] - total[s]) * down[s] + (e - s).astype(_U)))
    start = np.concatenate(starts) if starts else np.empty(0, np.int64)
    end = np.concatenate(ends) if ends else np.empty(0, np.int64)
    h = (np.concatenate(hs) if hs else np.empty(0, _U)) if hashes else None
    return Words(data, offsets, np.searchsorted(start, offsets), start, end, h)


def windows(h: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """A hash of every run of ``size`` consecutive hashes."""
    n = len(h) - size + 1
    if n <= 0:
        return np.empty(0, _U)
    out = np.full(n, _U(salt * 2 + 1))
    for i in range(size):
        out = (out ^ h[i : i + n]) * _U(_BASE)
        out ^= out >> _U(32)
    return mix(out)


def inside(first: np.ndarray, size: int) -> np.ndarray:
    """Places of the words at which a window of ``size`` words begins that ends in the same text."""
    n = int(first[-1])
    ok = np.zeros(n + 1, np.int64)
    count = np.diff(first)
    has = count >= size
    np.add.at(ok, first[:-1][has], 1)
    np.add.at(ok, first[:-1][has] + count[has] - size + 1, -1)
    return np.flatnonzero(np.cumsum(ok[:-1]) > 0)
