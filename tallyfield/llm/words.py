"""Vectorised tokenising of whole Arrow text columns into 64-bit word hashes.

A column's UTF-8 bytes are classified by table lookup. Words are runs of bytes of a class that
never cross documents. A word's hash is a polynomial over its bytes modulo 2^64, taken from one
running sum, then finalised; documents are cut into slabs of about SLAB bytes so that memory stays
small whatever the batch, and a longer document forms a slab of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLAB = 1 << 19
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words: anything but white space; and letters, digits and all beyond ASCII (after lower-casing).
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, *range(9, 14)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True

_VALUE = np.random.Generator(np.random.PCG64(20240917)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """The public splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, SLAB * 2)
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        for k, base in enumerate((BASE, inverse)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _powers[k] = np.cumprod(x, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


@dataclass
class Slab:
    """Documents first..first+len(offsets)-1 of a batch. words: starts, ends (bytes in buf), doc (from 0 in the slab), hash."""

    first: int
    buf: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    hash: np.ndarray

    @property
    def docs(self) -> int:
        return len(self.offsets) - 1

    def bounds(self) -> np.ndarray:
        """Where each document's words begin, and the end of all."""
        return np.searchsorted(self.starts, self.offsets).astype(np.int64)


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n, at = len(column), column.offset
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, kind)[at : at + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def spans(b: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of member bytes that don't cross documents."""
    inside = member[b]
    edge = np.zeros(len(b) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(b), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(b), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    return starts, np.flatnonzero(inside & (~after | edge[1:])) + 1


def run_hash(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte runs."""
    power, inverse = _power(len(b) + 1)
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_VALUE[b] * power[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts])


def slabs(column: pa.Array, member: np.ndarray = NOT_SPACE, size: int = SLAB) -> Iterator[Slab]:
    """Tokenise a text column, lower-casing A-Z."""
    data, off = raw(column)
    n, at = len(off) - 1, 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + size, "right")) - 1)
        b = LOWER[data[off[at] : off[to]]]
        offsets = off[at : to + 1] - off[at]
        starts, ends = spans(b, offsets, member)
        doc = np.searchsorted(offsets, starts, "right") - 1
        yield Slab(at, b, offsets, starts, ends, doc, run_hash(b, starts, ends))
        at = to


def hash_of(word: str) -> int:
    """The hash that slabs() gives to this one word."""
    s = next(slabs(pa.array([word]), np.ones(256, bool)))
    return int(s.hash[0])
