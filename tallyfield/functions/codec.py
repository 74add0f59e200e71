"""Compact binary packs: variable-length numbers, month masks, cells and their species.

Layout of a pack: the four bytes of MAGIC, resolution, number of cells, then for each cell in ascending
order the difference to the cell before, the months with samples as a 16-bit little-endian mask with their
samples, the number of species, and for each species in ascending order the difference to the one
before, its mask and its observations. Numbers are unsigned LEB128.
"""

from __future__ import annotations

import gzip
import struct
from collections.abc import Iterable, Iterator

MAGIC = b"H3P1"


def uvarint(n: int) -> bytes:
    if n < 0:
        raise ValueError(f"negative: {n}")
    out = []
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


class Reader:
    """A cursor over a pack's bytes."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def number(self) -> int:
        total = shift = 0
        while True:
            byte = self.data[self.at]
            self.at += 1
            total |= (byte & 127) << shift
            if byte < 128:
                return total
            shift += 7

    def months(self) -> list[int]:
        (mask,) = struct.unpack_from("<H", self.data, self.at)
        self.at += 2
        return [self.number() if mask >> m & 1 else 0 for m in range(12)]


def _months(values: Iterable[int]) -> bytes:
    own = list(values)
    mask = sum(1 << m for m, v in enumerate(own) if v)
    return struct.pack("<H", mask) + b"".join(uvarint(v) for v in own if v)


def _deltas(keys: Iterable[int]) -> Iterator[int]:
    last = 0
    for k in keys:
        yield k - last
        last = k


Cell = tuple[int, list[int], list[tuple[int, list[int]]]]  # cell, samples (12), [(species, obs (12))]


def header(n: int, res: int) -> bytes:
    return MAGIC + bytes([res]) + uvarint(n)


def encode_cells(cells: Iterable[Cell], last: int = 0) -> bytes:
    """What follows a header, or goes on after the cell last."""
    ordered = sorted(cells, key=lambda c: c[0])
    out = []
    for cell, samples, species in ordered:
        own = sorted(species)
        out += [uvarint(cell - last), _months(samples), uvarint(len(own))]
        last = cell
        for inner, (_, obs) in zip(_deltas(s for s, _ in own), own, strict=True):
            out += [uvarint(inner), _months(obs)]
    return b"".join(out)


def encode(cells: Iterable[Cell], res: int) -> bytes:
    own = list(cells)
    return header(len(own), res) + encode_cells(own)


def decode_cells(r: Reader, last: int = 0) -> Iterator[Cell]:
    """The cells up to the end of the bytes."""
    while r.at < len(r.data):
        last += r.number()
        samples, species, sid = r.months(), [], 0
        for _ in range(r.number()):
            sid += r.number()
            species.append((sid, r.months()))
        yield last, samples, species


def opened(data: bytes) -> tuple[int, int, Reader]:
    """(resolution, number of cells, what follows) of a pack, or of the first of its pieces."""
    if data[:4] != MAGIC:
        raise ValueError("not a pack")
    r = Reader(data)
    r.at = 5
    return data[4], r.number(), r


def decode(data: bytes) -> tuple[int, list[Cell]]:
    """(resolution, cells): the inverse of encode."""
    res, n, r = opened(data)
    cells = list(decode_cells(r))
    if len(cells) != n:
        raise ValueError(f"{len(cells)} cells instead of {n}")
    return res, cells


def compressed(data: bytes, level: int = 9) -> bytes:
    return gzip.compress(data, level, mtime=0)


def expanded(data: bytes) -> bytes:
    """The inverse of compressed, also of several members in a row."""
    return gzip.decompress(data)
