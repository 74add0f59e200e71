"""Distances, cluster counts, cell ids and a lattice of quads.

Cell ids have the bit layout of public 64-bit ones: mode at bit 59, resolution at 52, base cell at 45, then a
three-bit digit for each resolution, unused ones 7. The modes of the lattice and of the hexagons (`hexgrid`) differ from that of
such ids and from each other, so they can't be mixed up. Whole builds use hexagons.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import hexgrid

EARTH_KM = 6371.0
MODE, ROWS, COLUMNS, DEPTH = 2, 10, 12, 15


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance; the difference of longitudes wraps at the date line."""
    a, b = F.radians(lat1), F.radians(lat2)
    dlat, dlng = b - a, F.radians(lng2 - lng1)
    h = F.sin(dlat / 2) * F.sin(dlat / 2) + F.cos(a) * F.cos(b) * F.sin(dlng / 2) * F.sin(dlng / 2)
    return F.lit(2 * EARTH_KM) * F.atan2(F.sqrt(h), F.sqrt(F.greatest(F.lit(0.0), 1 - h)))


def desired_clusters(n: Column, low: int = 3, high: int = 30, scale: float = 1.5) -> Column:
    return F.when(n <= 0, F.lit(low)).otherwise(F.greatest(F.lit(low), F.least(F.lit(high), F.ceil(F.lit(scale) * F.log2(n.cast("double"))))))


def round3(x: Column) -> Column:
    """To three decimals, halves to even."""
    return F.rint(x * 1000) / 1000


def parent(cell: Column, res: int) -> Column:
    """The cell at a coarser resolution: its resolution and the digits beyond it are replaced."""
    kept = cell.bitwiseAND(F.lit(~(15 << 52)))
    return kept.bitwiseOR(F.lit((res << 52) | ((1 << 3 * (DEPTH - res)) - 1)))


def resolution(cell: Column) -> Column:
    return F.shiftright(cell, 52).bitwiseAND(15).cast("int")


def cell_hex(cell: Column) -> Column:
    return F.lower(F.hex(cell))


@dataclass(frozen=True)
class Lattice:
    """Quads in latitude and longitude, in column expressions: cheaper than hexagons, but narrow towards the poles."""

    def cell(self, lat: Column, lng: Column, res: int) -> Column:
        size = 1 << DEPTH
        qa = F.least(F.floor((lat + 90) / 180 * ROWS * size), F.lit(ROWS * size - 1)).cast("bigint")
        qo = F.least(F.floor((lng + 180) / 360 * COLUMNS * size), F.lit(COLUMNS * size - 1)).cast("bigint")
        base = F.shiftright(qa, DEPTH) * COLUMNS + F.shiftright(qo, DEPTH)
        out = F.lit((MODE << 59) | (res << 52) | ((1 << 3 * (DEPTH - res)) - 1)) + F.shiftleft(base, 45)
        for r in range(1, res + 1):
            digit = F.shiftright(qa, DEPTH - r).bitwiseAND(1) * 2 + F.shiftright(qo, DEPTH - r).bitwiseAND(1)
            out = out + F.shiftleft(digit.cast("bigint"), 3 * (DEPTH - r))
        return out

    def _steps(self, cell: Column, res: int, first: Column, bit: int) -> Column:
        n = F.shiftleft(first.cast("bigint"), res)
        for r in range(1, res + 1):
            d = F.shiftright(F.shiftright(cell, 3 * (DEPTH - r)).bitwiseAND(7), bit).bitwiseAND(1)
            n = n + F.shiftleft(d.cast("bigint"), res - r)
        return n

    def lat(self, cell: Column, res: int) -> Column:
        base = F.shiftright(cell, 45).bitwiseAND(127)
        return (self._steps(cell, res, F.floor(base / COLUMNS), 1) + 0.5) / float(1 << res) * (180 / ROWS) - 90

    def lng(self, cell: Column, res: int) -> Column:
        base = F.shiftright(cell, 45).bitwiseAND(127)
        return (self._steps(cell, res, F.pmod(base, F.lit(COLUMNS)), 0) + 0.5) / float(1 << res) * (360 / COLUMNS) - 180


class Grid(Protocol):
    """What the roll-ups need of a grid; ids have the bit layout that `parent` reads."""

    def cell(self, lat: Column, lng: Column, res: int) -> Column: ...

    def lat(self, cell: Column, res: int) -> Column: ...

    def lng(self, cell: Column, res: int) -> Column: ...


def grid() -> Grid:
    """The grid of whole builds."""
    return hexgrid.Hexagons()


def check_resolutions(resolutions: list[int], finer_than: int | None = None) -> list[int]:
    """Distinct, finest first, within 0..15; roll-ups must be strictly coarser than their source."""
    out = sorted(set(resolutions), reverse=True)
    if not out or out[0] > DEPTH or out[-1] < 0:
        raise ValueError(f"resolutions must be within 0..{DEPTH}: {resolutions}")
    if finer_than is not None and out[0] >= finer_than:
        raise ValueError(f"resolutions must be coarser than {finer_than}: {resolutions}")
    return out
