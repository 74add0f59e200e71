"""Areas drawn as polygons or circles: which cells of the hexagonal grid have their centre inside, and what was seen there.

An area is covered from coarse cells down: a cell whose descendants all lie outside is left out, one whose descendants
all lie inside stands for them as it is, any other is replaced by its children down to a depth. Stored cells meet
the cover by an equi-join on their ancestors, and only those below a cell at the edge are tested themselves.

A polygon's sides are straight in degrees, each goes the shorter way around the globe, and the last corner joins the
first. A side whose span of longitudes is half the globe goes west. Inside is decided by the sides that a
meridian crosses north of the place; a polygon around a pole holds the pole that its corners' mean latitude
is nearer to. A circle holds what is no farther than its radius. Null or short rings (under three corners), circles without a
radius or place, and cells without a centre hold or are held by nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo, hexgrid

#: The descendants of a cell lie within this share of its step (a geometric sum over the finer steps); slack for rounding.
REACH, SLACK = 1 / (math.sqrt(hexgrid.NORM) - 1), 1e-6
RING = "array<struct<lat:double,lng:double>>"


def _wrapped(x: Column) -> Column:
    """Degrees in [-180, 180)."""
    return F.pmod(x + 180, F.lit(360.0)) - 180


def _sides(ring: Column) -> Column:
    """Each corner with the step to the next: lat, lng, up, along."""
    n = F.size(ring)
    return F.transform(ring, lambda p, i: F.struct(p["lat"].alias("lat"), p["lng"].alias("lng"), (F.get(ring, (i + 1) % n)["lat"] - p["lat"]).alias("up"), _wrapped(F.get(ring, (i + 1) % n)["lng"] - p["lng"]).alias("along")))


def areas(df: DataFrame, area: str = "area_id", ring: str = "ring", lat: str = "lat", lng: str = "lng", km: str = "km") -> DataFrame:
    """area_id and its geometry: sides of a polygon (or null), and lat, lng, km of a circle (or null)."""
    r = F.col(ring).cast(RING)
    whole = F.forall(r, lambda p: p["lat"].isNotNull() & p["lng"].isNotNull())
    sides = F.when((F.size(r) >= 3) & whole, _sides(r))
    return df.select(F.col(area).alias("area_id"), F.struct(sides.alias("sides"), *[F.col(c).cast("double").alias(n) for c, n in ((lat, "lat"), (lng, "lng"), (km, "km"))]).alias("shape"))


def _crossed(shape: Column, lat: Column, lng: Column, high: Column, wide: Column) -> Column:
    """struct of meets (a side meets the box of so many degrees around the place) and inside (the place itself)."""

    def side(acc: Column, s: Column) -> Column:
        x, y = _wrapped(s["lng"] - lng), s["lat"] - lat
        dx, dy = s["along"], s["up"]
        box = F.lit(False)
        for shift in (-360, 0, 360):
            a = x + shift
            near = (F.least(a, a + dx) <= wide) & (F.greatest(a, a + dx) >= -wide) & (F.least(y, y + dy) <= high) & (F.greatest(y, y + dy) >= -high)
            box = box | (near & (F.abs(a * dy - y * dx) <= wide * F.abs(dy) + high * F.abs(dx)))
        over = ((x <= 0) != (x + dx <= 0)) & (y - x / dx * dy > 0)
        return F.struct((acc["meets"] | box).alias("meets"), (acc["n"] + over.cast("int")).alias("n"), (acc["turn"] + dx).alias("turn"), (acc["lats"] + s["lat"]).alias("lats"))

    none = F.struct(F.lit(False).alias("meets"), F.lit(0).alias("n"), F.lit(0.0).alias("turn"), F.lit(0.0).alias("lats"))
    pole = lambda a: ((F.abs(a["turn"]) > 180) & (a["lats"] > 0)).cast("int")
    found = F.aggregate(shape["sides"], none, side, lambda a: F.struct(a["meets"].alias("meets"), ((a["n"] + pole(a)) % 2 == 1).alias("inside")))
    return F.coalesce(found, F.struct(F.lit(False).alias("meets"), F.lit(False).alias("inside")))


def inside(shape: Column, lat: Column, lng: Column) -> Column:
    """Whether the area holds a place; never null."""
    zero = F.lit(-1.0)  # a box that nothing meets
    circle = geo.haversine_km(shape["lat"], shape["lng"], lat, lng) <= shape["km"]
    return (F.coalesce(_crossed(shape, lat, lng, zero, zero)["inside"], F.lit(False)) & lat.isNotNull() & lng.isNotNull()) | F.coalesce(circle, F.lit(False))


def _verdict(shape: Column, cell: Column, depth: int) -> Column:
    """2: the cell's descendants all have their centres in the area, 0: none has, 1: can't tell."""
    steps = [hexgrid.step_km(k, geo.EARTH_KM) * REACH * (1 + SLACK) for k in range(depth + 1)]
    known = F.struct(hexgrid.Hexagons().centre(cell).alias("c"), hexgrid.table(steps, "double")(geo.resolution(cell)).alias("km"))

    def judge(s: Column) -> Column:
        lat, lng, km = s["c"]["lat"], s["c"]["lng"], s["km"]
        high, spread = F.degrees(km / geo.EARTH_KM), F.sin(km / geo.EARTH_KM) / F.cos(F.radians(lat))
        wide = F.when((F.abs(lat) + high >= 90) | (spread >= 1), F.lit(180.0)).otherwise(F.degrees(F.asin(F.least(F.lit(1.0), spread))))
        parts = F.struct(_crossed(shape, lat, lng, high, wide).alias("p"), geo.haversine_km(shape["lat"], shape["lng"], lat, lng).alias("d"), km.alias("km"))
        return hexgrid.let(parts, both)

    def both(s: Column) -> Column:
        polygon = F.when(s["p"]["meets"], 1).when(s["p"]["inside"], 2).otherwise(0)
        circle = F.when(s["d"] + s["km"] <= shape["km"], 2).when(s["d"] - s["km"] > shape["km"], 0).when(s["d"].isNotNull() & shape["km"].isNotNull(), 1)
        return F.greatest(polygon, F.coalesce(circle, F.lit(0)))

    return hexgrid.let(known, judge)


def cover(own: DataFrame, depth: int) -> DataFrame:
    """area_id, shape, cell, whole: disjoint cells of resolution 0 to depth that hold every descendant's centre inside the area; whole: all of them are inside."""
    none = (hexgrid.MODE << 59) | ((1 << 3 * hexgrid.DEPTH) - 1)
    bases = hexgrid.array([none | b << 45 for b in range(len(hexgrid.RULES.base_face))], "bigint")
    shape, cell = F.col("shape"), F.col("cell")
    # Cells are judged as they are made, so each is judged once.
    judged = lambda cells: F.filter(F.transform(cells, lambda c: F.struct(c.alias("cell"), _verdict(shape, c, depth).alias("v"))), lambda x: x["v"] > 0)
    rows = own.filter("shape.sides is not null or shape.km is not null").select("area_id", "shape", F.explode(judged(bases)).alias("x")).select("area_id", "shape", "x.*")
    below = F.when(F.col("v") == 2, F.array(F.struct("cell", "v"))).otherwise(judged(hexgrid.Hexagons().children(cell)))
    for k in range(1, depth + 1):
        rows = rows.select("area_id", "shape", F.explode(below).alias("x")).select("area_id", "shape", "x.*")
        if k == min(2, depth):
            rows = rows.repartition("area_id", "cell")  # few areas begin in few tasks
    return rows.select("area_id", "shape", "cell", (F.col("v") == 2).alias("whole"))


def members(h3_cells: DataFrame, covered: DataFrame, res: int, depth: int) -> DataFrame:
    """area_id, res, cell_ref: stored cells of a resolution whose centres are in an area."""
    cells = h3_cells.filter(F.col("res") == res).select("res", "cell_ref", "lat", "lng", "h3")
    up = F.array(*[geo.parent(F.col("h3"), k) for k in range(min(depth, res) + 1)])
    met = cells.select("res", "cell_ref", F.col("lat").alias("own_lat"), F.col("lng").alias("own_lng"), F.explode(up).alias("cell")).join(covered, "cell")
    return met.filter(F.col("whole") | inside(F.col("shape"), F.col("own_lat"), F.col("own_lng"))).select("area_id", "res", "cell_ref")


def species(cell_obs: DataFrame, cell_samples: DataFrame, held: DataFrame) -> DataFrame:
    """area_id, species_id, month, obs, samples, frequency over the cells that an area holds: sums first, then the ratio."""
    key = ["res", "cell_ref"]
    obs = cell_obs.join(held, key).groupBy("area_id", "species_id", "month").agg(F.sum("obs").alias("obs"))
    samples = cell_samples.join(held, key).groupBy("area_id", "month").agg(F.sum("samples").alias("samples"))
    return obs.join(samples, ["area_id", "month"]).select("area_id", "species_id", "month", "obs", "samples", (F.col("obs").cast("double") / F.col("samples")).alias("frequency"))
