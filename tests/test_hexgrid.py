"""The hexagonal grid and area covers: properties over the whole globe, and areas against plain arithmetic."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tallyfield.functions import geo, hexgrid
from tallyfield.operators import areas

GRID = hexgrid.Hexagons()
HEAD = (hexgrid.MODE << 59) | ((1 << 45) - 1)


def places(spark, n):
    """Spread evenly over the globe."""
    k = F.col("id") + 0.5
    return spark.range(n).select("id", F.degrees(F.asin(1 - 2 * k / n)).alias("lat"), (F.pmod(k * 137.50776405, F.lit(360.0)) - 180).alias("lng"))


@pytest.fixture(scope="module")
def second(spark):
    """All cells of resolution 2, from the top, with their centres and neighbours."""
    rows = spark.createDataFrame([(HEAD | b << 45,) for b in range(122)], "cell bigint").repartition(4)
    for _ in range(2):
        rows = rows.select(F.explode(GRID.children(F.col("cell"))).alias("cell"))
    return {r.cell: r for r in rows.select("cell", GRID.centre(F.col("cell")).alias("c"), GRID.neighbours(F.col("cell"), 2).alias("near"), geo.parent(F.col("cell"), 1).alias("up")).collect()}


def test_solid():
    r = hexgrid.RULES
    assert len(r.base_face) == 122 and sum(f == g for f, g in zip([x // 3 for x in range(60)], r.first, strict=True)) == 12
    for f in range(20):
        for e in range(3):
            g = r.across[3 * f + e]
            back = next(x for x in range(3) if r.across[3 * g + x] == f)
            assert (r.turn[3 * f + e] + r.turn[3 * g + back]) % 6 == 0
    assert all(len(set(ring)) == 5 for ring in r.ring)


def test_cells_of_a_resolution(second):
    assert len(second) == 10 * 12 * 49 + 2
    near = {c: set(r.near) for c, r in second.items()}
    assert sum(len(n) == 5 for n in near.values()) == 12 and sum(len(n) == 6 for n in near.values()) == len(second) - 12
    # Neighbours are those of each other, and none is missed or far away.
    assert all(c in near[n] for c, ns in near.items() for n in ns)
    step = hexgrid.step_km(2, geo.EARTH_KM)
    for c, r in list(second.items())[::37]:
        for n in near[c]:
            assert km(r.c, second[n].c) <= step * (1 + 1e-9)
        around = [o for o, x in second.items() if o != c and km(r.c, x.c) < step * 0.55]
        assert set(around) <= near[c]


def km(p, q):
    a, b, o = math.radians(p.lat), math.radians(q.lat), math.radians(q.lng - p.lng)
    h = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(o / 2) ** 2
    return 2 * geo.EARTH_KM * math.asin(min(1, math.sqrt(h)))


@pytest.mark.parametrize("res", [0, 2, 7, 15])
def test_centres_map_back_and_parents_nest(spark, res):
    x = places(spark, 3000).withColumn("cell", GRID.cell(F.col("lat"), F.col("lng"), res)).withColumn("c", GRID.centre(F.col("cell")))
    x = x.withColumn("back", GRID.cell(F.col("c.lat"), F.col("c.lng"), res)).withColumn("km", geo.haversine_km(F.col("lat"), F.col("lng"), F.col("c.lat"), F.col("c.lng")))
    up = geo.parent(F.col("cell"), max(0, res - 1))
    x = x.withColumn("held", F.array_contains(GRID.children(up), F.col("cell")) if res else F.lit(True))
    got = x.agg(F.sum((F.col("back") == F.col("cell")).cast("int")), F.max("km"), F.sum(F.col("held").cast("int")), F.max(geo.resolution(F.col("cell")))).first()
    # A place is no farther from its centre than a hexagon's corner.
    assert got[0] == 3000 and got[1] <= hexgrid.step_km(res, geo.EARTH_KM) / math.sqrt(3) * (1 + 1e-6) and got[2] == 3000 and got[3] == res


def test_places_on_corners_edges_and_poles(spark):
    r = hexgrid.RULES
    rows = [(math.degrees(math.asin(z)), math.degrees(math.atan2(y, x)) + hexgrid.TURNED) for x, y, z in [*r.corners, *r.middles]]
    rows += [(90.0, 0.0), (90.0, 123.0), (-90.0, 5.0), (0.0, 180.0), (0.0, -180.0), (None, 1.0), (1.0, None)]
    x = spark.createDataFrame(rows, "lat double, lng double").coalesce(1).withColumn("cell", GRID.cell(F.col("lat"), F.col("lng"), 5)).withColumn("near", GRID.neighbours(F.col("cell"), 5)).collect()
    assert len({y.cell for y in x[:12]}) == 12 and {len(y.near) for y in x[:12]} == {5} and {len(y.near) for y in x[12:32]} == {6}
    assert x[32].cell == x[33].cell and x[35].cell == x[36].cell and x[37].cell is None and x[38].cell is None


def test_areas_differ_by_two_at_most(spark):
    """Places that are spread evenly, counted by cell: the spread of hexagons stays within the stated factor, and the sum of areas is the globe."""
    n = 400_000
    got = places(spark, n).repartition(4).groupBy(GRID.cell(F.col("lat"), F.col("lng"), 1).alias("cell")).count().withColumn("k", F.size(GRID.neighbours(F.col("cell"), 1))).collect()
    six = [r["count"] for r in got if r.k == 6]
    assert len(got) == 842 and max(six) / min(six) < 2.1


def plain_inside(shape, lat, lng):
    ring, circle = shape
    if circle:
        (a, o, r) = circle
        return km(Place(a, o), Place(lat, lng)) <= r
    wrap = lambda x: (x + 180) % 360 - 180
    n, turn = 0, 0.0
    for (y1, x1), (y2, x2) in zip(ring, ring[1:] + ring[:1], strict=True):
        x, dx = wrap(x1 - lng), wrap(x2 - x1)
        turn += dx
        n += (x <= 0) != (x + dx <= 0) and y1 - lat - x / dx * (y2 - y1) > 0
    return (n + (abs(turn) > 180 and sum(y for y, _ in ring) > 0)) % 2 == 1


class Place:
    def __init__(self, lat, lng):
        self.lat, self.lng = lat, lng


def shapes():
    rng = random.Random(6)
    out = {"pole": ([(70.0, -120.0), (75.0, 0.0), (65.0, 120.0)], None), "south": ([(-80.0, -100.0), (-60.0, 10.0), (-70.0, 130.0)], None), "line": ([(10.0, 170.0), (-10.0, 170.0), (-12.0, -170.0), (12.0, -165.0)], None)}
    out |= {"cap": (None, (90.0, 0.0, 1500.0)), "small": (None, (12.3, -179.9, 40.0)), "far": (None, (0.0, 0.0, 15000.0))}
    for i in range(8):
        a, o = rng.uniform(-60, 60), rng.uniform(-180, 180)
        turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(rng.randint(3, 9)))
        out[f"r{i}"] = ([(a + rng.uniform(2, 25) * math.sin(t), (o + rng.uniform(2, 30) * math.cos(t) + 180) % 360 - 180) for t in turns], None)
    return out


def test_cover_against_every_centre(spark, second):
    own = shapes()
    rows = [(k, ring, *(c or (None, None, None))) for k, (ring, c) in own.items()]
    rows += [("none", None, None, None, None), ("two", [(0.0, 0.0), (1.0, 1.0)], None, None, None), ("gap", [(0.0, 0.0), (None, 1.0), (2.0, 2.0)], None, None, None), ("bare", None, 1.0, None, 5.0)]
    df = areas.areas(spark.createDataFrame(rows, "area_id string, ring array<struct<lat:double,lng:double>>, lat double, lng double, km double"))
    cells = spark.createDataFrame([(2, i, c, r.c.lat, r.c.lng) for i, (c, r) in enumerate(second.items())], "res int, cell_ref bigint, h3 bigint, lat double, lng double")
    want = {(k, i) for k, s in own.items() for i, r in enumerate(second.values()) if plain_inside(s, r.c.lat, r.c.lng)}
    for depth in (0, 1, 2):
        covered = areas.cover(df, depth)
        got = [(r.area_id, r.cell_ref) for r in areas.members(cells, covered, 2, depth).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert 0 < covered.filter("whole").count() < covered.count() < len(want)
