"""Places by latitude and longitude: a table along a Z-order curve, boxes, and the nearest of many points."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import geo
from ..sources import stored

#: Levels of the curve, each halving both sides of a square; levels of a table's folders; most ranges that a box is cut into.
LEVELS, ZONE, RANGES = 20, 3, 64
#: Levels at which nearest places are looked for, from small squares to the whole world.
RINGS = (14, 12, 10, 8, 6, 5, 4, 3, 2, 1)


def row(lat: Column, level: int) -> Column:
    return F.least(F.floor((lat + 90) / 180 * (1 << level)), F.lit((1 << level) - 1)).cast("bigint")


def column(lng: Column, level: int) -> Column:
    """180 degrees east is where 180 degrees west is."""
    return F.pmod(F.floor((lng + 180) / 360 * (1 << level)).cast("bigint"), F.lit(1 << level))


def _spread(x: Column) -> Column:
    """The bits of a number of LEVELS bits, a zero before each."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
    return x


def curve(lat: Column, lng: Column) -> Column:
    """The place on the curve: the bits of row and column in turns; null without a place."""
    return _spread(row(lat, LEVELS)) * 2 + _spread(column(lng, LEVELS))


def write(places: DataFrame, path: str) -> None:
    """A table along the curve: a folder for each large square, files ranged and row groups sorted by the place in it. Places without coordinates have no folder."""
    at = places.filter("lat is not null and lng is not null").withColumn("curve", curve(F.col("lat"), F.col("lng")))
    ranged = at.withColumn("zone", F.shiftright("curve", 2 * (LEVELS - ZONE)).cast("int")).repartitionByRange("zone", "curve").sortWithinPartitions("zone", "curve")
    ranged.write.mode("overwrite").partitionBy("zone").parquet(path)


def ranges(south: float, west: float, north: float, east: float, most: int = RANGES) -> list[tuple[int, int]]:
    """Ranges of the curve, both ends included, that hold a box and at most most: squares are cut where they meet the edge, as long as there is room."""

    def meets(level: int, r: int, c: int) -> int:
        """0: apart, 1: in part, 2: inside."""
        h, w = 180 / (1 << level), 360 / (1 << level)
        lo, hi, le, ri = r * h - 90, (r + 1) * h - 90, c * w - 180, (c + 1) * w - 180
        if hi < south or lo > north or ri < west or le > east:
            return 0
        return 2 if south <= lo and hi <= north and west <= le and ri <= east else 1

    done: list[tuple[int, int, int]] = []
    edge = [(0, 0, 0)]
    for level in range(1, LEVELS + 1):
        parts = [(level, 2 * r + i, 2 * c + j) for _, r, c in edge for i in (0, 1) for j in (0, 1)]
        kinds = [(p, meets(*p)) for p in parts]
        inside, partly = [p for p, k in kinds if k == 2], [p for p, k in kinds if k == 1]
        if len(done) + len(inside) + len(partly) > most:
            break
        done, edge = done + inside, partly

    def ends(level: int, r: int, c: int) -> tuple[int, int]:
        key = sum(((r >> b & 1) << 2 * b + 1) | ((c >> b & 1) << 2 * b) for b in range(level))
        return key << 2 * (LEVELS - level), (key + 1 << 2 * (LEVELS - level)) - 1

    out: list[tuple[int, int]] = []
    for a, b in sorted(ends(*p) for p in done + edge):
        if out and out[-1][1] + 1 >= a:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def in_box(table: DataFrame, south: float, west: float, north: float, east: float) -> DataFrame:
    """The places of a written table in a box, edges included; a box whose west is greater than its east crosses the date line.

    Only the folders that the box meets are listed and only row groups in its ranges of the curve are read.
    """
    sides = [(west, east)] if west <= east else [(west, 180.0), (-180.0, east)]
    # What stands at 180 degrees is in the first column, whatever its sign.
    found = [r for a, b in sides for r in ranges(south, a, north, b)] + [r for a, b in sides if b >= 180 or a <= -180 for x in (-180.0,) for r in ranges(south, x, north, x)]
    if not found:
        return table.filter("false").drop("curve", "zone")
    zones = sorted({z for a, b in found for z in range(a >> 2 * (LEVELS - ZONE), (b >> 2 * (LEVELS - ZONE)) + 1)})
    on_curve = reduce(Column.__or__, [F.col("curve").between(a, b) for a, b in found])
    exact = F.col("lat").between(south, north) & reduce(Column.__or__, [F.col("lng").between(a, b) for a, b in sides])
    return table.filter(F.col("zone").isin(zones) & on_curve & exact).drop("curve", "zone")


def _around(level: int) -> Column:
    """Squares of a level: that of a point and its neighbours, as row * columns + column."""
    n = 1 << level
    rows = F.filter(F.transform(F.array(*[F.lit(d) for d in (-1, 0, 1)]), lambda d: row(F.col("lat"), level) + d), lambda r: r.between(0, n - 1))
    columns = F.array_distinct(F.transform(F.array(*[F.lit(d) for d in (-1, 0, 1)]), lambda d: F.pmod(column(F.col("lng"), level) + d, F.lit(n))))
    return F.flatten(F.transform(rows, lambda r: F.transform(columns, lambda c: r * n + c)))


def _certain(level: int) -> Column:
    """Kilometres around a point within which every place is in those squares."""
    h, w = 180 / (1 << level), 360 / (1 << level)
    if level == 1:
        return F.lit(float("inf"))  # the whole world
    aside = F.asin(F.least(F.lit(1.0), F.cos(F.radians("lat")) * F.sin(F.radians(F.lit(w)))))
    return F.least(F.radians(F.lit(h)), aside) * geo.EARTH_KM


def nearest(points: DataFrame, places: DataFrame, k: int) -> DataFrame:
    """(point_id, lat, lng) and (id, lat, lng) -> point_id, rank, id, km: the k nearest places of each point, nearest first, ties (to a thousandth of a millimetre) by id.

    Widening rings: each round joins the points that aren't done by the nine squares around them; a point is done when it
    has k places no farther than what those squares surely hold. Squares grow by rounds, so dense places are met at small ones,
    and where many places have the same coordinates only the k smallest ids are candidates. Points
    next to a pole, and all points where there are fewer than k places, take the last round, which holds the world.
    Point ids are taken as unique; points and places without coordinates have no row.
    """
    spark = points.sparkSession
    same = W.partitionBy("lat", "lng").orderBy("id")
    own = places.filter("lat is not null and lng is not null").select("id", "lat", "lng").withColumn("n", F.row_number().over(same)).filter(F.col("n") <= k)
    own = stored.store(spark, own.select("id", F.col("lat").alias("plat"), F.col("lng").alias("plng")), "places")
    open_ = stored.store(spark, points.filter("lat is not null and lng is not null").select("point_id", "lat", "lng"), "points")
    out: list[DataFrame] = []
    best = W.partitionBy("point_id").orderBy("km", "id")
    for level, last in _rounds():
        squares = open_.select("point_id", "lat", "lng", _certain(level).alias("sure"), F.explode(_around(level)).alias("square"))
        held = own.withColumn("square", row(F.col("plat"), level) * (1 << level) + column(F.col("plng"), level))
        km = F.round(geo.haversine_km(F.col("lat"), F.col("lng"), F.col("plat"), F.col("plng")), 9)
        near = squares.join(held, "square").select("point_id", "sure", "id", km.alias("km")).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        near = stored.store(spark, near, "near")
        done = near.filter(F.col("km") < F.col("sure") - 1e-6).groupBy("point_id").agg(F.count("*").alias("n")).filter(F.lit(last) | (F.col("n") >= k)).select("point_id")
        out.append(near.join(done, "point_id", "left_semi").select("point_id", "rank", "id", "km"))
        if not last:
            open_ = stored.store(spark, open_.join(done, "point_id", "left_anti"), "points")
            if open_.isEmpty():
                break
    return reduce(DataFrame.unionByName, out)


def _rounds() -> Iterator[tuple[int, bool]]:
    for level in RINGS:
        yield level, level == RINGS[-1]
