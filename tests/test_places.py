"""Places along the curve, boxes and nearest places, against plain versions."""

import math
import random

from pyspark.sql import functions as F

from tallyfield.operators import places

KIND = "id string, lat double, lng double"


def some(n: int, seed: int) -> list[tuple]:
    rng = random.Random(seed)
    spread = [(f"p{i:04d}", rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(n)]
    return [*spread, *[(f"q{i:03d}", 10.0, 20.0) for i in range(n // 3)], ("e", 5.0, 180.0), ("w", 5.0, -180.0), ("n", 90.0, 3.0), ("s", -90.0, -77.0), ("x", None, 1.0)]


def test_curve_ranges_hold_the_box(spark):
    rng = random.Random(2)
    for _ in range(30):
        s, n = sorted(rng.uniform(-90, 90) for _ in range(2))
        w, e = sorted(rng.uniform(-180, 180) for _ in range(2))
        found = places.ranges(s, w, n, e)
        assert 0 < len(found) <= places.RANGES and all(a <= b for a, b in found) and all(x[1] + 1 < y[0] for x, y in zip(found, found[1:], strict=False))
    points = spark.createDataFrame(some(60, 1), KIND).filter("lat is not null").withColumn("c", places.curve(F.col("lat"), F.col("lng"))).collect()
    for r in points:
        assert any(a <= r.c <= b for a, b in places.ranges(r.lat, -180.0 if r.lng == 180 else r.lng, r.lat, -180.0 if r.lng == 180 else r.lng))


def test_boxes_read_their_folders(spark, tmp_path):
    rows = some(400, 3)
    places.write(spark.createDataFrame(rows, KIND), str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    rng = random.Random(5)
    boxes = [(-90.0, -180.0, 90.0, 180.0), (0.0, 170.0, 10.0, -170.0), (5.0, 180.0, 5.0, 180.0), (0.0, -180.0, 9.0, -179.0), (10.0, 20.0, 10.0, 20.0), (60.0, 5.0, 50.0, 9.0)]
    for _ in range(6):
        s, n = sorted(rng.uniform(-90, 90) for _ in range(2))
        boxes.append((s, rng.uniform(-180, 180), n, rng.uniform(-180, 180)))
    for s, w, n, e in boxes:
        want = sorted(i for i, a, b in rows if a is not None and s <= a <= n and (w <= b <= e if w <= e else b >= w or b <= e))
        assert sorted(r.id for r in places.in_box(table, s, w, n, e).collect()) == want, (s, w, n, e)
    plan = places.in_box(table, 9.0, 19.0, 11.0, 21.0)._jdf.queryExecution().executedPlan().toString()
    assert "zone#" in plan.split("PartitionFilters: ")[1].split("PushedFilters: ")[0] and "GreaterThanOrEqual(curve" in plan.split("PushedFilters: ")[1]
    # Files of the other folders can't be read any more.
    want = sorted(r.id for r in places.in_box(table, 9.0, 19.0, 11.0, 21.0).collect())
    own = {r.zone for r in table.filter("id = 'q000'").select("zone").collect()}
    others = [f for d in (tmp_path / "t").iterdir() if d.is_dir() and int(d.name.split("=")[1]) not in own for f in d.glob("*.parquet")]
    for f in others:
        f.write_bytes(b"x" * f.stat().st_size)
    assert len(others) > 20 and sorted(r.id for r in places.in_box(table, 9.0, 19.0, 11.0, 21.0).collect()) == want


def _km(a: float, b: float, c: float, d: float) -> float:
    p, q = math.radians(a), math.radians(c)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return round(2 * 6371.0 * math.atan2(math.sqrt(h), math.sqrt(max(0, 1 - h))), 9)


def test_nearest_places_in_rings(spark):
    """Points among many places of one spot, at the date line, at the poles, and more places asked for than there are."""
    rows = some(150, 7)
    points = [*[(f"a{i}", a, b) for i, (_, a, b) in enumerate(some(12, 8))], ("hot", 10.0, 20.0), ("line", 5.0, 179.999)]
    for k, own in ((3, rows), (7, rows[:5]), (2, [])):
        got = places.nearest(spark.createDataFrame(points, "point_id string, lat double, lng double"), spark.createDataFrame(own, KIND), k).collect()
        want = []
        for p, a, b in points:
            if a is not None:
                best = sorted((_km(a, b, c, d), i) for i, c, d in own if c is not None)[:k]
                want += [(p, n + 1, i, km) for n, (km, i) in enumerate(best)]
        assert [r[:3] for r in sorted(tuple(r) for r in got)] == [x[:3] for x in sorted(want)]
