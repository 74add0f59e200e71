"""Golden values and properties of the scalar functions."""

import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyfield.functions import calendar, codec, geo, regions, score
from tallyfield.sources import readers


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


@pytest.mark.parametrize("o, n, want", [(3, 7, 0.15821692226262676), (1, 1, 0.20654329147389294), (25, 25, 0.8668035060468212), (0, 10, 0.0), (10, 100, 0.05522854161313612), (50, 100, 0.40382982859014716)])
def test_wilson(spark, o, n, want):
    assert one(spark, score.wilson(F.lit(o), F.lit(n)))[0] == pytest.approx(want, abs=1e-15)


@pytest.mark.parametrize("x, want", [(0.04, -1), (0.05, 0), (0.19, 1), (0.3, 3), (0.9, 4)])
def test_bucket_level(spark, x, want):
    assert one(spark, score.bucket_level(F.lit(x)))[0] == want


@pytest.mark.parametrize("p, want", [((0, 0, 0, 1), 111.19492664455873), ((0, 179.5, 0, -179.5), 111.19492664455873), ((40, -74, 51.5, -0.1), 5621.808324142771)])
def test_haversine(spark, p, want):
    assert one(spark, geo.haversine_km(*[F.lit(float(v)) for v in p]))[0] == pytest.approx(want, rel=1e-12)


@pytest.mark.parametrize("n, want", [(0, 3), (1, 3), (4, 3), (5, 4), (100, 10), (1000, 15), (2**20, 30), (10**7, 30)])
def test_desired_clusters(spark, n, want):
    assert one(spark, geo.desired_clusters(F.lit(n)))[0] == want


@pytest.mark.parametrize("res, want", [(8, "8828308281fffff"), (6, "86283082fffffff"), (0, "8029fffffffffff")])
def test_parent(spark, res, want):
    cell = F.lit(int("8928308280fffff", 16))
    assert one(spark, geo.cell_hex(geo.parent(cell, res)))[0] == want


def test_lattice_nests_and_centres_lie_in_their_cell(spark):
    g = geo.Lattice()
    p = spark.range(500).select(((F.col("id") * 37) % 180 - 90 + 0.25).alias("lat"), ((F.col("id") * 91) % 360 - 180 + 0.5).alias("lng"))
    p = p.withColumn("c", g.cell(F.col("lat"), F.col("lng"), 6)).withColumn("up", g.cell(F.col("lat"), F.col("lng"), 3))
    p = p.withColumn("back", g.cell(g.lat(F.col("c"), 6), g.lng(F.col("c"), 6), 6))
    assert p.filter((geo.parent(F.col("c"), 3) != F.col("up")) | (F.col("back") != F.col("c")) | (geo.resolution("c") != 6)).count() == 0


def test_resolutions():
    assert geo.check_resolutions([3, 6, 3]) == [6, 3]
    for bad in ([16], [-1], []):
        with pytest.raises(ValueError):
            geo.check_resolutions(bad)
    with pytest.raises(ValueError):
        geo.check_resolutions([6], 6)


@pytest.mark.parametrize("state, want", [("US", None), ("US-", None), ("US-CA", "US-CA"), ("", None), (None, None)])
def test_valid_state(spark, state, want):
    assert one(spark, regions.valid_state(F.lit(state).cast("string")))[0] == want


def test_region_prefixes(spark):
    codes = spark.createDataFrame([("RU-MO",), ("RU-MOS",), ("ru-mo-x",), ("RU",)], "c string")
    strict = {r.c for r in codes.filter(regions.in_region(F.col("c"), F.lit("RU-MO"))).collect()}
    loose = {r.c for r in codes.filter(regions.in_region(F.col("c"), F.lit("RU-MO"), "loose")).collect()}
    assert strict == {"RU-MO", "ru-mo-x"} and loose == {"RU-MO", "RU-MOS", "ru-mo-x"}


def test_list_and_paths(spark):
    row = one(spark, regions.parse_list(F.lit(" us-ca, ,mx  ca,")), calendar.object_path(F.lit("http://h/"), F.lit("/a/"), F.lit(""), F.lit("b")))
    assert row[0] == ["US-CA", "MX", "CA"] and row[1] == "http://h/a/b"


def test_release_calendar(spark):
    f = lambda d: one(spark, calendar.release_month(F.lit(d)))[0]
    assert f(datetime.date(2024, 7, 14)) == datetime.date(2024, 5, 1)
    assert f(datetime.date(2024, 7, 15)) == datetime.date(2024, 6, 1)
    assert f(datetime.date(2024, 1, 31)) == datetime.date(2023, 12, 1)
    options = one(spark, calendar.month_options(F.lit(datetime.date(2024, 7, 15))))[0]
    assert [tuple(x) for x in options] == [("Current (Jun 2024)", "Jun", "2024"), ("Previous (May 2024)", "May", "2024")]


def test_formats():
    assert calendar.format_size(1536) == "1.5 KB" and [calendar.format_duration(x) for x in (3725, 65.4, 9.96)] == ["1h 2m", "1m 5s", "10.0s"] and calendar.format_size(1 << 50) == "1.0 PB"
    assert readers.parse_env("# x\nA=1\nexport B='two words'\n\nC=\"q\"\nbad\n") == {"A": "1", "B": "two words", "C": "q"}


def test_codec_goldens():
    assert codec.uvarint(300) == bytes.fromhex("AC02")
    assert codec.encode([], 6) == bytes.fromhex("483350310600")
    cell = (300, [5] + [0] * 11, [(7, [2] + [0] * 11)])
    assert codec.encode([cell], 6) == bytes.fromhex("48335031 06 01 AC02 0100 05 01 07 0100 02")
    with pytest.raises(ValueError):
        codec.uvarint(-1)
    with pytest.raises(ValueError):
        codec.decode(b"nope")


_year = st.lists(st.integers(0, 2**40), min_size=12, max_size=12)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 2**62), st.tuples(_year, st.dictionaries(st.integers(0, 2**31), _year, max_size=4)), max_size=4))
def test_codec_round_trip(cells):
    own = [(c, s, sorted(sp.items())) for c, (s, sp) in sorted(cells.items())]
    assert codec.decode(codec.encode(own, 9)) == (9, own)
