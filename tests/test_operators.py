"""The adversarial mini-dataset, and invariants."""

import datetime
import gzip
import json
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfield.functions import codec, geo
from tallyfield.operators import arrays, cluster, counts, dims, occurrences, packs, rollup, search
from tallyfield.sources import ingest, readers, schema, sinks, stored

JAN, FEB, MAR = (datetime.date(2024, m, 3) for m in (1, 2, 3))


def checklist(loc, day, event, group="", kind="H", country="US", state="US-CA", county="", lat=10.2, lng=20.2, name="n"):
    return (loc, name, kind, day, event, group, country, state, county, lat, lng)


CHECKLISTS = [
    checklist("A", JAN, "e1", "g1"), checklist("A", JAN, "e2", "g1"), checklist("A", JAN, "e3", None), checklist("A", JAN, "e4", "", name="z", lat=10.1, lng=20.3),
    checklist("A", FEB, "e5"), checklist("B", JAN, "e6", "g1"), checklist("B", JAN, "e7"), checklist("P", JAN, "e8", kind="P"),
    checklist("C", JAN, "e9", state="US-", county=""), checklist("D", JAN, "e10", state="US", county="US-CA-1"), checklist("E", JAN, "e11", country="", state="", county="", lat=-50.0, lng=-50.0),
    checklist("N", JAN, "e12", lat=None), checklist("T1", JAN, "e13", state="XX-B", lat=60.0, lng=60.0), checklist("T2", JAN, "e14", state="XX-A", lat=60.0, lng=60.0),
]
OBSERVATIONS = [("A", JAN, "e1", "g1", "robin"), ("A", JAN, "e2", "g1", "robin"), ("A", JAN, "e3", None, "robin"), ("A", MAR, "x", "", "robin"), ("B", JAN, "e6", "g1", "robin"), ("A", JAN, "e4", "", "yeti"), ("E", JAN, "e11", "", "robin"), ("P", JAN, "e8", "", "robin")]
SPECIES = [(1, "robin", "Rüppell's Robin", "rob", 1.0, "RORO"), (2, "wren", "Wren", "", 2.0, None)]


@pytest.fixture(scope="module")
def t(spark):
    c = spark.createDataFrame(CHECKLISTS, schema.CHECKLISTS)
    o = spark.createDataFrame(OBSERVATIONS, schema.OBSERVATIONS)
    s = spark.createDataFrame(SPECIES, schema.SPECIES)
    dim, samples = dims.location_dim(c), counts.samples(c)
    observed = counts.observed(o, s)
    return {"dim": dim, "samples": samples, "observed": observed, "matched": counts.matched(observed, samples), "species": s, "checklists": c, "observations": o}


def rows(df, *c):
    return sorted((tuple(r) for r in df.select(*c).collect()), key=str)


def test_samples_dedupe_groups(t):
    got = {(a, m): n for a, m, n in rows(t["samples"], "location_id", "month", "samples")}
    assert got["A", 1] == 3 and got["A", 2] == 1 and got["B", 1] == 2


def test_attributes_are_independent_maxima(t):
    a = t["dim"].filter("location_id = 'A'").first()
    assert (a["name"], a["lat"], a["lng"]) == ("z", 10.2, 20.3)


def test_region_rules(t):
    got = {r["location_id"]: (r["region_code"], r["grid_region"]) for r in t["dim"].collect()}
    assert got["C"] == ("US", "US") and got["D"] == ("US-CA-1", "US") and got["E"] == (None, None) and got["A"] == ("US-CA", "US-CA")


def test_unmatched_and_unknown(t):
    assert ("A", 3, 1, 1) not in rows(t["matched"], "location_id", "month", "species_id", "obs")
    assert ("A", 3, 1, 1) in rows(t["observed"], "location_id", "month", "species_id", "obs")
    assert {r[0] for r in rows(t["observed"], "species_id")} == {1}


def test_regions_sum_and_hold_personal_places(t):
    got = {(c, m): n for c, m, n in rows(counts.region_samples(t["samples"], t["dim"]), "region_code", "month", "samples")}
    assert got["US-CA", 1] == 3 + 2 + 1 + 1  # A, B (its group again), P, N
    assert "P" not in {r[0] for r in rows(counts.month_obs(t["matched"], t["dim"]), "location_id")}


def test_year_samples_hold_months_without_the_species(t):
    y = counts.year_obs(t["matched"], t["samples"], t["dim"]).filter("location_id = 'A'").first()
    assert (y["obs"], y["samples"]) == (2, 4)


def test_cells_winner_orphans_rollup(t):
    c = rollup.cells(t["observed"], t["samples"], t["dim"], 6, geo.Lattice())
    where = {r["location_id"]: r["cell"] for r in rollup.cell_dim(t["dim"], 6, geo.Lattice()).collect()}
    assert "N" not in where
    win = {r["cell"]: r["region_code"] for r in rollup.winners(c.regions).collect()}
    assert win[where["T1"]] == "XX-A"
    assert [r[0] for r in rollup.orphans(c).collect()] == [where["E"]]
    up = rollup.roll_up(c, 3)
    assert up.samples.agg(F.sum("samples")).first()[0] == c.samples.agg(F.sum("samples")).first()[0]
    cells = rollup.tables(c, geo.Lattice())["h3_cells"]
    refs = sorted(r["cell_ref"] for r in cells.collect())
    assert refs == list(range(1, len(refs) + 1))


def test_dense_ids(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 3).alias("g"))
    x = dims.dense_ids(df, "n", [F.col("id")], ("g",), start=0)
    for g in range(3):
        own = [r["n"] for r in x.filter(f"g = {g}").orderBy("id").collect()]
        assert own == list(range(len(own)))
    assert dims.dense_ids(df.limit(0), "n", [F.col("id")]).count() == 0


def test_dense_ids_of_ties_spread(spark):
    """A first column that never differs: the rows still lie in many tasks, and their source is read once."""
    df = spark.range(20_000).select(F.lit(7).alias("samples"), F.format_string("%05d", (F.col("id") * 7919) % 20_000).alias("place"))
    runs = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    x = dims.dense_ids(df.mapInArrow(seen, df.schema), "n", [F.desc("samples"), F.col("place")])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert runs.value == 20_000
    got = x.select("n", "place", F.spark_partition_id().alias("p")).collect()
    assert sorted((r.place, r.n) for r in got) == [(f"{i:05d}", i + 1) for i in range(20_000)]
    assert runs.value == 20_000 and spark.read.parquet(*{f.rsplit("/", 1)[0] for f in x.inputFiles()}).count() == 20_000
    assert len(x.inputFiles()) > 1


def test_qcount_and_lifers(spark):
    levels = spark.createDataFrame([(1, 0, 4), (2, 0, 1), (3, 1, 0), (4, 1, -1)], "species_id bigint, loc_ref bigint, bucket_level int")
    q = occurrences.qcount(levels, "loc_ref")
    assert rows(q, "bucket", "loc_ref", "q_count") == [(0, 0, 2), (0, 1, 1), (1, 0, 2), (2, 0, 1), (3, 0, 1), (4, 0, 1)]
    seen = spark.createDataFrame([("u", 1), ("u", 9)], schema.SEEN)
    assert rows(occurrences.lifers(levels, q, seen, 0), "loc_ref", "lifers") == [(0, 1), (1, 1)]


def test_floors(spark):
    y = spark.createDataFrame([("a", 1, 5, 24, 0.5), ("b", 1, 5, 25, 0.05), ("b", 2, 5, 25, 0.0499)], "location_id string, species_id bigint, obs bigint, samples bigint, score double")
    h = spark.createDataFrame([("a",), ("b",)], "id string").select("id", *[F.lit(None).cast("string").alias(c) for c in ("name", "country_code", "subnational1_code", "subnational2_code", "region_code")], F.lit(1.0).alias("lat"), F.lit(1.0).alias("lng"))
    meta = occurrences.loc_meta(y, h)
    assert rows(meta, "loc_ref", "location_id") == [(0, "b")]
    assert rows(occurrences.loc_species(y, meta), "species_id", "bucket_level") == [(1, 0)]


def test_pivots(t):
    got = arrays.target_months(counts.month_obs(t["matched"], t["dim"])).filter("location_id = 'A'").first()
    assert got["samples"] == [3] + [None] * 11 and got["species"][0]["obs"] == [2] + [0] * 11
    none = arrays.cell_months(t["observed"].filter("false"), t["samples"], "location_id").filter("location_id = 'B'").first()
    assert none["samples"] == [2] + [0] * 11 and none["species"] == []


def test_csr_and_blobs(spark):
    levels = spark.createDataFrame([(1, 0), (1, 5), (3, 2)], "species_id bigint, loc_ref bigint")
    offsets = arrays.csr_offsets(levels, spark.createDataFrame([(1,), (3,)], "id bigint"))
    assert rows(offsets, "species_id", "offset") == [(0, 0), (1, 0), (2, 2), (3, 2), (4, 3)]
    empty = arrays.csr_offsets(levels.filter("false"), spark.createDataFrame([], "id bigint"))
    assert empty.count() == 0
    v = spark.createDataFrame([("k", 1, 7, 0.0), ("k", 4, 3, 0.0), ("h", 0, 2**62 + 1, 0.0), ("f", 1, 0, 0.1)], "key string, at bigint, value bigint, real double")
    sizes = spark.createDataFrame([("k", "i4", 6), ("h", "i8", 1), ("f", "f4", 2), ("none", "u1", 0)], "key string, kind string, size bigint")
    got = {(r.key, r.part): bytes(r.data) for r in arrays.blobs(v, sizes, 4).collect()}
    want = {("k", 0): np.array([0, 7, 0, 0], "<i4"), ("k", 1): np.array([3, 0], "<i4"), ("h", 0): np.array([2**62 + 1], "<i8"), ("f", 0): np.array([0, 0.1], "<f4"), ("none", 0): np.zeros(0, "u1")}
    assert got == {k: x.tobytes() for k, x in want.items()}
    back = {(r.key, r["at"]): r.value for r in arrays.elements(arrays.blobs(v, sizes, 4), sizes, 4).collect()}
    assert back["k", 4] == 3 and back["h", 0] == 2**62 + 1 and len(back) == 9


def k_center(lat, lng, k, start=None):
    """A plain version of what the rounds find: indexes of up to k centres."""
    def km(a, b):
        p, q = np.radians(lat), np.radians(a)
        h = np.sin((q - p) / 2) ** 2 + np.cos(p) * np.cos(q) * np.sin(np.radians(b - lng) / 2) ** 2
        return 2 * geo.EARTH_KM * np.arctan2(np.sqrt(h), np.sqrt(np.maximum(0, 1 - h)))

    n = len(lat)
    if k >= n:
        return np.arange(n)
    chosen, near = [int(np.argmin(km(*start))) if start else 0], np.full(n, np.inf)
    while len(chosen) < k:
        near = np.minimum(near, km(lat[chosen[-1]], lng[chosen[-1]]))
        near[chosen] = -1.0
        chosen.append(int(np.argmax(near)))
    return np.array(chosen, np.int64)


def test_k_center():
    lat, lng = np.array([0.0, 0.0, 0.0, 10.0]), np.array([0.0, 1.0, 1.0, 0.0])
    assert k_center(lat, lng, 3, (0.0, 0.1)).tolist() == [0, 3, 1]
    # Without a start the first point is the first centre; with as many as there are points, all in their order.
    assert k_center(lat[::-1], lng[::-1], 2).tolist() == [0, 1]
    assert k_center(lat, lng, 9, (9.0, 0.1)).tolist() == [0, 1, 2, 3]
    # A duplicate may be a centre.
    assert k_center(np.zeros(4), np.zeros(4), 3).tolist() == [0, 1, 2]
    assert len(k_center(lat[:0], lng[:0], 3)) == 0


def test_clusters_of_all_regions_in_rounds(spark):
    """Regions with and without a start, of few points and of one place only; points without a place; more rounds than are kept."""
    rng = np.random.default_rng(3)
    points = [("few", str(i), float(i), 2.0, None, None) for i in range(3)] + [("one", str(i), 5.0, 6.0, None, None) for i in range(40)] + [("few", "x", None, 1.0, None, None), ("none", "y", None, None, 1.0, 1.0)]
    for region, n, start in (("start", 300, (10.0, 179.0)), ("free", 90, None)):
        points += [(region, f"{i:04d}", float(a), float(b), *(start or (None, None))) for i, (a, b) in enumerate(zip(rng.uniform(-80, 80, n), rng.uniform(-180, 180, n), strict=True))]
    df = spark.createDataFrame(points, "region string, id string, lat double, lng double, center_lat double, center_lng double").repartition(5)
    got = {r.region: r.clusters for r in cluster.clusters(df).collect()}
    assert set(got) == {"few", "one", "start", "free"}
    for region, found in got.items():
        own = sorted((p for p in points if p[0] == region and p[2] is not None), key=lambda p: p[1])
        lat, lng = np.array([p[2] for p in own]), np.array([p[3] for p in own])
        k = max(3, min(30, int(np.ceil(1.5 * np.log2(len(own))))))
        at = k_center(lat, lng, k, own[0][4:] if own[0][4] is not None else None)
        assert found == [[float(np.rint(lat[i] * 1000) / 1000), float(np.rint(lng[i] * 1000) / 1000)] for i in at], region
    assert cluster.clusters(df.filter("false").drop("center_lat", "center_lng")).count() == 0


def test_packs_in_pieces(spark, tmp_path):
    """A pack of many pieces is the same as one of one piece: as text, as files written by several tasks, and as binary members."""
    hot = spark.createDataFrame([(r, f"h{i:03d}", "Wëst \"x\"", "US", None, None, 1.5, 2.5, 3, "US", None, None) for r, n in (("A", 23), ("B", 1)) for i in range(n)], "region string, id string, name string, country_code string, subnational1_code string, subnational2_code string, lat double, lng double, species bigint, country_name string, state_name string, county_name string")
    targets = spark.createDataFrame([(r, f"t{i}", [None] * 11 + [i], [("c", [i] * 12)] if i else []) for r in ("A", "X") for i in range(9)], "region string, location_id string, samples array<bigint>, species array<struct<code: string, obs: array<bigint>>>")
    cells = targets.select("region", F.col("location_id").alias("id"), F.lit(1.5).alias("lat"), F.lit(-0.25).alias("lng"), "samples", "species")
    whole = {r.region: r.document for r in packs.documents("t", hot, targets, cells, 6).collect()}
    assert set(whole) == {"A", "B"} and json.loads(whole["B"]) == {"v": 1, "updatedAt": "t", "hotspots": json.loads(whole["A"])["hotspots"][:1], "targets": [], "h3res": 6, "cells": []}
    a = json.loads(whole["A"])
    assert [len(a[k]) for k in ("hotspots", "targets", "cells")] == [23, 9, 9] and a["targets"][3]["species"] == [["c", *[3] * 12]] and "\n" not in whole["A"]
    for n in (1, 4, 5, 23, 46):
        got = packs.documents("t", hot, targets, cells, 6, n).collect()
        assert sorted(r.piece for r in got if r.region == "A") == list(range(-(-45 // n)))
        assert {x: "".join(r.document for r in sorted(got, key=lambda r: r.piece) if r.region == x) for x in whole} == whole
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sinks.write_documents(packs.documents("t", hot, targets, cells, 6, 3).withColumnRenamed("region", "name"), str(tmp_path / "d"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted((tmp_path / "d" / "name=A").glob("*.gz"))
    assert len(files) > 1 and json.loads(gzip.decompress(b"".join(f.read_bytes() for f in files))) == a

    grid = spark.createDataFrame([(6, i, 1000 + i * i, "A" if i < 30 else "B-C", 0.0, 0.0) for i in range(31)], "res int, cell_ref bigint, h3 bigint, region_code string, lat double, lng double")
    obs = spark.createDataFrame([(6, i, m, s, i + m) for i in range(0, 31, 2) for m in (1, 12) for s in (2, 300)], "res int, cell_ref bigint, month bigint, species_id bigint, obs bigint")
    samples = spark.createDataFrame([(6, i, 3, 5) for i in range(31)], "res int, cell_ref bigint, month bigint, samples bigint")
    regions_ = spark.createDataFrame([("A",), ("B",)], "region string")
    want = None
    for n in (1, 7, 30, 256):
        pieces = packs.binary_packs(grid, obs, samples, regions_, 6, n)
        got = {r.region: sorted((x.piece, bytes(x.data)) for x in pieces.collect() if x.region == r.region) for r in regions_.collect()}
        assert len(got["A"]) == -(-30 // n) and len(got["B"]) == 1
        # Members in a row are one gzip file.
        res, found = codec.decode(gzip.decompress(b"".join(d for _, d in got["A"])))
        assert res == 6 and [c for c, _, _ in found] == [1000 + i * i for i in range(30)]
        back = sorted((r.region, r.h3, r.samples, [(s.species_id, s.obs) for s in r.species]) for r in packs.unpacked(pieces).collect())
        assert [(h, s, o) for x, h, s, o in back if x == "A"] == found
        want = want or back
        assert back == want


def test_search(spark, t):
    fts = search.index(t["species"])
    find = lambda q: [r[0] for r in search.search(fts, q).collect()]
    assert find("RUPP rob") == [1] and find("ror") == [1] and find("zz") == [] and find(" ") == []


def test_packs(spark, t):
    finest = dims.finest_regions(spark.createDataFrame([("US",), ("US-CA",), ("US-C",), ("MX",)], "region string"))
    assert rows(finest, "region") == [("MX",), ("US-C",), ("US-CA",)]
    hot = dims.hotspots(t["dim"])
    got = packs.pack_targets(finest.filter("region = 'US-CA'"), hot, counts.month_obs(t["matched"], t["dim"]), t["species"])
    assert {r["location_id"]: [s["code"] for s in r["species"]] for r in got.collect()} == {"A": ["rob"], "B": ["rob"]}
    with pytest.raises(ValueError):
        packs.allowed(finest, ["ZZ"])
    text = got.filter("location_id = 'A'").select(packs.target_json()).first()[0]
    assert text == '{"id":"A","samples":[3,null,null,null,null,null,null,null,null,null,null,null],"species":[["rob",2,0,0,0,0,0,0,0,0,0,0,0]]}'


def test_ingest(spark, tmp_path):
    names = [*schema.OBSERVATION_COLUMNS, schema.COMPLETE, schema.CATEGORY]
    lines = ["\t".join(names), "A\t2024-01-03\te1\t\trobin \"x\t1\tspecies", "A\tbad\te2\t\trobin\t1\tissf", "short\trow", "A\t2024-01-03\te3\t\trobin\t0\tspecies", "A\t2024-01-03\te4\t\trobin\t1\tspuh"]
    (tmp_path / "o.tsv").write_text("\n".join(lines) + "\n")
    got = ingest.observations(readers.read_tsv(spark, str(tmp_path / "o.tsv")))
    assert rows(got, "event_id", "observed_on", "sci_name") == [("e1", JAN, 'robin "x'), ("e2", None, "robin")]
    with pytest.raises(readers.MissingColumn):
        ingest.observations(spark.createDataFrame([("x",)], "a string"))


def test_taxonomy_and_tables(spark, tmp_path, t):
    (tmp_path / "t.json").write_text('[{"sciName":"a","comName":"A","speciesCode":"x","taxonOrder":1.0,"bandingCodes":["B1"],"comNameCodes":["C1"]},{"sciName":"b","comName":"B","speciesCode":"y","taxonOrder":2}]')
    got = readers.read_taxonomy(spark, str(tmp_path / "t.json"))
    assert rows(got, "id", "sci_name", "search_codes") == [(1, "a", "B1 C1"), (2, "b", None)]
    sinks.write_table(counts.month_obs(t["matched"], t["dim"]), str(tmp_path), "month_obs")
    back = readers.read_table(spark, str(tmp_path), "month_obs")
    assert back.count() == counts.month_obs(t["matched"], t["dim"]).count() and sinks.violations(back, "month_obs").count() == 0


def test_invariant_under_partitioning(spark, t):
    want = rows(counts.month_obs(t["matched"], t["dim"]), "*")
    c, o = t["checklists"].repartition(7), t["observations"].repartition(5)
    again = counts.month_obs(counts.matched(counts.observed(o, t["species"]), counts.samples(c)), dims.location_dim(c))
    assert rows(again, "*") == want
    assert all(0 <= r[-1] < 1 and r[3] <= r[4] for r in want)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_observed_shuffles_rows_once(spark, t):
    """Distinct rows, counts and the join with samples use one dealing of the rows; its tasks aren't merged by compressed size."""
    text = plan(counts.observed(t["observations"], t["species"]))
    assert text.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_NUM" in text
    assert rows(t["observed"].filter("location_id = 'A' and month = 1"), "obs") == [(2,)]


def test_months_of_repeated_rows(spark):
    """Twelve numbers of fixed width: a month that occurs twice has its largest value, as in SQL."""
    df = spark.createDataFrame([("A", 1, 1, 2, 9), ("A", 1, 1, 3, 9), ("A", 12, 1, 5, 7)], "location_id string, month bigint, species_id bigint, obs bigint, samples bigint")
    got = arrays.target_months(df).first()
    assert got["samples"] == [9] + [None] * 10 + [7] and got["species"][0]["obs"] == [3] + [0] * 10 + [5]
    assert "collect_list(struct(cast(month" not in plan(arrays.target_months(df))


def test_rows_are_dealt_by_the_size_of_what_is_read(spark, tmp_path, monkeypatch):
    """A task for so many bytes of files, whatever the session shuffles into; folders with odd names, and another table beside."""
    big, small = str(tmp_path / "a b%20ü"), str(tmp_path / "k=1")
    spark.range(20000).select(F.col("id").cast("string").alias("location_id"), (F.col("id") % 12).alias("month"), F.lit(1).cast("bigint").alias("species_id"), F.lit(1).cast("bigint").alias("obs")).repartition(3).write.parquet(big)
    spark.range(5).select(F.col("id").cast("string").alias("location_id")).write.parquet(small)
    size = sum(p.stat().st_size for p in (tmp_path / "a b%20ü").glob("*.parquet"))
    x, y = spark.read.parquet(big), spark.read.parquet(small)
    assert stored.input_bytes(x) == stored.input_bytes(x.union(x).groupBy("month").count()) == size > 0 == stored.input_bytes(spark.range(3))
    monkeypatch.setattr(dims, "TASK_BYTES", size // 10)
    n = -(-size // (size // 10))
    assert n > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert dims.dealt(x, "location_id").rdd.getNumPartitions() == dims.dealt(y, "location_id", beside=x).rdd.getNumPartitions() == n
    assert dims.dealt(y, "location_id").rdd.getNumPartitions() == max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-stored.input_bytes(y) // dims.TASK_BYTES))
    samples = x.select("location_id", "month", F.lit(2).cast("bigint").alias("samples"))
    dim = x.select("location_id", F.lit("H").alias("locality_type")).distinct()
    plan = counts.year_obs(x, samples, dim)._jdf.queryExecution().executedPlan().toString()
    assert re.search(rf"hashpartitioning\(location_id#\d+, {n}\), REPARTITION_BY_NUM", plan)


def test_attributes_are_made_distinct_before_their_maxima(spark, t):
    """A maximum of strings sorts its rows, so it must not be given every checklist."""
    plan = dims.location_dim(t["checklists"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 2
    found = {r.location_id: (r["name"], r.lat) for r in dims.location_dim(t["checklists"]).collect()}
    assert found["A"] == ("z", 10.2) and found["N"] == ("n", None)
