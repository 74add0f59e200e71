"""Whole builds over the mini-dataset, sources and sinks, and the streaming extension."""

import datetime
import json
import sqlite3

import pytest
from pyspark.sql import functions as F

from tallyfield.operators import consumer
from tallyfield.plans import pipeline
from tallyfield.sources import readers, schema, sinks
from tallyfield.streaming import incremental

from .test_operators import CHECKLISTS, OBSERVATIONS, SPECIES


def many(n=30):
    """The mini-dataset, and a place with enough checklists for the floors."""
    day = datetime.date(2024, 5, 1)
    more = [("Z", "Zed", "H", day, f"z{i}", "", "US", "US-CA", "", 10.2, 20.2) for i in range(n)]
    seen = [("Z", day, f"z{i}", "", "robin") for i in range(n // 2)]
    return CHECKLISTS + more, OBSERVATIONS + seen


def test_builds(spark, tmp_path):
    c, o = many()
    c, o, s = spark.createDataFrame(c, schema.CHECKLISTS), spark.createDataFrame(o, schema.OBSERVATIONS), spark.createDataFrame(SPECIES, schema.SPECIES)
    src, out = f"{tmp_path}/targets", f"{tmp_path}/occurrences"
    pipeline.build_targets(spark, c, o, s, src, "2024", "May")
    pipeline.build_grid(spark, c, o, s, src, "may-2024", [6, 4])
    for name in ("month_obs", "year_obs", "hotspots", "h3_cells", "h3_cell_obs"):
        assert sinks.violations(readers.read_table(spark, src, name), name).count() == 0
    pipeline.build_occurrences(spark, src, out, "2024", "May", (3,))
    meta = readers.read_table(spark, out, "loc_meta").collect()
    assert [(r.loc_ref, r.location_id, r.samples) for r in meta] == [(0, "Z", 30)]
    blobs = {r.key: bytes(r.data) for r in readers.read_table(spark, out, "blob_cache").collect()}
    columns = "samples lat lng qcount spOff csrRef csrLvl".split()
    assert set(blobs) == {f"loc:{c}" for c in columns} | {"loc:cellRef:3"} | {f"zone:3:{c}" for c in [*columns, "h3"]}
    assert blobs["loc:samples"] == (30).to_bytes(4, "little") and len(blobs["zone:3:h3"]) % 8 == 0
    assert spark.read.parquet(f"{out}/metadata").first()["buckets"] == "[0.05,0.1,0.2,0.3,0.5]"

    packs = spark.createDataFrame([(1, "US-CA", None, None, "California", None), (2, "MX", None, None, "Mexico", None)], schema.PACKS)
    api = spark.createDataFrame([("US-CA", "Z", "Zed", "US", "US-CA", None, 10.2, 20.2, 3)], "region string, id string, name string, country_code string, subnational1_code string, subnational2_code string, lat double, lng double, species bigint")
    names = spark.createDataFrame([("US-CA", "California")], "code string, name string")
    pipeline.build_packs(spark, src, f"{tmp_path}/packs", packs, api, names, "may-2024", "http://h/", res=6, updated_at="t")
    rows = spark.read.text(f"{tmp_path}/packs/may-2024").collect()
    doc = json.loads(rows[0].value)
    assert [r.name for r in rows] == ["US-CA"] and doc["hotspots"][0]["countryName"] == "US" and "stateName" in doc["hotspots"][0]
    target = next(x for x in doc["targets"] if x["id"] == "Z")
    assert target["samples"][4] == 30 and target["species"] == [["rob", 0, 0, 0, 0, 15, 0, 0, 0, 0, 0, 0, 0]]
    assert doc["h3res"] == 6 and doc["cells"][0]["species"][0][0] == "rob"
    index = json.loads(spark.read.text(f"{tmp_path}/packs/index").first().value)
    assert index["packs"][0]["url"] == "http://h/may-2024/US-CA.json.gz" and index["packs"][0]["clusters"] == [[10.2, 20.2]]


def test_documents_sources(spark, tmp_path):
    (tmp_path / "h.json").write_text('[{"locId":"L1","locName":" Park ","lat":1.5,"lng":2.5,"countryCode":"US","subnational1Code":""},{"locId":"L2","lat":1,"lng":2,"numSpeciesAllTime":4}]')
    got = {r.id: r for r in readers.read_api_hotspots(spark, str(tmp_path / "h.json")).collect()}
    assert got["L1"].name == "Park" and got["L1"].subnational1_code is None and got["L1"].species == 0 and got["L2"].name == "" and got["L2"].species == 4
    (tmp_path / "n.json").write_text('{"US":"United States"}')
    assert [tuple(r) for r in readers.read_region_names(spark, str(tmp_path / "n.json")).collect()] == [("US", "United States")]
    db = sqlite3.connect(tmp_path / "x.db")
    db.execute("CREATE TABLE species (id INTEGER, name TEXT, score REAL)")
    db.execute("INSERT INTO species VALUES (1, 'a', 0.5), (2, NULL, NULL)")
    db.commit()
    db.close()
    assert readers.sqlite_tables(str(tmp_path / "x.db")) == ["species"]
    assert [tuple(r) for r in readers.read_sqlite(spark, str(tmp_path / "x.db"), "species").orderBy("id").collect()] == [(1, "a", 0.5), (2, None, None)]
    assert not sinks.pass_through(spark, str(tmp_path), str(tmp_path / "o"), "citation_metadata")


def test_stream_of_checklists(spark, tmp_path):
    rows = [("A", "e1", "g", datetime.datetime(2024, 1, 1)), ("A", "e2", "g", datetime.datetime(2024, 1, 1)), ("A", "e3", "", datetime.datetime(2024, 1, 2)), ("B", "e4", None, datetime.datetime(2024, 2, 2))]
    kinds = "location_id string, event_id string, group_id string, seen_at timestamp"
    spark.createDataFrame(rows, kinds).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(kinds).parquet(f"{tmp_path}/in")
    incremental.merge_into(incremental.monthly_samples(stream), f"{tmp_path}/out", f"{tmp_path}/check", ["location_id", "month"], "samples").awaitTermination(120)
    last = sorted(tmp_path.glob("out/v*"), key=lambda p: int(p.name[1:]))[-1]
    got = {(r.location_id, r.month): r.samples for r in spark.read.parquet(str(last)).collect()}
    assert got == {("A", 1): 2, ("B", 2): 1}


def test_a_repeated_key_fails_the_write(spark, tmp_path):
    """The table that was there stays, nothing half-written is left, and the check needs no shuffle of its own."""
    rows = [("A", 1, 1, 2, 3, 0.5), ("A", 2, 1, 2, 3, 0.4), ("B", 1, 1, 2, 3, 0.3)]
    kind = "location_id string, month bigint, species_id bigint, obs bigint, samples bigint, score double"
    good = spark.createDataFrame(rows, kind)
    sinks.write_table(good, str(tmp_path), "month_obs")
    for more in (("B", 1, 1, 9, 9, 0.1), (None, 1, 1, 9, 9, 0.1)):
        with pytest.raises(Exception, match="null or repeated key"):
            sinks.write_table(good.union(spark.createDataFrame([more], kind)), str(tmp_path), "month_obs")
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "month_obs")).select("location_id", "month").collect())) == [("A", 1), ("A", 2), ("B", 1)]
    assert [p.name for p in tmp_path.iterdir()] == ["month_obs"]
    key = schema.TABLES["month_obs"][1]
    plan = sinks.unique(good.repartitionByRange(*key).sortWithinPartitions(*key), "month_obs")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Window" in plan


def test_ranked_table_reads_one_bucket(spark, tmp_path):
    """A species with most rows is written by many tasks; a question reads its bucket, and of all species at once each task keeps k rows."""
    obs = spark.range(20_000).select(F.col("id").cast("string").alias("location_id"), F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 50).alias("species_id"), (F.pmod(F.xxhash64("id"), F.lit(997)) / 997.0).alias("score"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sinks.write_ranked(obs, "ranked_test", str(tmp_path / "r"), buckets=16)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    table = spark.table("ranked_test")
    got = consumer.best_ranked(table, 7, 10)
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in consumer.best_locations(obs, 7, 10).collect()]
    assert "TakeOrdered" in got._jdf.queryExecution().executedPlan().toString()
    own = {r.f.rsplit("/", 1)[1] for r in table.filter("species_id = 7").select(F.input_file_name().alias("f")).distinct().collect()}
    assert len(own) > 1
    best = consumer.best_of_each(table.drop("less"), 3)
    assert "WindowGroupLimit" in best._jdf.queryExecution().executedPlan().toString()
    assert best.filter("species_id = 7").count() == 3 and best.groupBy("species_id").count().filter("count > 3").count() == 0
    # Files of the other buckets can't be read any more.
    (bucket,) = {f.split("_")[-1].split(".")[0] for f in own}
    others = [f for f in (tmp_path / "r").glob("*.parquet") if f"_{bucket}." not in f.name]
    for f in others:
        f.write_bytes(b"x" * f.stat().st_size)
    assert len(others) > 10 and consumer.best_ranked(spark.table("ranked_test"), 7, 10).count() == 10
    with pytest.raises(Exception):
        spark.table("ranked_test").agg(F.sum("score")).collect()
    spark.sql("DROP TABLE ranked_test")


def test_a_stream_goes_on_where_a_table_stands(spark, tmp_path):
    """A second query adds to the table of the first; a restart goes on; a lost version is an error."""
    kind = "place string, samples bigint"

    def feed(name, rows):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(str(tmp_path / name))

    def run(name):
        stream = spark.readStream.schema(kind).parquet(str(tmp_path / name)).groupBy("place").agg(F.sum("samples").alias("samples"))
        incremental.merge_into(stream, str(tmp_path / "t"), str(tmp_path / f"{name}-checkpoint"), ["place"], "samples").awaitTermination()

    def table():
        newest = max((p for p in (tmp_path / "t").iterdir() if p.name.startswith("v")), key=lambda p: int(p.name[1:]))
        return {r.place: r.samples for r in spark.read.parquet(str(newest)).collect()}

    feed("one", [("A", 1), ("B", 2)])
    run("one")
    feed("one", [("A", 5)])
    run("one")
    assert table() == {"A": 6, "B": 2}
    feed("two", [("B", 10), ("C", 3)])
    run("two")
    assert table() == {"A": 6, "B": 12, "C": 3}
    feed("two", [("B", 1)])
    run("two")
    assert table() == {"A": 6, "B": 13, "C": 3}
    newest = max((tmp_path / "t").iterdir(), key=lambda p: p.name)
    newest.rename(tmp_path / "lost")
    feed("two", [("B", 1)])
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        run("two")
