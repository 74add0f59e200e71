"""Threshold buckets of hotspots and of coarser zones, and how many species each holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.score import BUCKETS, LOC_SAMPLES, LOC_SCORE, ZONE_RATIO, ZONE_SAMPLES, bucket_level
from .dims import dense_ids


def location_totals(year_obs: DataFrame, least: int = LOC_SAMPLES) -> DataFrame:
    """location_id, samples of locations with enough checklists; one without any species never appears."""
    return year_obs.groupBy("location_id").agg(F.max("samples").alias("samples")).filter(F.col("samples") >= least)


def loc_meta(year_obs: DataFrame, hotspots: DataFrame, least: int = LOC_SAMPLES) -> DataFrame:
    """Hotspots with a reference from 0, most samples first, ties by id."""
    own = hotspots.withColumnRenamed("id", "location_id").join(location_totals(year_obs, least), "location_id")
    return dense_ids(own, "loc_ref", [F.desc("samples"), F.col("location_id")], start=0).select(
        "loc_ref", "location_id", "name", "lat", "lng", "country_code", "subnational1_code", "subnational2_code", "region_code", "samples"
    )


def loc_species(year_obs: DataFrame, meta: DataFrame, least: float = LOC_SCORE, thresholds: tuple = BUCKETS) -> DataFrame:
    """species_id, loc_ref, bucket_level: by the Wilson score."""
    own = year_obs.filter(F.col("score") >= least).select("location_id", "species_id", "score")
    return own.join(meta.select("location_id", "loc_ref"), "location_id").select("species_id", "loc_ref", bucket_level(F.col("score"), thresholds).alias("bucket_level"))


def qcount(levels: DataFrame, *keys: str) -> DataFrame:
    """bucket, keys, q_count: species of that level or higher. One pass: a row stands in every bucket up to its own."""
    each = levels.filter("bucket_level >= 0").withColumn("bucket", F.explode(F.sequence(F.lit(0), F.col("bucket_level"))))
    return each.groupBy("bucket", *keys).agg(F.count("*").alias("q_count"))


def zone_meta(h3_cells: DataFrame, h3_cell_samples: DataFrame, resolutions: list[int], source_res: int, grid: geo.Grid, least: int = ZONE_SAMPLES) -> DataFrame:
    """res, cell_ref (from 0, by cell), h3, lat, lng (of the zone's centre), samples of zones with enough."""
    child = _child_samples(h3_cells, h3_cell_samples, source_res)
    ups = F.array(*[F.struct(F.lit(r).alias("res"), geo.parent(F.col("h3"), r).alias("h3")) for r in geo.check_resolutions(resolutions, source_res)])
    zone = child.select(F.explode(ups).alias("z"), "samples").groupBy("z.res", "z.h3").agg(F.sum("samples").alias("samples")).filter(F.col("samples") >= least)
    own = dense_ids(zone, "cell_ref", [F.col("h3")], ("res",), start=0)
    lat, lng = (F.coalesce(*[F.when(F.col("res") == r, f(F.col("h3"), r)) for r in set(resolutions)]) for f in (grid.lat, grid.lng))
    return own.select("res", "cell_ref", "h3", lat.alias("lat"), lng.alias("lng"), "samples")


def _child_samples(h3_cells: DataFrame, h3_cell_samples: DataFrame, source_res: int) -> DataFrame:
    """Months pooled before anything is rolled up."""
    year = h3_cell_samples.filter(F.col("res") == source_res).groupBy("cell_ref").agg(F.sum("samples").alias("samples"))
    return h3_cells.filter(F.col("res") == source_res).select("cell_ref", "h3").join(year, "cell_ref")


def child_zone(h3_cells: DataFrame, zones: DataFrame, resolutions: list[int], source_res: int) -> DataFrame:
    """child_ref, res, cell_ref, samples: the zones of each source cell; those below the floor are left out."""
    child = h3_cells.filter(F.col("res") == source_res).select(F.col("cell_ref").alias("child_ref"), F.col("h3").alias("child"))
    up = F.array(*[F.struct(F.lit(r).alias("res"), geo.parent(F.col("child"), r).alias("h3")) for r in geo.check_resolutions(resolutions, source_res)])
    return child.withColumn("z", F.explode(up)).select("child_ref", "z.res", "z.h3").join(zones.select("res", "h3", "cell_ref", "samples"), ["res", "h3"]).select("child_ref", "res", "cell_ref", "samples")


def zone_species(h3_cell_obs: DataFrame, children: DataFrame, source_res: int, least: float = ZONE_RATIO, thresholds: tuple = BUCKETS) -> DataFrame:
    """res, species_id, cell_ref, bucket_level: by the plain ratio; ratios from the floor up to the first threshold count as bucket 0."""
    year = h3_cell_obs.filter(F.col("res") == source_res).groupBy(F.col("cell_ref").alias("child_ref"), "species_id").agg(F.sum("obs").alias("obs"))
    zone = year.join(children, "child_ref").groupBy("res", "cell_ref", "species_id", "samples").agg(F.sum("obs").alias("obs"))
    ratio = F.col("obs").cast("double") / F.col("samples").cast("double")
    return zone.filter(ratio >= least).select("res", "species_id", "cell_ref", F.greatest(F.lit(0), bucket_level(ratio, thresholds)).alias("bucket_level"))


def loc_zone_h3(meta: DataFrame, resolutions: list[int], grid: geo.Grid) -> DataFrame:
    """res, loc_ref, h3 of each located hotspot."""
    located = meta.filter("lat is not null and lng is not null")
    out = None
    for res in geo.check_resolutions(resolutions):
        own = located.select(F.lit(res).alias("res"), "loc_ref", grid.cell(F.col("lat"), F.col("lng"), res).alias("h3"))
        out = own if out is None else out.unionByName(own)
    return out


def loc_cell_ref(meta: DataFrame, zone_of: DataFrame, zones: DataFrame) -> DataFrame:
    """res, loc_ref, cell_ref for every hotspot and resolution; -1 where the zone is below the floor, or there is none."""
    which = zone_of.select("res").distinct().withColumn("k", F.lit(1))  # at most 16 resolutions
    every = meta.select("loc_ref").withColumn("k", F.lit(1)).join(F.broadcast(which), "k").drop("k")
    there = every.join(zone_of, ["res", "loc_ref"], "left").join(zones.select("res", "h3", "cell_ref"), ["res", "h3"], "left")
    return there.select("res", "loc_ref", F.coalesce("cell_ref", F.lit(-1)).cast("bigint").alias("cell_ref"))


def lifers(levels: DataFrame, counts: DataFrame, seen: DataFrame, bucket: int) -> DataFrame:
    """user_id, loc_ref, lifers: species of the bucket or higher that the user hasn't seen. Places where all are seen have 0."""
    q = counts.filter(F.col("bucket") == bucket).select("loc_ref", "q_count")
    known = levels.filter(F.col("bucket_level") >= bucket).join(seen.distinct(), "species_id").groupBy("user_id", "loc_ref").agg(F.count("*").alias("seen"))
    # Every user meets every place: users are copied to as many parts as there are tasks, places dealt to them.
    parts = int(levels.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    users = seen.select("user_id").distinct().withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    every = q.withColumn("part", F.pmod(F.xxhash64("loc_ref"), F.lit(parts)).cast("int")).join(users, "part").drop("part")
    return every.join(known, ["user_id", "loc_ref"], "left").select("user_id", "loc_ref", (F.col("q_count") - F.coalesce("seen", F.lit(0))).alias("lifers"))
