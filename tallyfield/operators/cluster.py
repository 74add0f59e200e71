"""Greedy farthest-point (k-center) clustering of the points of all regions at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..sources import stored
from . import dims

#: Rounds between two writes of the points' distances.
KEPT = 8


def _km(c: Column) -> Column:
    return geo.haversine_km(F.col("lat"), F.col("lng"), c["lat"], c["lng"])


def _nearest() -> Column:
    """The distance to the nearest centre: that kept, or to one of those since."""
    return F.least("near", F.array_min(F.transform("fresh", _km)))


def clusters(points: DataFrame, most: int = 30) -> DataFrame:
    """(region, id, lat, lng[, center_lat, center_lng]) -> region, clusters: array of (lat, lng), rounded, in the order they were found.

    Points are in order of id. The first centre is the point nearest to the region's start, without one the first point; each
    further one is the farthest from those so far among the rest, a duplicate too; ties go to the lowest point. Where
    as many are wanted as there are points, they are all points in their order. Points without a place aren't counted, and
    a region without points has no row.

    Each round finds one more centre in every region that wants one, by an aggregate that begins before the shuffle, so a
    region's points are never in one task; at most most rounds. What a round adds is a row for each region.
    """
    spark = points.sparkSession
    start = [F.col(c) if c in points.columns else F.lit(None).cast("double").alias(c) for c in ("center_lat", "center_lng")]
    own = points.filter("lat is not null and lng is not null").select("region", "id", "lat", "lng", *start)
    x = dims.dense_ids(own, "place", [F.col(c) for c in ("id", "lat", "lng")], within=("region",), start=0)
    begun = F.coalesce(geo.haversine_km(F.col("lat"), F.col("lng"), F.col("center_lat"), F.col("center_lng")), F.lit(0.0))
    x = stored.store(spark, x.select("region", "place", "lat", "lng", begun.alias("begun"), F.lit(float("inf")).alias("near")), "points")
    at = F.struct("place", "lat", "lng")
    sizes = x.groupBy("region").agg(F.count("*").alias("n"), F.min(F.struct("begun", "place", "lat", "lng")).alias("first"))
    sizes = sizes.withColumn("k", F.least("n", geo.desired_clusters(F.col("n"), high=most)))
    one = F.array(F.struct("first.place", "first.lat", "first.lng"))
    found = stored.store(spark, sizes.select("region", "n", "k", one.alias("centers"), one.alias("fresh")), "centers")
    whole = x.join(found.filter("k >= n").select("region"), "region", "left_semi").groupBy("region").agg(F.sort_array(F.collect_list(at)).alias("centers"))  # of at most most points
    rounds = found.filter("k < n").agg(F.max("k")).first()[0] or 0
    found = found.filter("k < n")
    for done in range(1, rounds):
        # The names of what is joined are the same in each round: only the centres change.
        rest = x.join(found.filter(F.size("centers") < F.col("k")).select("region", "centers", "fresh"), "region").withColumn("near", _nearest())
        if done % KEPT == 0:
            x = stored.store(spark, rest.select("region", "place", "lat", "lng", "near"), "points")
            found = found.withColumn("fresh", F.slice("fresh", 1, 0))
            rest = x.join(found.select("region", "centers"), "region")
        free = rest.filter(~F.array_contains(F.col("centers.place"), F.col("place")))
        far = free.groupBy("region").agg(F.max(F.struct("near", (-F.col("place")).alias("less"), "place", "lat", "lng")).alias("far"))
        new = F.when(F.col("far").isNotNull(), F.array(F.struct("far.place", "far.lat", "far.lng"))).otherwise(F.slice("centers", 1, 0))
        both = found.join(far, "region", "left")
        found = stored.store(spark, both.select("region", "n", "k", F.concat("centers", new).alias("centers"), F.concat("fresh", new).alias("fresh")), "centers")
    out = found.select("region", "centers").unionByName(whole)
    return out.select("region", F.transform("centers", lambda c: F.array(geo.round3(c["lat"]), geo.round3(c["lng"]))).alias("clusters"))
