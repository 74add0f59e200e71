"""Dimensions: locations, regions, dense identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import regions as R
from ..sources import stored


#: Bytes of a table's files for which rows are dealt to one more task.
TASK_BYTES = 4 << 20


def dealt(df: DataFrame, *keys: str, beside: DataFrame | None = None) -> DataFrame:
    """Rows dealt by keys over a task for every TASK_BYTES of what df reads, so that what a task holds doesn't grow with the table,
    and over no fewer than the session shuffles into. The number is given, so that it isn't reduced by what rows take
    compressed: equal columns compress to a tenth, and a task holds them at full width.

    beside: the larger table that df is joined with, whose number df takes. Where Spark doesn't broadcast df, it deals the larger one alike.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-stored.input_bytes(df if beside is None else beside) // TASK_BYTES)), *keys)


def location_dim(checklists: DataFrame) -> DataFrame:
    """One row a location. Each attribute is the maximum of its own column, so they may come from different rows.

    Checklists repeat their location's attributes: distinct rows come first, by hash and mostly before the shuffle, since
    a maximum of strings sorts what it is given. They are counted, and the count is asked for, as Spark leaves plain distinct
    rows out below maxima.
    """
    own = ("locality", "locality_type", "country_code", "state_code", "county_code", "lat", "lng")
    # A cell needs both coordinates of a row.
    both = F.col("lat").isNotNull() & F.col("lng").isNotNull()
    rows = checklists.groupBy("location_id", *own).agg(F.count("*").alias("rows")).filter("rows > 0")
    m = rows.groupBy("location_id").agg(*[F.max(c).alias(c) for c in own], F.max(F.when(both, F.col("lat"))).alias("cell_lat"), F.max(F.when(both, F.col("lng"))).alias("cell_lng"))
    country, state, county = (F.col(c) for c in ("country_code", "state_code", "county_code"))
    return m.select(
        "location_id",
        F.col("locality").alias("name"),
        "locality_type",
        R.filled(country).alias("country_code"),
        R.valid_state(state).alias("subnational1_code"),
        R.filled(county).alias("subnational2_code"),
        R.leaf_region(country, state, county).alias("region_code"),
        R.grid_region(country, state).alias("grid_region"),
        "lat",
        "lng",
        "cell_lat",
        "cell_lng",
    )


def is_hotspot() -> Column:
    return F.col("locality_type") == "H"


def hotspots(dim: DataFrame) -> DataFrame:
    return dim.filter(is_hotspot()).select(F.col("location_id").alias("id"), "name", "country_code", "subnational1_code", "subnational2_code", "region_code", "lat", "lng")


def dense_ids(df: DataFrame, name: str, order: list[Column], within: tuple[str, ...] = (), start: int = 1) -> DataFrame:
    """Number the rows 0.. or 1.. in an order, for each group of within. Rows that tie in the whole order are numbered in any way.

    The rows are ranged over the tasks by the whole order, so many rows that agree in its first columns spread, too, and
    stored with their place in their task. Then one count for each task (and group) gives what is added. df is
    computed once, and what is returned reads stored rows.
    """
    spark, bits = df.sparkSession, 33
    keys = [F.col(c) for c in within]
    # Ranging reads its input twice, to find the bounds and to deal it out.
    x = stored.store(spark, df, name)
    x = x.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumn("__place", F.monotonically_increasing_id())
    x = stored.store(spark, x, name).withColumn("__task", F.shiftright("__place", bits))
    parts = x.groupBy(*within, "__task").agg(F.count("*").alias("__n"), F.min("__place").alias("__first"))
    before = (W.partitionBy(*within) if within else W.partitionBy(F.lit(0))).orderBy("__task").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select(*within, "__task", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    # A row for each task, where there are no groups.
    parts = parts if within else F.broadcast(parts)
    return x.join(parts, [*within, "__task"]).withColumn(name, (F.col("__before") + F.col("__place") - F.col("__first") + start).cast("bigint")).drop("__place", "__task", "__first", "__before")


def regions(samples_by_region: DataFrame) -> DataFrame:
    """Leaf regions with checklists, numbered by code from 1."""
    codes = samples_by_region.select(F.col("region_code").alias("code")).distinct()
    return dense_ids(codes, "id", [F.col("code")]).select("id", "code")


def finest_regions(packs: DataFrame) -> DataFrame:
    """Regions without another region below them."""
    p, c = packs.alias("p"), packs.select(F.col("region").alias("child"))
    # Every proper prefix of a code that ends before a hyphen is its ancestor: an equi-join on the ancestors.
    parts = F.split("child", "-")
    above = c.select(F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(parts) - 1)), lambda n: F.when(n < F.size(parts), F.array_join(F.slice(parts, F.lit(1), n), "-")))).alias("ancestor"))
    return p.join(above.filter("ancestor is not null").distinct(), F.col("p.region") == F.col("ancestor"), "left_anti")


def missing_regions(wanted: DataFrame, packs: DataFrame) -> DataFrame:
    """Asked-for regions that no pack has."""
    return wanted.join(packs, "region", "left_anti").select("region").distinct()
