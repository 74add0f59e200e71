"""The driver's tables read as checklists and observations.

A supplier is a location, an order at a supplier a checklist, and a part's brand, its type and the
return flag are the species seen on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dims import dealt
from ..sources import schema


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _group(key: str):  # noqa: ANN202
    k = F.col(key)
    return F.when(k % 5 == 0, F.concat(F.lit("G"), (k - k % 10).cast("string"))).otherwise(F.lit(""))


def locations(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    s = _t(spark, d, "supplier").join(F.broadcast(_t(spark, d, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))  # 25 rows
    country = F.concat(F.lit("R"), F.col("n_regionkey").cast("string"))
    state = F.when(k % 7 == 0, F.concat(country, F.lit("-"))).when(k % 11 == 0, F.lit("")).otherwise(F.concat(country, F.lit("-N"), F.col("n_nationkey").cast("string")))
    county = F.when((k % 4 == 0) & (k % 7 != 0) & (k % 11 != 0), F.concat(state, F.lit("-C"), (k % 3).cast("string"))).otherwise(F.lit(""))
    return s.select(
        k.alias("s_suppkey"),
        F.col("s_name").alias("locality"),
        F.when(k % 5 == 0, "P").otherwise("H").alias("locality_type"),
        F.when(k % 77 == 0, F.lit("")).otherwise(country).alias("country_code"),
        F.when(k % 77 == 0, F.lit("")).otherwise(state).alias("state_code"),
        county.alias("county_code"),
        F.when(k % 13 != 0, ((k * 37) % 18000) / 100.0 - 90).cast("string").alias("lat"),
        (((k * 91) % 36000) / 100.0 - 180).cast("string").alias("lng"),
    )


def raw_checklists(spark: SparkSession, d: str) -> DataFrame:
    """A row for each order at a supplier, in the columns of a raw extract."""
    orders = _t(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    # Dealt by order, lines are made distinct and joined with their orders where they lie.
    seen = _t(spark, d, "lineitem").select("l_suppkey", "l_orderkey")
    seen = dealt(seen, "l_orderkey").distinct()
    x = seen.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(locations(spark, d), F.col("l_suppkey") == F.col("s_suppkey"))
    values = {
        "location_id": F.col("l_suppkey").cast("string"), "locality": F.col("locality"), "locality_type": F.col("locality_type"), "observed_on": F.col("day").cast("string"),
        "event_id": F.col("l_orderkey").cast("string"), "group_id": _group("l_orderkey"), "country_code": F.col("country_code"), "state_code": F.col("state_code"),
        "county_code": F.col("county_code"), "lat": F.col("lat"), "lng": F.col("lng"),
    }
    complete = F.when(F.col("l_orderkey") % 17 == 0, "0").otherwise("1").alias(schema.COMPLETE)
    return x.select(*[values[v].alias(k) for k, v in schema.CHECKLIST_COLUMNS.items()], complete)


def raw_observations(spark: SparkSession, d: str) -> DataFrame:
    """A row for each species of each line, in the columns of a raw extract."""
    orders = _t(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    parts = _t(spark, d, "part").select("p_partkey", "p_brand", "p_type")
    lines = _t(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    x = dealt(lines, "l_orderkey").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(dealt(parts, "p_partkey", beside=lines), F.col("l_partkey") == F.col("p_partkey"))
    values = {"location_id": F.col("l_suppkey").cast("string"), "observed_on": F.col("day").cast("string"), "event_id": F.col("l_orderkey").cast("string"), "group_id": _group("l_orderkey"), "sci_name": F.array("p_brand", "p_type", F.concat(F.lit("RF-"), F.col("l_returnflag")))}
    complete = F.when(F.col("l_orderkey") % 17 == 0, "0").otherwise("1").alias(schema.COMPLETE)
    category = F.when(F.col("l_linenumber") == 7, "spuh").when(F.col("l_linenumber") == 3, "issf").otherwise("species").alias(schema.CATEGORY)
    # A line's values are made once, then a row for each of its species.
    rows = x.select(*[values[v].alias(k) for k, v in schema.OBSERVATION_COLUMNS.items()], complete, category)
    name = next(k for k, v in schema.OBSERVATION_COLUMNS.items() if v == "sci_name")
    return rows.withColumn(name, F.explode(F.col(f"`{name}`")))


def species(spark: SparkSession, d: str) -> DataFrame:
    """Numbered by name; one return flag is unknown to the taxonomy."""
    from pyspark.sql import Window as W

    part = _t(spark, d, "part")
    flags = _t(spark, d, "lineitem").select(F.concat(F.lit("RF-"), F.col("l_returnflag")).alias("sci_name"))
    names = part.select(F.col("p_brand").alias("sci_name")).union(part.select("p_type")).union(flags).distinct().filter("sci_name <> 'RF-A'")
    x = names.withColumn("id", F.row_number().over(W.orderBy("sci_name")).cast("bigint"))  # a few dozen names
    code = F.when(F.col("id") % 10 == 0, F.lit("")).otherwise(F.concat(F.lit("s"), F.col("id").cast("string")))
    return x.select("id", "sci_name", F.concat(F.lit("Común "), F.col("sci_name")).alias("name"), code.alias("code"), F.col("id").cast("double").alias("taxon_order"), F.lit(None).cast("string").alias("search_codes"))


def areas(spark: SparkSession, d: str) -> DataFrame:
    """A polygon and a circle for each nation; area_id, ring, lat, lng, km."""
    n = _t(spark, d, "nation").select(F.col("n_nationkey").alias("k"))
    middle, across = ((F.col("k") * 37) % 121 - 60).cast("double"), ((F.col("k") * 67) % 360 - 180).cast("double")
    corners = [F.struct((middle + up).alias("lat"), ((across + along + 540) % 360 - 180).alias("lng")) for up, along in ((25, 0), (5, 18), (-20, 12), (-8, -12), (10, -25))]
    none = F.lit(None).cast("double")
    polygons = n.select(F.concat(F.lit("P"), "k").alias("area_id"), F.array(*corners).alias("ring"), none.alias("lat"), none.alias("lng"), none.alias("km"))
    circles = n.select(F.concat(F.lit("C"), "k").alias("area_id"), F.lit(None).cast("array<struct<lat:double,lng:double>>").alias("ring"), ((F.col("k") * 53) % 181 - 90).cast("double").alias("lat"), ((F.col("k") * 101) % 360 - 180).cast("double").alias("lng"), (800 + 100 * F.col("k")).cast("double").alias("km"))
    return polygons.union(circles)
