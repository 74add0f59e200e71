"""The questions that the tables are made to answer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def best_locations(obs: DataFrame, species_id: int, k: int, month: int | None = None) -> DataFrame:
    """The k locations of best score for a species, of the year or of a month; ties by location."""
    own = obs.filter(F.col("species_id") == species_id)
    own = own if month is None else own.filter(F.col("month") == month)
    return own.orderBy(F.desc("score"), "location_id").limit(k)


def best_of_each(obs: DataFrame, k: int) -> DataFrame:
    """The k locations of best score for every species, with their rank; each task keeps k rows of a species before anything is shuffled."""
    rank = F.row_number().over(W.partitionBy("species_id").orderBy(F.desc("score"), "location_id"))
    return obs.withColumn("rank", rank).filter(F.col("rank") <= k)


def best_ranked(ranked: DataFrame, species_id: int, k: int) -> DataFrame:
    """`best_locations` of a table that `sinks.write_ranked` made."""
    return ranked.filter(F.col("species_id") == species_id).orderBy("less", "location_id").limit(k).drop("less")


def likely_in_area(cell_obs: DataFrame, cell_samples: DataFrame, area: DataFrame) -> DataFrame:
    """species_id, month, obs, samples, frequency over the cells (res, cell_ref) of an area: sums first, then the ratio."""
    key = ["res", "cell_ref"]
    obs = cell_obs.join(area, key, "left_semi").groupBy("species_id", "month").agg(F.sum("obs").alias("obs"))
    samples = cell_samples.join(area, key, "left_semi").groupBy("month").agg(F.sum("samples").alias("samples"))
    return obs.join(samples, "month").select("species_id", "month", "obs", "samples", (F.col("obs").cast("double") / F.col("samples")).alias("frequency"))


def region_chart(region_obs: DataFrame, region_samples: DataFrame) -> DataFrame:
    """region_id, species_id, month, frequency."""
    return region_obs.join(region_samples, ["region_id", "month"]).select("region_id", "species_id", "month", (F.col("obs").cast("double") / F.col("samples")).alias("frequency"))


def hotspots_per_cell(loc_cells: DataFrame) -> DataFrame:
    return loc_cells.filter("cell_ref >= 0").groupBy("res", "cell_ref").agg(F.count("*").alias("hotspots"))


def hotspots_of(hotspots: DataFrame, **codes: str) -> DataFrame:
    """Hotspots by country_code, subnational1_code, subnational2_code or region_code."""
    for column, value in codes.items():
        hotspots = hotspots.filter(F.col(column) == value)
    return hotspots
