"""Grid aggregates: cells, their winning region, dense references, and coarser resolutions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from .dims import dealt, dense_ids


@dataclass
class Cells:
    """Sums at one resolution. obs: cell, month, species_id, obs; samples: cell, month, samples; regions: cell, region_code, samples."""

    res: int
    obs: DataFrame
    samples: DataFrame
    regions: DataFrame


def cell_dim(dim: DataFrame, res: int, grid: geo.Grid) -> DataFrame:
    """location_id, cell, region_code of locations with coordinates."""
    own = dim.filter("cell_lat is not null and cell_lng is not null")
    return own.select("location_id", grid.cell(F.col("cell_lat"), F.col("cell_lng"), res).alias("cell"), F.col("grid_region").alias("region_code"))


def cells(observed: DataFrame, samples: DataFrame, dim: DataFrame, res: int, grid: geo.Grid) -> Cells:
    """Observations are not matched with samples here; one join feeds both sums of samples."""
    where = cell_dim(dim, res, grid)
    obs = observed.join(dealt(where, "location_id", beside=observed), "location_id").groupBy("cell", "month", "species_id").agg(F.sum("obs").alias("obs"))
    own = samples.join(where, "location_id").groupBy("cell", "region_code", "month").agg(F.sum("samples").alias("samples"))
    by_cell = own.groupBy("cell", "month").agg(F.sum("samples").alias("samples"))
    by_region = own.filter("region_code is not null").groupBy("cell", "region_code").agg(F.sum("samples").alias("samples"))
    return Cells(res, obs, by_cell, by_region)


def roll_up(c: Cells, res: int) -> Cells:
    """The same sums at a coarser resolution, from this one."""
    geo.check_resolutions([res], c.res)

    def up(df: DataFrame, *keys: str, value: str) -> DataFrame:
        return df.withColumn("cell", geo.parent(F.col("cell"), res)).groupBy("cell", *keys).agg(F.sum(value).alias(value))

    return Cells(res, up(c.obs, "month", "species_id", value="obs"), up(c.samples, "month", value="samples"), up(c.regions, "region_code", value="samples"))


def winners(regions: DataFrame) -> DataFrame:
    """cell, region_code: the region with most samples, of ties the first by code."""
    best = F.min(F.struct((-F.col("samples")).alias("less"), "region_code"))
    return regions.groupBy("cell").agg(best["region_code"].alias("region_code"))


def tables(c: Cells, grid: geo.Grid) -> dict[str, DataFrame]:
    """h3_cells, h3_cell_obs, h3_cell_samples of a resolution; cells without any region are left out."""
    refs = dense_ids(winners(c.regions), "cell_ref", [F.col("cell")])
    res = F.lit(c.res).cast("int").alias("res")
    own = refs.select(res, "cell_ref", F.col("cell").alias("h3"), "region_code", grid.lat(F.col("cell"), c.res).alias("lat"), grid.lng(F.col("cell"), c.res).alias("lng"))
    ref = refs.select("cell", "cell_ref")
    return {
        "h3_cells": own,
        "h3_cell_obs": c.obs.join(ref, "cell").select(res, "cell_ref", "month", "species_id", "obs"),
        "h3_cell_samples": c.samples.join(ref, "cell").select(res, "cell_ref", "month", "samples"),
    }


def orphans(c: Cells) -> DataFrame:
    """Cells with observations or samples, but without a region."""
    every = c.obs.select("cell").union(c.samples.select("cell")).distinct()
    return every.join(winners(c.regions), "cell", "left_anti")


def stats(c: Cells) -> DataFrame:
    """One row: cells, orphans, and the sums before cells without a region are left out."""
    obs = c.obs.groupBy("cell").agg(F.sum("obs").alias("obs"), F.count("*").alias("rows"))
    each = obs.join(c.samples.groupBy("cell").agg(F.sum("samples").alias("samples")), "cell", "full_outer").join(winners(c.regions).withColumn("won", F.lit(True)), "cell", "left")
    return each.agg(F.count("rows").alias("cells"), F.count_if(F.col("won").isNull()).alias("orphans"), F.sum("obs").alias("obs"), F.sum("samples").alias("samples")).select(F.lit(c.res).alias("res"), "cells", "orphans", "obs", "samples")
