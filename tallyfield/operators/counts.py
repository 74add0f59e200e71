"""Distinct checklist counts and their sums.

Distinct counts are made once, per (location, month[, species]); every higher level sums them. Rows are dealt by location and
month, once: keys hardly repeat in a task before that, so distinct rows, counts and the join of both find theirs where they lie.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.regions import dedupe_key
from ..functions.score import Z, wilson
from .dims import dealt, is_hotspot


def _month(c: str = "observed_on"):  # noqa: ANN202
    return F.month(c).cast("bigint")


def samples(checklists: DataFrame) -> DataFrame:
    """location_id, month, samples: distinct checklists, those of a group counted once."""
    rows = checklists.select("location_id", _month().alias("month"), dedupe_key(F.col("group_id"), F.col("event_id")).alias("k"))
    return dealt(rows.filter("month is not null"), "location_id", "month").groupBy("location_id", "month").agg(F.count_distinct("k").alias("samples"))


def observed(observations: DataFrame, species: DataFrame) -> DataFrame:
    """location_id, month, species_id, obs; names that the taxonomy lacks are dropped.

    The taxonomy (some ten thousand names) is broadcast, so rows are grouped by numbers instead of names.
    """
    known = observations.join(F.broadcast(species.select("sci_name", F.col("id").alias("species_id"))), "sci_name")
    rows = known.select("location_id", _month().alias("month"), "species_id", dedupe_key(F.col("group_id"), F.col("event_id")).alias("k"))
    return dealt(rows.filter("month is not null"), "location_id", "month").groupBy("location_id", "month", "species_id").agg(F.count_distinct("k").alias("obs"))


def matched(observed_: DataFrame, samples_: DataFrame) -> DataFrame:
    """Observations with checklists of their location and month, with samples."""
    return observed_.join(samples_, ["location_id", "month"])


def at_hotspots(df: DataFrame, dim: DataFrame) -> DataFrame:
    return df.join(dim.filter(is_hotspot()).select("location_id"), "location_id")


def month_obs(matched_: DataFrame, dim: DataFrame, z: float = Z) -> DataFrame:
    return at_hotspots(matched_, dim).select("location_id", "month", "species_id", "obs", "samples", wilson(F.col("obs"), F.col("samples"), z).alias("score"))


def year_samples(samples_: DataFrame, dim: DataFrame) -> DataFrame:
    return at_hotspots(samples_, dim).groupBy("location_id").agg(F.sum("samples").alias("samples"))


def year_obs(matched_: DataFrame, samples_: DataFrame, dim: DataFrame, z: float = Z) -> DataFrame:
    """Months pooled; samples are all of the hotspot's, also of months without the species."""
    # Months of a place lie in several tasks, so nothing could be summed before the shuffle.
    obs = dealt(matched_, "location_id").groupBy("location_id", "species_id").agg(F.sum("obs").alias("obs"))
    both = obs.join(year_samples(samples_, dim), "location_id")
    return both.select("location_id", "species_id", "obs", "samples", wilson(F.col("obs"), F.col("samples"), z).alias("score"))


def region_samples(samples_: DataFrame, dim: DataFrame) -> DataFrame:
    """region_code, month, samples over all locations of a leaf region."""
    own = dim.filter("region_code is not null").select("location_id", "region_code")
    return samples_.join(own, "location_id").groupBy("region_code", "month").agg(F.sum("samples").alias("samples"))


def region_obs(matched_: DataFrame, dim: DataFrame) -> DataFrame:
    own = dim.filter("region_code is not null").select("location_id", "region_code")
    return matched_.join(own, "location_id").groupBy("region_code", "month", "species_id").agg(F.sum("obs").alias("obs"))


def with_region_id(df: DataFrame, regions: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != "region_code"]
    return df.join(regions.select(F.col("id").alias("region_id"), F.col("code").alias("region_code")), "region_code").select("region_id", *rest)


def summary(matched_: DataFrame) -> DataFrame:
    """One row of totals."""
    return matched_.agg(F.count("*").alias("rows"), F.count_distinct("location_id").alias("locations"), F.count_distinct("species_id").alias("species"), F.coalesce(F.sum("obs"), F.lit(0)).alias("obs"))
