"""Twelve-month arrays, compressed rows and dense vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .dims import dealt

MONTHS = 12


def month_array(month: Column, value: Column, default: int | None) -> Column:
    """Aggregate: the values of months 1..12 in order, default where a month has none; of several, the largest. Twelve numbers of fixed width, no lists."""
    at = [F.max(F.when(month == m, value)) for m in range(1, MONTHS + 1)]
    return F.array(*(at if default is None else [F.coalesce(v, F.lit(default).cast("bigint")) for v in at]))


def _species(obs: DataFrame, keys: list[str], codes: DataFrame | None) -> DataFrame:
    """keys, species: array of (species_id, obs (12)), by species; with codes (species_id, code) of (species_id, code, obs), without the species that have none."""
    # Dealt by key once, so that arrays aren't shuffled.
    per = dealt(obs, *keys).groupBy(*keys, "species_id").agg(month_array(F.col("month"), F.col("obs"), 0).alias("obs"))
    if codes is None:
        return per.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("species_id", "obs"))).alias("species"))
    row = F.when(F.col("code").isNotNull(), F.struct("species_id", "code", "obs"))  # lists leave nulls out
    return per.join(F.broadcast(codes), "species_id", "left").groupBy(*keys).agg(F.sort_array(F.collect_list(row)).alias("species"))


def target_months(month_obs: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """location_id, samples (12, null where a month has no row), species: array of (species_id, [code,] obs (12)), by species."""
    species = _species(month_obs, ["location_id"], codes)
    months = month_obs.groupBy("location_id", "month").agg(F.max("samples").alias("samples"))
    samples = months.groupBy("location_id").agg(month_array(F.col("month"), F.col("samples"), None).alias("samples"))
    return samples.join(species, "location_id").select("location_id", "samples", "species")


def month_masks(df: DataFrame, *keys: str) -> DataFrame:
    """keys, mask: bit m - 1 is set if there is a row of month m."""
    return df.groupBy(*keys).agg(F.expr("bit_or(shiftleft(1, cast(month - 1 as int)))").alias("mask"))


def cell_months(cell_obs: DataFrame, cell_samples: DataFrame, *keys: str, codes: DataFrame | None = None) -> DataFrame:
    """keys, samples (12, 0 where none), species: array of (species_id, [code,] obs (12)); cells of either side."""
    none = F.array(*[F.lit(0).cast("bigint")] * MONTHS)
    species = _species(cell_obs, list(keys), codes)
    samples = cell_samples.groupBy(*keys).agg(month_array(F.col("month"), F.col("samples"), 0).alias("samples"))
    both = samples.join(species, list(keys), "full_outer")
    return both.select(*keys, F.coalesce("samples", none).alias("samples"), F.coalesce("species", F.array().cast(species.schema["species"].dataType)).alias("species"))


def csr_offsets(levels: DataFrame, species: DataFrame) -> DataFrame:
    """species_id, n, offset: where a species' rows begin in rows sorted by species; species without rows too, and one past the last."""
    counts = levels.groupBy("species_id").agg(F.count("*").alias("n"))
    top = species.agg((F.max("id") + 1).alias("top"))
    ids = top.filter("top is not null").select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("top"))).alias("species_id"))
    all_n = ids.join(counts, "species_id", "left").select("species_id", F.coalesce("n", F.lit(0)).alias("n"))
    upto = W.orderBy("species_id").rowsBetween(W.unboundedPreceding, -1)  # a row a species
    return all_n.select("species_id", "n", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("offset"))


def dense(df: DataFrame, index: str, value: str, size: DataFrame, default: int = 0) -> DataFrame:
    """index 0..n-1, value (default where there is no row). size: one row, column n."""
    ids = size.filter("n > 0").select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias(index))
    return ids.join(df.select(index, value), index, "left").select(index, F.coalesce(value, F.lit(default)).alias(value))


#: Little-endian element types of blobs, and elements of a piece.
KINDS = {"i4": "<i4", "i8": "<i8", "f4": "<f4", "u1": "<u1"}
PIECE = 1 << 20


def blobs(vectors: DataFrame, sizes: DataFrame, piece: int = PIECE) -> DataFrame:
    """(key, at, value bigint, real double) and (key, kind, size), a row a vector -> (key, part, data): each vector in pieces of so many little-endian elements, 0 where it has no row.

    A piece is one task's, whatever the length of its vector. Elements of kind f4 are real, others value.
    """

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        part, kind, size = key[1].as_py(), rows.column("kind")[0].as_py(), rows.column("size")[0].as_py()
        out = np.zeros(max(0, min(piece, size - part * piece)), KINDS[kind])
        at = rows.column("at").to_numpy()
        own = at >= 0
        out[at[own] - part * piece] = rows.column("real" if kind == "f4" else "value").to_numpy()[own]
        return pa.table({"key": pa.array([key[0].as_py()], pa.string()), "part": pa.array([part], pa.int64()), "data": pa.array([out.tobytes()], pa.binary())})

    every = sizes.select("key", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"greatest(0, size - 1) div {piece}"))).alias("part"))
    every = every.select("key", "part", F.lit(-1).cast("bigint").alias("at"), F.lit(0).cast("bigint").alias("value"), F.lit(0.0).alias("real"))
    rows = vectors.select("key", F.expr(f"at div {piece}").alias("part"), "at", "value", "real").unionByName(every)
    return rows.join(F.broadcast(sizes), "key").groupBy("key", "part").applyInArrow(run, "key string, part bigint, data binary")  # sizes: a row a vector


def elements(pieces: DataFrame, kinds: DataFrame, piece: int = PIECE) -> DataFrame:
    """(key, part, data) and (key, kind) -> (key, at, value, real): the pieces read back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, part, data, kind in zip(*(b.column(c).to_pylist() for c in ("key", "part", "data", "kind")), strict=True):
                own = np.frombuffer(data, KINDS[kind])
                whole, real = (np.zeros(len(own), np.int64), own.astype(np.float64)) if kind == "f4" else (own.astype(np.int64), np.zeros(len(own)))
                yield pa.RecordBatch.from_arrays([pa.array([key] * len(own), pa.string()), pa.array(part * piece + np.arange(len(own))), pa.array(whole), pa.array(real)], names=["key", "at", "value", "real"])

    return pieces.join(F.broadcast(kinds.select("key", "kind")), "key").mapInArrow(run, "key string, at bigint, value bigint, real double")
