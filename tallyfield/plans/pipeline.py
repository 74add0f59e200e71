"""Whole builds: targets, grid, occurrences, packs. Each reads typed inputs and writes Parquet tables."""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.score import BUCKETS, LOC_SAMPLES, LOC_SCORE, Z
from ..operators import arrays, cluster, counts, dims, occurrences, packs, rollup, search
from ..sources import readers, sinks


def targets(checklists: DataFrame, observations: DataFrame, species: DataFrame, z: float = Z, kept: list[DataFrame] | None = None) -> dict[str, DataFrame]:
    """All tables of the targets build. What feeds several of them is kept on executors' disks (made again if one is lost) and, where kept is given, put there to be let go."""
    dim = dims.location_dim(checklists).persist(StorageLevel.DISK_ONLY)
    samples = counts.samples(checklists).persist(StorageLevel.DISK_ONLY)
    matched = counts.matched(counts.observed(observations, species), samples).persist(StorageLevel.DISK_ONLY)
    if kept is not None:
        kept += [dim, samples, matched]
    region_samples = counts.region_samples(samples, dim)
    regions = dims.regions(region_samples)
    return {
        "species": species,
        "hotspots": dims.hotspots(dim),
        "regions": regions,
        "month_obs": counts.month_obs(matched, dim, z),
        "year_obs": counts.year_obs(matched, samples, dim, z),
        "region_month_samples": counts.with_region_id(region_samples, regions),
        "region_month_obs": counts.with_region_id(counts.region_obs(matched, dim), regions),
        "species_fts": search.index(species),
    }


def build_targets(spark: SparkSession, checklists: DataFrame, observations: DataFrame, species: DataFrame, root: str, year: str, month: str, z: float = Z) -> None:
    kept: list[DataFrame] = []
    for name, df in targets(checklists, observations, species, z, kept).items():
        sinks.write_table(df, root, name)
    sinks.write_table(sinks.metadata(spark, year, month), root, "metadata")
    for df in kept:
        df.unpersist()


def grid_tables(checklists: DataFrame, observations: DataFrame, species: DataFrame, resolutions: list[int], grid: geo.Grid | None = None) -> dict[str, DataFrame]:
    """h3_cells, h3_cell_obs, h3_cell_samples over all resolutions, the finest from the source and each coarser from the one before."""
    grid = grid or geo.grid()
    order = geo.check_resolutions(resolutions)
    dim = dims.location_dim(checklists)
    own = rollup.cells(counts.observed(observations, species), counts.samples(checklists), dim, order[0], grid)
    out: dict[str, DataFrame] = {}
    for res in order:
        own = own if res == own.res else rollup.roll_up(own, res)
        for name, df in rollup.tables(own, grid).items():
            out[name] = out[name].unionByName(df) if name in out else df
    return out


def build_grid(spark: SparkSession, checklists: DataFrame, observations: DataFrame, species: DataFrame, root: str, version: str, resolutions: list[int]) -> None:
    for name, df in grid_tables(checklists, observations, species, resolutions).items():
        sinks.write_table(df, root, name)
    rows = spark.range(1).select(F.explode(F.array(*[F.lit(r) for r in resolutions])).alias("res")).crossJoin(sinks.metadata(spark, *version.split("-")[::-1]).select("version", "generated_at"))
    sinks.write_table(rows, root, "h3_metadata")


def occurrence_tables(tables: dict[str, DataFrame], zone_res: list[int], source_res: int, grid: geo.Grid | None = None) -> dict[str, DataFrame]:
    """tables: year_obs, hotspots, h3_cells, h3_cell_obs, h3_cell_samples."""
    grid = grid or geo.grid()
    meta = occurrences.loc_meta(tables["year_obs"], tables["hotspots"])
    loc = occurrences.loc_species(tables["year_obs"], meta)
    zones = occurrences.zone_meta(tables["h3_cells"], tables["h3_cell_samples"], zone_res, source_res, grid)
    children = occurrences.child_zone(tables["h3_cells"], zones, zone_res, source_res)
    zone = occurrences.zone_species(tables["h3_cell_obs"], children, source_res)
    return {
        "loc_meta": meta,
        "loc_species": loc,
        "loc_qcount": occurrences.qcount(loc, "loc_ref"),
        "zone_meta": zones,
        "zone_species": zone,
        "zone_qcount": occurrences.qcount(zone, "res", "cell_ref"),
        "loc_zone_h3": (where := occurrences.loc_zone_h3(meta, zone_res, grid)),
        "loc_cell_ref": occurrences.loc_cell_ref(meta, where, zones),
    }


def blob_vectors(t: dict[str, DataFrame], zone_res: list[int]) -> tuple[DataFrame, DataFrame]:
    """(key, at, value, real) and (key, kind, size) of all blobs: of hotspots (loc:..) and of the zones of each resolution (zone:{res}:..).

    Per place: samples, lat, lng, of zones the cell, and a matrix of q_count by bucket; rows sorted by species as where
    each species begins (spOff), the place (csrRef) and the level (csrLvl); and each hotspot's zone (loc:cellRef:{res}).
    """
    vectors: list[DataFrame] = []
    sizes: list[DataFrame] = []

    def put(key: str, kind: str, size: DataFrame, rows: DataFrame, at, value) -> None:  # noqa: ANN001
        whole, real = (F.lit(0), F.coalesce(value, F.lit(0.0))) if kind == "f4" else (F.coalesce(value, F.lit(0)), F.lit(0.0))
        vectors.append(rows.select(F.lit(key).alias("key"), at.cast("bigint").alias("at"), whole.cast("bigint").alias("value"), real.cast("double").alias("real")))
        sizes.append(size.select(F.lit(key).alias("key"), F.lit(kind).alias("kind"), F.col("size").cast("bigint").alias("size")))

    def family(name: str, meta: DataFrame, levels: DataFrame, counts_: DataFrame, ref: str, more: tuple) -> None:
        at, n = F.col(ref), meta.agg(F.coalesce(F.max(ref) + 1, F.lit(0)).alias("size"))
        for column, kind in (("samples", "i4"), ("lat", "f4"), ("lng", "f4"), *more):
            put(f"{name}:{column}", kind, n, meta, at, F.col(column))
        matrix = counts_.withColumn("k", F.lit(1)).join(F.broadcast(n.withColumn("k", F.lit(1))), "k")  # one row
        put(f"{name}:qcount", "i4", n.select((F.col("size") * len(BUCKETS)).alias("size")), matrix, F.col("bucket") * F.col("size") + at, F.col("q_count"))
        offsets = arrays.csr_offsets(levels, levels.select(F.col("species_id").alias("id")))
        put(f"{name}:spOff", "i4", offsets.agg(F.count("*").alias("size")), offsets, F.col("species_id"), F.col("offset"))
        ordered, rows = dims.dense_ids(levels, "at", [F.col("species_id"), at], start=0), levels.agg(F.count("*").alias("size"))
        put(f"{name}:csrRef", "i4", rows, ordered, F.col("at"), at)
        put(f"{name}:csrLvl", "u1", rows, ordered, F.col("at"), F.col("bucket_level"))

    family("loc", t["loc_meta"], t["loc_species"], t["loc_qcount"], "loc_ref", ())
    for res in sorted(zone_res):
        own = {k: t[k].filter(F.col("res") == res) for k in ("loc_cell_ref", "zone_meta", "zone_species", "zone_qcount")}
        put(f"loc:cellRef:{res}", "i4", t["loc_meta"].agg(F.count("*").alias("size")), own["loc_cell_ref"], F.col("loc_ref"), F.col("cell_ref"))
        family(f"zone:{res}", own["zone_meta"], own["zone_species"], own["zone_qcount"], "cell_ref", (("h3", "i8"),))
    return reduce(DataFrame.unionByName, vectors), reduce(DataFrame.unionByName, sizes)


def build_occurrences(spark: SparkSession, source: str, root: str, year: str, month: str, zone_res: tuple[int, ...] = (3, 4)) -> None:
    needed = {n: readers.read_table(spark, source, n) for n in ("year_obs", "hotspots", "h3_cells", "h3_cell_obs", "h3_cell_samples", "species")}
    finest = needed["h3_cells"].agg(F.max("res")).first()[0]
    out = occurrence_tables(needed, list(zone_res), finest)
    for name, df in out.items():
        sinks.write_table(df, root, name)
    stored = {n: readers.read_table(spark, root, n) for n in out}
    sinks.write_table(arrays.blobs(*blob_vectors(stored, list(zone_res))), root, "blob_cache")
    sinks.write_table(needed["species"], root, "species")
    more = {"buckets": "[" + ",".join(map(str, BUCKETS)) + "]", "min_score": LOC_SCORE, "min_checklists": LOC_SAMPLES}
    sinks.metadata(spark, year, month, **more).write.mode("overwrite").parquet(f"{root}/metadata")
    sinks.pass_through(spark, source, root, "citation_metadata")


def build_packs(spark: SparkSession, source: str, root: str, packs_: DataFrame, api: DataFrame, names: DataFrame, version: str, base_url: str, res: int | None = None, only: list[str] | None = None, updated_at: str = "") -> None:
    """api: hotspots with the region of the pack that they were asked for."""
    own = packs.allowed(packs_, only) if only else packs_
    t = {n: readers.read_table(spark, source, n) for n in ("hotspots", "month_obs", "species")}
    hot = packs.pack_hotspots(api, names)
    targets_ = packs.pack_targets(own, t["hotspots"], t["month_obs"], t["species"])
    cells = None
    if res is not None:
        g = {n: readers.read_table(spark, source, n) for n in ("h3_cells", "h3_cell_obs", "h3_cell_samples")}
        cells = packs.pack_cells(own, g["h3_cells"], g["h3_cell_obs"], g["h3_cell_samples"], t["species"], res)
    docs = packs.documents(updated_at, hot, targets_, cells, res)
    sinks.write_documents(docs.withColumnRenamed("region", "name"), f"{root}/{version}")
    found = cluster.clusters(hot.join(own.select("region", "center_lat", "center_lng"), "region").select("region", "id", "lat", "lng", "center_lat", "center_lng"))
    sinks.write_documents(packs.index(own, hot, found, base_url, version).withColumn("name", F.lit("index")), f"{root}/index")
