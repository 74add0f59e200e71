"""Region packs: JSON documents of hotspots, targets and cells, their index, and binary packs.

All packs are made in one plan: each pack's region is matched with the codes at or below it. The rows of a pack are
numbered in their order and encoded in pieces of so many rows, each a task's; a pack is its pieces, one after another, and
no task or group holds the rows of a large region.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import codec, geo, regions
from ..sources import stored
from . import arrays, dims

#: Version of the document layout.
LAYOUT = 1
#: Rows of a piece.
PIECE = 256


def codes_of(packs: DataFrame, codes: DataFrame, mode: str) -> DataFrame:
    """region, code: the codes that a pack's region holds.

    strict: an equi-join on each code's ancestors (itself and all its prefixes that end before a hyphen);
    loose: an equi-join on all prefixes. Codes are short, so a code has few of either.
    """
    low = codes.filter("code is not null").select("code", F.lower("code").alias("low")).distinct()
    if mode == "loose":
        up = F.transform(F.sequence(F.lit(1), F.length("low")), lambda n: F.substring("low", F.lit(1), n))
    else:
        parts = F.split("low", "-")
        up = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "-"))
    above = low.filter("length(low) > 0").select("code", F.explode(up).alias("key"))
    return packs.select("region", F.lower("region").alias("key")).distinct().join(above, "key").select("region", "code")


def pack_targets(packs: DataFrame, hotspots: DataFrame, month_obs: DataFrame, species: DataFrame) -> DataFrame:
    """region, location_id, samples, species: array of (code, obs (12)); rows whose species has no code are left out. Regions match hotspots loosely."""
    where = codes_of(packs, hotspots.select(F.col("region_code").alias("code")), "loose").withColumnRenamed("code", "region_code")
    own = hotspots.select(F.col("id").alias("location_id"), "region_code").join(where, "region_code").select("region", "location_id")
    months = arrays.target_months(month_obs.join(own.select("location_id").distinct(), "location_id", "left_semi"), _codes(species))
    return own.join(months, "location_id").select("region", "location_id", "samples", _named())


def pack_cells(packs: DataFrame, cells: DataFrame, cell_obs: DataFrame, cell_samples: DataFrame, species: DataFrame, res: int) -> DataFrame:
    """region, id (hex), lat, lng (3 decimals), samples, species. Regions match cells strictly."""
    where = codes_of(packs, cells.select(F.col("region_code").alias("code")), "strict").withColumnRenamed("code", "region_code")
    own = cells.filter(F.col("res") == res).join(where, "region_code").select("region", "cell_ref", "h3", "lat", "lng")
    ref = own.select("cell_ref").distinct()
    pick = lambda df: df.filter(F.col("res") == res).join(ref, "cell_ref", "left_semi")
    months = arrays.cell_months(pick(cell_obs), pick(cell_samples), "cell_ref", codes=_codes(species))
    named = own.join(months, "cell_ref")
    return named.select("region", geo.cell_hex(F.col("h3")).alias("id"), geo.round3(F.col("lat")).alias("lat"), geo.round3(F.col("lng")).alias("lng"), "samples", _named())


def _codes(species: DataFrame) -> DataFrame:
    return species.filter("code <> ''").select(F.col("id").alias("species_id"), "code")


def _named() -> Column:
    """The species list without ids; one of no species stays, empty."""
    return F.transform("species", lambda s: F.struct(s["code"].alias("code"), s["obs"].alias("obs"))).alias("species")


def pack_hotspots(api: DataFrame, names: DataFrame) -> DataFrame:
    """API hotspots with region names: a country's defaults to its code, others to null."""

    def named(column: str, alias: str) -> DataFrame:
        return names.select(F.col("code").alias(column), F.col("name").alias(alias))

    x = api.join(F.broadcast(named("country_code", "country_name")), "country_code", "left")  # one row a region
    x = x.join(F.broadcast(named("subnational1_code", "state_name")), "subnational1_code", "left")
    x = x.join(F.broadcast(named("subnational2_code", "county_name")), "subnational2_code", "left")
    return x.withColumn("country_name", F.coalesce("country_name", "country_code"))


def species_json(species: Column) -> Column:
    """Rows [code, o1..o12], a mix of types that no array column holds."""
    row = F.transform(species, lambda s: F.concat(F.lit("["), F.to_json(F.array(s["code"])).substr(F.lit(2), F.length(F.to_json(F.array(s["code"]))) - 2), F.lit(","), F.array_join(s["obs"].cast("array<string>"), ","), F.lit("]")))
    return F.concat(F.lit("["), F.array_join(row, ","), F.lit("]"))


def samples_json(samples: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(samples.cast("array<string>"), ",", "null"), F.lit("]"))


def target_json() -> Column:
    return F.concat(F.lit('{"id":'), _text(F.col("location_id")), F.lit(',"samples":'), samples_json(F.col("samples")), F.lit(',"species":'), species_json(F.col("species")), F.lit("}"))


def cell_json() -> Column:
    place = F.concat(F.lit(',"lat":'), F.col("lat").cast("string"), F.lit(',"lng":'), F.col("lng").cast("string"))
    return F.concat(F.lit('{"id":'), _text(F.col("id")), place, F.lit(',"samples":'), samples_json(F.col("samples")), F.lit(',"species":'), species_json(F.col("species")), F.lit("}"))


def _text(c: Column) -> Column:
    """A JSON string."""
    one = F.to_json(F.array(c))
    return F.substring(one, F.lit(2), F.length(one) - 2)


def hotspot_json() -> Column:
    must = [F.col("id"), F.col("name"), F.col("species"), F.col("lat"), F.col("lng"), F.col("country_code").alias("country"), F.col("country_name").alias("countryName")]
    may = [("subnational1_code", "state"), ("subnational2_code", "county"), ("state_name", "stateName"), ("county_name", "countyName")]
    return F.to_json(F.struct(*must, *[F.col(c).alias(n) for c, n in may]))  # absent ones are null, and left out


def _pieces(rows: DataFrame, n: int) -> DataFrame:
    """place -> piece as well. The row before a piece's first is in both: it says how the piece goes on."""
    return rows.withColumn("piece", F.explode(F.array_distinct(F.array(F.expr(f"place div {n}"), F.expr(f"(place + 1) div {n}")))))


def documents(updated_at: str, hotspots: DataFrame, targets: DataFrame, cells: DataFrame | None = None, res: int | None = None, piece: int = PIECE) -> DataFrame:
    """region, piece, document: compact JSON for each region with API hotspots. A document is its pieces in order; a line break may stand between two of them."""
    regions_ = stored.store(hotspots.sparkSession, hotspots.select("region").distinct(), "packed")
    # Even parts are what stands around the lists, odd ones their elements.
    lists = [(hotspots, "id", hotspot_json()), (targets, "location_id", target_json())]
    marks = [f'{{"v":{LAYOUT},"updatedAt":"{updated_at}","hotspots":[', '],"targets":[']
    if cells is not None:
        lists.append((cells, "id", cell_json()))
        marks.append(f'],"h3res":{res},"cells":[')
    around = F.array(*[F.struct(F.lit(2 * i).alias("part"), F.lit("").alias("key"), F.lit(m).alias("text")) for i, m in enumerate([*marks, "]}"])])
    rows = regions_.select("region", F.explode(around).alias("r")).select("region", "r.*")
    for i, (df, key, text) in enumerate(lists):
        rows = rows.unionByName(df.join(regions_, "region", "left_semi").select("region", F.lit(2 * i + 1).alias("part"), F.col(key).alias("key"), text.alias("text")))
    x = dims.dense_ids(rows, "place", [F.col("part"), F.col("key"), F.col("text")], within=("region",), start=0)
    x = _pieces(x, piece).groupBy("region", "piece").agg(F.sort_array(F.collect_list(F.struct("place", "part", "text"))).alias("rows")).filter(F.element_at("rows", -1)["place"] >= F.col("piece") * piece)

    def written(r: Column, i: Column) -> Column:
        follows = (r["part"] % 2 == 1) & (F.get(F.col("rows"), i - 1)["part"] % 2 == 1)
        return F.when(r["place"] < F.col("piece") * piece, "").otherwise(F.concat(F.when(follows, ",").otherwise(""), r["text"]))

    return x.select("region", "piece", F.array_join(F.transform("rows", written), "").alias("document"))


def index(packs: DataFrame, hotspots: DataFrame, clusters: DataFrame, base_url: str, version: str) -> DataFrame:
    """One row, document: the list of packs that have hotspots, in order of id."""
    n = hotspots.groupBy("region").agg(F.count("*").alias("hotspots"))
    x = packs.join(n, "region").join(clusters, "region", "left")
    entry = F.struct("id", "region", "name", "hotspots", "clusters", F.concat_ws("/", F.lit(base_url.rstrip("/")), F.lit(version), F.concat("region", F.lit(".json.gz"))).alias("url"))
    return x.agg(F.to_json(F.struct(F.lit(version).alias("version"), F.sort_array(F.collect_list(entry)).alias("packs"))).alias("document"))


def binary_packs(cells: DataFrame, cell_obs: DataFrame, cell_samples: DataFrame, packs: DataFrame, res: int, piece: int = PIECE) -> DataFrame:
    """region, piece, data: binary packs of the cells at or below each region. Each piece is a gzip member; a pack is its members in order."""
    where = codes_of(packs, cells.select(F.col("region_code").alias("code")), "strict").withColumnRenamed("code", "region_code")
    own = cells.filter(F.col("res") == res).join(where, "region_code").select("region", "cell_ref", "h3")
    ref = own.select("cell_ref").distinct()
    pick = lambda df: df.filter(F.col("res") == res).join(ref, "cell_ref", "left_semi")
    rows = own.join(arrays.cell_months(pick(cell_obs), pick(cell_samples), "cell_ref"), "cell_ref").select("region", "h3", "samples", "species")
    x = dims.dense_ids(rows, "place", [F.col("h3")], within=("region",), start=0)
    total = x.groupBy("region").agg(F.count("*").alias("h3")).select("region", "h3", F.lit(-1).cast("bigint").alias("place"), F.lit(0).cast("bigint").alias("piece"))
    x = _pieces(x, piece).unionByName(total, allowMissingColumns=True)

    def run(key: tuple, tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, found, last, head = key[1].as_py(), [], 0, b""
        for r in (r for t in tables for r in t.to_pylist()):
            if r["place"] < 0:
                head = codec.header(r["h3"], res)
            elif r["place"] < at * piece:
                last = r["h3"]
            else:
                found.append((r["h3"], r["samples"], [(s["species_id"], s["obs"]) for s in r["species"]]))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()]), pa.array([at]), pa.array([codec.compressed(head + codec.encode_cells(found, last))], pa.binary())], names=["region", "piece", "data"])

    return x.groupBy("region", "piece").applyInArrow(run, "region string, piece bigint, data binary")


def unpacked(pieces: DataFrame) -> DataFrame:
    """region, h3, samples, species: what binary packs hold. Pieces are decoded each for itself, then moved on by the cells before them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for region, at, data in zip(*(b.column(c).to_pylist() for c in ("region", "piece", "data")), strict=True):
                plain = codec.expanded(data)
                own = codec.opened(plain)[2] if at == 0 else codec.Reader(plain)
                found = [{"region": region, "piece": at, "step": cell, "samples": samples, "species": [{"species_id": i, "obs": obs} for i, obs in species]} for cell, samples, species in codec.decode_cells(own)]
                yield pa.RecordBatch.from_pylist(found, kind)

    months = pa.list_(pa.int64())
    kind = pa.schema([("region", pa.string()), ("piece", pa.int64()), ("step", pa.int64()), ("samples", months), ("species", pa.list_(pa.struct([("species_id", pa.int64()), ("obs", months)])))])
    x = pieces.select("region", "piece", "data").mapInArrow(run, "region string, piece bigint, step bigint, samples array<bigint>, species array<struct<species_id: bigint, obs: array<bigint>>>")
    before = W.partitionBy("region").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)  # a row a piece
    moved = x.groupBy("region", "piece").agg(F.max("step").alias("last")).select("region", "piece", F.coalesce(F.sum("last").over(before), F.lit(0)).alias("before"))
    return x.join(moved, ["region", "piece"]).select("region", (F.col("before") + F.col("step")).alias("h3"), "samples", "species")


def allowed(packs: DataFrame, wanted: list[str]) -> DataFrame:
    """The packs asked for; an unknown region is an error."""
    codes = packs.sparkSession.createDataFrame([(w,) for w in wanted], "region string")
    lost = [r["region"] for r in codes.join(packs, "region", "left_anti").collect()]
    if lost:
        raise ValueError(f"no such pack: {', '.join(sorted(lost))}")
    return packs.join(codes, "region", "left_semi")


def holds(column: str, region: str, mode: str = "strict") -> Column:
    return regions.in_region(F.col(column), F.lit(region), mode)
