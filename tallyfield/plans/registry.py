"""Queries over the driver's tables, one for each family of operators, and their SQL twins."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import calendar, geo, hexgrid, regions, score
from ..operators import areas, arrays, cluster, consumer, counts, dims, occurrences, packs, places, rollup, search
from ..sources import ingest, sinks, stored
from . import analog, pipeline, sql

#: Resolution of cells and of zones, and of an area's cover.
RES, ZONES, DEPTH = 6, [4, 3], 3


class Tables:
    """The chain of tables over one folder; each is a plan, built when it is first asked for."""

    def __init__(self, spark: SparkSession, d: str):
        self.spark, self.d, self.grid, self.stored = spark, d, geo.Lattice(), set()

    def store(self, *names: str) -> None:
        """Write tables that a query reads more than once, in order, each once."""
        for name in names:
            if name not in self.stored:
                setattr(self, name, stored.store(self.spark, getattr(self, name), name))
                self.stored.add(name)

    def after(self, *names: str) -> Tables:
        """Itself, with these tables stored."""
        self.store(*names)
        return self

    checklists = cached_property(lambda t: ingest.checklists(analog.raw_checklists(t.spark, t.d)))
    observations = cached_property(lambda t: ingest.observations(analog.raw_observations(t.spark, t.d)))
    species = cached_property(lambda t: analog.species(t.spark, t.d))
    dim = cached_property(lambda t: dims.location_dim(t.checklists))
    hotspots = cached_property(lambda t: dims.hotspots(t.dim))
    samples = cached_property(lambda t: counts.samples(t.checklists))
    observed = cached_property(lambda t: counts.observed(t.observations, t.species))
    matched = cached_property(lambda t: counts.matched(t.observed, t.samples))
    month_obs = cached_property(lambda t: counts.month_obs(t.matched, t.dim))
    year_obs = cached_property(lambda t: counts.year_obs(t.matched, t.samples, t.dim))
    region_samples = cached_property(lambda t: counts.region_samples(t.samples, t.dim))
    region_obs = cached_property(lambda t: counts.region_obs(t.matched, t.dim))
    regions = cached_property(lambda t: dims.regions(t.region_samples))
    cells = cached_property(lambda t: rollup.cells(t.observed, t.samples, t.dim, RES, t.grid))
    grid_tables = cached_property(lambda t: rollup.tables(t.after("dim", "samples").cells, t.grid))
    hexes = cached_property(lambda t: rollup.cells(t.observed, t.samples, t.dim, RES, hexgrid.Hexagons()))
    hex_tables = cached_property(lambda t: rollup.tables(t.after("dim", "samples").hexes, hexgrid.Hexagons()))
    areas = cached_property(lambda t: areas.areas(analog.areas(t.spark, t.d)))
    loc_meta = cached_property(lambda t: occurrences.loc_meta(t.after("dim", "samples", "year_obs").year_obs, t.hotspots))
    loc_species = cached_property(lambda t: occurrences.loc_species(t.after("dim", "samples", "year_obs").year_obs, t.loc_meta))
    loc_qcount = cached_property(lambda t: occurrences.qcount(t.loc_species, "loc_ref"))
    zone_meta = cached_property(lambda t: occurrences.zone_meta(t.grid_tables["h3_cells"], t.grid_tables["h3_cell_samples"], ZONES, RES, t.grid))
    zone_species = cached_property(lambda t: occurrences.zone_species(t.grid_tables["h3_cell_obs"], occurrences.child_zone(t.grid_tables["h3_cells"], t.zone_meta, ZONES, RES), RES))
    loc_zone = cached_property(lambda t: occurrences.loc_zone_h3(t.loc_meta, ZONES, t.grid))
    loc_cells = cached_property(lambda t: occurrences.loc_cell_ref(t.loc_meta, t.loc_zone, t.zone_meta))
    packs = cached_property(lambda t: t.dim.select(F.col("grid_region").alias("region")).union(t.dim.select("country_code")).filter("region is not null").distinct())
    seen = cached_property(lambda t: t.species.filter(F.col("id") % 3 == 0).select(F.lit("u1").alias("user_id"), F.col("id").alias("species_id")))


_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _query(text: str | None = None, *roots: str):  # noqa: ANN202
    def add(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        _QUERIES[f.__name__] = f
        if text:
            _SQL[f.__name__] = sql.query(text, *roots)
        return f

    return add


def _text(c: str) -> F.Column:
    return F.array_join(F.col(c).cast("array<string>"), ",", "null").alias(c)


@_query("SELECT location_id, locality, locality_type, observed_on, event_id, group_id, country_code, state_code, county_code, lat, lng FROM cl", "cl")
def filter_complete(t: Tables) -> DataFrame:
    return t.checklists


@_query("SELECT location_id, observed_on, event_id, group_id, sci_name FROM ob", "ob")
def filter_categories(t: Tables) -> DataFrame:
    return t.observations


@_query("SELECT location_id, name, locality_type, nullif(cy, '') AS country_code, sub1 AS subnational1_code, nullif(cc, '') AS subnational2_code, region_code, grid_region, lat, lng FROM dim", "dim")
def location_dim(t: Tables) -> DataFrame:
    return t.dim.drop("cell_lat", "cell_lng")


@_query("SELECT region_code, grid_region, count(*) AS n FROM dim GROUP BY 1, 2", "dim")
def region_code_rules(t: Tables) -> DataFrame:
    return t.dim.groupBy("region_code", "grid_region").agg(F.count("*").alias("n"))


@_query("SELECT * FROM sa", "sa")
def samples_agg(t: Tables) -> DataFrame:
    return t.samples


@_query("SELECT * FROM oa", "oa")
def obs_agg(t: Tables) -> DataFrame:
    return t.observed


@_query("SELECT * FROM mo", "mo")
def month_obs(t: Tables) -> DataFrame:
    return t.month_obs


@_query("SELECT * FROM yo", "yo")
def year_obs(t: Tables) -> DataFrame:
    return t.year_obs


@_query("SELECT * FROM ys", "ys")
def year_samples(t: Tables) -> DataFrame:
    return counts.year_samples(t.samples, t.dim)


@_query("SELECT * FROM re", "re")
def regions_dense(t: Tables) -> DataFrame:
    return t.regions


@_query("SELECT re.id AS region_id, month, samples FROM rs JOIN re ON code = region_code", "rs", "re")
def region_month_samples(t: Tables) -> DataFrame:
    return counts.with_region_id(t.region_samples, t.regions)


@_query("SELECT re.id AS region_id, month, species_id, obs FROM ro JOIN re ON code = region_code", "ro", "re")
def region_month_obs(t: Tables) -> DataFrame:
    return counts.with_region_id(t.region_obs, t.regions)


@_query("SELECT * FROM hot", "hot")
def hotspots(t: Tables) -> DataFrame:
    return t.hotspots


@_query("SELECT * FROM yo WHERE species_id = 3 ORDER BY score DESC, location_id LIMIT 10", "yo")
def top_species_locations(t: Tables) -> DataFrame:
    return consumer.best_locations(t.year_obs, 3, 10)


@_query("SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY species_id ORDER BY score DESC, location_id) AS INTEGER) AS rank FROM yo) WHERE rank <= 10", "yo")
def best_of_each_species(t: Tables) -> DataFrame:
    return consumer.best_of_each(t.year_obs, 10)


@_query("SELECT location_id, species_id, obs, samples, score FROM (SELECT *, row_number() OVER (PARTITION BY species_id ORDER BY score DESC, location_id) AS k FROM yo WHERE species_id IN (2, 3, 4)) WHERE k <= 10", "yo")
def ranked_table(t: Tables) -> DataFrame:
    """Of three species, each from its bucket of a stored table."""
    name = f"ranked_{uuid.uuid4().hex}"
    sinks.write_ranked(t.year_obs, name, stored.passing(t.spark, name))
    return reduce(DataFrame.union, [consumer.best_ranked(t.spark.table(name), s, 10) for s in (2, 3, 4)])


@_query("SELECT count(*) AS rows, count(DISTINCT location_id) AS locations, count(DISTINCT species_id) AS species, CAST(coalesce(sum(obs), 0) AS BIGINT) AS obs FROM ma", "ma")
def global_counts(t: Tables) -> DataFrame:
    return counts.summary(t.matched)


@_query("SELECT * FROM co", "co")
def cell_obs(t: Tables) -> DataFrame:
    return t.cells.obs


@_query("SELECT * FROM cs", "cs")
def cell_samples(t: Tables) -> DataFrame:
    return t.cells.samples


@_query("SELECT * FROM wi", "wi")
def cell_region_winner(t: Tables) -> DataFrame:
    return rollup.winners(t.cells.regions)


@_query("SELECT * FROM ce", "ce")
def cell_refs(t: Tables) -> DataFrame:
    return t.grid_tables["h3_cells"]


@_query("SELECT * FROM ho", "ho")
def cell_obs_dense(t: Tables) -> DataFrame:
    return t.grid_tables["h3_cell_obs"]


@_query("SELECT DISTINCT cell FROM (SELECT cell FROM co UNION SELECT cell FROM cs) WHERE cell NOT IN (SELECT cell FROM wi)", "co", "cs", "wi")
def orphan_cells_anti(t: Tables) -> DataFrame:
    return rollup.orphans(t.after("dim", "samples").cells)


@_query(
    "SELECT 6 AS res, (SELECT count(DISTINCT cell) FROM co) AS cells, (SELECT count(DISTINCT cell) FROM (SELECT cell FROM co UNION SELECT cell FROM cs) WHERE cell NOT IN (SELECT cell FROM wi)) AS orphans, (SELECT CAST(sum(obs) AS BIGINT) FROM co) AS obs, (SELECT CAST(sum(samples) AS BIGINT) FROM cs) AS samples",
    "co", "cs", "wi",
)
def grid_stats(t: Tables) -> DataFrame:
    return rollup.stats(t.after("dim", "samples").cells)


@_query(f"SELECT {sql.parent('cell', 4)} AS cell, month, species_id, CAST(sum(obs) AS BIGINT) AS obs FROM co GROUP BY 1, 2, 3", "co")
def grid_rollup(t: Tables) -> DataFrame:
    return rollup.roll_up(t.cells, 4).obs


@_query(f"SELECT cell, region_code FROM (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY samples DESC, region_code) AS rn FROM (SELECT {sql.parent('cell', 3)} AS cell, region_code, sum(samples) AS samples FROM cr GROUP BY 1, 2)) WHERE rn = 1", "cr")
def rollup_winner(t: Tables) -> DataFrame:
    return rollup.winners(rollup.roll_up(rollup.roll_up(t.cells, 4), 3).regions)


@_query("SELECT * FROM lm", "lm")
def loc_meta(t: Tables) -> DataFrame:
    return t.loc_meta


@_query("SELECT * FROM ls", "ls")
def loc_species(t: Tables) -> DataFrame:
    return t.loc_species


@_query("SELECT * FROM lq", "lq")
def loc_qcount(t: Tables) -> DataFrame:
    return t.loc_qcount


@_query("SELECT * FROM zm", "zm")
def zone_meta(t: Tables) -> DataFrame:
    return t.zone_meta


@_query("SELECT * FROM zs", "zs")
def zone_species(t: Tables) -> DataFrame:
    return t.zone_species


@_query("SELECT res, CAST(b AS INTEGER) AS bucket, cell_ref, count(*) AS q_count FROM zs, range(5) AS r(b) WHERE bucket_level >= b GROUP BY 1, 2, 3", "zs")
def zone_qcount(t: Tables) -> DataFrame:
    return occurrences.qcount(t.zone_species, "res", "cell_ref")


@_query("SELECT * FROM lr", "lr")
def loc_cell_ref_left(t: Tables) -> DataFrame:
    return t.loc_cells


@_query(
    "SELECT 'u1' AS user_id, lq.loc_ref, q_count - coalesce(n, 0) AS lifers FROM lq LEFT JOIN (SELECT loc_ref, count(*) AS n FROM ls WHERE bucket_level >= 1 AND species_id % 3 = 0 GROUP BY 1) s ON s.loc_ref = lq.loc_ref WHERE bucket = 1", "lq", "ls"
)
def lifers(t: Tables) -> DataFrame:
    t.store("loc_species")
    return occurrences.lifers(t.loc_species, t.loc_qcount, t.seen, 1)


@_query("SELECT res, cell_ref, count(*) AS hotspots FROM lr WHERE cell_ref >= 0 GROUP BY 1, 2", "lr")
def hotspots_per_cell(t: Tables) -> DataFrame:
    return consumer.hotspots_per_cell(t.loc_cells)


@_query("SELECT * FROM mo WHERE location_id IN (SELECT id FROM hot WHERE region_code ILIKE 'r1-n%')", "mo", "hot")
def semi_join_region(t: Tables) -> DataFrame:
    own = t.hotspots.filter(packs.holds("region_code", "r1-n", "loose"))
    return t.month_obs.join(own.select(F.col("id").alias("location_id")), "location_id", "left_semi")


@_query("SELECT id, region_code FROM hot WHERE region_code ILIKE 'r2' OR region_code ILIKE 'r2-%'", "hot")
def region_prefix_filter(t: Tables) -> DataFrame:
    return t.hotspots.filter(packs.holds("region_code", "r2")).select("id", "region_code")


@_query("SELECT region FROM pk p WHERE NOT EXISTS (SELECT 1 FROM pk c WHERE c.region LIKE p.region || '-%')", "pk")
def finest_regions_anti(t: Tables) -> DataFrame:
    return dims.finest_regions(t.packs)


@_query("SELECT DISTINCT region FROM (SELECT 'R' || r || '-N' || n AS region FROM (SELECT CAST(n_regionkey % 3 AS VARCHAR) AS r, CAST(n_nationkey AS VARCHAR) AS n FROM nation)) WHERE region NOT IN (SELECT region FROM pk)", "pk")
def missing_regions(t: Tables) -> DataFrame:
    nation = t.spark.read.parquet(f"{t.d}/nation.parquet")
    wanted = nation.select(F.concat(F.lit("R"), (F.col("n_regionkey") % 3).cast("string"), F.lit("-N"), F.col("n_nationkey").cast("string")).alias("region"))
    return dims.missing_regions(wanted, t.packs)


@_query("SELECT p.region, c.code FROM pk p, (SELECT DISTINCT region_code AS code FROM hot WHERE region_code IS NOT NULL) c WHERE c.code = p.region OR c.code LIKE p.region || '-%'", "pk", "hot")
def pack_regions_strict(t: Tables) -> DataFrame:
    return packs.codes_of(t.packs, t.hotspots.select(F.col("region_code").alias("code")), "strict")


@_query(
    f"SELECT location_id, samples, species_id, obs FROM (SELECT location_id, {sql.months('samples', 'null')} AS samples FROM mo GROUP BY 1) JOIN (SELECT location_id, species_id, {sql.months('obs', '0')} AS obs FROM mo GROUP BY 1, 2) USING (location_id)", "mo"
)
def month_pivot(t: Tables) -> DataFrame:
    x = arrays.target_months(t.after("month_obs").month_obs).select("location_id", "samples", F.explode("species").alias("s"))
    return x.select("location_id", "samples", "s.species_id", "s.obs").select("location_id", _text("samples"), "species_id", _text("obs"))


@_query(
    f"SELECT cell_ref, coalesce(samples, '0,0,0,0,0,0,0,0,0,0,0,0') AS samples, coalesce(n, 0) AS n FROM (SELECT cell_ref, {sql.months('samples', '0')} AS samples FROM hs GROUP BY 1) FULL JOIN (SELECT cell_ref, count(DISTINCT species_id) AS n FROM ho GROUP BY 1) USING (cell_ref)", "hs", "ho"
)
def cells_full_outer(t: Tables) -> DataFrame:
    x = arrays.cell_months(t.grid_tables["h3_cell_obs"].drop("res"), t.grid_tables["h3_cell_samples"].drop("res"), "cell_ref")
    return x.select("cell_ref", _text("samples"), F.size("species").cast("bigint").alias("n"))


@_query("SELECT location_id, code, CAST(sum(obs) AS BIGINT) AS obs FROM mo JOIN code ON id = species_id WHERE code <> '' GROUP BY 1, 2", "mo", "code")
def species_name_lookup(t: Tables) -> DataFrame:
    codes = t.species.filter("code <> ''").select(F.col("id").alias("species_id"), "code")
    return t.month_obs.join(F.broadcast(codes), "species_id").groupBy("location_id", "code").agg(F.sum("obs").alias("obs"))


@_query("SELECT r.id AS species_id, coalesce(n, 0) AS n, CAST(coalesce(sum(n) OVER (ORDER BY r.id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS \"offset\" FROM (SELECT unnest(range(0, (SELECT max(id) FROM sp) + 2)) AS id) r LEFT JOIN (SELECT species_id, count(*) AS n FROM ls GROUP BY 1) c ON c.species_id = r.id", "sp", "ls")
def csr_offsets(t: Tables) -> DataFrame:
    return arrays.csr_offsets(t.loc_species, t.species)


@_query("SELECT loc_ref, coalesce(q_count, 0) AS q_count FROM lm LEFT JOIN (SELECT loc_ref, q_count FROM lq WHERE bucket = 3) USING (loc_ref)", "lm", "lq")
def dense_vector(t: Tables) -> DataFrame:
    return arrays.dense(t.loc_qcount.filter("bucket = 3"), "loc_ref", "q_count", t.loc_meta.agg(F.count("*").alias("n")))


@_query(
    "SELECT id, round(2 * 6371 * atan2(sqrt(h), sqrt(greatest(0, 1 - h))), 6) AS km FROM (SELECT id, power(sin((radians(lat) - radians(40.0)) / 2), 2) + cos(radians(40.0)) * cos(radians(lat)) * power(sin(radians(lng + 74.0) / 2), 2) AS h FROM hot WHERE lat IS NOT NULL)", "hot"
)
def haversine(t: Tables) -> DataFrame:
    km = geo.haversine_km(F.lit(40.0), F.lit(-74.0), F.col("lat"), F.col("lng"))
    return t.hotspots.filter("lat is not null").select("id", F.round(km, 6).alias("km"))


@_query("SELECT CAST(n AS BIGINT) AS n, CAST(CASE WHEN n <= 0 THEN 3 ELSE greatest(3, least(30, ceil(1.5 * log2(n)))) END AS BIGINT) AS k FROM range(2000) AS r(n)")
def desired_clusters(t: Tables) -> DataFrame:
    return t.spark.range(2000).select(F.col("id").alias("n"), geo.desired_clusters(F.col("id")).cast("bigint").alias("k"))


@_query(
    "SELECT d, CAST(date_trunc('month', CASE WHEN day(d) >= 15 THEN d - INTERVAL 1 MONTH ELSE d - INTERVAL 2 MONTH END) AS DATE) AS release, lower(strftime(CASE WHEN day(d) >= 15 THEN d - INTERVAL 1 MONTH ELSE d - INTERVAL 2 MONTH END, '%b-%Y')) AS slug FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)"
)
def release_calendar(t: Tables) -> DataFrame:
    days = t.spark.read.parquet(f"{t.d}/orders.parquet").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    m = calendar.release_month(F.col("d"))
    return days.select("d", m.alias("release"), calendar.slug(F.date_format(m, "MMM"), F.date_format(m, "yyyy")).alias("slug"))


@_query("SELECT id AS species_id FROM sp WHERE regexp_matches(lower('comun ' || sci_name), '(^|[^a-z0-9])brand') AND regexp_matches(lower(sci_name), '(^|[^a-z0-9])1')", "sp")
def search_prefix(t: Tables) -> DataFrame:
    return search.search(search.index(t.species), "BRAND 1")


#: Words put before names, by number of species, and what is looked for.
MARKED = ("Việt", "Øre", "Łabędź", "Ǹandú", "Ελλαδα", "Ёжик", "日本")
WANTED = ("VIET br", "ore", "øre 1", "łabedz brand", "labedz", "nandu", "ελλ", "日 standard", "e", "brand", "s", "viet viet plated tin")


def _wanted_sql() -> str:
    names = f"SELECT id, regexp_split_to_array(lower(strip_accents({list(MARKED)}[id % {len(MARKED)} + 1] || ' ' || sci_name)), '[^\\p{{L}}\\p{{N}}]+') AS t FROM sp"
    asks = ", ".join(f"('{q}', {search.words_of(q)})" for q in WANTED)
    return f"SELECT q AS query, id AS species_id FROM (VALUES {asks}) AS a(q, w), ({names}) WHERE len(list_filter(w, lambda x: len(list_filter(t, lambda y: starts_with(y, x))) > 0)) = len(w)"


@_query(_wanted_sql(), "sp")
def search_blocks(t: Tables) -> DataFrame:
    """Names in several scripts, with and without marks, found through stored posting lists."""
    names = t.species.withColumn("name", F.concat(F.get(F.array(*[F.lit(w) for w in MARKED]), (F.col("id") % len(MARKED)).cast("int")), F.lit(" "), "sci_name"))
    held = stored.store(t.spark, search.blocks(search.index(names)), "blocks")
    out = [search.find(held, q).select(F.lit(q).alias("query"), "species_id") for q in WANTED]
    return reduce(DataFrame.union, out)


@_query("SELECT species_id, month, CAST(o AS BIGINT) AS obs, CAST(s AS BIGINT) AS samples, CAST(o AS DOUBLE) / s AS frequency FROM (SELECT species_id, month, sum(obs) AS o FROM ho WHERE cell_ref % 2 = 0 GROUP BY 1, 2) JOIN (SELECT month, sum(samples) AS s FROM hs WHERE cell_ref % 2 = 0 GROUP BY 1) USING (month)", "ho", "hs")
def likely_in_area(t: Tables) -> DataFrame:
    area = t.grid_tables["h3_cells"].filter(F.col("cell_ref") % 2 == 0).select("res", "cell_ref")
    return consumer.likely_in_area(t.grid_tables["h3_cell_obs"], t.grid_tables["h3_cell_samples"], area)


@_query("SELECT re.id AS region_id, species_id, month, CAST(obs AS DOUBLE) / samples AS frequency FROM ro JOIN rs USING (region_code, month) JOIN re ON code = region_code", "ro", "rs", "re")
def region_chart(t: Tables) -> DataFrame:
    t.store("dim", "samples")
    return consumer.region_chart(counts.with_region_id(t.region_obs, t.regions), counts.with_region_id(t.region_samples, t.regions))


@_query("SELECT * FROM hot WHERE country_code = 'R1'", "hot")
def hotspots_of_country(t: Tables) -> DataFrame:
    return consumer.hotspots_of(t.hotspots, country_code="R1")


@_query(f"SELECT location_id, lower(hex(cell)) AS id, lower(hex({sql.parent('cell', 3)})) AS up FROM lc", "lc")
def cell_ids(t: Tables) -> DataFrame:
    x = rollup.cell_dim(t.dim, RES, t.grid)
    return x.select("location_id", geo.cell_hex(F.col("cell")).alias("id"), geo.cell_hex(geo.parent(F.col("cell"), 3)).alias("up"))


@_query("SELECT location_id, lower(hex(id)) AS id, round(lat, 6) AS lat, round(lng, 6) AS lng FROM hd WHERE k = 6", "hd")
def hex_cells(t: Tables) -> DataFrame:
    x = rollup.cell_dim(t.dim, RES, grid := hexgrid.Hexagons()).withColumn("c", grid.centre(F.col("cell")))
    return x.select("location_id", geo.cell_hex(F.col("cell")).alias("id"), F.round("c.lat", 6).alias("lat"), F.round("c.lng", 6).alias("lng"))


@_query(f"SELECT location_id, k AS res, lower(hex(CASE k {' '.join(f'WHEN {k} THEN {sql.parent("id", k)}' for k in range(6))} END)) AS up, round(lat, 6) AS lat, round(lng, 6) AS lng FROM hd WHERE k < 6", "hd")
def hex_parents(t: Tables) -> DataFrame:
    """Every coarser cell of a place's cell, and its centre."""
    grid = hexgrid.Hexagons()
    ups = F.explode(F.array(*[F.struct(F.lit(k).alias("res"), geo.parent(F.col("cell"), k).alias("up")) for k in range(RES)]))
    x = rollup.cell_dim(t.dim, RES, grid).select("location_id", ups.alias("u")).select("location_id", "u.*").withColumn("c", grid.centre(F.col("up")))
    return x.select("location_id", "res", geo.cell_hex(F.col("up")).alias("up"), F.round("c.lat", 6).alias("lat"), F.round("c.lng", 6).alias("lng"))


@_query(
    """, hc AS (SELECT id AS cell, max(lat) AS lat, max(lng) AS lng FROM hd WHERE k = 6 GROUP BY 1 HAVING max(region_code) IS NOT NULL),
    hl AS (SELECT location_id, id AS cell FROM hd WHERE k = 6),
    ed AS (SELECT area_id, lats[i] AS y, lngs[i] AS x, lats[i % len(lats) + 1] - lats[i] AS dy, (lngs[i % len(lats) + 1] - lngs[i] + 540) % 360 - 180 AS dx FROM ar, range(1, 6) AS r(i) WHERE lats IS NOT NULL),
    ins AS (
      SELECT area_id, cell FROM (SELECT area_id, cell, sum(CASE WHEN (w <= 0) <> (w + dx <= 0) AND y - lat - w / dx * dy > 0 THEN 1 ELSE 0 END) AS n, sum(dx) AS turn, sum(y) AS lats FROM (SELECT *, (((x - lng + 180) % 360) + 360) % 360 - 180 AS w FROM ed, hc) GROUP BY 1, 2)
      WHERE (n + CASE WHEN abs(turn) > 180 AND lats > 0 THEN 1 ELSE 0 END) % 2 = 1
      UNION SELECT area_id, cell FROM (SELECT *, power(sin((radians(lat) - radians(clat)) / 2), 2) + cos(radians(clat)) * cos(radians(lat)) * power(sin(radians(lng - clng) / 2), 2) AS h FROM ar, hc WHERE km IS NOT NULL) WHERE 2 * 6371 * atan2(sqrt(h), sqrt(greatest(0, 1 - h))) <= km
    ),
    ao AS (SELECT area_id, species_id, month, CAST(sum(obs) AS BIGINT) AS obs FROM oa JOIN hl USING (location_id) JOIN ins USING (cell) GROUP BY 1, 2, 3),
    am AS (SELECT area_id, month, CAST(sum(samples) AS BIGINT) AS samples FROM sa JOIN hl USING (location_id) JOIN ins USING (cell) GROUP BY 1, 2)
    SELECT area_id, species_id, month, obs, samples, CAST(obs AS DOUBLE) / samples AS frequency FROM ao JOIN am USING (area_id, month)""",
    "hd", "ar", "oa", "sa",
)
def area_species(t: Tables) -> DataFrame:
    """Polygons and circles, some across the date line: the most likely species of each month."""
    t.store("dim", "samples")
    held = stored.store(t.spark, areas.members(t.hex_tables["h3_cells"], areas.cover(t.areas, DEPTH), RES, DEPTH), "held")
    return areas.species(t.hex_tables["h3_cell_obs"], t.hex_tables["h3_cell_samples"], held)


@_query("SELECT n_name, string_agg(upper(x), '|' ORDER BY i) AS codes FROM (SELECT n_name, unnest(['us', 'ca', n_name]) AS x, unnest([1, 2, 3]) AS i FROM nation) GROUP BY 1")
def parse_region_list(t: Tables) -> DataFrame:
    raw = F.concat(F.lit(" us, ca ,, "), F.col("n_name"), F.lit(" "))
    return t.spark.read.parquet(f"{t.d}/nation.parquet").select("n_name", F.array_join(regions.parse_list(raw), "|").alias("codes"))


@_query("SELECT location_id, month, species_id, count(*) AS rows FROM (SELECT * FROM mo UNION ALL SELECT * FROM mo WHERE species_id % 5 = 0) GROUP BY 1, 2, 3 HAVING count(*) > 1", "mo")
def key_violations(t: Tables) -> DataFrame:
    """Of a table in which some rows stand twice."""
    return sinks.violations(t.month_obs.unionByName(t.month_obs.filter("species_id % 5 = 0")), "month_obs")


@_query("SELECT cell, x - coalesce(lag(x) OVER (PARTITION BY cell ORDER BY x), 0) AS step, x AS species_id FROM (SELECT DISTINCT cell, species_id AS x FROM co)", "co")
def species_deltas(t: Tables) -> DataFrame:
    x = t.cells.obs.select("cell", "species_id").distinct()
    return x.select("cell", (F.col("species_id") - F.coalesce(F.lag("species_id").over(W.partitionBy("cell").orderBy("species_id")), F.lit(0))).alias("step"), "species_id")


@_query("SELECT * FROM hs", "hs")
def cell_samples_dense(t: Tables) -> DataFrame:
    return t.grid_tables["h3_cell_samples"]


@_query("SELECT * FROM lz", "lz")
def loc_zone_h3(t: Tables) -> DataFrame:
    return t.loc_zone


@_query("SELECT * FROM cz", "cz")
def child_zone(t: Tables) -> DataFrame:
    return occurrences.child_zone(t.grid_tables["h3_cells"], t.zone_meta, ZONES, RES)


@_query("SELECT id, code, 'Común ' || sci_name AS name, sci_name, lower(sci_name) AS sci_lower, lower('Común ' || sci_name) AS name_lower, CAST(id AS DOUBLE) AS taxon_order FROM code", "code")
def species_lookup(t: Tables) -> DataFrame:
    return search.lookup(t.species)


@_query("SELECT n AS read, w AS written, n - w AS skipped FROM (SELECT count(*) * 3 AS n FROM lineitem), (SELECT count(*) AS w FROM ob)", "ob")
def ingest_counters(t: Tables) -> DataFrame:
    return ingest.counters(analog.raw_observations(t.spark, t.d), t.observations)


@_query("SELECT location_id, species_id, CAST(sum(1 << CAST(month - 1 AS INTEGER)) AS INTEGER) AS mask FROM mo GROUP BY 1, 2", "mo")
def month_mask(t: Tables) -> DataFrame:
    return arrays.month_masks(t.month_obs, "location_id", "species_id")


@_query("SELECT id, round_even(lat / 7 * 1000, 0) / 1000 AS lat, round_even(lng / 7 * 1000, 0) / 1000 AS lng FROM hot", "hot")
def coordinates_rounded(t: Tables) -> DataFrame:
    return t.hotspots.select("id", geo.round3(F.col("lat") / 7).alias("lat"), geo.round3(F.col("lng") / 7).alias("lng"))


@_query(f"SELECT location_id, species_id, {sql.level('score')} AS bucket_level FROM yo", "yo")
def bucket_levels(t: Tables) -> DataFrame:
    return t.year_obs.select("location_id", "species_id", score.bucket_level(F.col("score")).alias("bucket_level"))


@_query("SELECT location_id, month, species_id, obs, samples FROM ma", "ma")
def obs_with_samples(t: Tables) -> DataFrame:
    return t.matched


@_query("SELECT * FROM mo WHERE species_id = 5 AND month = 6 ORDER BY score DESC, location_id LIMIT 10", "mo")
def top_locations_of_month(t: Tables) -> DataFrame:
    return consumer.best_locations(t.month_obs, 5, 10, 6)


def _api(t: Tables) -> DataFrame:
    where = packs.codes_of(dims.finest_regions(t.packs), t.hotspots.select(F.col("region_code").alias("code")), "strict").withColumnRenamed("code", "region_code")
    return t.hotspots.join(where, "region_code").select("region", "id", "name", "country_code", "subnational1_code", "subnational2_code", "lat", "lng", F.lit(0).cast("bigint").alias("species"))


def _kcenter_sql() -> str:
    """Each region's points in order of id; the farthest from the centres so far is the next, until there are k."""
    radians = lambda c: f"radians({c})"
    h = f"power(sin((radians(la[nx]) - radians(la[i])) / 2), 2) + cos(radians(la[i])) * cos(radians(la[nx])) * power(sin(radians(lo[nx] - lo[i]) / 2), 2)"
    km = f"2 * {geo.EARTH_KM} * atan2(sqrt({h}), sqrt(greatest(0, 1 - ({h}))))"
    return f"""SELECT region, CAST(place AS BIGINT) AS place, lat, lng FROM (
WITH RECURSIVE p AS (
  SELECT f.region, hot.id, hot.lat, hot.lng FROM (SELECT region FROM pk WHERE NOT EXISTS (SELECT 1 FROM pk c WHERE c.region LIKE pk.region || '-%')) f
  JOIN hot ON lower(hot.region_code) = lower(f.region) OR lower(hot.region_code) LIKE lower(f.region) || '-%' WHERE hot.lat IS NOT NULL AND hot.lng IS NOT NULL
), g AS (SELECT region, list(lat ORDER BY id) AS la, list(lng ORDER BY id) AS lo, count(*) AS n, least(30, greatest(3, CAST(ceil(1.5 * log2(count(*))) AS INT))) AS k FROM p GROUP BY 1),
s AS (
  SELECT region, la, lo, n, k, 1 AS step, CAST(1 AS BIGINT) AS nx, list_transform(la, lambda x: CAST('inf' AS DOUBLE)) AS near FROM g
  UNION ALL
  SELECT region, la, lo, n, k, step + 1, CASE WHEN k >= n THEN step + 1 ELSE list_position(d, list_max(d)) END, d FROM (
    SELECT *, list_transform(range(1, n + 1), lambda i: CASE WHEN i = nx OR near[i] = -1 THEN CAST(-1 AS DOUBLE) ELSE least(near[i], {km}) END) AS d FROM s WHERE step < least(k, n))
)
SELECT region, step - 1 AS place, round(la[nx], 3) AS lat, round(lo[nx], 3) AS lng FROM s)"""


@_query(_kcenter_sql(), "pk", "hot")
def kcenter(t: Tables) -> DataFrame:
    x = cluster.clusters(_api(t).select("region", "id", "lat", "lng"))
    return x.select("region", F.posexplode("clusters").alias("place", "c")).select("region", F.col("place").cast("bigint").alias("place"), F.col("c")[0].alias("lat"), F.col("c")[1].alias("lng"))


#: Regions of packs with the codes that they hold: in a column of a table, strictly or by any prefix.
def _held_sql(table: str, loose: bool = False) -> str:
    below = "lower(x.region_code) LIKE lower(f.region) || '%'" if loose else "(lower(x.region_code) = lower(f.region) OR lower(x.region_code) LIKE lower(f.region) || '-%')"
    return f"SELECT f.region, x.* FROM (SELECT region FROM pk WHERE NOT EXISTS (SELECT 1 FROM pk c WHERE c.region LIKE pk.region || '-%')) f JOIN {table} x ON {below}"


def _pack_sql() -> str:
    """The text of every document, in pieces."""
    json = lambda c: f"CAST(to_json({c}) AS VARCHAR)"
    named = lambda c: f"(SELECT {json(repr('Region ').replace(chr(34), chr(39)) + f' || pk.region')} FROM pk WHERE pk.region = {c})"
    may = lambda key, text: f"coalesce(',\"{key}\":' || {text}, '')"
    hotspot = (
        f"""'{{"id":' || {json('id')} || ',"name":' || {json('name')} || ',"species":0' || {may('lat', 'CAST(lat AS VARCHAR)')} || {may('lng', 'CAST(lng AS VARCHAR)')} || {may('country', json('country_code'))}"""
        f""" || {may('countryName', f"coalesce({named('country_code')}, {json('country_code')})")} || {may('state', json('subnational1_code'))} || {may('county', json('subnational2_code'))} || {may('stateName', named('subnational1_code'))} || {may('countyName', named('subnational2_code'))} || '}}'"""
    )
    row = f"""'["' || code || '",' || {sql.months('obs', '0')} || ']'"""
    lists = lambda key: f"""(SELECT {key}, string_agg(j, ',' ORDER BY species_id) AS species FROM (SELECT {key}, species_id, {row} AS j FROM {{}} JOIN code ON id = species_id WHERE code <> '' GROUP BY {key}, species_id, code) GROUP BY 1)"""
    three = lambda c: f"CAST(round_even({c} * 1000, 0) / 1000 AS VARCHAR)"
    none = ",".join("0" * arrays.MONTHS)
    return f""", h AS (SELECT region, id AS key, {hotspot} AS text FROM ({_held_sql('hot')})),
    t AS (SELECT region, location_id AS key, '{{"id":' || {json('location_id')} || ',"samples":[' || samples || '],"species":[' || coalesce(species, '') || ']}}' AS text
      FROM ({_held_sql('hot', True)}) q JOIN (SELECT location_id, {sql.months('samples', 'null')} AS samples FROM mo GROUP BY 1) ON location_id = q.id LEFT JOIN {lists('location_id').format('mo')} USING (location_id)),
    c AS (SELECT region, lower(hex(h3)) AS key, '{{"id":"' || lower(hex(h3)) || '","lat":' || {three('lat')} || ',"lng":' || {three('lng')} || ',"samples":[' || coalesce(samples, '{none}') || '],"species":[' || coalesce(species, '') || ']}}' AS text
      FROM ({_held_sql('ce')}) LEFT JOIN (SELECT cell_ref, {sql.months('samples', '0')} AS samples FROM hs GROUP BY 1) USING (cell_ref) LEFT JOIN {lists('cell_ref').format('ho')} USING (cell_ref)),
    w AS (SELECT region, 0 AS part, '' AS key, '{{"v":{packs.LAYOUT},"updatedAt":"2024-01-01T00:00:00Z","hotspots":[' AS text FROM h GROUP BY 1
      UNION ALL SELECT region, 1, key, text FROM h UNION ALL SELECT region, 2, '', '],"targets":[' FROM h GROUP BY 1
      UNION ALL SELECT region, 3, key, text FROM t WHERE region IN (SELECT region FROM h) UNION ALL SELECT region, 4, '', '],"h3res":{RES},"cells":[' FROM h GROUP BY 1
      UNION ALL SELECT region, 5, key, text FROM c WHERE region IN (SELECT region FROM h) UNION ALL SELECT region, 6, '', ']}}' FROM h GROUP BY 1)
    SELECT region, piece, string_agg(text, '' ORDER BY place) AS document FROM (SELECT region, place, CAST(place // {packs.PIECE} AS BIGINT) AS piece, CASE WHEN part % 2 = 1 AND before = part THEN ',' ELSE '' END || text AS text FROM (
      SELECT *, row_number() OVER o - 1 AS place, lag(part) OVER o AS before FROM w WINDOW o AS (PARTITION BY region ORDER BY part, key, text))) GROUP BY 1, 2"""


@_query(_pack_sql(), "pk", "hot", "mo", "code", "ce", "hs", "ho")
def pack_json(t: Tables) -> DataFrame:
    t.store("dim", "samples", "observed")
    finest = dims.finest_regions(t.packs)
    names = t.packs.select(F.col("region").alias("code"), F.concat(F.lit("Region "), "region").alias("name"))
    g = t.grid_tables
    targets = packs.pack_targets(finest, t.hotspots, t.month_obs, t.species)
    cells = packs.pack_cells(finest, g["h3_cells"], g["h3_cell_obs"], g["h3_cell_samples"], t.species, RES)
    return packs.documents("2024-01-01T00:00:00Z", packs.pack_hotspots(_api(t), names), targets, cells, RES)


@_query(
    f"""SELECT region, lower(hex(h3)) AS id, coalesce(samples, '{",".join("0" * arrays.MONTHS)}') AS samples, species_id, obs FROM ({_held_sql("ce")}) LEFT JOIN (SELECT cell_ref, {sql.months("samples", "0")} AS samples FROM hs GROUP BY 1) USING (cell_ref) LEFT JOIN (SELECT cell_ref, species_id, {sql.months("obs", "0")} AS obs FROM ho GROUP BY 1, 2) USING (cell_ref)""", "pk", "ce", "hs", "ho"
)
def pack_binary(t: Tables) -> DataFrame:
    """Every pack, written and read back."""
    t.store("dim", "samples", "observed")
    g = t.grid_tables
    pieces = stored.store(t.spark, packs.binary_packs(g["h3_cells"], g["h3_cell_obs"], g["h3_cell_samples"], dims.finest_regions(t.packs), RES), "pieces")
    x = packs.unpacked(pieces).select("region", geo.cell_hex(F.col("h3")).alias("id"), "samples", F.explode_outer("species").alias("s"))
    return x.select("region", "id", _text("samples"), "s.species_id", "s.obs").select("region", "id", "samples", "species_id", _text("obs"))


#: Boxes by south, west, north, east: one across the date line, one that is a line.
BOXES = {"north": (20.0, -100.0, 60.0, 40.5), "line": (-60.0, 170.0, 10.25, -150.0), "pole": (-90.0, -180.0, -75.0, 180.0), "thin": (-40.0, -30.0, 40.0, -30.0)}


@_query(" UNION ALL ".join(f"SELECT '{name}' AS box, id, lat, lng FROM hot WHERE lat BETWEEN {s} AND {n} AND (lng BETWEEN {w} AND {e}{' OR false' if w <= e else f' OR lng >= {w} OR lng <= {e}'})" for name, (s, w, n, e) in BOXES.items()), "hot")
def places_in_boxes(t: Tables) -> DataFrame:
    """From a table along the curve."""
    places.write(t.hotspots, path := stored.passing(t.spark, "places"))
    held = t.spark.read.parquet(path)
    return reduce(DataFrame.union, [places.in_box(held, *box).select(F.lit(name).alias("box"), "id", "lat", "lng") for name, box in BOXES.items()])


_KM_SQL = f"round(2 * {geo.EARTH_KM} * atan2(sqrt(h), sqrt(greatest(0, 1 - h))), 9)"


@_query(
    f"""SELECT point_id, CAST(rank AS INTEGER) AS rank, id, round(km, 6) AS km FROM (SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY km, id) AS rank FROM (SELECT point_id, id, {_KM_SQL} AS km FROM (
      SELECT location_id AS point_id, hot.id, power(sin((radians(hot.lat) - radians(dim.lat)) / 2), 2) + cos(radians(dim.lat)) * cos(radians(hot.lat)) * power(sin(radians(hot.lng - dim.lng) / 2), 2) AS h
      FROM dim, hot WHERE locality_type <> 'H' AND dim.lat IS NOT NULL AND dim.lng IS NOT NULL AND hot.lat IS NOT NULL AND hot.lng IS NOT NULL))) WHERE rank <= 5""", "dim", "hot"
)
def nearest_hotspots(t: Tables) -> DataFrame:
    """Of each personal location."""
    t.store("dim")
    points = t.dim.filter(~dims.is_hotspot()).select(F.col("location_id").alias("point_id"), "lat", "lng")
    return places.nearest(points, t.hotspots, 5).withColumn("km", F.round("km", 6))


def _blob_sql() -> str:
    """Every element of every blob."""
    out = []

    def family(name: str, meta: str, levels: str, counts_: str, ref: str, more: str = "") -> None:
        out.append(f"SELECT '{name}:samples' AS key, {ref} AS place, samples AS value, CAST(0 AS DOUBLE) AS real FROM {meta}")
        out.extend(f"SELECT '{name}:{c}', {ref}, 0, CAST(CAST(coalesce({c}, 0) AS FLOAT) AS DOUBLE) FROM {meta}" for c in ("lat", "lng"))
        out.append(f"SELECT '{name}:qcount', b * (SELECT max({ref}) + 1 FROM {meta}) + m.{ref}, coalesce(q_count, 0), 0 FROM {meta} m CROSS JOIN range({len(score.BUCKETS)}) AS r(b) LEFT JOIN {counts_} q ON q.bucket = b AND q.{ref} = m.{ref}")
        out.append(f"SELECT '{name}:spOff', s, (SELECT count(*) FROM {levels} WHERE species_id < s), 0 FROM range((SELECT max(species_id) + 2 FROM {levels})) AS r(s)")
        out.extend(f"SELECT '{name}:{k}', row_number() OVER (ORDER BY species_id, {ref}) - 1, {v}, 0 FROM {levels}" for k, v in (("csrRef", ref), ("csrLvl", "bucket_level")))
        if more:
            out.append(f"SELECT '{name}:h3', {ref}, h3, 0 FROM {meta}")

    family("loc", "lm", "ls", "lq", "loc_ref")
    for r in ZONES:
        out.append(f"SELECT 'loc:cellRef:{r}', loc_ref, cell_ref, 0 FROM lr WHERE res = {r}")
        counts_ = f"(SELECT CAST(b AS INTEGER) AS bucket, cell_ref, count(*) AS q_count FROM zs, range({len(score.BUCKETS)}) AS r(b) WHERE res = {r} AND bucket_level >= b GROUP BY 1, 2)"
        family(f"zone:{r}", f"(SELECT * FROM zm WHERE res = {r})", f"(SELECT * FROM zs WHERE res = {r})", counts_, "cell_ref", "h3")
    return "SELECT key, CAST(place AS BIGINT) AS place, CAST(value AS BIGINT) AS value, real FROM (" + " UNION ALL ".join(out) + ")"


@_query(_blob_sql(), "lm", "ls", "lq", "lr", "zm", "zs")
def blob_cache(t: Tables) -> DataFrame:
    """Every blob, packed and read back. Each blob reads one of few tables, which are stored."""
    t.store("samples", "observed", "dim", "year_obs", "loc_meta", "loc_species", "zone_meta", "zone_species", "loc_cells")
    zone_counts = occurrences.qcount(t.zone_species, "res", "cell_ref")
    tables = {"loc_species": t.loc_species, "loc_meta": t.loc_meta, "loc_qcount": t.loc_qcount, "loc_cell_ref": t.loc_cells, "zone_meta": t.zone_meta, "zone_species": t.zone_species, "zone_qcount": zone_counts}
    vectors, sizes = pipeline.blob_vectors(tables, ZONES)
    return arrays.elements(arrays.blobs(vectors, sizes), sizes).withColumnRenamed("at", "place")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, d, f=f: f(Tables(spark, d))) for name, f in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Year score of each (location, species), best first."""
    return Tables(spark, d).year_obs.orderBy(F.desc("score"), "location_id", "species_id")
