"""SQL twins of the queries, for another engine to run on the driver's tables."""

from __future__ import annotations

from ..functions import geo, hexgrid
from ..functions.score import BUCKETS, Z

_D = "CAST({} AS DOUBLE)".format
_HEAD = (geo.MODE << 59)


def wilson(o: str, n: str) -> str:
    z, zz = _D(Z), Z * Z
    o, n = _D(o), _D(n)
    return f"(({o} + {_D(zz / 2)} - {z} * sqrt({o} * ({n} - {o}) / {n} + {_D(zz / 4)})) / ({n} + {_D(zz)}))"


def level(x: str) -> str:
    return "CAST(" + " + ".join(f"CASE WHEN {x} >= {_D(t)} THEN 1 ELSE 0 END" for t in BUCKETS) + " - 1 AS INTEGER)"


def cell(lat: str, lng: str, res: int) -> str:
    size = 1 << geo.DEPTH
    qa = f"CAST(least(floor(({lat} + 90) / 180 * {geo.ROWS} * {size}), {geo.ROWS * size - 1}) AS BIGINT)"
    qo = f"CAST(least(floor(({lng} + 180) / 360 * {geo.COLUMNS} * {size}), {geo.COLUMNS * size - 1}) AS BIGINT)"
    terms = [f"({_HEAD | (res << 52) | ((1 << 3 * (geo.DEPTH - res)) - 1)})", f"(((({qa}) >> 15) * {geo.COLUMNS} + (({qo}) >> 15)) << 45)"]
    for r in range(1, res + 1):
        d = f"(((({qa}) >> {15 - r}) & 1) * 2 + ((({qo}) >> {15 - r}) & 1))"
        terms.append(f"({d} << {3 * (15 - r)})")
    return "(" + " + ".join(terms) + ")"


def parent(c: str, res: int) -> str:
    return f"((({c}) & {~(15 << 52)}) | {(res << 52) | ((1 << 3 * (15 - res)) - 1)})"


def centre(c: str, res: int, lat: bool) -> str:
    first = f"((({c}) >> 45) & 127) // {geo.COLUMNS}" if lat else f"((({c}) >> 45) & 127) % {geo.COLUMNS}"
    bit = 1 if lat else 0
    n = " + ".join([f"(CAST({first} AS BIGINT) << {res})", *[f"((((({c}) >> {3 * (15 - r)}) & 7) >> {bit} & 1) << {res - r})" for r in range(1, res + 1)]])
    step, low = (180 / geo.ROWS, 90) if lat else (360 / geo.COLUMNS, 180)
    return f"(({n}) + {_D(0.5)}) / {_D(1 << res)} * {_D(step)} - {low}"


def _months(value: str, default: str) -> str:
    return "concat_ws(',', " + ", ".join(f"coalesce(CAST(max(CASE WHEN month = {m} THEN {value} END) AS VARCHAR), '{default}')" for m in range(1, 13)) + ")"


def _settled(rows: str, keep: str) -> str:
    """rows: keep, f, a, b, k. A centre in the coordinates of its first face, and the turn on the way."""
    r, at = hexgrid.RULES, lambda v, i: f"{list(v)}[{i} + 1]"
    firsts, units = [hexgrid.CORNERS[c] for c in r.first_corner], [hexgrid.UNITS[k] for k in r.turn]
    ca, cb, ua, ub, ta, tb = (at([x[j] for x in v], i) for v, i in ((firsts, "3 * f + c"), (units, "3 * f + e"), (r.shift, "3 * f + e")) for j in (0, 1))
    over = f"{ua} * a - {ub} * b + {ta} * sa - {tb} * sb", f"{ua} * b + {ub} * a + {ub} * b + {ta} * sb + {tb} * sa + {tb} * sb"
    there = f"{ca} * sa - {cb} * sb", f"{ca} * sb + {cb} * sa + {cb} * sb"
    pick = lambda x, y, z: f"CASE WHEN c IS NOT NULL THEN {x} WHEN e IS NOT NULL THEN {y} ELSE {z} END"
    return f"""SELECT {keep}, k, {pick(at(r.first, '3 * f + c'), at(r.across, '3 * f + e'), 'f')} AS f, {pick(there[0], over[0], 'a')} AS a, {pick(there[1], over[1], 'b')} AS b, {pick(at(r.first_turn, '3 * f + c'), at(r.turn, '3 * f + e'), '0')} AS turn FROM (
      SELECT *, CASE WHEN p = 0 AND q = 0 THEN 0 WHEN p = n THEN 1 WHEN q = n THEN 2 END AS c,
      CASE WHEN p + q > n THEN 0 WHEN p < 0 THEN 1 WHEN q < 0 THEN 2 WHEN p + q = n AND {at(r.across, '3 * f')} < f THEN 0 WHEN p = 0 AND {at(r.across, '3 * f + 1')} < f THEN 1 WHEN q = 0 AND {at(r.across, '3 * f + 2')} < f THEN 2 END AS e FROM (
        SELECT *, a * (sa + sb) + b * sb AS p, b * sa - a * sb AS q FROM (SELECT *, {at([x for x, _ in r.sides], 'k')} AS sa, {at([y for _, y in r.sides], 'k')} AS sb, {at(r.norms, 'k')} AS n FROM ({rows}))))"""


def _hexagons(points: str, res: int) -> str:
    """location_id, region_code, k, f, a, b, id: the states of a place's cell and of its parents down to k = 0, where id is the cell's. points: location_id, region_code, lat, lng."""
    r = hexgrid.RULES
    dots = ", ".join(f"x * {_D(m[0])} + y * {_D(m[1])} + z * {_D(m[2])}" for m in r.middles)
    share = lambda j: " + ".join(f"{[m[3 * j + i] for m in r.shares]}[f + 1] * {c}" for i, c in enumerate("xyz"))
    sa, sb = r.sides[res]
    start = f"""SELECT location_id, region_code, {res} AS k, f, CAST(CASE WHEN da > db AND da > dc THEN -rb - rc ELSE ra END AS BIGINT) AS a, CAST(CASE WHEN db >= da AND db > dc THEN -ra - rc ELSE rb END AS BIGINT) AS b FROM (
      SELECT *, abs(ra - a) AS da, abs(rb - b) AS db, abs(rc + a + b) AS dc FROM (SELECT *, round_even(a, 0) AS ra, round_even(b, 0) AS rb, round_even(-a - b, 0) AS rc FROM (
        SELECT location_id, region_code, f, ({sa} * v - {sb} * w) / (u + v + w) AS a, ({sa} * w + {sb} * v + {sb} * w) / (u + v + w) AS b FROM (SELECT *, {share(0)} AS u, {share(1)} AS v, {share(2)} AS w FROM (
          SELECT *, list_position(d, list_max(d)) - 1 AS f FROM (SELECT *, [{dots}] AS d FROM (
            SELECT location_id, region_code, cos(radians(lat)) * cos(radians(lng - {_D(hexgrid.TURNED)})) AS x, cos(radians(lat)) * sin(radians(lng - {_D(hexgrid.TURNED)})) AS y, sin(radians(lat)) AS z FROM {points})))))))"""
    head = (hexgrid.MODE << 59) | (res << 52) | ((1 << 3 * (hexgrid.DEPTH - res)) - 1)
    ua, ub = ([0, *[x[j] for x in hexgrid.UNITS]] for j in (0, 1))
    away = f"{r.direction}[(((a + {hexgrid.ROOT} * b) % {hexgrid.NORM}) + {hexgrid.NORM}) % {hexgrid.NORM} + 1]"
    # (a - ua) + (b - ub)w, times the conjugate of the step, by its norm.
    up = f"SELECT location_id, region_code, id, d, k - 1 AS k, f, ((a - {ua}[d + 2]) * 3 + (b - {ub}[d + 2])) // 7 AS a, ((b - {ub}[d + 2]) * 2 - (a - {ua}[d + 2])) // 7 AS b FROM (SELECT *, {away} AS d FROM s WHERE k > 0)"
    step = f"SELECT location_id, region_code, k, f, a, b, id + CASE WHEN d < 0 THEN 0 ELSE (d + turn) % 6 + 1 END * (CAST(1 AS BIGINT) << (3 * ({hexgrid.DEPTH} - k - 1))) AS id FROM ({_settled(up, 'location_id, region_code, id, d')})"
    first = f"SELECT location_id, region_code, k, f, a, b, CAST({head} AS BIGINT) AS id FROM ({_settled(start, 'location_id, region_code')})"
    return f"""WITH RECURSIVE s AS ({first} UNION ALL {step})
      SELECT location_id, region_code, k, f, a, b, max(CASE WHEN k = 0 THEN id + (CAST({r.base}[f * 25 + (a + 2) * 5 + b + 1] AS BIGINT) << 45) END) OVER (PARTITION BY location_id) AS id FROM s"""


def hex_centre(rows: str, keep: str) -> str:
    """keep, lat, lng of states f, a, b, k."""
    r = hexgrid.RULES
    part = ["n - p - q", "p", "q"]
    ends = lambda j: " + ".join(f"({part[i]}) * {[r.corners[face[i]][j] for face in r.faces]}[f + 1]" for i in range(3))
    return f"""SELECT {keep}, degrees(atan2(z, sqrt(x * x + y * y))) AS lat, CASE WHEN o >= 180 THEN o - 360 ELSE o END AS lng FROM (SELECT *, degrees(atan2(y, x)) + {_D(hexgrid.TURNED)} AS o FROM (SELECT *, {ends(0)} AS x, {ends(1)} AS y, {ends(2)} AS z FROM (
      SELECT *, a * (sa + sb) + b * sb AS p, b * sa - a * sb AS q FROM (SELECT *, {[x for x, _ in r.sides]}[k + 1] AS sa, {[y for _, y in r.sides]}[k + 1] AS sb, {r.norms}[k + 1] AS n FROM ({rows})))))"""


#: name -> (what it reads, text). Each may use those before it.
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "loc": ((), """SELECT *, CASE WHEN k % 77 = 0 THEN '' ELSE c0 END AS country_code, CASE WHEN k % 77 = 0 THEN '' ELSE s0 END AS state_code,
      CASE WHEN k % 4 = 0 AND k % 7 <> 0 AND k % 11 <> 0 THEN s0 || '-C' || CAST(k % 3 AS VARCHAR) ELSE '' END AS county_code
      FROM (SELECT *, CASE WHEN k % 7 = 0 THEN c0 || '-' WHEN k % 11 = 0 THEN '' ELSE c0 || '-N' || CAST(n AS VARCHAR) END AS s0
      FROM (SELECT s_suppkey AS k, n_nationkey AS n, CAST(s_suppkey AS VARCHAR) AS location_id, s_name AS locality, CASE WHEN s_suppkey % 5 = 0 THEN 'P' ELSE 'H' END AS locality_type,
      'R' || CAST(n_regionkey AS VARCHAR) AS c0, CASE WHEN s_suppkey % 13 <> 0 THEN CAST((s_suppkey * 37) % 18000 AS DOUBLE) / CAST(100 AS DOUBLE) - 90 END AS lat,
      CAST((s_suppkey * 91) % 36000 AS DOUBLE) / CAST(100 AS DOUBLE) - 180 AS lng FROM supplier JOIN nation ON s_nationkey = n_nationkey))"""),
    "cl": (("loc",), """SELECT loc.*, CAST(l_orderkey AS VARCHAR) AS event_id, CASE WHEN l_orderkey % 5 = 0 THEN 'G' || CAST(l_orderkey - l_orderkey % 10 AS VARCHAR) ELSE '' END AS group_id,
      CAST(o_orderdate AS DATE) AS observed_on, CAST(month(o_orderdate) AS BIGINT) AS month
      FROM (SELECT DISTINCT l_suppkey, l_orderkey FROM lineitem WHERE l_orderkey % 17 <> 0) JOIN orders ON l_orderkey = o_orderkey JOIN loc ON k = l_suppkey"""),
    "ob": ((), """SELECT CAST(l_suppkey AS VARCHAR) AS location_id, CAST(o_orderdate AS DATE) AS observed_on, CAST(month(o_orderdate) AS BIGINT) AS month, CAST(l_orderkey AS VARCHAR) AS event_id,
      CASE WHEN l_orderkey % 5 = 0 THEN 'G' || CAST(l_orderkey - l_orderkey % 10 AS VARCHAR) ELSE '' END AS group_id, unnest([p_brand, p_type, 'RF-' || l_returnflag]) AS sci_name
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE l_orderkey % 17 <> 0 AND l_linenumber <> 7"""),
    "sp": ((), """SELECT sci_name, CAST(row_number() OVER (ORDER BY sci_name) AS BIGINT) AS id FROM
      (SELECT p_brand AS sci_name FROM part UNION SELECT p_type FROM part UNION SELECT 'RF-' || l_returnflag FROM lineitem) WHERE sci_name <> 'RF-A'"""),
    "code": (("sp",), "SELECT id, sci_name, CASE WHEN id % 10 = 0 THEN '' ELSE 's' || CAST(id AS VARCHAR) END AS code FROM sp"),
    "dim": (("cl",), """SELECT *, coalesce(nullif(cc, ''), sub1, nullif(cy, '')) AS region_code, coalesce(sub1, nullif(cy, '')) AS grid_region FROM
      (SELECT location_id, max(locality) AS name, max(locality_type) AS locality_type, max(country_code) AS cy, max(county_code) AS cc,
      CASE WHEN length(max(state_code)) > length(split_part(max(state_code), '-', 1)) + 1 THEN max(state_code) END AS sub1, max(lat) AS lat, max(lng) AS lng,
      max(CASE WHEN lat IS NOT NULL AND lng IS NOT NULL THEN lat END) AS clat, max(CASE WHEN lat IS NOT NULL AND lng IS NOT NULL THEN lng END) AS clng FROM cl GROUP BY 1)"""),
    "sa": (("cl",), "SELECT location_id, month, count(DISTINCT coalesce(nullif(group_id, ''), event_id)) AS samples FROM cl GROUP BY 1, 2"),
    "oa": (("ob", "sp"), "SELECT location_id, month, id AS species_id, count(DISTINCT coalesce(nullif(group_id, ''), event_id)) AS obs FROM ob JOIN sp USING (sci_name) GROUP BY 1, 2, 3"),
    "ma": (("oa", "sa"), "SELECT location_id, month, species_id, obs, samples FROM oa JOIN sa USING (location_id, month)"),
    "hot": (("dim",), "SELECT location_id AS id, name, nullif(cy, '') AS country_code, sub1 AS subnational1_code, nullif(cc, '') AS subnational2_code, region_code, lat, lng FROM dim WHERE locality_type = 'H'"),
    "mo": (("ma", "hot"), f"SELECT location_id, month, species_id, obs, samples, {wilson('obs', 'samples')} AS score FROM ma WHERE location_id IN (SELECT id FROM hot)"),
    "ys": (("sa", "hot"), "SELECT location_id, CAST(sum(samples) AS BIGINT) AS samples FROM sa WHERE location_id IN (SELECT id FROM hot) GROUP BY 1"),
    "yo": (("ma", "ys"), f"""SELECT location_id, species_id, obs, samples, {wilson('obs', 'samples')} AS score FROM
      (SELECT location_id, species_id, CAST(sum(obs) AS BIGINT) AS obs FROM ma GROUP BY 1, 2) JOIN ys USING (location_id)"""),
    "rs": (("sa", "dim"), "SELECT region_code, month, CAST(sum(samples) AS BIGINT) AS samples FROM sa JOIN dim USING (location_id) WHERE region_code IS NOT NULL GROUP BY 1, 2"),
    "ro": (("ma", "dim"), "SELECT region_code, month, species_id, CAST(sum(obs) AS BIGINT) AS obs FROM ma JOIN dim USING (location_id) WHERE region_code IS NOT NULL GROUP BY 1, 2, 3"),
    "re": (("rs",), "SELECT CAST(row_number() OVER (ORDER BY code) AS BIGINT) AS id, code FROM (SELECT DISTINCT region_code AS code FROM rs)"),
    "lc": (("dim",), f"SELECT location_id, grid_region AS region_code, {cell('clat', 'clng', 6)} AS cell FROM dim WHERE clat IS NOT NULL AND clng IS NOT NULL"),
    "co": (("oa", "lc"), "SELECT cell, month, species_id, CAST(sum(obs) AS BIGINT) AS obs FROM oa JOIN lc USING (location_id) GROUP BY 1, 2, 3"),
    "cs": (("sa", "lc"), "SELECT cell, month, CAST(sum(samples) AS BIGINT) AS samples FROM sa JOIN lc USING (location_id) GROUP BY 1, 2"),
    "cr": (("sa", "lc"), "SELECT cell, region_code, CAST(sum(samples) AS BIGINT) AS samples FROM sa JOIN lc USING (location_id) WHERE region_code IS NOT NULL GROUP BY 1, 2"),
    "wi": (("cr",), "SELECT cell, region_code FROM (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY samples DESC, region_code) AS rn FROM cr) WHERE rn = 1"),
    "ce": (("wi",), f"SELECT 6 AS res, CAST(row_number() OVER (ORDER BY cell) AS BIGINT) AS cell_ref, cell AS h3, region_code, {centre('cell', 6, True)} AS lat, {centre('cell', 6, False)} AS lng FROM wi"),
    "ho": (("co", "ce"), "SELECT res, cell_ref, month, species_id, obs FROM co JOIN ce ON cell = h3"),
    "hs": (("cs", "ce"), "SELECT res, cell_ref, month, samples FROM cs JOIN ce ON cell = h3"),
    "lm": (("yo", "hot"), """SELECT CAST(row_number() OVER (ORDER BY samples DESC, location_id) - 1 AS BIGINT) AS loc_ref, location_id, name, lat, lng, country_code, subnational1_code, subnational2_code, region_code, samples
      FROM hot JOIN (SELECT location_id, max(samples) AS samples FROM yo GROUP BY 1 HAVING max(samples) >= 25) ON id = location_id"""),
    "ls": (("yo", "lm"), f"SELECT species_id, loc_ref, {level('score')} AS bucket_level FROM yo JOIN lm USING (location_id) WHERE score >= CAST(0.05 AS DOUBLE)"),
    "lq": (("ls",), "SELECT CAST(b AS INTEGER) AS bucket, loc_ref, count(*) AS q_count FROM ls, range(5) AS r(b) WHERE bucket_level >= b GROUP BY 1, 2"),
    "ch": (("hs", "ce"), "SELECT cell_ref, h3, samples FROM ce JOIN (SELECT cell_ref, CAST(sum(samples) AS BIGINT) AS samples FROM hs GROUP BY 1) USING (cell_ref)"),
    "zm": (("ch",), " UNION ALL ".join(
        f"SELECT {r} AS res, CAST(row_number() OVER (ORDER BY z) - 1 AS BIGINT) AS cell_ref, z AS h3, {centre('z', r, True)} AS lat, {centre('z', r, False)} AS lng, samples FROM (SELECT {parent('h3', r)} AS z, CAST(sum(samples) AS BIGINT) AS samples FROM ch GROUP BY 1 HAVING sum(samples) >= 25)"
        for r in (4, 3))),
    "cz": (("ce", "zm"), " UNION ALL ".join(f"SELECT ce.cell_ref AS child_ref, zm.res, zm.cell_ref, zm.samples FROM ce JOIN zm ON zm.res = {r} AND zm.h3 = {parent('ce.h3', r)}" for r in (4, 3))),
    "zs": (("ho", "cz"), f"""SELECT res, species_id, cell_ref, greatest(0, {level('CAST(obs AS DOUBLE) / CAST(samples AS DOUBLE)')}) AS bucket_level FROM
      (SELECT cz.res, cz.cell_ref, species_id, cz.samples, CAST(sum(obs) AS BIGINT) AS obs FROM ho JOIN cz ON ho.cell_ref = child_ref GROUP BY 1, 2, 3, 4) WHERE CAST(obs AS DOUBLE) / CAST(samples AS DOUBLE) >= CAST(0.01 AS DOUBLE)"""),
    "lz": (("lm",), " UNION ALL ".join(f"SELECT {r} AS res, loc_ref, {cell('lat', 'lng', r)} AS h3 FROM lm WHERE lat IS NOT NULL AND lng IS NOT NULL" for r in (4, 3))),
    "lr": (("lz", "zm", "lm"), "SELECT r.res, lm.loc_ref, coalesce(zm.cell_ref, -1) AS cell_ref FROM lm, (SELECT DISTINCT res FROM lz) r LEFT JOIN lz ON lz.res = r.res AND lz.loc_ref = lm.loc_ref LEFT JOIN zm ON zm.res = r.res AND zm.h3 = lz.h3"),
    "hp": (("dim",), "SELECT location_id, grid_region AS region_code, clat AS lat, clng AS lng FROM dim WHERE clat IS NOT NULL AND clng IS NOT NULL"),
    "hx": (("hp",), _hexagons("hp", 6)),
    "hd": (("hx",), hex_centre("SELECT * FROM hx", "location_id, region_code, k, id")),
    "ar": ((), """SELECT 'P' || k AS area_id, list_transform(range(1, 6), lambda i: c + [25, 5, -20, -8, 10][i]) AS lats, list_transform(range(1, 6), lambda i: (o + [0, 18, 12, -12, -25][i] + 540) % 360 - 180) AS lngs, NULL AS clat, NULL AS clng, NULL AS km
      FROM (SELECT n_nationkey AS k, CAST((n_nationkey * 37) % 121 - 60 AS DOUBLE) AS c, CAST((n_nationkey * 67) % 360 - 180 AS DOUBLE) AS o FROM nation)
      UNION ALL SELECT 'C' || n_nationkey, NULL, NULL, CAST((n_nationkey * 53) % 181 - 90 AS DOUBLE), CAST((n_nationkey * 101) % 360 - 180 AS DOUBLE), CAST(800 + 100 * n_nationkey AS DOUBLE) FROM nation"""),
    "pk": (("dim",), "SELECT DISTINCT grid_region AS region FROM dim WHERE grid_region IS NOT NULL UNION SELECT DISTINCT nullif(cy, '') FROM dim WHERE nullif(cy, '') IS NOT NULL"),
}


def query(final: str, *roots: str) -> str:
    """A statement with the named CTEs and all that they read."""
    need: set[str] = set()

    def add(name: str) -> None:
        if name not in need:
            need.add(name)
            for n in CTES[name][0]:
                add(n)

    for r in roots:
        add(r)
    text = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in CTES if n in need)
    return f"WITH {text}\n{final}" if text else final


months = _months
