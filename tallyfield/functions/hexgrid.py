"""A hexagonal grid of the globe in column expressions.

The globe is projected from its centre onto the twenty faces of an icosahedron. Each face carries a lattice of
the ring Z[w], w a sixth root of one: a + b*w is a cell's centre. At resolution 0 a face's side is 2 + 2w
steps, so there are 122 cells; each finer lattice multiplies it by 2 + w, of norm 7, so every
cell has itself and its six neighbours as children, whichever of the finer cells they share their area with. Twelve
cells lie on corners and have five neighbours and five children beside their own.

A centre beyond its face's edge is written in the coordinates of the face next to it, and one that lies on several
faces in those of the first. A child's digit is 0 for the same centre, else 1 + k for the direction w^k in the
coordinates of its parent's face. An id has the bit layout of public 64-bit cell ids (mode at bit 59,
resolution at 52, base cell at 45, a three-bit digit for each resolution, unused ones 7) with a mode of its own.

Areas of hexagons differ by a factor of 2 at most (the cube of the cosine of the angle to the face's centre).
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

MODE, DEPTH = 3, 15
#: Degrees by which the solid is turned, so that no round meridian is an edge.
TURNED = 11.3
#: A side of a face at resolution 0, and the step to the next resolution, as (a, b); the remainder of a + 5b by 7 tells the child.
SIDE, STEP, ROOT, NORM = (2, 2), (2, 1), 5, 7

Ring = tuple[int, int]
UNITS: list[Ring] = [(1, 0), (0, 1), (-1, 1), (-1, 0), (0, -1), (1, -1)]
#: A face's corners, in sides: 0, 1, w.
CORNERS: list[Ring] = [(0, 0), (1, 0), (0, 1)]


def times(x, y):  # noqa: ANN001, ANN201
    """The product of two numbers (a, b) = a + b*w, of integers or of columns."""
    (a, b), (c, d) = x, y
    return a * c - b * d, a * d + b * c + b * d


def bar(x):  # noqa: ANN001, ANN201
    """The conjugate."""
    return x[0] + x[1], -x[1]


def _add(x: Ring, y: Ring) -> Ring:
    return x[0] + y[0], x[1] + y[1]


def _less(x: Ring, y: Ring) -> Ring:
    return x[0] - y[0], x[1] - y[1]


def _solid() -> tuple[list[tuple[float, ...]], list[tuple[int, int, int]]]:
    """Corners as unit vectors, and faces as three corners, counterclockwise from outside."""
    low = math.atan(0.5)
    places = [(math.pi / 2, 0.0), *[(low, 2 * math.pi * k / 5) for k in range(5)], *[(-low, 2 * math.pi * (k + 0.5) / 5) for k in range(5)], (-math.pi / 2, 0.0)]
    corners = [(math.cos(a) * math.cos(o), math.cos(a) * math.sin(o), math.sin(a)) for a, o in places]
    faces = []
    for k in range(5):
        n = (k + 1) % 5
        faces += [(0, 1 + k, 1 + n), (1 + k, 6 + k, 1 + n), (1 + n, 6 + k, 6 + n), (11, 6 + n, 6 + k)]
    return corners, faces


def _rows(face: tuple[int, int, int], corners: list) -> list[float]:
    """The inverse of the matrix of a face's corners: nine numbers that turn a vector into shares of the corners."""
    a, b, c = (corners[i] for i in face)
    cross = lambda p, q: (p[1] * q[2] - p[2] * q[1], p[2] * q[0] - p[0] * q[2], p[0] * q[1] - p[1] * q[0])
    det = sum(x * y for x, y in zip(a, cross(b, c), strict=True))
    return [x / det for row in (cross(b, c), cross(c, a), cross(a, b)) for x in row]


class Rules:
    """Tables that follow from the solid. Those of a face and one of its corners (or the edge opposite) are at 3 * face + corner."""

    def __init__(self) -> None:
        self.corners, self.faces = _solid()
        self.middles = [[sum(self.corners[i][x] for i in f) / 3 for x in range(3)] for f in self.faces]
        self.shares = [_rows(f, self.corners) for f in self.faces]
        self.sides: list[Ring] = [SIDE]
        for _ in range(DEPTH):
            self.sides.append(times(self.sides[-1], STEP))
        self.norms = [12 * NORM**k for k in range(DEPTH + 1)]
        # How often 60 degrees fit into the angle of a side.
        self.turns = [int(math.degrees(math.atan2(b * math.sqrt(3) / 2, a + b / 2)) % 360 // 60) for a, b in self.sides]
        #: remainder -> direction, -1 for none.
        self.direction = [-1] * NORM
        for k, (a, b) in enumerate(UNITS):
            self.direction[(a + ROOT * b) % NORM] = k
        self._edges()
        self._rings()
        self._bases()

    def _edges(self) -> None:
        """Across the edge opposite to a corner: the face there, how often a direction is turned by 60 degrees, what is added in sides."""
        self.across, self.turn, self.shift = [], [], []
        for f, face in enumerate(self.faces):
            for e in range(3):
                i, j = (e + 1) % 3, (e + 2) % 3
                g = next(g for g, other in enumerate(self.faces) if g != f and {face[i], face[j]} <= set(other))
                gi, gj = (CORNERS[self.faces[g].index(face[x])] for x in (i, j))
                k = next(k for k in range(6) if times(UNITS[k], _less(CORNERS[j], CORNERS[i])) == _less(gj, gi))
                self.across.append(g)
                self.turn.append(k)
                self.shift.append(_less(gi, times(UNITS[k], CORNERS[i])))

    def _rings(self) -> None:
        """Of each face's corner: the first face that has it and which corner it is there, the turn to it, and the five faces around, counterclockwise from this one."""
        self.first, self.first_corner, self.first_turn, self.ring, self.ring_corner = [], [], [], [], []
        for f, face in enumerate(self.faces):
            for i in range(3):
                around = [(f, i)]
                while len(around) < 5:
                    g, c = around[-1]
                    g = self.across[3 * g + (c + 1) % 3]  # the edge that ends the sector, counterclockwise
                    around.append((g, self.faces[g].index(face[i])))
                first = min(around)
                # Sectors from the first face on to this one.
                s = (5 - around.index(first)) % 5
                self.first.append(first[0])
                self.first_corner.append(first[1])
                self.first_turn.append((2 * first[1] + s - 2 * i) % 6)
                self.ring.append([g for g, _ in around])
                self.ring_corner.append([c for _, c in around])

    def _bases(self) -> None:
        """Base cells, numbered by face and place; -1 where a face has none of its own."""
        self.base, self.base_face, self.base_place = [-1] * (20 * 25), [], []
        for f in range(20):
            for a in range(-2, 3):
                for b in range(5):
                    if all(x >= 0 for x in self.inside((a, b), 0)) and self.own(f, (a, b)):
                        self.base[f * 25 + (a + 2) * 5 + b] = len(self.base_face)
                        self.base_face.append(f)
                        self.base_place.append((a, b))

    def inside(self, z: Ring, res: int) -> tuple[int, int, int]:
        """Shares of the corners, in parts of the norm."""
        p, q = times(z, bar(self.sides[res]))
        return self.norms[res] - p - q, p, q

    def own(self, f: int, z: Ring) -> bool:
        """Whether no earlier face has this base cell, too."""
        shares = self.inside(z, 0)
        if self.norms[0] in shares:
            return self.first[3 * f + shares.index(self.norms[0])] == f
        return all(self.across[3 * f + e] > f for e in range(3) if shares[e] == 0)


RULES = Rules()


def let(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x), with x worked out once."""
    return F.transform(F.array(x), f)[0]


def array(values: list, kind: str) -> Column:
    """A constant array; as text, since each element of a Python list would be a call of its own."""
    return F.expr(f"cast(array({','.join(f'{v!r}D' if kind == 'double' else str(v) for v in values)}) as array<{kind}>)")


def table(values: list, kind: str = "int") -> Callable[[Column], Column]:
    held = array(values, kind)
    return lambda i: F.get(held, i)


def _pick(values: list[Ring], i: Column) -> tuple[Column, Column]:
    return table([v[0] for v in values], "bigint")(i), table([v[1] for v in values], "bigint")(i)


def _state(f: Column, z: tuple[Column, Column], turn: Column | None = None) -> Column:
    return F.struct(f.cast("int").alias("f"), z[0].cast("bigint").alias("a"), z[1].cast("bigint").alias("b"), (F.lit(0) if turn is None else turn).cast("int").alias("turn"))


def _corner(p: Column, q: Column, norm: Column) -> Column:
    """Which corner of its face a centre is, or null."""
    return F.when((p == 0) & (q == 0), 0).when((p == norm) & (q == 0), 1).when((p == 0) & (q == norm), 2)


def _settled(f: Column, z: tuple[Column, Column], res: Column) -> Column:
    """The centre in the coordinates of its first face, and how often directions turn on the way."""
    r, side, norm = RULES, _pick(RULES.sides, res), table(RULES.norms, "bigint")(res)

    def settle(s: Column) -> Column:
        z = s["a"], s["b"]
        p, q, n = s["p"], s["q"], s["n"]
        corner = _corner(p, q, n)
        i = s["f"] * 3
        tied = [(x == 0) & (table(r.across)(i + e) < s["f"]) for e, x in enumerate((n - p - q, p, q))]
        edge = F.when(n - p - q < 0, 0).when(p < 0, 1).when(q < 0, 2).when(tied[0], 0).when(tied[1], 1).when(tied[2], 2)
        own = F.struct(*[s[c].alias(c) for c in ("f", "a", "b", "sa", "sb")], (i + corner).alias("corner"), (i + edge).alias("edge"))

        def move(s: Column) -> Column:
            side = s["sa"], s["sb"]
            there = times(_pick(CORNERS, table(r.first_corner)(s["corner"])), side)
            k = table(r.turn)(s["edge"])
            turned, moved = times(_pick(UNITS, k), (s["a"], s["b"])), times(_pick(r.shift, s["edge"]), side)
            at_corner = _state(table(r.first)(s["corner"]), there, table(r.first_turn)(s["corner"]))
            over = _state(table(r.across)(s["edge"]), (turned[0] + moved[0], turned[1] + moved[1]), k)
            return F.when(s["corner"].isNotNull(), at_corner).when(s["edge"].isNotNull(), over).otherwise(_state(s["f"], (s["a"], s["b"])))

        return let(own, move)

    given = F.struct(f.cast("int").alias("f"), z[0].cast("bigint").alias("a"), z[1].cast("bigint").alias("b"), side[0].alias("sa"), side[1].alias("sb"), norm.alias("n"))

    def shares(s: Column) -> Column:
        p, q = times((s["a"], s["b"]), bar((s["sa"], s["sb"])))
        return let(F.struct(*[s[c].alias(c) for c in ("f", "a", "b", "sa", "sb", "n")], p.alias("p"), q.alias("q")), settle)

    return let(given, shares)


def _nearest(a: Column, b: Column) -> tuple[Column, Column]:
    """The lattice point nearest to real coordinates, from a struct of both."""
    ra, rb, rc = F.rint(a), F.rint(b), F.rint(-a - b)
    da, db, dc = F.abs(ra - a), F.abs(rb - b), F.abs(rc + a + b)
    return F.when((da > db) & (da > dc), -rb - rc).otherwise(ra), F.when((db >= da) & (db > dc), -ra - rc).otherwise(rb)


def _located(lat: Column, lng: Column, res: int) -> Column:
    """State of the cell that holds a place: the nearest centre of the nearest face."""
    a, o = F.radians(lat), F.radians(lng - TURNED)
    at = F.struct((F.cos(a) * F.cos(o)).alias("x"), (F.cos(a) * F.sin(o)).alias("y"), F.sin(a).alias("z"))

    def on_face(s: Column) -> Column:
        near = F.array(*[s["x"] * m[0] + s["y"] * m[1] + s["z"] * m[2] for m in RULES.middles])
        f = let(near, lambda d: F.array_position(d, F.array_max(d)).cast("int") - 1)
        return F.struct(s["x"].alias("x"), s["y"].alias("y"), s["z"].alias("z"), f.alias("f"))

    def shares(s: Column) -> Column:
        rows = table([x for m in RULES.shares for x in m], "double")
        part = [sum((rows(s["f"] * 9 + 3 * k + j) * s[c] for j, c in enumerate("xyz")), F.lit(0.0)) for k in range(3)]
        return F.struct(s["f"].alias("f"), part[0].alias("u"), part[1].alias("v"), part[2].alias("w"))

    def real(s: Column) -> Column:
        total = s["u"] + s["v"] + s["w"]
        side = [float(x) for x in RULES.sides[res]]
        x, y = times((F.lit(side[0]), F.lit(side[1])), (s["v"] / total, s["w"] / total))
        return F.struct(s["f"].alias("f"), x.alias("a"), y.alias("b"))

    settle = lambda s: _settled(s["f"], _nearest(s["a"], s["b"]), F.lit(res))
    return let(let(let(let(at, on_face), shares), real), settle)


def _encoded(state: Column, res: int) -> Column:
    """The id of a settled centre: parents up to its base cell give the digits."""

    def up(s: Column, k: Column) -> Column:
        k = k.cast("int")
        d = table(RULES.direction)(F.pmod(s["a"] + ROOT * s["b"], F.lit(NORM)).cast("int"))
        child = F.struct(*[s[c].alias(c) for c in ("f", "a", "b", "id")], d.alias("d"), k.alias("k"))

        def parent(s: Column) -> Column:
            da, db = _pick(UNITS, F.when(s["d"] >= 0, s["d"]))
            a, b = times((s["a"] - F.coalesce(da, F.lit(0)), s["b"] - F.coalesce(db, F.lit(0))), bar(STEP))
            p = _settled(s["f"], (F.floor(a / NORM), F.floor(b / NORM)), s["k"] - 1)

            def digit(p: Column) -> Column:
                d = F.when(s["d"] >= 0, F.pmod(s["d"] + p["turn"], F.lit(6)) + 1).otherwise(0)
                return F.struct(p["f"].alias("f"), p["a"].alias("a"), p["b"].alias("b"), (s["id"] + d * table([8 ** (DEPTH - j) for j in range(DEPTH + 1)], "bigint")(s["k"])).alias("id"))

            return let(p, digit)

        return let(child, parent)

    head = (MODE << 59) | (res << 52) | ((1 << 3 * (DEPTH - res)) - 1)
    start = let(state, lambda s: F.when(s.isNotNull(), F.struct(s["f"].alias("f"), s["a"].alias("a"), s["b"].alias("b"), F.lit(head).cast("bigint").alias("id"))))
    levels = array(list(range(res, 0, -1)), "int")
    done = lambda s: s["id"] + F.shiftleft(table(RULES.base)(s["f"] * 25 + ((s["a"] + 2) * 5 + s["b"]).cast("int")).cast("bigint"), 45)
    return F.aggregate(levels, start, up, done)


def _decoded(cell: Column) -> Column:
    """State of a cell, with its resolution; null where a corner's cell has no such child."""
    r = RULES
    head = F.struct(cell.alias("cell"), F.shiftright(cell, 45).bitwiseAND(127).cast("int").alias("base"), F.shiftright(cell, 52).bitwiseAND(15).cast("int").alias("res"))

    def down(s: Column, k: Column) -> Column:
        k = k.cast("int")
        digit = F.shiftright(s["cell"], 0).bitwiseAND(table([7 * 8 ** (DEPTH - j) for j in range(DEPTH + 1)], "bigint")(k)) / table([8 ** (DEPTH - j) for j in range(DEPTH + 1)], "bigint")(k)
        p, q = times((s["a"], s["b"]), bar(_pick(r.sides, k - 1)))
        own = F.struct(*[s[c].alias(c) for c in ("f", "a", "b", "cell", "res")], k.alias("k"), (digit.cast("int") - 1).alias("d"), _corner(p, q, table(r.norms, "bigint")(k - 1)).alias("corner"))

        def child(s: Column) -> Column:
            da, db = _pick(UNITS, F.when(s["d"] >= 0, s["d"]))
            a, b = times((s["a"], s["b"]), STEP)
            plain = _settled(s["f"], (a + F.coalesce(da, F.lit(0)), b + F.coalesce(db, F.lit(0))), s["k"])
            # Around a corner there are five sectors; the sixth direction isn't there.
            sector = F.pmod(s["d"] - table(r.turns)(s["k"]) - 2 * s["corner"] - 1, F.lit(6))
            at = F.struct((((s["f"] * 3 + s["corner"]) * 5) + sector).alias("at"), sector.alias("sector"), *[s[c].alias(c) for c in ("corner", "d", "k")])

            def around(s: Column) -> Column:
                g, c = table([x for y in r.ring for x in y])(s["at"]), table([x for y in r.ring_corner for x in y])(s["at"])
                ua, ub = _pick(UNITS, F.pmod(s["d"] - 2 * s["corner"] - s["sector"] + 2 * c, F.lit(6)))
                a, b = times(_pick(CORNERS, c), _pick(r.sides, s["k"]))
                return F.when(s["sector"] < 5, _state(g, (a + ua, b + ub)))

            moved = F.when((s["d"] >= 0) & s["corner"].isNotNull(), let(at, around)).otherwise(plain)
            return let(moved, lambda m: F.struct(m["f"].alias("f"), m["a"].alias("a"), m["b"].alias("b"), s["cell"].alias("cell"), s["res"].alias("res")))

        return let(own, child)

    def run(h: Column) -> Column:
        place = _pick(r.base_place, h["base"])
        start = F.struct(table(r.base_face)(h["base"]).alias("f"), place[0].alias("a"), place[1].alias("b"), h["cell"].alias("cell"), h["res"].alias("res"))
        return F.aggregate(F.slice(array(list(range(1, DEPTH + 1)), "int"), F.lit(1), h["res"]), start, down)

    return let(head, run)


def _centre(state: Column) -> Column:
    """lat, lng of a decoded cell; null where there is no such cell."""

    def vector(s: Column) -> Column:
        p, q = times((s["a"], s["b"]), bar(_pick(RULES.sides, s["res"])))
        part = [table(RULES.norms, "bigint")(s["res"]) - p - q, p, q]
        ends = table([x for f in RULES.faces for i in f for x in RULES.corners[i]], "double")
        return F.struct(*[sum((part[k] * ends(s["f"] * 9 + 3 * k + j) for k in range(3)), F.lit(0.0)).alias(c) for j, c in enumerate("xyz")])

    def place(v: Column) -> Column:
        lng = F.degrees(F.atan2(v["y"], v["x"])) + TURNED
        return F.struct(F.degrees(F.atan2(v["z"], F.sqrt(v["x"] * v["x"] + v["y"] * v["y"]))).alias("lat"), F.when(lng >= 180, lng - 360).otherwise(lng).alias("lng"))

    return let(let(state, vector), place)


def step_km(res: int, radius: float) -> float:
    """No two neighbouring centres lie farther apart: a step in the plane, stretched as at a face's centre."""
    side = math.dist(RULES.corners[0], RULES.corners[1])
    height = math.sqrt(sum(x * x for x in RULES.middles[0]))
    return side / math.sqrt(RULES.norms[res]) / height * radius


@dataclass(frozen=True)
class Hexagons:
    """The grid's operations. A null place or cell gives null."""

    def cell(self, lat: Column, lng: Column, res: int) -> Column:
        return F.when(lat.isNotNull() & lng.isNotNull(), _encoded(_located(lat, lng, res), res))

    def centre(self, cell: Column) -> Column:
        """struct of lat and lng; both null for an id that no cell has (a missing child of a corner)."""
        return F.when(cell.isNotNull(), _centre(_decoded(cell)))

    def lat(self, cell: Column, res: int) -> Column:
        return self.centre(cell)["lat"]

    def lng(self, cell: Column, res: int) -> Column:
        return self.centre(cell)["lng"]

    def children(self, cell: Column) -> Column:
        """Ids of the next resolution with this parent; of a corner's cell one of seven isn't there."""

        def below(s: Column) -> Column:
            p, q = times((s["a"], s["b"]), bar(_pick(RULES.sides, s["res"])))
            own = F.struct(s["cell"].alias("cell"), s["res"].alias("res"), _corner(p, q, table(RULES.norms, "bigint")(s["res"])).alias("corner"))

            def some(s: Column) -> Column:
                unit = table([8 ** (DEPTH - j) for j in range(DEPTH + 1)], "bigint")(s["res"] + 1)
                missing = F.coalesce(F.pmod(table(RULES.turns)(s["res"] + 1) + 2 * s["corner"], F.lit(6)) + 1, F.lit(0))
                there = F.filter(array(list(range(NORM)), "bigint"), lambda d: (d == 0) | (d != missing))
                return F.transform(there, lambda d: s["cell"] + F.lit(1 << 52) + (d - 7) * unit)

            return let(own, some)

        return F.when(cell.isNotNull(), let(_decoded(cell), below))

    def neighbours(self, cell: Column, res: int) -> Column:
        """Ids of the six cells around (five around a corner's), counterclockwise in the coordinates of the cell's face."""

        def around(s: Column) -> Column:
            p, q = times((s["a"], s["b"]), bar(_pick(RULES.sides, s["res"])))
            own = F.struct(*[s[c].alias(c) for c in ("f", "a", "b")], _corner(p, q, F.lit(RULES.norms[res])).alias("corner"))

            def step(s: Column, k: Column) -> Column:
                da, db = _pick(UNITS, k)
                sector = F.pmod(k - RULES.turns[res] - 2 * s["corner"] - 1, F.lit(6))
                at = (s["f"] * 3 + s["corner"]) * 5 + sector
                g, c = table([x for y in RULES.ring for x in y])(at), table([x for y in RULES.ring_corner for x in y])(at)
                ua, ub = _pick(UNITS, F.pmod(k - 2 * s["corner"] - sector + 2 * c, F.lit(6)))
                a, b = times(_pick(CORNERS, c), tuple(F.lit(x) for x in RULES.sides[res]))
                return F.when(s["corner"].isNull(), _settled(s["f"], (s["a"] + da, s["b"] + db), F.lit(res))).when(sector < 5, _state(g, (a + ua, b + ub)))

            return let(own, lambda s: F.transform(array(list(range(6)), "int"), lambda k: step(s, k)))

        there = F.filter(let(_decoded(cell), around), lambda s: s.isNotNull())
        return F.when(cell.isNotNull(), F.transform(there, lambda s: _encoded(s, res)))
