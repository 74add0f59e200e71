"""Personal data by patterns, checksums and context, in DataFrame functions alone.

For each kind a regular expression proposes spans over the whole text, leftmost and not
overlapping; a validator confirms them (octets of an address, the Luhn sum of a card, the number of
digits of a phone, mod 97 of an IBAN); and words within WINDOW code points of a span, whatever lies there,
adjust its score: those that speak for its kind before or behind it, those against before it. Spans of the four base kinds stay whatever their score; those of the added
kinds need MIN_SCORE.

Where a span lies follows from what is around it: splitting the text by the pattern gives the pieces
between matches, and running sums of lengths give code points. Sums run through matches in chunks of CHUNK,
so a text's cost grows in line with its matches. Patterns are possessive and start at the head of a run or
where the last match ended, which finds the same matches as the plain pattern but looks at each code point a
bounded number of times, however long the text.

Defined cases: a null text is empty; a text without personal data gives zeros, the digest of the
empty string and an empty string; spans of several kinds may lie over each other, and those that start at one
place go in the order of the kinds; repeated rows each give a row; a null doc_id stays null; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

_EMAIL = "A-Za-z0-9._%+-"
#: Characters of an IBAN by country, as registered.
IBAN = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH CR HR LI LV",
    22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
#: Kind to (cheap test that any match passes, pattern). In the order in which kinds at one start are listed.
PATTERNS = {
    "email": ("@", rf"(?:\G|(?<![{_EMAIL}]))[{_EMAIL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"[0-9]\.[0-9]", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (r"[0-9][\x20-]?+[0-9]", r"[0-9](?:[\x20-]?+[0-9]){13,}+"),  # shorter runs of digits are no cards
    "phone": (r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]"),
    "iban": (r"[A-Z]{2}[0-9]{2}", r"\b(?:" + "|".join(rf"(?:{own.replace(' ', '|')})[0-9][0-9](?:\x20?[A-Z0-9]){{{n - 4}}}" for n, own in IBAN.items()) + r")\b"),
    "ssn": (r"[0-9]-[0-9]", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"),
}
BASE = ("email", "ip", "card", "phone")
#: Matches whose places are summed in one go.
CHUNK = 512
#: Words near a span that speak for its kind, and, before it, against it.
FOR = {
    "email": "e-?mail|contact|mailto|write",
    "ip": "ip|host|server|address|login",
    "card": "card|visa|mastercard|amex|credit|payment",
    "phone": "phone|tel|call|mobile|fax|cell",
    "iban": "iban|account|konto|bank|compte|cuenta",
    "ssn": "ssn|social|security",
}
AGAINST = "version|build|isbn|serial|order|invoice|sample|example|test"
#: Score of a confirmed span by itself, and what context adds or takes; the added kinds need MIN_SCORE.
CONFIRMED = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.4}
BONUS, MALUS, MIN_SCORE, WINDOW = 0.2, 0.3, 0.5, 40


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _at(s: Column, i: Column) -> Column:
    return F.substring(s, i.cast("int"), F.lit(1)).cast("int")


def luhn(digits: Column) -> Column:
    """Whether the Luhn sum of a string of digits is a multiple of 10."""
    n = F.length(digits)

    def one(i: Column) -> Column:
        d = _at(digits, i)
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(F.pmod(n - i, F.lit(2)) == 1, twice).otherwise(d)

    return F.pmod(F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda a, i: a + one(i)), F.lit(10)) == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN's check is right: moved, letters as numbers, the remainder by 97 is 1."""
    plain = F.replace(iban, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    value = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def step(a: Column, i: Column) -> Column:
        v = F.instr(F.lit(value), F.substring(moved, i.cast("int"), F.lit(1))) - 1
        return F.pmod(F.when(v > 9, a * 100 + v).otherwise(a * 10 + v), F.lit(97))

    return (F.length(plain) >= 15) & (F.length(plain) <= 34) & (F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step) == 1)


def confirmed(kind: str, s: Column) -> Column:
    n = F.length(_digits(s))
    if kind == "ip":
        plain = lambda x: F.ltrim(x, F.lit("0"))
        return F.forall(F.split(s, r"\."), lambda x: (F.length(plain(x)) <= 3) & (F.coalesce(F.substring(plain(x), 1, 3).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.when((n >= 14) & (n <= 19), luhn(_digits(s))).otherwise(F.lit(False))
    if kind == "phone":
        return (n >= 10) & (n <= 15)
    if kind == "iban":
        return mod97(s)
    if kind == "ssn":
        return ~s.rlike(r"^(?:000|666|9[0-9][0-9])|-00-|-0000$")
    return F.lit(True)


def spans_of(kind: str, text: Column) -> Column:
    """array<struct<start, kind, end, score>>: the confirmed spans of a kind, in order."""
    test, pattern = PATTERNS[kind]
    place = list(PATTERNS).index(kind)
    empty = F.array().cast("array<struct<start:int,place:int,end:int,score:double>>")
    # What follows each match is a group of a look-ahead, which changes no match.
    found, behind = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(rf"{pattern}(?=([\s\S]{{0,{WINDOW}}}+))"), F.lit(1))
    pieces = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    spans = "array<struct<start:int,place:int,end:int,match:string,before:string,after:string>>"
    last = lambda s: F.substring(s, -WINDOW, WINDOW)

    def step(a: Column, x: Column) -> Column:
        start = a["at"] + F.length(x["piece"])
        end = start + F.length(x["match"])
        before = last(F.concat(a["tail"], last(x["piece"])))
        one = F.struct(start.alias("start"), F.lit(place).alias("place"), end.alias("end"), x["match"].alias("match"), before.alias("before"), x["after"].alias("after"))
        return F.struct(end.alias("at"), last(F.concat(before, last(x["match"]))).alias("tail"), F.array_append(a["out"], one).alias("out"))

    def chunk(a: Column, own: Column) -> Column:
        state = F.struct(a["at"].alias("at"), a["tail"].alias("tail"), F.array().cast(spans).alias("out"))
        done = F.aggregate(own, state, step)
        return F.aggregate(F.array(done), a, lambda b, x: F.struct(x["at"].alias("at"), x["tail"].alias("tail"), F.array_append(b["out"], x["out"]).alias("out")))

    zipped = F.arrays_zip(found.alias("match"), pieces.alias("piece"), behind.alias("after"))
    nothing = F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"), F.array().cast(f"array<{spans}>").alias("out"))
    starts = F.sequence(F.lit(1), F.greatest(F.size(found), F.lit(1)), F.lit(CHUNK))
    chunks = F.aggregate(F.array(zipped), F.array().cast("array<array<struct<match:string,piece:string,after:string>>>"), lambda _, z: F.transform(starts, lambda i: F.slice(z, i, F.lit(CHUNK))))
    placed = F.aggregate(chunks, nothing, chunk, lambda a: F.flatten(a["out"]))

    def near(x: Column, side: str, own: str) -> Column:
        return x[side].rlike(rf"(?i)(?<![a-z])(?:{own})(?![a-z])")

    def score(x: Column) -> Column:
        plus = F.when(near(x, "before", FOR[kind]) | near(x, "after", FOR[kind]), F.lit(BONUS)).otherwise(F.lit(0.0))
        minus = F.when(near(x, "before", AGAINST), F.lit(MALUS)).otherwise(F.lit(0.0))
        return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(CONFIRMED[kind]) + plus - minus))

    good = F.filter(placed, lambda x: confirmed(kind, x["match"]))
    scored = F.transform(good, lambda x: F.struct(x["start"].alias("start"), x["place"].alias("place"), x["end"].alias("end"), score(x).alias("score")))
    if kind not in BASE:
        scored = F.filter(scored, lambda x: x["score"] >= MIN_SCORE)
    return F.when(text.rlike(test), scored).otherwise(empty)


def joined(spans: Column) -> Column:
    """kind:start:end by start, then kind."""
    names = F.array(*[F.lit(k) for k in PATTERNS])
    each = F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.element_at(names, x["place"] + 1), x["start"].cast("string"), x["end"].cast("string")))
    return F.array_join(each, ",")


def find(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, and for each kind its spans as array<struct<start, place, end, score>> (code points, end exclusive)."""
    rows = shared.texts(docs)
    return rows.select("doc_id", *[spans_of(k, F.col("text")).alias(k) for k in PATTERNS])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = find(shared.table(spark, sf_dir, "documents"))
    base, every = (F.concat(*[F.col(k) for k in kinds]) for kinds in (BASE, tuple(PATTERNS)))
    counts = [F.size(k).cast("bigint").alias(f"n_{k}") for k in PATTERNS]
    best = reduce(lambda a, k: F.greatest(a, F.coalesce(F.array_max(F.transform(k, lambda s: s["score"])), F.lit(0.0))), PATTERNS, F.lit(0.0))
    return x.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(every).alias("spans"), best.alias("top_score"))


def _sql() -> str:
    """The same by lists of another engine: matches and the pieces between them, with plain patterns."""
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
        "card": r"[0-9](?:[\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "iban": PATTERNS["iban"][1],
        "ssn": PATTERNS["ssn"][1],
    }
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    doubled = "list_transform(range(1, length(d) + 1), lambda i: CASE WHEN (length(d) - i) % 2 = 1 THEN CASE WHEN d[i]::INT > 4 THEN d[i]::INT * 2 - 9 ELSE d[i]::INT * 2 END ELSE d[i]::INT END)"
    moved = "replace(m, ' ', '')[5:] || replace(m, ' ', '')[:4]"
    value = "'0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ'"
    steps = f"list_transform(range(1, length({moved}) + 1), lambda i: CAST(instr({value}, ({moved})[i]) - 1 AS BIGINT))"
    rest = f"list_reduce(list_prepend(CAST(0 AS BIGINT), {steps}), lambda a, v: (CASE WHEN v > 9 THEN a * 100 + v ELSE a * 10 + v END) % 97)"
    good = {
        "email": "true",
        "ip": "len(list_filter(string_split(m, '.'), lambda x: length(ltrim(x, '0')) > 3 OR coalesce(TRY_CAST(ltrim(x, '0') AS INT), 0) > 255)) = 0",
        "card": f"length(d) BETWEEN 14 AND 19 AND list_sum({doubled}) % 10 = 0",
        "phone": "length(d) BETWEEN 10 AND 15",
        "iban": f"length(replace(m, ' ', '')) BETWEEN 15 AND 34 AND {rest} = 1",
        "ssn": "NOT regexp_matches(m, '^(?:000|666|9[0-9][0-9])|-00-|-0000$')",
    }
    parts = []
    for k, (kind, p) in enumerate(plain.items()):
        near = lambda w, side: f"regexp_matches(lower({side}), '(^|[^a-z])({w})($|[^a-z])')"
        before, after = f"substr(t, greatest(s - {WINDOW}, 0) + 1, least(s, {WINDOW}))", f"substr(t, s + length(m) + 1, {WINDOW})"
        tests = ("+", f"{near(FOR[kind], before)} OR {near(FOR[kind], after)}", BONUS), ("-", near(AGAINST, before), MALUS)
        score = " ".join(f"{sign} CASE WHEN {test} THEN CAST({v} AS DOUBLE) ELSE CAST(0 AS DOUBLE) END" for sign, test, v in tests)
        parts.append(
            f"""SELECT doc_id, '{kind}' AS kind, {k} AS place, s, s + length(m) AS e, least(CAST(1 AS DOUBLE), greatest(CAST(0 AS DOUBLE), CAST({CONFIRMED[kind]} AS DOUBLE) {score})) AS score FROM (
  SELECT doc_id, r, t, ms[i] AS m, {digits.replace("m,", "ms[i],")} AS d, CAST(list_sum(list_transform(ps[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s
  FROM (SELECT doc_id, r, t, regexp_extract_all(t, '{p}') AS ms, string_split_regex(t, '{p}') AS ps FROM d), unnest(range(1, len(ms) + 1)) AS u(i)) WHERE {good[kind]}"""
        )
    found = "\nUNION ALL ".join(x.replace("SELECT doc_id, '", "SELECT r, doc_id, '", 1) for x in parts)
    counts = ", ".join(f"CAST(count(*) FILTER (kind = '{k}') AS BIGINT) AS n_{k}" for k in PATTERNS)
    text = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place)"
    base = ", ".join(f"'{k}'" for k in BASE)
    zero = ", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in PATTERNS)
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
f AS ({found}), k AS (SELECT * FROM f WHERE place < {len(BASE)} OR score >= {MIN_SCORE}),
g AS (SELECT r, {counts}, {text.replace(" ORDER", " ORDER")} FILTER (kind IN ({base})) AS base, {text} AS spans, max(score) AS top_score FROM k GROUP BY 1)
SELECT doc_id, {zero}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(top_score, CAST(0 AS DOUBLE)) AS top_score FROM d LEFT JOIN g USING (r)"""


SQL = _sql()
