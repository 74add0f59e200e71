"""Spelling variants grouped by anagram hashing.

Words are runs of letters with their number of occurrences. Each letter has a power as its value, and a word's key is
the sum of its letters' values, whatever their order: adding, removing or exchanging a letter adds, takes away or
exchanges a value. A word is therefore dealt to the keys that are left when one letter's value is taken away, and
meets there the words of that very key (one letter more against one less) and the words that come to the same key by
taking away another letter (an exchange). The order of the remaining letters is verified by two sums modulo primes that depend on the places,
and by the place of the letter. What meets is at most one word for each letter of the alphabet and place, and is
counted and ranked without pairing it out.

Defined cases: a null text has no words and a null doc_id is written as the empty text; a text of any length is read whole, and a word
of any length costs rows of fixed size, one for each letter; repeated rows count again; of near words with equal n the
smallest in code-point order is the form; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import shared

#: Letters of a word; its least length; least occurrences; how many times as frequent a form is; deleted: one occurrence in so many, by digest.
LETTERS, LEAST, OFTEN, TIMES, DELETED = r"A-Za-zÀ-ÿ", 6, 5, 5, 199
#: The value of a letter is this power of its code point.
POWER = 5
#: Sums of places: (prime, base), the verified order of letters. Letters of words that are worked on at once.
PLACES, AT_ONCE = ((2147483647, 1103515245), (2147483629, 69069069)), 1 << 20


def words(docs: DataFrame, deleted: int = DELETED) -> DataFrame:
    """word, n: words of at least LEAST letters with at least OFTEN occurrences. Where deleted divides the digest of document and run, one letter of the run is taken out."""
    runs = shared.texts(docs).select("doc_id", F.explode(F.regexp_extract_all(shared.lower_ascii(F.col("text")), F.lit(f"[{LETTERS}]{{{LEAST},}}"), F.lit(0))).alias("run"))
    digest = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run").cast("binary"))
    at = (digest % F.length("run")).cast("int")
    less = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    found = runs.select(F.when(digest % deleted == 0, less).otherwise(F.col("run")).alias("word")).filter(F.length("word") >= LEAST)
    return found.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= OFTEN)


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    out = np.ones(1, np.int64)
    while len(out) < n:
        out = np.concatenate([out, out * (int(out[-1]) * base % prime) % prime])
    return out[:n]


def probes(letters: np.ndarray, lengths: np.ndarray) -> dict[str, np.ndarray]:
    """For words (all letters in a row, and each word's length): a row of the whole word (place -1) and one for each place without its letter: word (its number), key, order, place, letter, last (no equal letter follows)."""
    ends = np.cumsum(lengths)
    starts = ends - lengths
    word = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(letters)) - starts[word]
    value = letters.astype(np.int64)
    for _ in range(POWER - 1):
        value = value * letters
    key = np.concatenate([[0], np.cumsum(value)])
    key = key[ends] - key[starts]
    whole, less = np.zeros(len(lengths), np.int64), np.zeros(len(letters), np.int64)
    for prime, base in PLACES:
        sums = np.concatenate([[0], np.cumsum((letters + 1) * _powers(base, prime, int(lengths.max(initial=0)) + 1)[place] % prime)])
        before, after = (sums[:-1] - sums[starts[word]]) % prime, (sums[ends[word]] - sums[1:]) % prime
        whole = whole << 31 | (sums[ends] - sums[starts]) % prime
        less = less << 31 | (before + after * pow(base, -1, prime)) % prime
    same = np.zeros(len(letters), bool)
    same[:-1] = (letters[1:] == letters[:-1]) & (word[1:] == word[:-1])
    none = np.full(len(lengths), -1)
    return {
        "word": np.concatenate([np.arange(len(lengths)), word]),
        "key": np.concatenate([key, key[word] - value]),
        "order": np.concatenate([whole, less]),
        "place": np.concatenate([none, place]),
        "letter": np.concatenate([none, letters]),
        "last": np.concatenate([np.zeros(len(lengths), bool), ~same]),
    }


def _probe(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in shared.batches(rows):
        lengths = pc.utf8_length(batch.column("word")).to_numpy().astype(np.int64)
        group = np.cumsum(lengths) // AT_ONCE
        for cut in np.split(np.arange(len(lengths)), np.flatnonzero(np.diff(group)) + 1):
            part = batch.slice(int(cut[0]), len(cut))
            letters = np.frombuffer("".join(part.column("word").to_pylist()).encode("utf-32-le"), np.uint32).astype(np.int64)
            got = probes(letters, lengths[cut])
            own = got["word"]
            ids, n = part.column("id").to_numpy()[own], part.column("n").to_numpy()[own]
            yield pa.RecordBatch.from_arrays(
                [pa.array(got["key"]), pa.array(got["order"]), pa.array(got["place"].astype(np.int32)), pa.array(got["letter"].astype(np.int32)), pa.array(got["last"]), pa.array(ids), pa.array(n)],
                names=["key", "order", "place", "letter", "last", "id", "n"],
            )


def meetings(found: DataFrame, times: int = TIMES) -> DataFrame:
    """id, near (words met), forms (array of those that are at least times as frequent, the most frequent of each meeting): rows of the words that met others. found: id, word, n."""
    dealt = found.mapInArrow(_probe, "key bigint, order bigint, place int, letter int, last boolean, id bigint, n bigint").repartition("key", "order")
    met, same = W.partitionBy("key", "order"), W.partitionBy("key", "order", "place")
    own = F.struct("n", "id")
    ranked = same.orderBy(F.desc("n"), "letter").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    x = dealt.withColumn("whole", F.max(F.when(F.col("place") < 0, own)).over(met)).withColumn("longer", F.sum(F.col("last").cast("bigint")).over(met)).withColumn("longest", F.max(F.when(F.col("last"), F.col("n"))).over(met))
    x = x.withColumn("others", F.count("*").over(same) - 1).withColumn("first", F.first(own).over(ranked)).withColumn("second", F.nth_value(own, 2).over(ranked))
    exchanged = F.when(F.col("others") > 0, F.when(F.col("first.id") == F.col("id"), F.col("second")).otherwise(F.col("first")))
    less = F.when(F.col("last"), F.col("whole"))
    one = F.lit(1).cast("bigint")
    # The shorter word learns of the longer ones by their number, and of its form from the most frequent of them.
    rows = F.when(F.col("place") < 0, F.array(F.struct("id", "n", F.col("longer").alias("near"), F.lit(None).cast("struct<n:bigint,id:bigint>").alias("other")))).otherwise(
        F.array(
            F.struct("id", "n", F.col("others").alias("near"), exchanged.alias("other")),
            F.struct("id", "n", F.when(less.isNotNull(), one).otherwise(0).alias("near"), less.alias("other")),
            F.struct(F.col("whole.id").alias("id"), F.col("whole.n").alias("n"), F.lit(0).cast("bigint").alias("near"), F.when(F.col("last") & (F.col("n") == F.col("longest")), own).alias("other")),
        )
    )
    y = x.filter((F.col("others") > 0) | (F.col("whole").isNotNull() & (F.col("longer") > 0))).select(F.explode(rows).alias("r")).select("r.*")
    form = F.when(F.col("other.n") >= times * F.col("n"), F.col("other.id"))
    return y.filter("id is not null").select("id", "near", form.alias("form_id"), F.when(form.isNotNull(), F.col("other.n")).alias("form_n")).filter("near > 0 or form_id is not null")


def group(spark: SparkSession, docs: DataFrame, deleted: int = DELETED, times: int = TIMES) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of docs."""
    stage = shared.Stage(spark, "spelling")
    found = stage.write(stage.write(words(docs, deleted), "counted").select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")
    stage.drop("counted")
    met = stage.write(meetings(found, times), "met")
    near = met.groupBy("id").agg(F.sum("near").alias("n_near"))
    named = met.filter("form_id is not null").select("id", "form_id", "form_n").distinct().join(found.select(F.col("id").alias("form_id"), F.col("word").alias("form")), "form_id")
    best = F.min(F.struct((-F.col("form_n")).alias("rank"), "form", "form_id"))
    forms = stage.write(named.groupBy("id").agg(best.alias("b")).select("id", "b.form", "b.form_id", (-F.col("b.rank")).alias("form_n")), "forms")
    # A form is more frequent, so the way ends; each round doubles the steps that a row has gone.
    roots, rounds = forms.select("id", F.col("form_id").alias("to"), F.col("form").alias("root")), 0
    while True:
        ahead = roots.select(F.col("id").alias("to"), F.col("to").alias("next"), F.col("root").alias("further"))
        moved = stage.write(roots.join(ahead, "to", "left").select("id", F.coalesce("next", "to").alias("to"), F.coalesce("further", "root").alias("root"), F.col("next").isNotNull().alias("moved")), f"roots{rounds}")
        roots, rounds = moved.drop("moved"), rounds + 1
        if moved.filter("moved").isEmpty():
            break
    facts = near.join(forms, "id", "left").join(roots.select("id", "root"), "id", "left")
    return found.join(facts, "id", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group(spark, shared.table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE r AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]{6,}')) AS run FROM documents
), d AS (SELECT doc_id, run, count(*) AS times FROM r GROUP BY ALL
), crc AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t
), b AS (
  SELECT d.*, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + unicode(c)::BIGINT // 64, 128 + unicode(c)::BIGINT % 64] END)) AS bytes FROM d
), h AS (
  SELECT run, times, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, x: xor(c // 256, t[(xor(c, x) % 256 + 1)::INTEGER])), 4294967295) AS h FROM b, crc
), o AS (
  SELECT CASE WHEN h % 199 = 0 THEN run[:(h % length(run))::INTEGER] || run[(h % length(run) + 2)::INTEGER:] ELSE run END AS word, times FROM h
), w AS (SELECT word, sum(times)::BIGINT AS n FROM o WHERE length(word) >= 6 GROUP BY 1 HAVING sum(times) >= 5
), p AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w
), l AS (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS less FROM p
), e AS (
  SELECT a.word, a.n, b.word AS other, b.n AS m FROM l a JOIN l b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
  UNION SELECT l.word, l.n, w.word, w.n FROM l JOIN w ON l.less = w.word
  UNION SELECT w.word, w.n, l.word, l.n FROM l JOIN w ON l.less = w.word
), f AS (SELECT word, count(*) AS n_near, max(m) FILTER (WHERE m >= 5 * n) AS form_n FROM e GROUP BY 1
), g AS (SELECT f.word, n_near, form_n, min(other) AS form FROM f LEFT JOIN e ON e.word = f.word AND e.m = f.form_n GROUP BY ALL
), a AS (SELECT word AS start, word AS here FROM w UNION ALL SELECT a.start, g.form FROM a JOIN g ON g.word = a.here AND g.form IS NOT NULL
), z AS (SELECT start, here AS root FROM a WHERE here NOT IN (SELECT word FROM g WHERE form IS NOT NULL))
SELECT w.word, g.form, z.root, w.n, coalesce(g.n_near, 0) AS n_near, g.form_n FROM w LEFT JOIN g USING (word) JOIN z ON z.start = w.word
"""
