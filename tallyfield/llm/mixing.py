"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A source gets a target of words: its share of the budget by weight, never above a multiple of what
it has, the excess reshared by weight among the others. Whole epochs come first: every document is
taken floor(target / size of the source) times. The rest of the target is drawn without replacement:
each document has the exponential key -ln(u) / weight (weight: its quality), documents are sorted by
key within the source, and their sizes are prefix-summed up to what is left; the document on the
boundary is taken in part, so that the target is met.

A source may hold a third of all rows, so its order is never made in one task: keys fall into
BUCKETS equal-probability buckets per source, bucket sums are prefix-summed, and only the rows of a
source's boundary bucket are sorted.

Defined cases: a null text has size 0, a text of any length is counted whole; a null source is a source of its
own, the last; an empty table gives no rows; repeated rows count each, and ties of key go by doc_id, then size; a
null doc_id has the key of its text's digest; null or non-positive weights count as 1; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import shared

#: Fixed values of the contract: weights of the sources in order, repeating; share of all sizes; most times that a source is used.
WEIGHTS, BUDGET, MOST = (5, 2, 1), 1.5, 2
BUCKETS = 4096
#: Sampling weight of a document by its quality label; without a label, 1.
QUALITY = {1: 2.0, 0: 0.5}


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(rf"[^{shared.SPACE}]++")).cast("bigint")


def uniform(name: Column, seed: str) -> Column:
    """In (0, 1), from the digest of a string: the same on every run."""
    digest = F.md5(F.concat(name, F.lit(f"/{seed}")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / 2.0**52


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET, most: int = MOST) -> DataFrame:
    """source, source_size, target, from (source, source_size): min(most * size, level * weight), the level such that all of the budget is dealt.

    A row for each source; windows over it see one row a source.
    """
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    every = F.array(*[F.lit(float(w)) for w in weights])
    x = sizes.withColumn("weight", F.element_at(every, (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int")))
    x = x.withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    order = W.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    all_of = W.partitionBy(F.lit(1))
    before = order.rowsBetween(W.unboundedPreceding, -1)
    # With the sources before this one at their caps, the level at which the rest of the budget is dealt to it and those after it.
    rest = F.lit(budget) * F.sum("source_size").over(all_of) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    heavy = F.sum("weight").over(all_of) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    x = x.withColumn("level", rest / heavy).withColumn("free", F.col("cap") > F.col("level") * F.col("weight"))
    level = F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source", F.col("level").alias("l"))))
    x = x.withColumn("at", level.over(all_of)["l"])
    return x.select("source", "source_size", F.coalesce(F.least("cap", F.col("at") * F.col("weight")), F.col("cap")).alias("target"))


def mix(spark: SparkSession, docs: DataFrame, weight: DataFrame | None = None, seed: str = "mix") -> DataFrame:
    """Per document: doc_id, size, source_size, target (of its source), taken (words that the mix takes), source.

    weight: (doc_id, weight), a row for each weighted document.
    """
    stage = shared.Stage(spark, "mixing")
    rows = shared.texts(docs, F.col("source").cast("string").alias("source"))
    name = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.col("text").cast("binary")))
    rows = rows.select("doc_id", "source", n_words(F.col("text")).alias("size"), uniform(name, seed).alias("u"))
    if weight is not None:
        rows = rows.join(weight.select("doc_id", "weight"), "doc_id", "left")
    else:
        rows = rows.withColumn("weight", F.lit(1.0))
    w = F.when(F.col("weight") > 0, F.col("weight")).otherwise(F.lit(1.0)).cast("double")
    key = -F.log("u") / w
    # 1 - exp(-key) grows with the key and is spread over (0, 1).
    bucket = F.floor((1.0 - F.exp(-key)) * BUCKETS).cast("int")
    base = stage.write(rows.select("doc_id", "source", "size", key.alias("key"), bucket.alias("bucket")), "sizes")
    sums = base.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    sums = stage.write(sums, "sums")
    aims = targets(sums.groupBy("source").agg(F.sum("bucket_size").alias("source_size")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    aims = aims.withColumn("epochs", epochs).withColumn("rest", F.floor(F.col("target") - F.col("epochs") * F.col("source_size")).cast("bigint"))
    upto = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    placed = sums.withColumn("before", F.coalesce(F.sum("bucket_size").over(upto), F.lit(0)))
    a, b = placed.alias("a"), aims.alias("b")
    plan = a.join(b, F.col("a.source").eqNullSafe(F.col("b.source"))).select("a.source", "a.bucket", "before", "bucket_size", "source_size", "target", "epochs", "rest")
    plan = stage.write(plan, "plan")  # at most BUCKETS rows a source
    stage.drop("sums")
    edge = (F.col("before") < F.col("rest")) & (F.col("before") + F.col("bucket_size") > F.col("rest"))
    d, p = base.alias("d"), plan.alias("p")
    joined = d.join(p, F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d.bucket") == F.col("p.bucket"))).select(
        "doc_id", "d.source", "d.bucket", "size", "key", "before", "bucket_size", "source_size", "target", "epochs", "rest"
    )
    within = W.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    inside = joined.filter(edge).withColumn("run", F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    inside = inside.withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("run"))))
    whole = joined.filter(~edge).withColumn("part", F.when(F.col("before") + F.col("bucket_size") <= F.col("rest"), F.col("size")).otherwise(F.lit(0)))
    columns = ["doc_id", "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("part")).cast("bigint").alias("taken"), "source"]
    return whole.select(columns).unionByName(inside.select(columns))


def quality(labels: DataFrame) -> DataFrame:
    """(doc_id, weight) from quality labels; of several labels of a document the best counts."""
    w = F.coalesce(*[F.when(F.col("q") == k, F.lit(v)) for k, v in QUALITY.items()], F.lit(1.0))
    return labels.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("quality").alias("q")).select("doc_id", w.alias("weight"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark, shared.table(spark, sf_dir, "documents"), quality(shared.table(spark, sf_dir, "labels")))


SQL = r"""
WITH q AS (SELECT doc_id, max(quality) AS q FROM labels GROUP BY 1),
d AS (
  SELECT documents.doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    -ln((CAST(('0x' || substr(md5(CAST(documents.doc_id AS VARCHAR) || '/mix'), 1, 13)) AS BIGINT) + CAST(0.5 AS DOUBLE)) / CAST(4503599627370496 AS DOUBLE))
      / CAST(CASE q WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END AS DOUBLE) AS key
  FROM documents LEFT JOIN q ON q.doc_id = documents.doc_id
), s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
w AS (SELECT *, CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight, CAST(2 * source_size AS DOUBLE) AS cap FROM s),
l AS (
  SELECT *, (CAST(1.5 AS DOUBLE) * sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level
  FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, coalesce(least(cap, (SELECT arg_min(level, cap / weight) FROM l WHERE cap > level * weight) * weight), cap) AS target FROM l
), e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
r AS (SELECT *, CAST(floor(target - epochs * source_size) AS BIGINT) AS rest FROM e),
c AS (
  SELECT d.*, source_size, target, epochs, rest, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, size, source_size, target, CAST(epochs * size + greatest(0, least(size, rest - run)) AS BIGINT) AS taken, source FROM c
"""
