"""Exact deduplication by a tree merge of sorted digest runs.

Each input partition forms one run: its digests in order, a row for each, with the identifier that
stays, the number of copies, and a second digest and length that verify equality. Runs move in
binomial rounds: in round k the runs whose number agrees above k * BITS bits meet (run r goes to
r with its low bits cleared) and are merged, equal digests keeping one identifier. The digest's
first bytes split every run, so a round's merges spread over the cluster and the last run is never
one task. The final identifiers then travel down the same tree. A digest has at most one row a run,
so a group of copies of any size puts at most 2^BITS rows into any merge.

Defined cases: a null text counts as empty; a text of any length is digested whole; a null doc_id ranks below every
other; among rows that repeat both doc_id and text (the only ties) one stays; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

#: Runs that meet in a round: 2^BITS.
BITS = 4


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, row (unique once stored), run, digest, check."""
    text = shared.lower_ascii(F.col("text"))
    return shared.texts(docs).select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        F.spark_partition_id().alias("run"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.struct(F.octet_length(text).alias("bytes"), F.xxhash64(text).alias("hash")).alias("check"),
    )


def merge(runs: DataFrame, largest: bool) -> DataFrame:
    """Merge the runs of equal number: co-locate by run and digest range, sort, and combine equal neighbours."""
    met = runs.repartition("run", "part").sortWithinPartitions("run", "part", "digest")
    pick = F.max if largest else F.min
    merged = met.groupBy("run", "part", "digest").agg(
        pick("keep").alias("keep"), F.sum("size").alias("size"), F.min("check").alias("check"), F.max("check").alias("other")
    )
    same = F.when(F.col("check") == F.col("other"), F.col("check")).otherwise(F.raise_error(F.lit("two different texts share a digest")))
    return merged.select("run", "part", "digest", "keep", "size", same.alias("check"))


def dedup(spark: SparkSession, docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 (of the lower-cased text), row.

    keep: "smallest" or "largest" doc_id of a group stays.
    """
    largest, stage = keep == "largest", shared.Stage(spark, "exact-dedup")
    base = stage.write(digests(docs), "digests")
    part = F.conv(F.hex(F.substring("digest", 1, 2)), 16, 10).cast("int")
    # A null doc_id must not stay where another is there.
    rank = F.struct(F.col("doc_id").isNotNull().alias("known") if largest else F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")
    level = merge(base.select("run", part.alias("part"), "digest", rank.alias("keep"), F.lit(1).cast("bigint").alias("size"), "check"), largest)
    level = stage.write(level, "runs0")
    top = base.agg(F.max("run")).first()[0] or 0
    rounds = 0
    levels = [level]
    while top >> (BITS * rounds):
        rounds += 1
        level = stage.write(merge(level.withColumn("run", F.shiftright("run", BITS)), largest), f"runs{rounds}")
        levels.append(level)
    found = levels.pop().select("run", "part", "digest", "keep", "size")
    while levels:
        lower = levels.pop().select(F.col("run").alias("own"), F.shiftright("run", BITS).alias("run"), "part", "digest")
        found = lower.join(found, ["run", "part", "digest"]).select(F.col("own").alias("run"), "part", "digest", "keep", "size")
        if levels:
            found = stage.write(found, f"found{len(levels)}")
    rows = base.select("doc_id", "row", "run", part.alias("part"), "digest")
    return rows.join(found, ["run", "part", "digest"]).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("row") == F.col("keep.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "row",
    )


def distinct_documents(spark: SparkSession, docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """The documents that stay, with all their columns."""
    ids = dedup(spark, docs, keep).filter("kept").select(F.col("doc_id").alias("__tf_id"), F.col("text_sha256").alias("__tf_sha"))
    own = docs.withColumn("__tf_own", F.sha2(shared.lower_ascii(F.coalesce(F.col("text"), F.lit(""))), 256))
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("__tf_id")) & (F.col("__tf_own") == F.col("__tf_sha"))
    return own.join(ids, same, "left_semi").dropDuplicates(["doc_id", "__tf_own"]).drop("__tf_own")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(spark, shared.table(spark, sf_dir, "documents"), "largest").drop("row")


SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents
), g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256 FROM d JOIN g USING (text_sha256)
"""
