"""A training corpus from raw documents: toxic ones go, then copies, near copies and benchmark text; sources are mixed.

Each stage takes (spark, docs, sf_dir), works on all documents that the one before it kept, and returns
a DataFrame, which run() writes to the shared folder and rereads. All stages but the last return the
columns of documents; the last returns the mix: doc_id, size, source_size, target, taken, source of each
document that is taken (in words; above its size where it is repeated).

Defined cases, in all stages: a null text is empty, a text of any length is read whole, columns beyond those of
documents are passed on (by all but the last), an empty table gives an empty one. run() reads documents, labels
and benchmark; rows that repeat both doc_id and text count once from the second stage on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.llm import decontaminate, exact_dedup, jaccard_join, mixing, shared, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose worst window scores under the threshold; the network learns from those kept labels that its query learns from. Without labels of both kinds every document stays; an empty text has the score of an empty window; a null doc_id has no label."""
    labels = shared.table(spark, sf_dir, "labels").filter(shared.crc_mod(3) != 1)
    return toxicity.clean_documents(spark, docs, toxicity.learn(docs, labels))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (null: empty), the document with the largest doc_id; a null doc_id stays only where its copies have none."""
    return exact_dedup.distinct_documents(spark, docs, "largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by similar shingle sets, the one with the smallest doc_id. Documents without words all stay."""
    return jaccard_join.one_of_each(spark, docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a relevant share of benchmark text; those without words stay, and all stay where the benchmark is empty."""
    return decontaminate.clean_documents(spark, docs, shared.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes. One without words is never taken; a null source is a source; of equal keys the smaller doc_id comes first."""
    return mixing.mix(spark, docs, mixing.quality(shared.table(spark, sf_dir, "labels"))).filter(F.col("taken") > 0)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources", mix_sources),
]

#: A trained network decides the first stage, which SQL can't express; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = shared.Stage(spark, "pipeline")
    docs = shared.table(spark, sf_dir, "documents")
    for k, (_, function) in enumerate(STAGES):
        docs = stage.write(function(spark, docs, sf_dir), f"stage{k}")
        if k:
            stage.drop(f"stage{k - 1}")
    return docs
