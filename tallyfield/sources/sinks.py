"""Sinks: sorted Parquet tables, extracts, packs and blobs."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import readers, schema


def conform(df: DataFrame, name: str) -> DataFrame:
    """The declared columns of a table, cast to their types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.TABLES[name][0]])


def write_table(df: DataFrame, root: str, name: str, rows_per_file: int = 5_000_000) -> None:
    """Write a table ranged and sorted by its key, so that row groups carry tight min/max statistics.

    A repeated or null key fails the write; what stood there before stays until all is written.
    """
    _, key, by = schema.TABLES[name]
    out = conform(df, name)
    if key:
        out = unique(out.repartitionByRange(*key).sortWithinPartitions(*key), name)
    building = f"{root}/_building-{name}-{uuid.uuid4().hex}"
    writer = out.write.option("maxRecordsPerFile", rows_per_file)
    try:
        (writer.partitionBy(*by) if by else writer).parquet(building)
    except Exception:
        _files(df.sparkSession, building, lambda fs, path: fs.delete(path, True))
        raise
    _files(df.sparkSession, f"{root}/{name}", lambda fs, path: fs.delete(path, True))
    moved = _files(df.sparkSession, building, lambda fs, path: fs.rename(path, df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")))
    if not moved:
        raise OSError(f"{building} can't be moved to {root}/{name}")


def _files(spark: SparkSession, path: str, act):  # noqa: ANN001, ANN202
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return act(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p)


def unique(ranged: DataFrame, name: str) -> DataFrame:
    """The same rows, failing on a key that is null or occurs twice. ranged: by the key, and sorted, so equal keys are neighbours in one task and nothing is shuffled."""
    key = schema.TABLES[name][1]
    null = F.exists(F.array(*[F.col(k).isNull() for k in key]), lambda x: x)
    place = F.row_number().over(W.partitionBy(*key).orderBy(*key))
    wrong = F.raise_error(F.concat(F.lit(f"{name}: null or repeated key "), F.to_json(F.struct(*key))))
    return ranged.withColumn("__place", place).filter(F.when((F.col("__place") > 1) | null, wrong.cast("boolean")).otherwise(True)).drop("__place")


def write_ranked(df: DataFrame, table: str, path: str, buckets: int = 64, species: str = "species_id", score: str = "score", tie: str = "location_id") -> None:
    """An external table in buckets by species, best score first: what is asked of one species reads its bucket alone.

    Rows are ranged by species and score before, so a species with many rows is written by many tasks, a file each. less is -score: files are
    sorted upwards, and the statistics of row groups prune by it.
    """
    ranked = df.withColumn("less", -F.col(score)).repartitionByRange(species, "less", tie)
    ranked.write.mode("overwrite").option("path", path).bucketBy(buckets, species).sortBy(species, "less", tie).saveAsTable(table)


def violations(df: DataFrame, name: str) -> DataFrame:
    """Rows of a table's key that occur twice or hold a null: what unique indexes would refuse."""
    key = schema.TABLES[name][1]
    null = F.exists(F.array(*[F.col(k).isNull() for k in key]), lambda x: x)
    return df.groupBy(*key).agg(F.count("*").alias("rows")).filter((F.col("rows") > 1) | null)


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("sep", "\t").option("quote", "").option("compression", "gzip").csv(path)


def write_documents(df: DataFrame, path: str) -> None:
    """(name, document[, piece]) rows as gzipped text, a directory for each name.

    Pieces are ranged over the tasks, so a large document is written by several, a file each: it is its files in order of
    their names, joined byte by byte (gzip members may follow one another).
    """
    own = df if "piece" in df.columns else df.withColumn("piece", F.lit(0))
    ranged = own.repartitionByRange("name", "piece").sortWithinPartitions("name", "piece")
    ranged.select("name", F.col("document").alias("value")).write.mode("overwrite").partitionBy("name").option("compression", "gzip").text(path)


def metadata(spark: SparkSession, year: str, month: str, **more: object) -> DataFrame:
    """One row: version (mon-yyyy), its parts, and when it was made."""
    now = datetime.datetime.now(datetime.UTC).isoformat()
    row = {"version": f"{month.lower()}-{year}", "version_year": year, "version_month": month, **more, "generated_at": now}
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in row.items()])


def pass_through(spark: SparkSession, source: str, target: str, name: str) -> bool:
    """Copy an optional table as it is, if it is there."""
    if not readers.exists(spark, f"{source}/{name}"):
        return False
    spark.read.parquet(f"{source}/{name}").write.mode("overwrite").parquet(f"{target}/{name}")
    return True
