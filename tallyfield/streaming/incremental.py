"""Keeping the summed tables current from a stream of new checklists (an extension; the batch builds don't need it).

Sums are additive, distinct counts are not: duplicates of a checklist are dropped within the watermark
before anything is summed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.regions import dedupe_key


def monthly_samples(checklists: DataFrame, lateness: str = "7 days") -> DataFrame:
    """Streaming checklists (location_id, event_id, group_id, seen_at) -> location_id, month, samples."""
    rows = checklists.withColumn("k", dedupe_key(F.col("group_id"), F.col("event_id"))).withWatermark("seen_at", lateness)
    once = rows.withColumn("month", F.month("seen_at").cast("bigint")).dropDuplicatesWithinWatermark(["location_id", "month", "k"])
    return once.groupBy("location_id", "month").agg(F.count("*").alias("samples"))


def merge_into(df: DataFrame, path: str, checkpoint: str, keys: list[str], value: str) -> StreamingQuery:
    """Keep the table's versions v0, v1, ... at path current: each batch writes the next, with its sums in place of the query's older ones.

    A query with a new checkpoint on a path that has versions adds its sums to those of the newest, which it must not have read itself. A batch that is
    run again writes its own version again. A version that is missing is an error, never an empty table. Versions before the last two go, but for the one
    that a query began with.
    """
    spark = df.sparkSession
    start = _start(spark, path, checkpoint)

    def one(batch: DataFrame, number: int) -> None:
        spark, n = batch.sparkSession, start + number
        empty = batch.select(*keys, value).limit(0)
        base = spark.read.parquet(f"{path}/v{start - 1}") if start else empty
        old = spark.read.parquet(f"{path}/v{n - 1}") if n else empty
        before = base.select(*keys, F.col(value).alias("__before"))
        sums = batch.select(*keys, value).join(before, keys, "left").select(*keys, (F.col(value) + F.coalesce("__before", F.lit(0))).alias(value))
        kept = old.select(*keys, value).join(batch.select(*keys), keys, "left_anti")
        kept.unionByName(sums).write.mode("overwrite").parquet(f"{path}/v{n}")
        for v in range(max(0, n - 2), n - 1):
            if v != start - 1:
                fs, p = _handle(spark, f"{path}/v{v}")
                fs.delete(p, True)

    return df.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(one).trigger(availableNow=True).start()


def _handle(spark: SparkSession, path: str):  # noqa: ANN202
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _start(spark: SparkSession, path: str, checkpoint: str) -> int:
    """The version that a query's first batch writes: behind the newest when the query was new, which is noted beside its checkpoint."""
    note = f"{checkpoint.rstrip('/')}-start"
    fs, p = _handle(spark, note)
    if fs.exists(p):
        return spark.read.parquet(note).first()["start"]
    fs, p = _handle(spark, path)
    names = [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []
    start = max((int(n[1:]) + 1 for n in names if n[:1] == "v" and n[1:].isdigit()), default=0)
    spark.range(1).select(F.lit(start).alias("start")).write.parquet(note)
    return start
