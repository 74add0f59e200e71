"""Tables that several parts of a plan read, written once.

They go to the folder that the cluster names in ``spark.checkpoint.dir``, so a lost executor loses none; a
session on one machine that names none uses a temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return "file://" + tempfile.mkdtemp(prefix="tallyfield-")


def passing(spark: SparkSession, name: str) -> str:
    """A new path in the folder, which goes when the session ends."""
    path = f"{folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def store(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write df and read it back; the table goes when the session ends."""
    path = passing(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that df reads, each once; 0 where it reads none. Folders are listed, no file is opened."""
    spark, folders, total = df.sparkSession, {}, 0
    for name in df.inputFiles():
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(name))
        folders.setdefault(p.getParent().toString(), (p.getParent(), set()))[1].add(p.getName())
    for parent, names in folders.values():
        found = parent.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(parent)
        total += sum(f.getLen() for f in found if f.getPath().getName() in names)
    return total
