"""Session helpers that the operators of this subpackage share.

Intermediate tables go to the folder that the cluster names in ``spark.checkpoint.dir``: every
executor can read them, so losing an executor never loses part of one.
"""

from __future__ import annotations

import ctypes
import gc
import pickle
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

#: Code points that the contracts call white space between words.
SPACE = r"\x20\x09-\x0D"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, which may not have it installed; once per application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).resolve().parent.parent
        path = Path(tempfile.mkdtemp(prefix="tallyfield-")) / f"{package.name}.zip"
        with zipfile.ZipFile(path, "w") as out:
            for p in sorted(package.rglob("*.py")):
                out.write(p, p.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(path))
        _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the input folder, through Spark's own reader (any store that Spark can open)."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables. A session that names none may use a temporary one only if it has no other machine."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    own = "file://" + tempfile.mkdtemp(prefix="tallyfield-")
    spark.sparkContext.setCheckpointDir(own)
    return own


class Stage:
    """Tables written for one run of an operator. Those that later steps don't read are dropped at once, those that the result reads when the session ends."""

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.fs, self.path = self._handle(self.root)
        self.fs.deleteOnExit(self.path)

    def _handle(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write df and read it back: the lineage ends here."""
        self.sweep()
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.root}/{name}")
        self.sweep()
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            fs, path = self._handle(f"{self.root}/{name}")
            fs.delete(path, True)

    def sweep(self) -> None:
        """Let Spark's cleaner drop the shuffle files of plans that are no longer held."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; everything else stays."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts(df: DataFrame, *more: str, text: str = "text") -> DataFrame:
    """doc_id (bigint), text (null: empty) and the named columns; columns beyond those are ignored."""
    return df.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), *more)


def crc_mod(n: int) -> Column:
    """crc32 of doc_id's decimal text, mod n (null doc_id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % n


def trim() -> None:
    """Give freed memory back to the system: a worker lives on between tasks, and would hold what its largest task took."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows' batches that aren't empty; memory is trimmed before the first and behind the last."""
    trim()
    for b in rows:
        if b.num_rows:
            yield b
    b = None
    trim()


#: Labels that are learned (the most frequent ones), and bytes of text of a training sample: rows beyond are left out, whole.
LABELS, SAMPLE_BYTES = 1000, 1 << 28


def sample(rows: DataFrame, label: str, per: int) -> DataFrame:
    """About per rows of each value of label (fewer where there are fewer), never more than per times the values, by the digest of doc_id: the same rows on every run. Of more than LABELS values the most frequent count."""
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().orderBy(F.desc("count"), label).limit(LABELS).collect()}
    if not counts:
        return rows.limit(0)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.element_at(F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(per / n))]), F.col(label))
    return rows.withColumn("place", place / share).filter("place < 1").orderBy("place", "doc_id").limit(per * len(counts)).drop("place")


def train(rows: DataFrame, function) -> object:  # noqa: ANN001
    """function(table of all rows) in one task, so that the driver needn't hold what training holds. rows: a bounded sample, of which whole rows are taken up to SAMPLE_BYTES; the result comes back pickled."""

    def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, batch, left = [], None, SAMPLE_BYTES
        for batch in batches_:
            size = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
            n = int(np.searchsorted(size, left, "right"))
            held.append(batch.slice(0, n))
            left -= int(size[n - 1]) if n else 0
            if n < batch.num_rows:
                break
        model = pickle.dumps(function(pa.Table.from_batches(held, schema)))
        held = batch = None
        trim()
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], names=["model"])

    schema = to_arrow_schema(rows.schema)
    found = rows.repartition(1).mapInArrow(run, "model binary").first()
    return pickle.loads(bytes(found["model"])) if found else function(schema.empty_table())
