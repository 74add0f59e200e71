"""Scans: raw extracts, captured API documents, configuration, and tables of earlier runs."""

from __future__ import annotations

import sqlite3
from contextlib import closing
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import members, schema


class MissingColumn(ValueError):
    """An extract lacks a column that is needed."""


def read_tsv(spark: SparkSession, path: str, encoding: str = "UTF-8", member_bytes: int | None = None) -> DataFrame:
    """A (gzipped) tab-separated extract as strings: no quoting, bytes that aren't UTF-8 replaced, structurally short rows dropped.

    A gzip stream can't be split; callers store the projection as Parquet before anything else. With member_bytes, a file of several gzip
    members with an index (`members.index`) is read by a task for so many bytes of members.
    """
    header = spark.read.option("encoding", encoding).text(path).first()
    if header is None:
        raise MissingColumn(f"{path} has no header")
    names = header[0].rstrip("\r").split("\t")
    plain = members.read(spark, [path], member_bytes) if member_bytes else spark.read.option("encoding", encoding).text(path)
    lines = plain.select(F.split(F.regexp_replace("value", "\r$", ""), "\t").alias("f"))
    full = lines.filter((F.size("f") >= len(names)) & (F.array_join("f", "\t") != F.lit("\t".join(names))))
    return full.select(*[F.get("f", F.lit(i)).alias(n) for i, n in enumerate(names)])


def need(df: DataFrame, columns: list[str]) -> None:
    if lost := [c for c in columns if c not in df.columns]:
        raise MissingColumn(f"columns not found: {', '.join(lost)}")


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """Captured taxonomy document (a JSON array of objects) -> species: id is the place in the document from 1, only category species."""
    text = spark.read.option("wholetext", True).text(path)
    rows = text.select(F.posexplode(F.from_json("value", f"array<{schema.TAXONOMY.simpleString()}>")).alias("k", "t"))
    kept = rows.filter(F.coalesce(F.col("t.category"), F.lit("species")) == "species")
    codes = F.nullif(F.concat_ws(" ", F.concat(F.coalesce("t.bandingCodes", F.array().cast("array<string>")), F.coalesce("t.comNameCodes", F.array().cast("array<string>")))), F.lit(""))
    return kept.select((F.col("k") + 1).cast("bigint").alias("id"), F.col("t.sciName").alias("sci_name"), F.col("t.comName").alias("name"), F.col("t.speciesCode").alias("code"), F.col("t.taxonOrder").alias("taxon_order"), codes.alias("search_codes"))


def read_api_hotspots(spark: SparkSession, path: str) -> DataFrame:
    """Captured hotspot documents (JSON arrays) -> trimmed rows with defaults; empty strings become null."""
    raw = spark.read.schema(schema.API_HOTSPOTS).option("multiLine", True).json(path)
    text = {"locName": "name", "countryCode": "country_code", "subnational1Code": "subnational1_code", "subnational2Code": "subnational2_code"}
    clean = [F.nullif(F.trim(c), F.lit("")).alias(n) for c, n in text.items()]
    return raw.select(F.col("locId").alias("id"), *clean, "lat", "lng", F.coalesce("numSpeciesAllTime", F.lit(0)).alias("species")).withColumn("name", F.coalesce("name", F.lit("")))


def read_region_names(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object code -> name, as rows."""
    text = spark.read.option("wholetext", True).text(path)
    return text.select(F.explode(F.from_json("value", "map<string,string>")).alias("code", "name"))


def read_packs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.PACKS).option("multiLine", True).json(path)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of an earlier run, with its declared schema."""
    return spark.read.schema(schema.TABLES[name][0]).parquet(f"{root}/{name}")


def read_sqlite(spark: SparkSession, path: str, table: str, most: int = 1_000_000) -> DataFrame:
    """A dimension table of a SQLite file on the driver's machine, opened read-only. Larger tables belong in Parquet: beyond most rows this is an error."""
    with closing(sqlite3.connect(f"file:{path}?mode=ro&immutable=1", uri=True)) as db:
        rows = db.execute(f'SELECT * FROM "{table}" LIMIT {most + 1}').fetchall()
        kinds = {r[1]: r[2].upper() for r in db.execute(f'PRAGMA table_info("{table}")')}
    if len(rows) > most:
        raise ValueError(f"{table} has more than {most} rows")
    spark_kind = lambda k: "bigint" if "INT" in k else "double" if k in ("REAL", "DOUBLE", "FLOAT") else "binary" if k == "BLOB" else "string"
    return spark.createDataFrame(rows, ", ".join(f"`{n}` {spark_kind(k)}" for n, k in kinds.items()))


def sqlite_tables(path: str) -> list[str]:
    with closing(sqlite3.connect(f"file:{path}?mode=ro&immutable=1", uri=True)) as db:
        return [r[0] for r in db.execute("SELECT name FROM sqlite_master WHERE type = 'table' ORDER BY name")]


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def parse_env(text: str) -> dict[str, str]:
    """key=value lines; blank lines and comments are skipped, one pair of quotes around a value goes."""
    out = {}
    for line in text.splitlines():
        key, eq, value = line.strip().removeprefix("export ").partition("=")
        if eq and key and not key.startswith("#"):
            value = value.strip()
            out[key.strip()] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'" else value
    return out


def load_env(path: str | Path) -> dict[str, str]:
    return parse_env(Path(path).read_text()) if Path(path).exists() else {}
