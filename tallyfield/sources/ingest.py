"""Raw extracts -> typed checklists and observations.

Malformed rows: structurally short ones are dropped by the scan; a date that can't be read leaves the
row without a month (it counts nowhere), a coordinate that can't be read is null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from . import schema
from .readers import need


def checklists(raw: DataFrame) -> DataFrame:
    """Complete checklists only."""
    need(raw, [*schema.CHECKLIST_COLUMNS, schema.COMPLETE])
    return typed(raw.filter(F.col(f"`{schema.COMPLETE}`") == "1"), schema.CHECKLIST_COLUMNS, schema.CHECKLISTS)


def observations(raw: DataFrame) -> DataFrame:
    """Observations of complete checklists, in the categories that are counted."""
    need(raw, [*schema.OBSERVATION_COLUMNS, schema.COMPLETE, schema.CATEGORY])
    kept = raw.filter((F.col(f"`{schema.COMPLETE}`") == "1") & F.col(f"`{schema.CATEGORY}`").isin(*schema.CATEGORIES))
    return typed(kept, schema.OBSERVATION_COLUMNS, schema.OBSERVATIONS)


def counters(raw: DataFrame, kept: DataFrame) -> DataFrame:
    """One row: rows read, written and skipped. For a running job attach ``observe`` to the same frames instead."""
    n = lambda df, name: df.agg(F.count("*").alias(name), F.lit(1).alias("k"))
    return n(raw, "read").join(n(kept, "written"), "k").select("read", "written", (F.col("read") - F.col("written")).alias("skipped"))


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """df with a count of its rows that is filled in by whatever action runs it."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def typed(raw: DataFrame, names: dict[str, str], into) -> DataFrame:  # noqa: ANN001
    kinds = {f.name: f.dataType for f in into}
    return raw.select(*[F.col(f"`{k}`").try_cast(kinds[v]).alias(v) for k, v in names.items()])
