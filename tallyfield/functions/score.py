"""Wilson score, threshold buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Default z, thresholds of buckets, and the floors of hotspots and zones.
Z = 1.96
BUCKETS = (0.05, 0.10, 0.20, 0.30, 0.50)
LOC_SCORE, LOC_SAMPLES, ZONE_RATIO, ZONE_SAMPLES = 0.05, 25, 0.01, 25


def wilson(obs: Column, samples: Column, z: float = Z) -> Column:
    """Lower bound of the Wilson interval of obs of samples."""
    o, n = obs.cast("double"), samples.cast("double")
    zz = F.lit(z * z)
    root = F.sqrt(o * (n - o) / n + F.lit(z * z / 4))
    return (o + F.lit(z * z / 2) - F.lit(z) * root) / (n + zz)


def bucket_level(x: Column, thresholds: tuple[float, ...] = BUCKETS) -> Column:
    """Number of thresholds that x reaches, less one: -1 below the first."""
    reached = [F.when(x >= F.lit(t), 1).otherwise(0) for t in thresholds]
    total = reached[0]
    for r in reached[1:]:
        total = total + r
    return (total - 1).cast("int")
