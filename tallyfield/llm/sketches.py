"""Arrays of counters that partitions fill alone and that are then added: a fixed size whatever the input.

A partition sends its counters as compressed chunks (chunk, counts); chunks of one number are added
in one task each, so no task holds more than a chunk per partition, streamed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CHUNK = 1 << 16
SCHEMA = "chunk int, counts binary"


def chunks(counters: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Numbers and bytes of the chunks that aren't all zero."""
    parts = counters.reshape(-1, min(CHUNK, len(counters)))
    kept = [k for k, x in enumerate(parts) if x.any()]
    return kept, [_pack(parts[k]) for k in kept]


def _pack(x: np.ndarray) -> bytes:
    low, high = x.min(), x.max()
    kind = next(t for t in ("<u1", "<i4", "<i8") if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    data = x.astype(kind).tobytes()
    return kind.encode() + len(data).to_bytes(4, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(data[7:], int.from_bytes(data[3:7], "little"), codec="zstd"), data[:3].decode())


def _add(key: tuple, tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for t in tables:
        for x in t.column("counts"):
            own = _unpack(x.as_py()).astype(np.int64)
            total = own if total is None else total + own
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([_pack(total)], pa.binary())], names=["chunk", "counts"])


def total(rows: DataFrame, size: int, kind: type = np.int64) -> np.ndarray:
    """The sum of all partitions' counters, as kind (larger sums become its maximum). rows: (chunk, counts)."""
    out, most = np.zeros(size, kind), np.iinfo(kind).max
    step = min(CHUNK, size)
    for row in rows.select("chunk", "counts").groupBy("chunk").applyInArrow(_add, SCHEMA).collect():  # at most size counters
        out[row["chunk"] * step : (row["chunk"] + 1) * step] = np.minimum(_unpack(bytes(row["counts"])).astype(np.int64), most)
    return out
