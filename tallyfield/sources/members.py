"""Gzipped text of several members, read by as many tasks.

A gzip file may be several members in a row, as joined or block-wise compressed files are. Where each begins can't be
told from the bytes without inflating them, so `index` writes it down beside the file, once, in one pass a file; `gzip_lines` then reads a file
with an index by ranges of members, and one without in a single task, with a warning. Files are opened by their URI in
the tasks, so any shared file system that Arrow knows will do.
"""

from __future__ import annotations

import warnings
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of a read, lines of a batch, and what is added to a file's name for its index.
BLOCK, LINES, SUFFIX = 1 << 20, 4096, ".members"


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _members(file: pa.NativeFile) -> Iterator[int]:
    """Where members begin, then the end of the last one."""
    at = 0
    while True:
        file.seek(at)
        inflate, seen = zlib.decompressobj(31), 0
        while not inflate.eof:
            block = file.read(BLOCK)
            if not block:
                if seen:
                    raise EOFError(f"a member that begins at {at} isn't whole")
                yield at
                return
            inflate.decompress(block)
            seen += len(block)
        yield at
        at += seen - len(inflate.unused_data)


def index(spark: SparkSession, paths: list[str]) -> None:
    """Write the index of each file beside it: a task a file, no rows through the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column("path").to_pylist():
                system, own = _opened(path)
                with system.open_input_file(own) as file:
                    found = list(_members(file))
                with system.open_output_stream(own + SUFFIX) as out:
                    out.write("\n".join(map(str, found)).encode())
        yield pa.RecordBatch.from_arrays([pa.array([], pa.string())], names=["path"])

    spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths))).mapInArrow(run, "path string").collect()  # no rows


class _Range(InputPartition):
    def __init__(self, path: str, start: int, end: int | None):
        self.path, self.start, self.end = path, start, end


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str], size: int):
        self.paths, self.size = paths, size

    def partitions(self) -> list[InputPartition]:
        out = []
        for path in self.paths:
            system, own = _opened(path)
            if system.get_file_info(own + SUFFIX).type == fs.FileType.NotFound:
                warnings.warn(f"{path} has no index of members: one task reads it", stacklevel=2)
                out.append(_Range(path, 0, None))
                continue
            with system.open_input_stream(own + SUFFIX) as file:
                found = [int(x) for x in file.read().split()]
            starts = found[:1]
            for x in found[1:-1]:
                if x - starts[-1] >= self.size:
                    starts.append(x)
            out += [_Range(path, a, b) for a, b in zip(starts, [*starts[1:], found[-1]], strict=True)] if len(found) > 1 else []
        return out

    def read(self, partition: _Range | None) -> Iterator[pa.RecordBatch]:
        """The lines that begin in a range: what stands before its first line break is the range's before, and its last line may go on in the next."""
        if partition is None:  # there are none
            return
        system, own = _opened(partition.path)
        held: list[str] = []
        with system.open_input_file(own) as file:
            for line in _lines(file, partition.start, partition.end):
                held.append(line.decode("utf-8", "replace"))
                if len(held) == LINES:
                    yield _batch(held)
                    held = []
        if held:
            yield _batch(held)


def _batch(lines: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])


def _inflated(file: pa.NativeFile, at: int) -> Iterator[tuple[int, bytes]]:
    """(where its member begins, bytes) up to the end of the file."""
    file.seek(at)
    inflate, rest, read, begun = zlib.decompressobj(31), b"", at, False
    while block := rest or file.read(BLOCK):
        read += 0 if rest else len(block)
        plain, begun = inflate.decompress(block), True
        rest = inflate.unused_data
        if plain:
            yield at, plain
        if inflate.eof:
            at, inflate, begun = read - len(rest), zlib.decompressobj(31), False
    if begun:
        raise EOFError(f"a member that begins at {at} isn't whole")


def _lines(file: pa.NativeFile, start: int, end: int | None) -> Iterator[bytes]:
    part: list[bytes] = []
    skipping = start > 0  # the line that is open at the start is the range's before; its break may be that range's last byte
    for member, plain in _inflated(file, start):
        beyond = end is not None and member >= end
        pieces = plain.split(b"\n")
        for piece in pieces[:-1]:
            if not skipping:
                yield b"".join([*part, piece])
            part, skipping = [], False
            if beyond:
                return
        if not skipping:
            part.append(pieces[-1])
    if not skipping and any(part):
        yield b"".join(part)


class GzipLines(DataSource):
    """Options: paths (one in a line), size (bytes of members that a task reads at least)."""

    @classmethod
    def name(cls) -> str:
        return "gzip_lines"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _Reader(self.options["paths"].split("\n"), int(self.options.get("size", 64 << 20)))


def read(spark: SparkSession, paths: list[str], size: int = 64 << 20) -> DataFrame:
    """value: the lines of gzipped files, in no order. Bytes that aren't UTF-8 are replaced; a line may cross members, and an empty file has none."""
    spark.dataSource.register(GzipLines)
    return spark.read.format("gzip_lines").option("paths", "\n".join(paths)).option("size", size).load()
