"""Gzip files of several members, read by several tasks."""

import gzip
import random
import warnings

import pytest

from tallyfield.sources import members, readers


def joined(data: bytes, cuts: list[int]) -> bytes:
    ends = [0, *sorted(cuts), len(data)]
    return b"".join(gzip.compress(data[a:b]) for a, b in zip(ends, ends[1:], strict=False))


def read(spark, path, size):
    return sorted(r.value for r in members.read(spark, [str(path)], size).collect())


def test_a_file_of_members_is_read_by_tasks(spark, tmp_path):
    rng = random.Random(1)
    lines = [f"{i}\t" + "é" * rng.randint(0, 400) for i in range(2000)]
    data = "\n".join(lines).encode()
    path = tmp_path / "x.gz"
    path.write_bytes(joined(data, rng.sample(range(len(data)), 15)))
    with pytest.warns(UserWarning, match="no index"):
        members._Reader([str(path)], 1).partitions()
    members.index(spark, [str(path)])
    df = members.read(spark, [str(path)], 1)
    assert df.rdd.getNumPartitions() == 16 == len(members._Reader([str(path)], 1).partitions())
    want = sorted(r.value for r in spark.read.text(str(path)).collect())
    assert sorted(r.value for r in df.collect()) == want == sorted(lines)
    assert len(members._Reader([f"file://{path}"], len(path.read_bytes()) // 3).partitions()) in (2, 3)


def test_members_of_any_shape(spark, tmp_path):
    """Cuts at, before and behind line breaks, members of part of a line, empty members, no last break, an empty file."""
    texts = [b"", b"a", b"a\n", b"\n\n", b"ab\ncd\n\nef", b"abcdefgh\nx", b"x\nabcdefgh"]
    for n, data in enumerate(texts):
        for k in range(3):
            cuts = [random.Random(n * 9 + k).randint(0, len(data)) for _ in range(4 * k)]
            path = tmp_path / f"{n}-{k}.gz"
            path.write_bytes(joined(data, cuts))
            members.index(spark, [str(path)])
            parts = members._Reader([str(path)], 1)
            got = [x for p in parts.partitions() for b in parts.read(p) for x in b.column(0).to_pylist()]
            assert got == data.decode().splitlines(), (data, cuts)
    (tmp_path / "none.gz").write_bytes(b"")
    members.index(spark, [str(tmp_path / "none.gz")])
    assert read(spark, tmp_path / "none.gz", 1) == []


def test_a_cut_off_file_is_an_error(spark, tmp_path):
    path = tmp_path / "x.gz"
    path.write_bytes(joined(b"a\nb\n" * 50, [20])[:-9])
    with pytest.raises(Exception, match="isn't whole"):
        members.index(spark, [str(path)])
    with warnings.catch_warnings(), pytest.raises(Exception, match="isn't whole"):
        warnings.simplefilter("ignore")
        read(spark, path, 1)


def test_extracts_by_members(spark, tmp_path):
    rows = ["a\tb"] + [f"{i}\tx" for i in range(100)] + ["short"]
    data = "\r\n".join(rows).encode()
    path = tmp_path / "o.gz"
    path.write_bytes(joined(data, [50, 99, 300]))
    members.index(spark, [str(path)])
    got, want = (sorted(tuple(r) for r in readers.read_tsv(spark, str(path), member_bytes=n).collect()) for n in (1, None))
    assert got == want and len(got) == 100
