"""Byte-level BPE, spelling variants, whitening: against the public library, brute force and plain linear algebra, and the defined cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfield.llm import bpe, spelling, whitening

P = pytest.importorskip("public_tokenizers")
RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    with open(RANKS, "rb") as f:
        return bpe.Vocabulary(f.read(), P.PATTERN)


@pytest.fixture(scope="module")
def library(vocabulary):
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=vocabulary.tokens, special_tokens={})


def odd_texts():
    rng = random.Random(2)
    pieces = ["the", " cat", "'s", "'re", "\n", "  ", "\t", "é", "日本", "🙂", "‍", "\x00", "\x1c", "\u0085", " ", "1234", "٣", "aaaa", "!!", "<|endoftext|>", "́"]
    out = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    return [*out, "a" * 30_000, " " * 20_000 + "x", "ab" * 9_000, "".join(rng.choice("etaoin") for _ in range(5_000)), "日本語" * 2_000]


def test_encoding_equals_the_library(vocabulary, library):
    texts = odd_texts()
    ids, counts = vocabulary.encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [library.encode_ordinary(t) for t in texts]
    assert vocabulary.decode(ids, counts) == [t.encode() for t in texts]


def test_every_token_encodes_to_itself(vocabulary):
    assert bpe.merges(vocabulary)


def test_known_words_are_forgotten(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN", 3)
    monkeypatch.setattr(bpe, "LETTERS", 8)
    for t in ("one two three four", "five six seven", "one six eight nine"):
        assert vocabulary.encode([t])[0].tolist() == library.encode_ordinary(t)


def test_documents_with_all_cases(spark, edge, library, monkeypatch):
    monkeypatch.setattr(bpe, "TEXT_BYTES", 64)
    rows = edge.collect()
    got = bpe.digests(spark, edge.repartition(3), RANKS, P.PATTERN).collect()
    digest = lambda b: hashlib.sha256(b).hexdigest()
    want = [(r.doc_id, len(i := library.encode_ordinary(r.text or "")), digest(" ".join(map(str, i)).encode()), digest((r.text or "").encode())) for r in rows]
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    assert bpe.digests(spark, edge.limit(0), RANKS, P.PATTERN).count() == 0


def test_encode_keeps_columns_and_decode_takes_any_list(spark, edge):
    out = bpe.encode(spark, edge.withColumn("ids", F.lit("x")), RANKS, P.PATTERN)
    assert out.columns == [*edge.columns, "ids"] and out.schema["ids"].dataType.simpleString() == "array<int>"
    given = spark.createDataFrame([([15339, None, 10**6, 0],), (None,), ([],)], "ids array<int>")
    first = bpe.decode(spark, spark.createDataFrame([([15339, 0],)], "ids array<int>"), RANKS).first().decoded
    assert [bytes(r.decoded) for r in bpe.decode(spark, given.coalesce(1), RANKS).collect()] == [bytes(first), b"", b""]


A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_spelling(rows, deleted):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(A_Z)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % deleted == 0 else run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    form, count = {}, {}
    for w in n:
        others = [v for v in n if near(w, v)]
        best = min(others, key=lambda v: (-n[v], v), default=None)
        count[w], form[w] = len(others), best if best and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], count[w], n[form[w]] if form[w] else None))
    return sorted(out)


def spelling_rows():
    rng, rows = random.Random(4), []
    for base, often in (("abcdef", 400), ("aabbccdd", 300), ("straße", 150), ("ÀÉÎÕÜÿ", 90), ("levels", 500)):
        rows += [base] * often
        for _ in range(60):
            w = list(base)
            for _ in range(rng.randint(1, 2)):
                i, c = rng.randrange(len(w)), rng.choice("abcdefsé")
                match rng.randrange(3):
                    case 0:
                        w[i] = c
                    case 1:
                        w.insert(i, c)
                    case 2 if len(w) > 1:
                        del w[i]
            rows += ["".join(w)] * rng.choice([1, 4, 5, 6, 20, 60])
    # Anagrams share a key and aren't near; long words differ in one letter.
    rows += [w for w in ("listen", "silent", "enlist", "tinsel") for _ in range(9)]
    rows += ["x" * 5000] * 30 + ["x" * 2500 + "y" + "x" * 2499] * 6 + ["x" * 5001] * 5
    rng.shuffle(rows)
    return [(i // 40, " ".join(rows[i : i + 40]) + " Ab1 -") for i in range(0, len(rows), 40)]


@pytest.mark.parametrize("deleted", [199, 3])
def test_spelling_against_brute_force(spark, deleted):
    rows = [*spelling_rows(), (None, "levels LEVELS"), (7, None), (8, ""), (8, "levels")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("word", F.lit("x")).withColumn("n", F.lit(1)).withColumn("id", F.lit(0))
    got = spelling.group(spark, docs.repartition(5), deleted)
    assert sorted(map(tuple, got.collect())) == brute_spelling(rows, deleted)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_spelling_of_edge_cases(spark, edge):
    assert spelling.group(spark, edge.limit(0)).count() == 0
    assert sorted(map(tuple, spelling.group(spark, edge).collect())) == brute_spelling([(r.doc_id, r.text) for r in edge.collect()], 199)


def test_meetings_are_not_paired_out(spark):
    """All words of one removal meet: rows grow with the letters, not with the square of the words."""
    words = ["abcde" + chr(0xC0 + i) + "fgh" for i in range(60)]
    docs = spark.createDataFrame([(1, " ".join(words * 5))], "doc_id bigint, text string")
    found = spelling.words(docs, 10**9).withColumn("id", F.monotonically_increasing_id())
    met = spelling.meetings(found)
    assert met.count() == 60 and {r.near for r in met.collect()} == {59}


def brute_whitening(vectors):
    x = np.floor(np.array(vectors, float) * 1024) + 100_000
    n, s = len(x), x.sum(0)
    c = x - s / n
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1][:8], q[:, ::-1][:, :8]
    deviation = [int(((n * r.astype(object) - s.astype(object)) ** 2).sum()) for r in x]
    return deviation, c @ q / np.sqrt(e), e / np.trace(c.T @ c / n)


@pytest.mark.parametrize(("n", "dims"), [(300, 40), (500, 5), (40, 64)])
def test_whitening_against_plain_algebra(spark, n, dims):
    rng = np.random.default_rng(3)
    vectors = (rng.standard_normal((n, dims)) * np.linspace(1, 3, dims) @ rng.standard_normal((dims, dims))).astype(np.float32)
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, component string").withColumn("x", F.lit(1)).withColumn("n", F.lit("y"))
    got = whitening.whiten(spark, df.repartition(4)).toPandas()
    deviation, want, explained = brute_whitening(vectors)
    k = min(8, dims)
    assert len(got) == n * k and (got.n == n).all() and got.identity_error.max() < 1e-9
    one = got[got.component == 1].sort_values("vec_id")
    assert one.deviation.tolist() == deviation
    values = got.pivot(index="vec_id", columns="component", values="whitened").sort_index().to_numpy()
    sign = np.sign((values * want[:, :k]).sum(0))
    assert np.abs(values - want[:, :k] * sign).max() < 1e-8
    assert np.abs(got.groupby("component").explained.first().to_numpy() / explained[:k] - 1).max() < 1e-9


def test_whitening_of_bad_rows(spark):
    nan, inf = math.nan, math.inf
    good = [(i, [float(i % 7), float(i % 3), 1.0]) for i in range(30)]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [nan, 0.0, 0.0]), (104, [inf, 0.0, 0.0]), (105, [1.0, 2.0])]
    df = spark.createDataFrame([*good, *bad, (None, [5.0, 1.0, 1.0])], "vec_id bigint, embedding array<double>")
    got = whitening.whiten(spark, df)
    # The third dimension is constant, so two components are left.
    assert {(r.vec_id, r.component) for r in got.collect()} == {(i, c) for i in [*range(30), None] for c in (1, 2)}
    assert got.first().identity_error < 1e-9 and abs(sum(r.explained for r in got.filter("vec_id = 3").collect()) - 1) < 1e-9
    for few in (df.limit(0), df.filter("vec_id = 4"), df.filter("vec_id in (100, 101)"), df.filter("vec_id in (4, 25)").withColumn("embedding", F.lit([1.0, 1.0]))):
        assert whitening.whiten(spark, few).count() == 0


def test_huge_entries(spark):
    df = spark.createDataFrame([(i, [x, 0.0]) for i, x in enumerate([1e300, -1e300, 0.0, 1.0])], "vec_id bigint, embedding array<double>")
    got = whitening.whiten(spark, df).filter("component = 1").collect()
    assert {r.deviation for r in got} == {None} or max(r.deviation or 0 for r in got) < 1 << 63
    assert all(math.isfinite(r.whitened) for r in got)


def test_lanczos_restarts_on_breakdown():
    """Few different eigenvalues exhaust a block at once; every direction of the largest is still found, and a full basis ends the passes."""
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.standard_normal((50, 50)))[0]
    for values in (np.array([3.0] * 12 + [1.0] * 38), np.array([2.0, 1.0] + [0.0] * 48), np.ones(50), np.linspace(1, 1.01, 50)):
        a, passes = q * values @ q.T, []
        e, v = whitening.lanczos(lambda x: (passes.append(x.shape[1]), a @ x)[1], 50, 8, 8)
        assert np.abs(e - np.sort(values)[::-1][:8]).max() < 1e-12 and np.abs(v.T @ v - np.eye(8)).max() < 1e-12
        assert np.abs(a @ v - v * e).max() < 1e-12 and sum(passes) <= 50
