"""Exact deduplication, the Jaccard join, decontamination: against brute force, and the defined cases."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tallyfield.llm import components, decontaminate, exact_dedup, jaccard_join, shared

A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE, ALNUM = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(x):
    return (x or "").translate(A_Z)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_dedup(spark, edge, keep):
    rows = edge.select("doc_id", "text").collect()
    groups = defaultdict(list)
    for r in rows:
        groups[low(r.text)].append(r.doc_id)
    got = exact_dedup.dedup(spark, edge.repartition(5), keep).collect()
    assert len(got) == len(rows)
    pick = max if keep == "largest" else min
    sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
    for r in got:
        own = sha[r.text_sha256]
        known = [i for i in own if i is not None]
        assert r.group_size == len(own) and r.keep_id == (pick(known) if known else None)
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups)


def test_exact_dedup_empty_and_filter(spark, edge):
    assert exact_dedup.dedup(spark, edge.limit(0)).count() == 0
    out = exact_dedup.distinct_documents(spark, edge, "largest")
    assert out.columns == edge.columns
    assert sorted(low(r.text) for r in out.collect()) == sorted({low(r.text) for r in edge.collect()})


def test_tree_of_many_runs(spark):
    df = spark.range(2000).selectExpr("id as doc_id", "case when id % 3 = 0 then 'hot' else cast(id % 500 as string) end as text").repartition(40)
    got = {r.text_sha256: (r.keep_id, r.group_size) for r in exact_dedup.dedup(spark, df).collect()}
    assert got[hashlib.sha256(b"hot").hexdigest()] == (0, 667)


def brute_components(rows, n=5):
    sets = []
    for r in rows:
        w = SPACE.findall(low(r.text))
        sets.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            o = len(sets[i] & sets[j])
            if o and 100 * o >= 75 * (len(sets[i]) + len(sets[j]) - o):
                up[find(i)] = find(j)
    ids = defaultdict(list)
    for i, r in enumerate(rows):
        ids[find(i)].append(r.doc_id)
    return sorted((str(r.doc_id), len(s), str(min((x for x in ids[find(i)] if x is not None), default=None) if s else r.doc_id)) for i, (r, s) in enumerate(zip(rows, sets, strict=True)))


def test_jaccard_join(spark, near):
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard_join.join(spark, near.repartition(3)).collect())
    assert got == brute_components(near.collect())


def test_jaccard_join_edge(spark, edge):
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard_join.join(spark, edge).collect())
    assert got == brute_components(edge.collect())
    assert jaccard_join.join(spark, edge.limit(0)).count() == 0
    out = jaccard_join.one_of_each(spark, edge)
    assert out.columns == edge.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(["1", "2", "3", "4", "5", "6", "8", "9", "None"])


@pytest.mark.parametrize("bits", [1])
def test_jaccard_join_of_clashing_classes(spark, near, bits):
    """Different sets that share a class number stay apart."""
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard_join.join(spark, near, bits=bits).collect())
    assert got == brute_components(near.collect())


def test_jaccard_join_of_a_hub(spark, monkeypatch):
    """1,000 copies of one text and 300 near copies, with a filter that lets all pass and classes that count as hubs early."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base)] * 1000
    for _ in range(300):
        own = list(base)
        own[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(own))
    texts += [" ".join(rng.choice(base) for _ in range(20)) for _ in range(50)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(6)
    monkeypatch.setattr(jaccard_join, "HUB", 4)
    monkeypatch.setattr(components, "HUB", 4)
    monkeypatch.setattr(components, "SALT_FROM", 1)
    got = {r.doc_id: r.component_id for r in jaccard_join.join(spark, docs).collect()}
    rows = [r for r in docs.collect() if not 1 <= r.doc_id < 1000]
    want = {int(i): int(c) for i, _, c in brute_components(rows)}
    assert {i: c for i, c in got.items() if i in want} == want and all(got[i] == 0 for i in range(1000))


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 300), (7, 7)]
    got = {r.node: r.label for r in components.components(shared.Stage(spark, "t"), spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 100, 300: 100}
    assert components.components(shared.Stage(spark, "t"), spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def brute_hits(docs, items, window=13):
    windows = defaultdict(set)
    for i, text in items:
        w = ALNUM.findall(low(text))
        if w:
            m = min(window, len(w))
            for k in range(len(w) - m + 1):
                windows[tuple(w[k : k + m])].add("" if i is None else str(i))
    sizes = {len(k) for k in windows}
    out = []
    for d, text in docs:
        w, hit, own = ALNUM.findall(low(text)), set(), set()
        for m in sizes:
            for k in range(len(w) - m + 1):
                if found := windows.get(tuple(w[k : k + m])):
                    hit |= set(range(k, k + m))
                    own |= found
        out.append((str(d), len(w), len(hit), len(own), hashlib.sha256(",".join(sorted(own)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


ITEMS = [(1, " ".join(f"W{i}" for i in range(100, 130))), (2, "one two"), (3, None), (4, ""), (5, "w5"), (10, "one TWO"), (None, " ".join(f"w{i}" for i in range(300, 313))), (10, "another one")]


@pytest.mark.parametrize("block", [1 << 20, 20])
def test_decontamination(spark, edge, near, block):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = edge.select("doc_id", "text").unionByName(near)
    found = decontaminate.find(spark, docs, items, block_words=block)
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, len(r["items"]), hashlib.sha256(",".join(sorted(r["items"])).encode()).hexdigest(), bool(r.n_hit) and 20 * r.n_hit >= r.n_words) for r in found.collect())
    own = docs.collect()
    assert got == brute_hits([(r.doc_id, r.text) for r in own], ITEMS)
    short = sorted((str(r.doc_id), *brute_longest(r.text, ITEMS)) for r in own if len(r.text or "") < 3000)
    assert sorted((str(r.doc_id), r.longest_match, r.longest_at) for r in found.collect() if r.n_words < 700) == [x for x in short]


@pytest.mark.parametrize("block", [1 << 20, 20])
def test_decontamination_filter(spark, edge, block):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    out = decontaminate.clean_documents(spark, edge, items, block_words=block)
    want = [x for x in brute_hits([(r.doc_id, r.text) for r in edge.collect()], ITEMS) if not x[-1]]
    assert out.columns == edge.columns and sorted(str(r.doc_id) for r in out.collect()) == [x[0] for x in want]
    assert decontaminate.clean_documents(spark, edge, items.limit(0)).count() == edge.count()
    assert decontaminate.report(spark, edge.limit(0), items).count() == 0


def brute_longest(text, items, window=13):
    """(length, place) of the longest verbatim match that holds a window, or a whole shorter item."""
    w, best = ALNUM.findall(low(text)), (0, -1)
    for _, item in items:
        v = ALNUM.findall(low(item))
        for p in range(len(w)):
            for q in range(len(v) if len(v) >= window else min(1, len(v))):
                n = 0
                while p + n < len(w) and q + n < len(v) and w[p + n] == v[q + n]:
                    n += 1
                if n >= min(window, len(v)) and (n, -p) > (best[0], -best[1]):
                    best = (n, p)
    return best


def test_longest_match():
    items = [("1", "a b c d e f g"), ("2", "d e f x"), ("3", "b c"), ("4", "a b c"), ("5", "d e f"), ("6", "z z z z z z")]
    docs = ["x a b c d y", "e f g a b", "a b c d e f", "a b c q d e f x", "z z z z z z z z", "b c", "", "q", "c d e f x d e f g"]
    ix = decontaminate.index([i for i, _ in items], pa.array([t for _, t in items]), 3)
    spark_rows = decontaminate._scan(lambda: ix, True)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(docs))), pa.array(range(len(docs))), pa.array(docs)], names=["doc_id", "row", "text"])
    got = next(spark_rows(iter([batch])))
    assert list(zip(got["longest_match"].to_pylist(), got["longest_at"].to_pylist(), strict=True)) == [brute_longest(d, items, 3) for d in docs]
    # Touching runs of two items are one run of hit words, but no match is that long.
    two = decontaminate.index(["4", "5"], pa.array(["a b c", "d e f"]), 3)
    got = next(decontaminate._scan(lambda: two, True)(iter([batch.slice(2, 1)])))
    assert got["hits"].to_pylist() == [[0, 6]] and got["longest_match"].to_pylist() == [3]


def test_sorted_suffixes():
    rng = random.Random(3)
    for _ in range(60):
        text = [rng.randint(0, 3) for _ in range(rng.randint(0, 25))] + [0]
        want = sorted((k for k, x in enumerate(text) if x), key=lambda k: (text[k : text.index(0, k)], k))
        got = decontaminate.sorted_suffixes(np.array(text, np.uint32)).tolist()
        key = lambda k: text[k : text.index(0, k)]  # noqa: E731, B023
        assert [key(k) for k in got] == [key(k) for k in want] and sorted(got) == sorted(want)
