"""Folding against the tokenizer of a full-text index, and stored posting lists against the plain search."""

import sqlite3
import unicodedata

import pytest
from pyspark.sql import functions as F

from tallyfield.functions import folding
from tallyfield.operators import search


def letters():
    return [c for c in map(chr, range(0x41, 0x30000)) if unicodedata.category(c)[0] == "L"]


def test_folding_equals_the_tokenizer():
    con = sqlite3.connect(":memory:")
    try:
        con.execute("CREATE VIRTUAL TABLE t USING fts5(x, tokenize = 'unicode61 remove_diacritics 2')")
    except sqlite3.OperationalError:
        pytest.skip("no full-text index in this build")
    con.execute("CREATE VIRTUAL TABLE v USING fts5vocab(t, instance)")
    con.executemany("INSERT INTO t (rowid, x) VALUES (?, ?)", [(ord(c), f"q{c}z") for c in letters()])
    terms = {}
    for doc, term in con.execute("SELECT doc, term FROM v"):
        terms.setdefault(chr(doc), []).append(term)
    # The tokenizer knows an older Unicode: it leaves newer letters as they are, or takes them for separators.
    other = {c: terms.get(c) for c in letters() if terms.get(c) != [f"q{folding.fold_text(c)}z"]}
    newer = [c for c, t in other.items() if t in ([f"q{c}z"], ["q", "z"])]
    assert set(other) - set(newer) <= {"Ǡ"} and "ǡ" in newer and len(other) < 450
    assert not any(ord(c) < 0x1E0 for c in other) and not any(0x1E00 <= ord(c) < 0x2000 for c in other)


def test_marks_and_strokes(spark):
    names = ["Việt", "ǰ", "ŵ", "ķ", "ơ", "Øre", "Łabędź", "đ", "é", "STRASSE ß", "ΣΊΣΥΦΟΣ", "İ"]
    want = ["viet", "j", "w", "k", "o", "øre", "łabedz", "đ", "e", "strasse ß", "σίσυφοσ", "i"]
    df = spark.createDataFrame(list(enumerate(names)), "i int, s string")
    assert [r.f for r in df.select("i", folding.fold(F.col("s")).alias("f")).orderBy("i").collect()] == want == [folding.fold_text(n) for n in names]
    every = spark.createDataFrame([("".join(letters()),)], "s string")
    assert every.select(folding.fold(F.col("s"))).first()[0] == folding.fold_text("".join(letters()))


@pytest.fixture(scope="module")
def names(spark):
    rows = [(i, f"{w} {v} {i}", f"{v} sp{i % 7}", None) for i, (w, v) in enumerate((w, v) for w in ("Việt", "Øre", "Łabędź", "ab", "a", "日本語") for v in ("abcdef", "abcxyz", "ábc", "x") for _ in range(30))]
    rows += [(i * 5000, "far away", "", "code") for i in range(1, 5)] + [(9, None, None, None)]
    return spark.createDataFrame(rows, "id bigint, name string, sci_name string, search_codes string")


@pytest.mark.parametrize("query", ["viet", "v", "vi", "VIỆT abc", "abcd", "abcdef", "abcde sp1", "ab ab", "a x 1", "łabę", "labedz", "日", "日本 x", "far code", "away", "nothing", "", " -- ", "abc_x"])
def test_blocks_find_what_the_index_holds(spark, names, query):
    fts = search.index(names).cache()
    got = sorted(r.species_id for r in search.find(search.blocks(fts), query).collect())
    assert got == sorted(r.species_id for r in search.search(fts, query).collect())
    words = search.words_of(query)
    tokens = {}
    for r in fts.collect():
        tokens.setdefault(r.species_id, set()).add(r.token)
    assert got == sorted(i for i, t in tokens.items() if words and all(any(x.startswith(w) for x in t) for w in words))


def test_a_query_reads_the_blocks_of_its_prefix(spark, names, tmp_path):
    search.blocks(search.index(names)).write.parquet(str(tmp_path / "b"))
    stored = spark.read.parquet(str(tmp_path / "b"))
    assert stored.groupBy("kind", "key", "block").count().filter("count > 1").count() == 0 and stored.filter(F.size("offsets") > 1 << search.BLOCK_BITS).count() == 0
    plan = search.find(stored, "far awa")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(kind,3)" in plan and "EqualTo(key,far)" in plan and "EqualTo(key,awa)" in plan
    assert search.blocks(search.index(names.limit(0))).count() == 0
