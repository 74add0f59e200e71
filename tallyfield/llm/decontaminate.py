"""Benchmark decontamination with suffix arrays over the training text.

Training documents are cut into shards of about half a megabyte. A shard's words become the benchmark's
word numbers (0: not a benchmark word, which no match can hold), and the suffixes that begin as a
benchmark window begins (no other can hold one) are sorted into the shard's suffix array, to the depth of a
window. Every suffix of every benchmark item is looked up by binary search of its first words, one window; a
range of the array gives the verbatim occurrences and where they are. Each occurrence is then extended: its
whole suffix is searched in the sorted suffixes of the benchmark, and what it shares with its neighbours there
is the longest verbatim match that begins at this place.

The benchmark's windows are broadcast only up to BLOCK_WORDS words, counted first; a larger
benchmark is dealt into blocks of about that size, one at a time, each searched against all documents; the
blocks' hits (clean documents give none) are united per document.

Defined cases: a null text has no words and no hits; a null or empty item has no windows; a null
item_id counts as the empty string; items that repeat an item_id count once; an empty benchmark
leaves every document clean; a document longer than a shard is a shard of its own; of equally long matches the
first place counts; repeated documents each give a row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared, words

WINDOW = 13
#: A document is contaminated if at least 1 / SHARE of its words are hit.
SHARE = 20
BLOCK_WORDS = 1 << 20
_BITS = 22


@dataclass
class Index:
    """A block of the benchmark: its vocabulary, its distinct windows as sorted search keys, and the items of each window."""

    vocabulary: np.ndarray
    keys: np.ndarray  # windows x WINDOW, word numbers, 0 after a short item's end
    lengths: np.ndarray
    items_of: list[np.ndarray]
    items: list[str]
    heads: list[np.ndarray]  # by number of leading words 1, 2, 3: which hashes of them begin a window
    text: np.ndarray  # word numbers of all items, a 0 behind each
    suffixes: np.ndarray  # places in text in the order of the words from there to the item's end


def _head(ids: np.ndarray, depth: int) -> np.ndarray:
    """Hash of the first words of each row of ids."""
    h = ids[:, 0].astype(np.uint64)
    for k in range(1, depth):
        h = h * np.uint64(0x9E3779B97F4A7C15) + ids[:, k].astype(np.uint64)
    return (words.mix(h) & np.uint64((1 << _BITS) - 1)).astype(np.int64)


def _packed(keys: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings that sort alike."""
    return np.ascontiguousarray(keys.astype(">u4")).view(f"S{4 * keys.shape[1]}").ravel()


def sorted_suffixes(text: np.ndarray) -> np.ndarray:
    """Places of text's words in the order of what follows them up to a 0, by doubling the compared length; 0s are no suffixes."""
    n = len(text)
    rank, step = np.concatenate([text.astype(np.int64), [0]]), 1
    ends = np.append(np.flatnonzero(text == 0), n)
    end = ends[np.searchsorted(ends, np.arange(n))]
    place = np.arange(n)
    while n and step < int((end - place).max(initial=0)):
        behind = np.where(place + step < end, rank[np.minimum(place + step, n)], 0)
        _, found = np.unique(rank[:n] * np.int64(rank.max() + 2) + behind, return_inverse=True)
        rank[:n] = np.where(text > 0, found.ravel() + 1, 0)
        step *= 2
    own = np.flatnonzero(text > 0)
    return own[np.argsort(rank[own], kind="stable")]


def index(item_ids: list[str], texts: pa.Array, window: int = WINDOW) -> Index:
    hashes: list[np.ndarray] = []
    for s in words.slabs(texts, words.ALNUM):
        at = s.bounds()
        hashes += [s.hash[at[i] : at[i + 1]] for i in range(s.docs)]
    vocabulary = np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, np.uint64)
    rows, owners, whole = [], [], []
    for item, h in zip(item_ids, hashes, strict=True):
        if len(h):
            ids = (np.searchsorted(vocabulary, h) + 1).astype(np.uint32)
            whole += [ids, np.zeros(1, np.uint32)]
            if len(ids) < window:
                ids = np.concatenate([ids, np.zeros(window - len(ids), np.uint32)])
            own = np.lib.stride_tricks.sliding_window_view(ids, window)
            rows.append(own)
            owners += [item] * len(own)
    items = sorted(set(owners))
    keys = np.concatenate(rows) if rows else np.zeros((0, window), np.uint32)
    keys, which = np.unique(keys, axis=0, return_inverse=True)
    number = {x: i for i, x in enumerate(items)}
    pairs = np.unique(np.stack([which.ravel(), np.array([number[x] for x in owners], np.int64)], 1), axis=0) if owners else np.zeros((0, 2), np.int64)
    cut = np.searchsorted(pairs[:, 0], np.arange(len(keys) + 1))
    lengths = (keys > 0).sum(1)
    heads = []
    for depth in (1, 2, 3):
        head = np.zeros(1 << _BITS, bool)
        chosen = keys[lengths == depth] if depth < 3 else keys[lengths >= 3]
        if window >= depth:
            head[_head(chosen, depth)] = True
        heads.append(head)
    text = np.concatenate(whole) if whole else np.zeros(1, np.uint32)
    return Index(vocabulary, keys, lengths, [pairs[a:b, 1] for a, b in zip(cut[:-1], cut[1:], strict=True)], items, heads, text, sorted_suffixes(text))


def numbers(slab: words.Slab, ix: Index) -> np.ndarray:
    """The shard's words as benchmark word numbers, and a window of 0s behind them."""
    n = len(slab.hash)
    at = np.searchsorted(ix.vocabulary, slab.hash)
    at[at == len(ix.vocabulary)] = 0
    ids = np.zeros(n + ix.keys.shape[1], np.uint32)
    ids[:n] = np.where(ix.vocabulary[at] == slab.hash, at + 1, 0)
    return ids


def suffix_array(slab: words.Slab, ix: Index, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of a shard's suffixes that may hold a window, in the order of their words; and their packed words."""
    window, n = ix.keys.shape[1], len(slab.hash)
    last = slab.bounds()[1:][slab.doc] if n else np.zeros(0, np.int64)
    near = np.lib.stride_tricks.sliding_window_view(ids, window)
    where = np.arange(n)
    may = np.zeros(n, bool)
    for depth, head in enumerate(ix.heads, 1):
        if depth <= window and head.any():
            known = np.flatnonzero((where + depth <= last) & (ids[:n] > 0)) if n else where
            may[known[head[_head(near[known, :depth], depth)]]] = True
    chosen = np.flatnonzero(may)
    keys = near[chosen] * (chosen[:, None] + np.arange(window) < last[chosen][:, None])
    packed = _packed(keys)
    order = np.argsort(packed, kind="stable")
    return chosen[order], packed[order]


def matches(slab: words.Slab, ix: Index, ids: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(position, window) of every verbatim occurrence: binary search of each window in the shard's suffix array."""
    none = np.zeros(0, np.int64)
    if not len(ix.keys) or not len(slab.hash):
        return none, none
    positions, suffixes = suffix_array(slab, ix, numbers(slab, ix) if ids is None else ids)
    upper = ix.keys.astype(np.uint64)
    upper[np.arange(len(upper)), ix.lengths - 1] += 1
    low, high = (np.searchsorted(suffixes, _packed(k)) for k in (ix.keys, upper))
    count = high - low
    which = np.repeat(np.arange(len(count)), count)
    first = np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
    return positions[first], which


def _shared(ix: Index, ids: np.ndarray, position: np.ndarray, last: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many words a document has from position (up to last) in common with the benchmark from place, and whether it sorts behind that."""
    length, going = np.zeros(len(position), np.int64), np.arange(len(position))
    behind = np.zeros(len(position), bool)
    while len(going):
        p, q = position[going] + length[going], place[going] + length[going]
        a, b = np.where(p < last[going], ids[np.minimum(p, len(ids) - 1)], 0), ix.text[q]
        same = (a == b) & (b > 0)
        behind[going[~same]] = (a > b)[~same]
        going = going[same]
        length[going] += 1
    return length, behind


def longest(ix: Index, ids: np.ndarray, position: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Words of the longest verbatim match with any item that begins at each position, by binary search in the benchmark's suffixes."""
    low, high = np.zeros(len(position), np.int64), np.full(len(position), len(ix.suffixes))
    best = np.zeros(len(position), np.int64)
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) // 2
        length, behind = _shared(ix, ids, position[open_], last[open_], ix.suffixes[middle])
        best[open_] = np.maximum(best[open_], length)  # both neighbours of the place that is found are met on the way
        low[open_] = np.where(behind, middle + 1, low[open_])
        high[open_] = np.where(behind, high[open_], middle)
    return best


def _scan(ix_of, all_: bool) -> callable:
    """mapInArrow function: doc_id, row, text -> doc_id, row, n_words, n_hit, hits (start, end word), items, longest match and its place; all_: also of documents without a hit."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = ix_of()
        for batch in shared.batches(rows):
            n_words, n_hit, hits, items, length, place = [], [], [], [], [], []
            for slab in words.slabs(batch.column("text"), words.ALNUM):
                bound = slab.bounds()
                n_words += np.diff(bound).tolist()
                got: list = [([], [], 0, -1, 0)] * slab.docs
                ids = numbers(slab, ix) if len(ix.keys) else None
                positions, which = matches(slab, ix, ids)
                if len(positions):
                    order = np.argsort(positions, kind="stable")
                    positions, which = positions[order], which[order]
                    doc = slab.doc[positions]
                    reach = longest(ix, ids, positions, bound[1:][doc])
                    reach = np.where(reach >= ix.keys.shape[1], reach, ix.lengths[which])
                    cut = np.flatnonzero(np.diff(doc, prepend=-1))
                    for a, b in zip(cut, [*cut[1:], len(doc)], strict=True):
                        d = int(doc[a])
                        p, w = positions[a:b] - bound[d], which[a:b]
                        start, end = unite(p, p + ix.lengths[w])
                        own = np.unique(np.concatenate([ix.items_of[k] for k in np.unique(w)]))
                        top = a + int(np.argmax(reach[a:b]))
                        got[d] = (np.stack([start, end], 1).ravel().tolist(), [ix.items[k] for k in own], int(reach[top]), int(positions[top] - bound[d]), int((end - start).sum()))
                for to, k in ((hits, 0), (items, 1), (length, 2), (place, 3), (n_hit, 4)):
                    to += [x[k] for x in got]
            found = pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(hits, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string())), pa.array(length, pa.int64()), pa.array(place, pa.int64())],
                names=["doc_id", "row", "n_words", "n_hit", "hits", "items", "longest_match", "longest_at"],
            )
            yield found if all_ else found.filter(pa.array(np.array(n_hit) > 0))

    return run


def unite(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of spans sorted by start, as disjoint spans."""
    reach = np.maximum.accumulate(end)
    new = np.concatenate([[True], start[1:] > reach[:-1]])
    return start[new], np.maximum.reduceat(end, np.flatnonzero(new))


_FOUND = "doc_id bigint, row bigint, n_words bigint, n_hit bigint, hits array<bigint>, items array<string>, longest_match bigint, longest_at bigint"


def _unite_blocks(pdf: pd.DataFrame) -> pd.DataFrame:
    spans = np.array(sorted(tuple(x) for h in pdf["hits"] for x in np.reshape(h, (-1, 2))), np.int64).reshape(-1, 2)
    start, end = unite(spans[:, 0], spans[:, 1])
    top = pdf.sort_values(["longest_match", "longest_at"], ascending=[False, True]).iloc[0]
    items = sorted({x for own in pdf["items"] for x in own})
    return pd.DataFrame({"doc_id": [top["doc_id"]], "row": [top["row"]], "n_words": [top["n_words"]], "n_hit": [int((end - start).sum())], "hits": [np.stack([start, end], 1).ravel().tolist()], "items": [items], "longest_match": [top["longest_match"]], "longest_at": [top["longest_at"]]})


def _count_words(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in shared.batches(rows):
        n = [x for slab in words.slabs(batch.column("text"), words.ALNUM) for x in np.diff(slab.bounds()).tolist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), pa.array(n, pa.int64())], names=["doc_id", "row", "n_words"])


def _blocks(benchmark: DataFrame, window: int, block_words: int) -> Iterator[Index]:
    """The benchmark's indexes, each of a bounded size; one unless the benchmark is beyond block_words."""
    tests = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = tests.agg(F.sum(F.length("text") / 2)).first()[0] or 0  # no text has more words than half its length, rounded up
    blocks = max(1, int(-(-n // block_words)))
    for k in range(blocks):
        own = tests.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).toPandas()
        yield index(own["item_id"].tolist(), pa.array(own["text"].tolist(), pa.string()), window)


def _hits(stage: shared.Stage, rows: DataFrame, benchmark: DataFrame, window: int, block_words: int) -> DataFrame:
    """Documents with hits of a benchmark of several blocks; one block at a time is broadcast. rows: doc_id, row, text."""
    found = []
    for k, ix in enumerate(_blocks(benchmark, window, block_words)):
        held = stage.spark.sparkContext.broadcast(ix)
        found.append(stage.write(rows.mapInArrow(_scan(lambda held=held: held.value, False), _FOUND), f"hits{k}"))
        held.destroy()
    return reduce(DataFrame.unionByName, found).groupBy("row").applyInPandas(_unite_blocks, _FOUND)


def _large(benchmark: DataFrame, block_words: int) -> bool:
    return (benchmark.agg(F.sum(F.length("text") / 2)).first()[0] or 0) > block_words


def find(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document row: doc_id, row, n_words, n_hit, hits (start and end of each disjoint run of hit words), items with hits, longest_match (words of the longest verbatim match of a window or more, or of a whole shorter item; 0 without), longest_at (its first word in the document; -1 without)."""
    rows = shared.texts(docs).withColumn("row", F.monotonically_increasing_id())
    if not _large(benchmark, block_words):
        held = spark.sparkContext.broadcast(next(_blocks(benchmark, window, block_words)))
        return rows.mapInArrow(_scan(lambda: held.value, True), _FOUND)
    stage = shared.Stage(spark, "decontaminate")
    rows = stage.write(rows, "rows")
    hits = _hits(stage, rows, benchmark, window, block_words).drop("doc_id", "n_words")
    out = rows.mapInArrow(_count_words, "doc_id bigint, row bigint, n_words bigint").join(hits, "row", "left")
    none = {"n_hit": F.lit(0), "hits": F.array().cast("array<bigint>"), "items": F.array().cast("array<string>"), "longest_match": F.lit(0), "longest_at": F.lit(-1)}
    return out.select("doc_id", "row", "n_words", *[F.coalesce(c, v.cast("bigint") if c not in ("hits", "items") else v).alias(c) for c, v in none.items()])


def contaminated() -> Column:
    return (F.col("n_hit") > 0) & (F.col("n_hit") * SHARE >= F.col("n_words"))


def clean_documents(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents that are not contaminated, with all their columns; nothing is shuffled unless the benchmark needs several blocks."""
    if _large(benchmark, block_words):
        stage = shared.Stage(spark, "decontaminate")
        rows = stage.write(docs.select(F.struct("*").alias("own"), "doc_id", "text").withColumn("row", F.monotonically_increasing_id()), "rows")
        bad = _hits(stage, shared.texts(rows, "row"), benchmark, window, block_words).filter(contaminated()).select("row")
        return rows.join(bad, "row", "left_anti").select("own.*")
    held = spark.sparkContext.broadcast(next(_blocks(benchmark, window, block_words)))
    column = docs.columns.index("text")

    def keep(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shared.batches(rows):
            good = []
            for slab in words.slabs(batch.column(column), words.ALNUM):
                bound, ix = slab.bounds(), held.value
                positions, which = matches(slab, ix)
                edges = np.bincount(positions, minlength=len(slab.hash) + 1) - np.bincount(positions + ix.lengths[which], minlength=len(slab.hash) + 1)
                n_hit = np.bincount(slab.doc[np.cumsum(edges[:-1]) > 0], minlength=slab.docs)
                good.append((n_hit == 0) | (SHARE * n_hit < np.diff(bound)))
            yield batch.filter(pa.array(np.concatenate(good)))

    return docs.mapInArrow(keep, docs.schema)


def report(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    x = find(spark, docs, benchmark)
    digest = F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256)
    return x.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), digest.alias("items_sha256"), contaminated().alias("contaminated"), "longest_match", "longest_at")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(spark, shared.table(spark, sf_dir, "documents"), shared.table(spark, sf_dir, "benchmark"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), b AS (SELECT item_id, row_number() OVER () AS r, {_WORDS} AS w FROM benchmark),
io AS (SELECT r, item_id, k AS o, least(len(w), 13) AS m, list_slice(w, k, k + least(len(w), 13) - 1) AS win FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS u(k) WHERE len(w) > 0),
m AS (SELECT DISTINCT m FROM io),
dw AS (SELECT doc_id, k, m, list_slice(w, k, k + m - 1) AS win FROM d, m, unnest(range(1, len(w) - m + 2)) AS u(k) WHERE len(w) >= m),
h AS (SELECT doc_id, k, dw.m, item_id, r, o FROM dw JOIN io USING (win)),
p AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT DISTINCT doc_id, k, m FROM h), unnest(range(k, k + m)) AS u(q) GROUP BY 1),
i AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM h GROUP BY 1),
e AS (SELECT doc_id, r, m, k, k - o AS diagonal, k - row_number() OVER (PARTITION BY doc_id, r, k - o ORDER BY k) AS run FROM h),
l AS (SELECT doc_id, min(k) - 1 AS place, count(*) + any_value(m) - 1 AS size FROM e GROUP BY doc_id, r, diagonal, run),
t AS (SELECT doc_id, size, place FROM l QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY size DESC, place) = 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated, coalesce(size, 0) AS longest_match, coalesce(place, -1) AS longest_at
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN i USING (doc_id) LEFT JOIN t USING (doc_id)
"""
