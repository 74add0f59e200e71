"""Similarity self-join on word n-gram sets, with vertical partitioning.

Texts with equal sets form a class; classes are joined, not copies. A set is known by a digest of 128 bits, a
class by its first 64; of different sets that share those, all but one get another number. The global n-gram order puts
rare n-grams first (frequencies of all documents, from one count sketch of a fixed size; a wrong
estimate costs time, never a link). By it

* candidates share an n-gram among the first of both, at places from which the needed overlap can
  still be reached, and have fitting sizes;
* the order is cut into FRAGMENTS of about equal load; the overlap of a candidate pair is counted in
  each fragment separately, and the partial counts are summed per pair.

All pairs of a large group of near copies would be too many, and only the classes that links connect
are wanted. So each n-gram's classes are first compared with one of them (ANCHORS times, another one
each time), which joins most of a group to one component; then every pair that may still connect two
components is compared, the smaller part of each n-gram's classes against all of it. No link between
components is lost.

No key gathers a hub's rows in one task: the rows of a class that is in many pairs are dealt over several tasks, and so
are the classes of one component.

Defined cases: a null text, or one without words, has an empty set and is linked with nothing (its
component is itself); a text of fewer words than n has one n-gram, all its words; repeated rows each
give a row, and rows that repeat a doc_id with different texts are separate; a null doc_id is its own
component unless copies have one; n-grams of equal frequency go by their hash; a text of any length is one set,
whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import shared, sketches, words
from .components import HUB, HUBS, back, components, salt, spread

N = 5
#: Linked if DEN * intersection >= NUM * union.
NUM, DEN = 75, 100
FRAGMENTS = 4
ANCHORS = 1
#: N-grams that a task gathers before it passes them on.
FLUSH = 1 << 19
#: Bits of a digest that number a class, and most classes that share theirs with another (expected: the square of the sets over 2^65).
CLASS_BITS, CLASHES = 64, 1 << 16
#: log2 of the counters of the frequency sketch (broadcast, 4 bytes each).
SKETCH_BITS = 21
#: log2 of the bits of the filter of documents that are in candidate pairs (broadcast).
FILTER_BITS = 23

#: Odd multipliers of a window's words, without small linear relations.
_STEP = words.mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)
_D1, _D2 = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


def sets(column: pa.Array, n: int = N) -> Iterator[np.ndarray]:
    """Each text's set of word n-grams as sorted distinct 64-bit hashes."""
    for s in words.slabs(column):
        at = s.bounds()
        grams = np.zeros(len(s.hash), np.uint64)
        m = len(s.hash) - n + 1
        if m > 0:
            for k in range(n):
                grams[:m] += s.hash[k : k + m] * _STEP[k]
            grams[:m] = words.mix(grams[:m])
        for i in range(s.docs):
            a, b = at[i], at[i + 1]
            if b - a >= n:
                yield np.unique(grams[a : b - n + 1])
            elif b > a:
                yield words.mix((s.hash[a:b] * _STEP[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a))
            else:
                yield grams[:0]


def digest(grams: np.ndarray, bits: int = CLASS_BITS) -> tuple[int, int]:
    """Two independent digests of a set, of bits and 64 bits, as signed numbers."""
    a = words.mix(words.mix(grams ^ _D1).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(grams))) >> np.uint64(64 - bits)
    b = words.mix(grams * _D2 + _D1).sum(dtype=np.uint64, keepdims=True)
    return int(a.view(np.int64)[0]), int(b.view(np.int64)[0])


def renamed(a: int, b: int) -> int:
    """Another number for a class whose own another set has."""
    x = words.mix(np.array([a, b], np.int64).view(np.uint64) + _D2)
    return int(words.mix(x[:1] ^ (x[1:] * _STEP[9])).view(np.int64)[0])


def slot(grams: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    return (grams >> np.uint64(64 - bits)).astype(np.int64)


_PROFILE = "doc_id bigint, mark bigint, n int, cls bigint, other bigint, chunk int, counts binary"


def _profile(n: int, bits_: int):
    """doc_id, text, mark -> a row for each document, and the partition's n-gram counters."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        pool: list[np.ndarray] = []
        held = 0
        for batch in shared.batches(rows):
            sizes, first, second = [], [], []
            for g in sets(batch.column("text"), n):
                a, b = digest(g, bits_)
                sizes.append(len(g))
                first.append(a)
                second.append(b)
                pool.append(slot(g))
                held += len(g)
                if held > FLUSH:
                    counts += np.bincount(np.concatenate(pool), minlength=len(counts))
                    pool, held = [], 0
            none = pa.nulls(len(sizes))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), pa.array(sizes, pa.int32()), pa.array(first, pa.int64()), pa.array(second, pa.int64()), none.cast(pa.int32()), none.cast(pa.binary())],
                names=["doc_id", "mark", "n", "cls", "other", "chunk", "counts"],
            )
        if pool:
            counts += np.bincount(np.concatenate(pool), minlength=len(counts))
        kept, data = sketches.chunks(counts)
        none = pa.nulls(len(kept))
        yield pa.RecordBatch.from_arrays(
            [none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.int32()), none.cast(pa.int64()), none.cast(pa.int64()), pa.array(kept, pa.int32()), pa.array(data, pa.binary())],
            names=["doc_id", "mark", "n", "cls", "other", "chunk", "counts"],
        )

    return run


def pivots(sketch: np.ndarray, fragments: int = FRAGMENTS) -> np.ndarray:
    """Frequencies that cut the order (frequency, hash) into fragments of about equal load."""
    own = np.sort(sketch)
    load = np.cumsum(own.astype(np.float64))
    at = np.searchsorted(load, load[-1] * np.arange(1, fragments) / fragments)
    return own[np.minimum(at, len(own) - 1)]


def fits(na: Column, nb: Column, left_a: Column, left_b: Column) -> Column:
    """Whether the overlap that linked sets of these sizes need can still be reached with so many n-grams left, this one included."""
    return F.least(left_a, left_b) * (NUM + DEN) >= (na + nb) * NUM


def _prefixes(held, n: int, bits_: int):
    """doc_id, text -> gram, cls, n, place: the first n-grams of each class in the order; a class once a partition."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (sketch, other), seen = held.value, set()
        grams, classes, sizes, firsts, held_grams = [], [], [], [], 0
        for batch in shared.batches(rows):
            for g in sets(batch.column("text"), n):
                key = digest(g, bits_)
                if len(g) and (cls := other.get(key, key[0])) not in seen:
                    seen.add(cls)
                    m = len(g) - -(-NUM * len(g) // DEN) + 1
                    first = np.argsort(sketch[slot(g)], kind="stable")[:m]  # g is sorted: ties go by hash
                    grams.append(g[first].view(np.int64))
                    classes.append(cls)
                    sizes.append(len(g))
                    firsts.append(m)
                    held_grams += m
                    if held_grams > FLUSH:
                        held_grams = 0
                        yield _first_rows(grams, classes, sizes, firsts)
                        grams, classes, sizes, firsts = [], [], [], []
        if grams:
            yield _first_rows(grams, classes, sizes, firsts)

    return run


def _first_rows(grams: list[np.ndarray], classes: list[int], sizes: list[int], firsts: list[int]) -> pa.RecordBatch:
    m = np.array(firsts)
    place = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(grams)), pa.array(np.repeat(np.array(classes, np.int64), m)), pa.array(np.repeat(np.array(sizes, np.int32), m)), pa.array(place.astype(np.int32))],
        names=["gram", "cls", "n", "place"],
    )


def _slots(ids: np.ndarray) -> np.ndarray:
    h = words.mix(ids.astype(np.int64).view(np.uint64) + _D1)
    return np.concatenate([h >> np.uint64(64 - FILTER_BITS), (h << np.uint64(FILTER_BITS)) >> np.uint64(64 - FILTER_BITS)]).astype(np.int64)


def _mark(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(1 << FILTER_BITS, np.uint8)
    for batch in shared.batches(rows):
        bits[_slots(batch.column("doc_id").to_numpy(zero_copy_only=False))] = 1
    kept, data = sketches.chunks(bits)
    yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int32()), pa.array(data, pa.binary())], names=["chunk", "counts"])


def _segments(held, n: int, bits_: int):
    """doc_id, text -> cls, part (fragment), grams, of the documents that the filter lets pass."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, cuts, bits, other = held.value
        for batch in shared.batches(rows):
            known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            may = (bits[_slots(ids)] > 0).reshape(2, -1).all(0) | ~known
            text = batch.column("text").filter(pa.array(may))
            classes, parts, grams, pending = [], [], [], 0
            for g in sets(text, n):
                if len(g):
                    fragment = np.searchsorted(cuts, sketch[slot(g)])
                    key = digest(g, bits_)
                    cls = other.get(key, key[0])
                    for k in np.unique(fragment):
                        classes.append(cls)
                        parts.append(int(k))
                        grams.append(g[fragment == k].view(np.int64))
                    pending += len(g)
                    if pending > FLUSH:
                        yield _segment_rows(classes, parts, grams)
                        classes, parts, grams, pending = [], [], [], 0
            if grams:
                yield _segment_rows(classes, parts, grams)

    return run


def _segment_rows(classes: list[int], parts: list[int], grams: list[np.ndarray]) -> pa.RecordBatch:
    lengths = np.cumsum([0, *map(len, grams)]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(lengths), pa.array(np.concatenate(grams)))
    return pa.RecordBatch.from_arrays([pa.array(classes, pa.int64()), pa.array(parts, pa.int32()), lists], names=["cls", "part", "grams"])


def _hubs(pairs: DataFrame) -> DataFrame:
    """(hub): classes x that are in at least HUB pairs; at most HUBS, so they may be broadcast."""
    n = pairs.groupBy("x").agg(F.count("*").alias("n")).filter(F.col("n") >= HUB)
    return n.orderBy(F.desc("n"), "x").limit(HUBS).select(F.col("x").alias("hub"))


def _unique(segments: DataFrame) -> DataFrame:
    """One segment a class and fragment: copies that the filter let pass go. The exchange is the one that joins on both need, and is shared by them."""
    return segments.repartition("cls", "part").groupBy("cls", "part").agg(F.any_value("grams").alias("grams"))


def _overlaps(pairs: DataFrame, segments: DataFrame, hubs: DataFrame | None, how: str) -> DataFrame:
    """Of (x, y, nx, ny, fragment): part, the overlap in the fragment, and the sizes there (rx, ry). The side that many pairs share travels last, that of a hub salted."""
    one = _unique(segments)

    def both(own: DataFrame, x: DataFrame, *more: str) -> DataFrame:
        y = own.join(one.alias("s"), (F.col("y") == F.col("s.cls")) & (F.col("fragment") == F.col("s.part")), how).select(*own.columns, F.col("grams").alias("own"))
        on = (F.col("x") == F.col("s.cls")) & (F.col("fragment") == F.col("s.part"))
        for c in more:
            on = on & (F.col(c) == F.col(f"s.{c}_"))
        size = lambda c: F.coalesce(F.size(c), F.lit(0))
        part = F.when(F.col("own").isNotNull() & F.col("grams").isNotNull(), F.size(F.array_intersect("own", "grams"))).otherwise(F.lit(0))
        return y.join(x.alias("s"), on, how).select("x", "y", "nx", "ny", "fragment", part.alias("part"), size("grams").alias("rx"), size("own").alias("ry"))

    if hubs is None:
        return both(pairs, one)
    is_hub = F.col("x") == F.col("hub")
    cold, hot = pairs.join(F.broadcast(hubs), is_hub, "left_anti"), pairs.join(F.broadcast(hubs), is_hub, "left_semi").withColumn("salt", salt("y"))
    held = spread(one.join(F.broadcast(hubs), F.col("cls") == F.col("hub"), "left_semi"), F.lit(True)).withColumnRenamed("salt", "salt_")
    return both(cold, one).unionByName(both(hot, held, "salt"))


def _links(stage: shared.Stage, pairs: DataFrame, segments: DataFrame, name: str) -> DataFrame:
    """Of the pairs (x, y, nx, ny) those that are linked: overlaps are counted by fragment and summed.

    The fragment of the rarest n-grams comes first: a pair that can't reach the overlap that it needs
    with all of the rest goes no further.
    """
    hubs = stage.write(_hubs(pairs), f"hubs_{name}")
    hubs = hubs if hubs.count() else None
    first = _overlaps(pairs.withColumn("fragment", F.lit(0)), segments.filter("part = 0"), hubs, "left")
    reach = F.col("part") + F.least(F.col("nx") - F.col("rx"), F.col("ny") - F.col("ry"))
    first = stage.write(first.filter(reach * (NUM + DEN) >= (F.col("nx") + F.col("ny")) * NUM).select("x", "y", "nx", "ny", "part"), name)
    rest = first.drop("part").withColumn("fragment", F.explode(F.sequence(F.lit(1), F.lit(FRAGMENTS - 1))))
    rest = _overlaps(rest, segments.filter("part > 0"), hubs, "inner").select("x", "y", "nx", "ny", "part")
    total = first.unionByName(rest).groupBy("x", "y", "nx", "ny").agg(F.sum("part").alias("o"))
    return total.filter(DEN * F.col("o") >= NUM * (F.col("nx") + F.col("ny") - F.col("o"))).select(F.col("x").alias("u"), F.col("y").alias("v"))


def _labelled(index: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return index.withColumn("label", F.col("cls"))
    return index.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))


def _pair(a: str, b: str) -> list[Column]:
    return [F.col(f"{a}.cls").alias("x"), F.col(f"{b}.cls").alias("y"), F.col(f"{a}.n").alias("nx"), F.col(f"{b}.n").alias("ny")]


def _may_link(a: str, b: str) -> Column:
    c = lambda t, k: F.col(f"{t}.{k}")
    return (c(a, "label") != c(b, "label")) & fits(c(a, "n"), c(b, "n"), c(a, "n") - c(a, "place"), c(b, "n") - c(b, "place"))


def _anchored(index: DataFrame, turn: int) -> DataFrame:
    """Each n-gram's classes with one of them: first the one with the fewest rarer n-grams, later another."""
    rank = F.struct("place", F.xxhash64("cls")) if turn == 0 else F.struct(F.xxhash64("cls", F.lit(turn)), "place")
    one = F.min(F.struct(rank.alias("rank"), "cls", "n", "place", "label"))
    anchors = index.groupBy("gram").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), one.alias("one")).filter("lo <> hi")
    anchors = anchors.select("gram", "one.cls", "one.n", "one.place", "one.label")
    return anchors.alias("a").join(index.alias("b"), (F.col("a.gram") == F.col("b.gram")) & _may_link("a", "b")).select(*_pair("a", "b")).distinct()


def _remaining(index: DataFrame) -> DataFrame:
    """Every pair that may link two components: the classes outside of an n-gram's largest component with all others."""
    per = index.groupBy("gram", "label").agg(F.count("*").alias("c"))
    major = per.groupBy("gram").agg(F.max(F.struct("c", "label"))["label"].alias("major"), F.count("*").alias("labels")).filter("labels > 1")
    minor = index.join(major, "gram").filter("label <> major")
    once = (F.col("b.label") == F.col("a.major")) | (F.col("a.cls") < F.col("b.cls"))
    return minor.alias("a").join(index.alias("b"), (F.col("a.gram") == F.col("b.gram")) & once & _may_link("a", "b")).select(*_pair("b", "a")).distinct()


def _renamed(classes: DataFrame) -> dict[tuple[int, int], int]:
    """New numbers of the classes (cls, other) that share their number with another; one of each number keeps it."""
    shared_ = classes.groupBy("cls").agg(F.min("other").alias("own"), F.max("other").alias("most")).filter("own <> most")
    found = classes.join(shared_, "cls").filter("other <> own").select("cls", "other").limit(CLASHES + 1).collect()
    if len(found) > CLASHES:
        raise ValueError(f"more than {CLASHES} classes share a number")
    return {(a, b): renamed(a, b) for a, b in found}


def join(spark: SparkSession, docs: DataFrame, n: int = N, bits: int = CLASS_BITS) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included), cls (class of equal sets), mark (hash of the text).

    bits: of a digest that number a class (fewer only to test sets that share them).
    """
    stage = shared.Stage(spark, "jaccard-join")
    rows = shared.texts(docs)
    profile = stage.write(rows.withColumn("mark", F.xxhash64("text")).mapInArrow(_profile(n, bits), _PROFILE), "profile")
    sketch = sketches.total(profile.filter("chunk is not null"), 1 << SKETCH_BITS, np.int32)
    documents = profile.filter("chunk is null").select("doc_id", "mark", "n", "cls", "other")
    classes = stage.write(documents.filter("n > 0").groupBy("cls", "other").agg(F.min("doc_id").alias("first")), "classes")
    other = _renamed(classes)
    if other:
        new = spark.createDataFrame([(*k, v) for k, v in other.items()], "cls bigint, other bigint, new bigint")
        named = lambda df: df.join(F.broadcast(new), ["cls", "other"], "left").withColumn("cls", F.coalesce("new", "cls")).drop("new")
        documents, classes = named(documents), named(classes)
    classes = classes.drop("other")

    held = spark.sparkContext.broadcast((sketch, other))
    index = rows.mapInArrow(_prefixes(held, n, bits), "gram bigint, cls bigint, n int, place int")
    # One shuffle: copies of a class from other partitions go, and so do n-grams of one class.
    index = index.repartition("gram").groupBy("gram", "cls").agg(F.min("n").alias("n"), F.min("place").alias("place"))
    index = index.withColumn("c", F.count("*").over(W.partitionBy("gram"))).filter("c > 1").drop("c")
    index = stage.write(index, "shared")
    # What has no partner of a fitting size and place is in no candidate pair.
    index = index.withColumn("label", F.col("cls")).alias("a").join(index.withColumn("label", F.col("cls")).alias("b"), (F.col("a.gram") == F.col("b.gram")) & _may_link("a", "b"), "left_semi").drop("label")
    index = stage.write(index, "index")
    stage.drop("shared")

    wanted = classes.join(index.select("cls").distinct(), "cls", "left_semi").filter("first is not null").select(F.col("first").alias("doc_id"))
    bits_ = sketches.total(wanted.mapInArrow(_mark, sketches.SCHEMA), 1 << FILTER_BITS, np.uint8)
    held.unpersist()
    held = spark.sparkContext.broadcast((sketch, pivots(sketch), bits_, other))
    segments = rows.mapInArrow(_segments(held, n, bits), "cls bigint, part int, grams array<bigint>")
    segments = stage.write(segments, "segments")

    labels, links = None, None
    for turn in range(ANCHORS + 1):
        own = _labelled(index, labels)
        pairs = stage.write(_anchored(own, turn) if turn < ANCHORS else _remaining(own), f"pairs{turn}")
        found = stage.write(_links(stage, pairs, segments, f"open{turn}"), f"links{turn}")
        stage.drop(f"pairs{turn}", f"open{turn}", f"hubs_open{turn}")
        links = found if links is None else links.unionByName(found)
        labels = components(stage, links, f"star{turn}_")
    stage.drop("segments", "index")

    # Classes without links are their own components.
    linked = labels.withColumnRenamed("node", "cls").join(classes, "cls")
    least = linked.groupBy("label").agg(F.min("first").alias("component_id"), F.count("*").alias("n"))
    reach = back(linked, least, "label", "cls").select("cls", F.col("component_id").alias("reached"))
    reach = stage.write(classes.join(reach, "cls", "left").select("cls", F.coalesce("reached", "first").alias("component_id")), "reach")
    stage.drop("classes", *[f"links{turn}" for turn in range(ANCHORS + 1)])
    out = documents.join(reach, "cls", "left")
    return out.select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "cls", "mark")


def one_of_each(spark: SparkSession, docs: DataFrame, n: int = N) -> DataFrame:
    """The documents that stay when each component keeps its smallest doc_id, with all their columns; of rows that repeat both doc_id and text one stays."""
    ids = join(spark, docs, n).filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__tf_id"), F.col("mark").alias("__tf_mark"))
    own = docs.withColumn("__tf_own", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("__tf_id")) & (F.col("__tf_own") == F.col("__tf_mark"))
    return own.join(ids, same, "left_semi").dropDuplicates(["doc_id", "__tf_own"]).drop("__tf_own")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(spark, shared.table(spark, sf_dir, "documents")).drop("cls", "mark")


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, hash(list_slice(w, k, k + 4)) AS g FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS u(k) WHERE len(w) > 0
), c AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
l AS MATERIALIZED (
  SELECT a.doc_id AS u, b.doc_id AS v FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN c x ON x.doc_id = a.doc_id JOIN c y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), r AS (SELECT doc_id AS u, doc_id AS c FROM d UNION SELECT l.v, r.c FROM r JOIN l ON l.u = r.u WHERE r.c < l.v)
SELECT d.doc_id, coalesce(c.n, 0) AS n_shingles, min(r.c) AS component_id FROM d LEFT JOIN c USING (doc_id) JOIN r ON r.u = d.doc_id GROUP BY 1, 2
"""
