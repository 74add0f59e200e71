"""Byte-level BPE, encoded and decoded by DuckDB inside Spark's tasks.

A task cuts its texts into words by the tokenizer's pattern. Words that it hasn't met go to DuckDB as rows of
(word, place, token), a token for each byte, and a recursive query joins neighbours with the merge table: each
step contracts the leftmost pair of least rank of every word, together with the later pairs of that very rank which don't
overlap it, until no word has a pair left. Contracting equal ranks together is the same as one after the other, since
tokens of a vocabulary that was learned by merges encode to themselves, so a contraction never makes a pair of lower rank; `merges` verifies that for
the vocabulary by running it over its own tokens. Decoding joins token places with the
vocabulary and puts the bytes together by an ordered aggregation.

Defined cases: a null or empty text has no tokens; a text or word of any length is encoded whole; a null id stays null; repeated rows are
encoded again; strings of special tokens are ordinary text; when decoding, null ids and ids that the vocabulary
lacks give no bytes, and a null list gives none; an empty table gives no rows; other columns are kept by `encode` and `decode`, except
one with the name of a result, which is replaced.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, IntegerType, StructType

from . import shared

#: Bytes of text and tokens that are worked on at once; words that a task remembers; letters of words that go to one recursion.
TEXT_BYTES, TOKENS, KNOWN, LETTERS = 1 << 22, 1 << 19, 1 << 19, 1 << 17

#: k is a word's number and the place of a token. miss: the last row before this one whose pair isn't of its word's least rank; so of
#: pairs of least rank that overlap, every second from the left is taken, and the token behind a taken pair's first is gone.
CONTRACT = """
WITH RECURSIVE step AS (
  SELECT word * 4294967296 + place AS k, token, true AS live FROM start
  UNION ALL
  (WITH ranked AS MATERIALIZED (
    SELECT p.k, p.token, p.i, merged AS rank FROM (
      SELECT k, token, row_number() OVER o AS i, CASE WHEN lead(k) OVER o >> 32 = k >> 32 THEN token * 4294967296 + lead(token) OVER o END AS pair FROM step WHERE live WINDOW o AS (ORDER BY k)
    ) p LEFT JOIN merges USING (pair)
  ), least AS (SELECT k >> 32 AS word, min(rank) AS best FROM ranked GROUP BY 1)
  SELECT k, CASE WHEN rank = best AND (i - miss) % 2 = 1 THEN best ELSE token END AS token, best IS NOT NULL AS live FROM (
    SELECT k, token, rank, best, i, coalesce(last_value(CASE WHEN rank = best THEN NULL ELSE i END IGNORE NULLS) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS miss FROM ranked JOIN least ON least.word = ranked.k >> 32
  ) WHERE (i - miss) % 2 = 1)
)
SELECT k >> 32 AS word, token FROM step WHERE NOT live ORDER BY k
"""
TOGETHER = "SELECT text, string_agg(chars, '' ORDER BY place) AS chars FROM given JOIN vocabulary USING (token) GROUP BY text"


class Vocabulary:
    """A rank file's tokens, with a DuckDB of its own, in one thread and without files."""

    def __init__(self, file: bytes, pattern: str):
        import duckdb
        import regex

        self.tokens = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file.splitlines() if line)}
        self.cut = regex.compile(pattern).findall
        self.bytes = np.array([self.tokens[bytes([b])] for b in range(256)], np.int64)
        self.db = duckdb.connect()
        self.db.execute("SET threads = 1; SET memory_limit = '1GB'; SET temp_directory = ''")
        pairs = [(self.tokens[t[:k]] << 32 | self.tokens[t[k:]], i) for t, i in self.tokens.items() for k in range(1, len(t)) if t[:k] in self.tokens and t[k:] in self.tokens]
        merges = pa.table({"pair": pa.array([p for p, _ in pairs], pa.int64()), "merged": pa.array([i for _, i in pairs], pa.int64())})
        # Bytes travel as the characters of the same numbers.
        vocabulary = pa.table({"token": pa.array(list(self.tokens.values()), pa.int64()), "chars": pa.array([t.decode("latin-1") for t in self.tokens])})
        for name, rows in (("merges", merges), ("vocabulary", vocabulary)):
            self.db.register("given", rows)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")

        self.known: dict[str, int] = {}
        self.ids, self.ends, self.uses = [np.zeros(0, np.int64)], [np.zeros(1, np.int64)], np.zeros(0, np.int64)

    def forget(self) -> None:
        """Keep the words that most batches of texts had, half of KNOWN at most and none that only one had."""
        often = np.argsort(-self.uses, kind="stable")[: KNOWN // 2]
        kept = np.sort(often[self.uses[often] > 1])
        words, ids, ends = list(self.known), self.ids[0], self.ends[0]
        self.known = {words[i]: k for k, i in enumerate(kept)}
        parts = [ids[ends[i] : ends[i + 1]] for i in kept]
        self.ids, self.ends = [np.concatenate([ids[:0], *parts])], [np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)]
        self.uses = self.uses[kept]

    def contract(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all words in a row, and how many each has."""
        lengths = np.array([len(w) for w in words], np.int64)
        word = np.repeat(np.arange(len(words)), lengths)
        place = np.arange(len(word)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        start = pa.table({"word": word, "place": place, "token": self.bytes[np.frombuffer(b"".join(words), np.uint8)]})
        self.db.register("start", start)
        got = self.db.execute(CONTRACT).fetchnumpy()
        self.db.unregister("start")
        return np.asarray(got["token"], np.int64), np.bincount(np.asarray(got["word"], np.int64), minlength=len(words))

    def learn(self, words: set[str]) -> None:
        """Encode words that aren't known yet."""
        todo, size = [], 0
        for w in sorted(words):
            todo.append(w)
            size += len(w)
            if size >= LETTERS:
                self._learn(todo)
                todo, size = [], 0
        if todo:
            self._learn(todo)

    def _learn(self, words: list[str]) -> None:
        ids, counts = self.contract([w.encode() for w in words])
        self.ids.append(ids)
        self.ends.append(self.ends[-1][-1] + np.cumsum(counts))
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words)), strict=True))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all texts in a row, and how many each text has."""
        words = [self.cut(t) for t in texts]
        if len(self.known) > KNOWN:
            self.forget()
        self.learn({w for ws in words for w in ws if w not in self.known})
        if len(self.ids) > 1:
            self.ids, self.ends = [np.concatenate(self.ids)], [np.concatenate(self.ends)]
        own = np.array([self.known[w] for ws in words for w in ws], np.int64)
        self.uses = np.pad(self.uses, (0, len(self.known) - len(self.uses)))
        self.uses[np.unique(own)] += 1
        starts, ends = self.ends[0][own], self.ends[0][own + 1]
        counts = ends - starts
        last = np.cumsum(counts)
        ids = self.ids[0][np.arange(last[-1] if len(last) else 0) + np.repeat(starts - (last - counts), counts)]
        text = np.repeat(np.arange(len(texts)), [len(ws) for ws in words])
        return ids, np.bincount(text, weights=counts, minlength=len(texts)).astype(np.int64)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        text = np.repeat(np.arange(len(counts)), counts)
        self.db.register("given", pa.table({"text": text, "place": np.arange(len(ids)), "token": ids}))
        got = dict(self.db.execute(TOGETHER).fetchall())
        self.db.unregister("given")
        return [got.get(i, "").encode("latin-1") for i in range(len(counts))]


@lru_cache(maxsize=2)
def _opened(digest: str, pattern: str) -> Vocabulary:
    return Vocabulary(_FILES[digest], pattern)


_FILES: dict[str, bytes] = {}


def _vocabulary(file: bytes, pattern: str) -> Vocabulary:
    """The vocabulary of a worker, opened once."""
    digest = hashlib.sha256(file).hexdigest()
    _FILES[digest] = file
    return _opened(digest, pattern)


def _cut(sizes: np.ndarray, most: int) -> list[np.ndarray]:
    """Neighbouring rows of about most in all; a row that is larger by itself stays whole."""
    if not len(sizes):
        return []
    return np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(np.cumsum(sizes) // most)) + 1)


def _with(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    kept = [n for n in batch.schema.names if n not in columns]
    return pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], *columns.values()], names=[*kept, *columns])


def _result(df: DataFrame, **columns: DataType) -> StructType:
    out = StructType([f for f in df.schema.fields if f.name not in columns])
    for name, kind in columns.items():
        out = out.add(name, kind)
    return out


def merges(vocabulary: Vocabulary) -> bool:
    """Whether every token encodes to itself."""
    ids, counts = vocabulary.contract(list(vocabulary.tokens))
    return bool((counts == 1).all() and (ids == np.array(list(vocabulary.tokens.values()))).all())


def encode(spark: SparkSession, docs: DataFrame, ranks: str, pattern: str, text: str = "text") -> DataFrame:
    """docs with ids (array of int). ranks: a file that the driver can read; its size, that of a vocabulary, bounds what is sent to tasks."""
    shared.ship(spark)
    with open(ranks, "rb") as f:
        file = spark.sparkContext.broadcast(f.read())

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _vocabulary(file.value, pattern)
        for batch in shared.batches(rows):
            texts = pc.fill_null(batch.column(text), "")
            for cut in _cut(pc.binary_length(texts).to_numpy(), TEXT_BYTES):
                part = batch.slice(int(cut[0]), len(cut))
                ids, counts = v.encode(texts.slice(int(cut[0]), len(cut)).to_pylist())
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield _with(part, {"ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))})

    return docs.withColumn(text, F.col(text).cast("string")).mapInArrow(run, _result(docs.withColumn(text, F.col(text).cast("string")), ids=ArrayType(IntegerType())))


def decode(spark: SparkSession, df: DataFrame, ranks: str, ids: str = "ids") -> DataFrame:
    """df with decoded (binary): the bytes of its column ids."""
    shared.ship(spark)
    with open(ranks, "rb") as f:
        file = spark.sparkContext.broadcast(f.read())

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _vocabulary(file.value, "")
        for batch in shared.batches(rows):
            lists = batch.column(ids)
            counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
            for cut in _cut(counts, TOKENS):
                part = batch.slice(int(cut[0]), len(cut))
                own = pc.fill_null(lists.slice(int(cut[0]), len(cut)).flatten(), -1).to_numpy().astype(np.int64)
                yield _with(part, {"decoded": pa.array(v.decode(own, counts[cut]), pa.binary())})

    return df.mapInArrow(run, _result(df, decoded=BinaryType()))


def digests(spark: SparkSession, docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document."""
    ids = encode(spark, shared.texts(docs), ranks, pattern).select("doc_id", "ids")
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decode(spark, ids, ranks).select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(spark, shared.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
