"""Language identification by a bidirectional gated recurrent network over bytes, trained here in numpy.

A text's UTF-8 bytes (A-Z lower-cased) are read in windows of WINDOW bytes, both ways. Every position
gets a distribution over the languages; a document's is the mean over all its positions. Training uses
a bounded sample of PER_LANGUAGE documents per language, drawn by the digest of the id, with all their windows:
each step draws as many windows of every language, each as likely as another, however short.

Defined cases: texts of any length are read whole; a null text, or one without a letter, is "und" with score 0; without training rows every
text is "und"; null languages are not learned from; ties go to the language that sorts first; repeated
rows each give a row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import gru, shared, words

#: Documents per language to learn from.
PER_LANGUAGE = 600
WINDOW, EMBED, HIDDEN = 64, 12, 16
STEPS, BATCH, PAD = 350, 192, 256
UNKNOWN = "und"
#: Windows that are scored together.
ROWS = 2048


def windows(b: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols (windows x WINDOW, PAD behind the end), document and length of each window, over all bytes."""
    size = np.diff(offsets)
    count = -(-size // WINDOW)
    doc = np.repeat(np.arange(len(size)), count)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[:-1][doc] + k * WINDOW
    length = np.minimum(WINDOW, offsets[1:][doc] - start)
    padded = np.concatenate([b.astype(np.int16), np.full(WINDOW, PAD, np.int16)])
    symbols = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[start]
    short = np.flatnonzero(length < WINDOW)
    if len(short):
        symbols[short] = np.where(np.arange(WINDOW) < length[short, None], symbols[short], PAD)
    return symbols, doc, length


def train(texts: list[str], langs: list[str], seed: int = 1) -> dict:
    """The network's parameters and the languages, in order."""
    rng = np.random.default_rng(seed)
    names = sorted(set(langs))
    data, off = words.raw(pa.array(texts, pa.string()))
    symbols, doc, length = windows(words.LOWER[data], off)
    label = np.searchsorted(names, np.array(langs))[doc] if len(doc) else np.zeros(0, np.int64)
    p = gru.init(rng, EMBED, HIDDEN) | {"E": (rng.standard_normal((257, EMBED)) * 0.3).astype(np.float32), "O": gru.glorot(rng, 2 * HIDDEN, len(names)), "c": np.zeros((1, len(names)), np.float32)}
    if not len(label) or len(names) < 2:
        return p | {"names": names}
    by = [np.flatnonzero(label == k) for k in range(len(names))]
    adam = gru.Adam(p)
    for step in range(STEPS):
        pick = np.concatenate([rng.choice(x, BATCH // len(names) + 1) for x in by if len(x)])
        s, y = symbols[pick].T, label[pick]
        both = np.stack([s, s[::-1]])
        x = p["E"][both]
        h, cache = gru.forward(p, x)
        joint = np.concatenate([h[0], h[1, ::-1]], 2)
        logits = joint @ p["O"] + p["c"]
        q = np.exp(logits - logits.max(2, keepdims=True))
        q /= q.sum(2, keepdims=True)
        mask = (s != PAD).astype(np.float32)[:, :, None]
        q[:, np.arange(len(y)), y] -= 1
        # Every window weighs alike, by its positions' mean.
        q *= mask / mask.sum(0) / len(y)
        flat = q.reshape(-1, len(names))
        dj = (flat @ p["O"].T).reshape(joint.shape)
        grads, dx = gru.backward(p, x, cache, np.stack([dj[:, :, :HIDDEN], dj[::-1, :, HIDDEN:]]))
        dE = np.zeros_like(p["E"])
        np.add.at(dE, both.ravel(), dx.reshape(-1, EMBED))
        grads |= {"O": joint.reshape(-1, 2 * HIDDEN).T @ flat, "c": flat.sum(0, keepdims=True), "E": dE}
        adam.step(grads, 1.0 if step < STEPS * 2 // 3 else 0.3)
    return p | {"names": names}


def score(p: dict, b: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(documents, languages): the mean of the positions' distributions, 0 for documents without bytes."""
    symbols, doc, length = windows(b, offsets)
    n = len(p["names"])
    tables = [p["E"] @ p["W"][d] + p["b"][d] for d in (0, 1)]
    out = np.zeros((len(offsets) - 1, n))
    for a in range(0, len(doc), ROWS):
        s = np.ascontiguousarray(symbols[a : a + ROWS].T.astype(np.int64))
        logits = np.empty((WINDOW, s.shape[1], n), np.float32)
        own = p["O"][:HIDDEN]

        def ahead(t: int, h: np.ndarray, logits=logits, own=own) -> None:
            np.matmul(h, own, out=logits[t])

        def behind(t: int, h: np.ndarray, logits=logits) -> None:
            logits[WINDOW - 1 - t] += h @ p["O"][HIDDEN:]

        gru.run(tables[0], p["U"][0], s, ahead)
        gru.run(tables[1], p["U"][1], s[::-1], behind)
        logits += p["c"]
        np.exp(np.minimum(logits, 60, out=logits), out=logits)
        logits /= logits.sum(2, keepdims=True)
        logits[s == PAD] = 0
        each = logits.sum(0)
        for k in range(n):
            out[:, k] += np.bincount(doc[a : a + ROWS], each[:, k], len(out))
    return out / np.maximum(np.diff(offsets), 1)[:, None]


def has_letter(b: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    def any_of(member: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(member)])[offsets]) > 0

    plain = any_of((b >= 97) & (b <= 122))
    for i in np.flatnonzero(~plain & any_of(b >= 128)):
        plain[i] = any(c.isalpha() for c in b[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return plain


def learn(docs: DataFrame, per: int = PER_LANGUAGE) -> dict:
    """Train on rows of doc_id, text, lang: at most per documents of each language, by the digest of the id."""
    rows = shared.texts(docs.filter("lang is not null"), F.col("lang").cast("string").alias("lang"))
    return shared.train(shared.sample(rows, "lang", per), _train)


def _train(rows: pa.Table) -> dict:
    rows = rows.sort_by([("lang", "ascending"), ("doc_id", "ascending"), ("text", "ascending")])
    return train(rows.column("text").to_pylist(), rows.column("lang").to_pylist())


def predict(spark: SparkSession, docs: DataFrame, model: dict, *more: str) -> DataFrame:
    """doc_id, lang_pred, score and the named columns."""
    held = spark.sparkContext.broadcast(model)
    rows = shared.texts(docs, *more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = held.value
        names = np.array([*p["names"], UNKNOWN], object)
        for batch in shared.batches(batches):
            data, off = words.raw(batch.column("text"))
            best, how = [], []
            at = 0
            while at < len(off) - 1:
                to = max(at + 1, int(np.searchsorted(off, off[at] + words.SLAB, "right")) - 1)
                b, o = words.LOWER[data[off[at] : off[to]]], off[at : to + 1] - off[at]
                known = has_letter(b, o)
                q = score(p, b, o) if p["names"] else np.zeros((len(o) - 1, 1))
                best.append(np.where(known, q.argmax(1), len(p["names"])) if p["names"] else np.zeros(len(o) - 1, int))
                how.append(np.where(known, np.clip(q.max(1), 0, 1), 0.0))
                at = to
            columns = [batch.column("doc_id"), pa.array(names[np.concatenate(best)], pa.string()), pa.array(np.concatenate(how))]
            yield pa.RecordBatch.from_arrays(columns + [batch.column(c) for c in more], names=["doc_id", "lang_pred", "score", *more])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, ", ".join(["doc_id bigint, lang_pred string, score double", *[f"`{c}` {kinds[c]}" for c in more]]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents")
    part = shared.crc_mod(3)
    model = learn(docs.filter(part != 1))
    return predict(spark, docs, model).select("doc_id", (part == 1).alias("held_out"), "lang_pred", "score")
