"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained here in numpy.

A text's words (split at white space, A-Z lower-cased, without other characters than letters and
digits) are inputs of two kinds: an embedding of the word, and the mean embedding of its characters'
n-grams with their place at the word's ends. Windows of WINDOW words start every STRIDE words, so all
overlap; the network reads a window both ways, attention pools its positions into one vector, and that
gives the window's logit. A document's score is that of its worst window, over the whole text.

Training takes a bounded sample of PER_LABEL documents per label, drawn by the digest of the id, with all their
windows; of a document's windows a step weighs the worst ones most. Labels are the only other input of training.

Defined cases: a text of any length is scored whole; a null text, or one without words, gets the score of an empty window; a document with
several labels counts as toxic if any is; of rows that repeat a sampled doc_id the texts that sort first are learned from; null labels are not learned from; without rows of both
labels every score is 0; repeated rows each give a row; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import gru, shared, words

#: Documents per label to learn from, and windows that go through the network together.
PER_LABEL, TOGETHER = 2000, 4096
WINDOW, STRIDE = 16, 8
WORD_BITS, GRAM_BITS, EMBED, HIDDEN, ATTEND = 14, 14, 12, 16, 16
GRAMS = (3, 4, 5)
STEPS, BATCH = 320, 32
#: Smallest score that counts as toxic.
THRESHOLD = 0.7
ROWS = 4096

#: Bytes of words' letters and digits; the rest is dropped, such as punctuation.
_KEEP = words.ALNUM


def slabs(column: pa.Array) -> Iterator[words.Slab]:
    return words.slabs(column, _KEEP)


def vocabulary(s: words.Slab) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of a slab: each word's number from 1 (0 is the empty word), word buckets, and n-gram buckets with their owners."""
    _, first, number = np.unique(s.hash, return_index=True, return_inverse=True)
    bucket = np.concatenate([[0], (s.hash[first] >> np.uint64(64 - WORD_BITS)).astype(np.int64)])
    start, size = s.starts[first], s.ends[first] - s.starts[first]
    # Words with a mark at both ends, one after the other.
    length = size + 2
    at = np.cumsum(length) - length
    text = np.ones(int(length.sum()), np.uint64)
    inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    text[np.repeat(at + 1, size) + inner] = s.buf[np.repeat(start, size) + inner]
    owner = np.repeat(np.arange(1, len(first) + 1), length)
    left = np.repeat(at + length, length) - np.arange(len(text))
    grams, owners = [], []
    for n in GRAMS:
        h = np.full(max(0, len(text) - n + 1), n, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + text[k : k + len(h)]
        ok = left[: len(h)] >= n
        grams.append((words.mix(h[ok]) >> np.uint64(64 - GRAM_BITS)).astype(np.int64))
        owners.append(owner[: len(h)][ok])
    return number.ravel() + 1, bucket, np.concatenate(grams), np.concatenate(owners)


def inputs(p: dict, bucket: np.ndarray, grams: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Input vectors of the distinct words, and how many n-grams each has."""
    n = np.maximum(np.bincount(owners, minlength=len(bucket)), 1).astype(np.float32)
    own = p["G"][grams]
    chars = np.stack([np.bincount(owners, own[:, k], len(bucket)) for k in range(own.shape[1])], 1).astype(np.float32)
    word = p["E"][bucket].copy()
    word[0] = 0
    return np.concatenate([word, chars / np.sqrt(n)[:, None]], 1), n


def windows(number: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(windows, WINDOW) word numbers, 0 behind a document's end, and the document of each; one empty window for a document without words."""
    size = np.diff(bound)
    count = np.maximum(1, -(-(size - WINDOW) // STRIDE) + 1)
    doc = np.repeat(np.arange(len(size)), count)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = bound[:-1][doc] + k * STRIDE
    padded = np.concatenate([number, np.zeros(WINDOW, number.dtype)])
    out = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[start]
    length = np.minimum(WINDOW, bound[1:][doc] - start)
    return np.where(np.arange(WINDOW) < length[:, None], out, 0), doc


def fresh(rng: np.random.Generator) -> dict[str, np.ndarray]:
    p = gru.init(rng, 2 * EMBED, HIDDEN)
    p |= {"E": np.zeros((1 << WORD_BITS, EMBED), np.float32), "G": (rng.standard_normal((1 << GRAM_BITS, EMBED)) * 0.05).astype(np.float32)}
    return p | {"A": gru.glorot(rng, 2 * HIDDEN, ATTEND), "a": gru.glorot(rng, ATTEND, 1), "O": gru.glorot(rng, 2 * HIDDEN, 1), "c": np.full((1, 1), -1.0, np.float32)}


def train(texts: list[str], labels: np.ndarray, seed: int = 1) -> dict:
    rng = np.random.default_rng(seed)
    labels = np.asarray(labels, np.float32)
    p = fresh(rng)
    if len(labels) == 0 or labels.min() == labels.max():
        return p | {"const": True}
    bags = []
    for s in slabs(pa.array(texts, pa.string())):
        number, bucket, grams, owners = vocabulary(s)
        w, doc = windows(number, s.bounds())
        cut = np.searchsorted(doc, np.arange(s.docs + 1))
        order = np.argsort(owners, kind="stable")
        ends = np.searchsorted(owners[order], np.arange(len(bucket) + 1))
        w, bucket, grams = w.astype(np.int32), bucket.astype(np.int32), grams[order].astype(np.int32)
        bags += [(w[a:b], bucket, grams, ends) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    adam = gru.Adam(p, 0.004)
    turn = np.zeros(0, np.int64)
    for step in range(STEPS):
        if len(turn) < BATCH:
            turn = np.concatenate([turn, rng.permutation(len(bags))])
        chosen, turn = turn[:BATCH], turn[BATCH:]
        _step(p, adam, [bags[i] for i in chosen], labels[chosen], 1.0 if step < STEPS * 3 // 4 else 0.3)
    return p | {"const": False}


def _gather(bags: list) -> tuple:
    """The batch's windows over one list of distinct words of the batch."""
    w, bag, bucket, grams, owners, base = [], [], [np.zeros(1, np.int64)], [], [], 1
    for k, (own, buckets, all_grams, ends) in enumerate(bags):
        used, number = np.unique(own, return_inverse=True)
        number = number.reshape(own.shape)
        if used[0] == 0:
            used, number = used[1:], number - 1
        w.append(np.where(number >= 0, number + base, 0))
        bag.append(np.full(len(own), k))
        bucket.append(buckets[used])
        n = ends[used + 1] - ends[used]
        owner = np.repeat(np.arange(len(used)), n)
        grams.append(all_grams[ends[used][owner] + np.arange(len(owner)) - (np.cumsum(n) - n)[owner]])
        owners.append(owner + base)
        base += len(used)
    none = [np.zeros(0, np.int64)]
    return np.concatenate(w), np.concatenate(bag), np.concatenate(bucket), np.concatenate(grams or none), np.concatenate(owners or none)


def _forward(p: dict, vectors: np.ndarray, w: np.ndarray) -> dict:
    """Logits of windows, and what their gradients need."""
    s = w.T
    both = np.stack([s, s[::-1]])
    x = vectors[both]
    h, cache = gru.forward(p, x)
    joint = np.concatenate([h[0], h[1, ::-1]], 2)  # (T, B, 2H)
    hidden = np.tanh(joint @ p["A"])
    score = (hidden @ p["a"])[:, :, 0]
    e = np.exp(score - score.max(0)) * np.maximum(s > 0, s[:1] == 0)
    alpha = e / e.sum(0)
    pooled = np.einsum("tb,tbh->bh", alpha, joint)
    return {"both": both, "x": x, "cache": cache, "joint": joint, "hidden": hidden, "alpha": alpha, "pooled": pooled, "logit": (pooled @ p["O"] + p["c"])[:, 0]}


def _backward(p: dict, f: dict, d: np.ndarray, words_: int) -> tuple[dict, np.ndarray]:
    """Gradients of the parameters behind the inputs, and of the distinct words' vectors, from those of the logits."""
    pooled, alpha, joint, hidden = f["pooled"], f["alpha"], f["joint"], f["hidden"]
    dpool = d @ p["O"].T
    grads = {"O": pooled.T @ d, "c": d.sum(0, keepdims=True)}
    djoint = alpha[:, :, None] * dpool
    dalpha = np.einsum("bh,tbh->tb", dpool, joint)
    dscore = alpha * (dalpha - (alpha * dalpha).sum(0))
    grads["a"] = hidden.reshape(-1, ATTEND).T @ dscore.reshape(-1, 1)
    dhid = dscore[:, :, None] * p["a"][:, 0] * (1 - hidden * hidden)
    grads["A"] = joint.reshape(-1, 2 * HIDDEN).T @ dhid.reshape(-1, ATTEND)
    djoint = djoint + dhid @ p["A"].T
    more, dx = gru.backward(p, f["x"], f["cache"], np.stack([djoint[:, :, :HIDDEN], djoint[::-1, :, HIDDEN:]]).astype(np.float32))
    flat, at = dx.reshape(-1, 2 * EMBED), f["both"].ravel()
    return grads | more, np.stack([np.bincount(at, flat[:, k], words_) for k in range(2 * EMBED)], 1).astype(np.float32)


def _step(p: dict, adam: gru.Adam, bags: list, y: np.ndarray, rate: float) -> None:
    w, bag, bucket, grams, owners = _gather(bags)
    vectors, n = inputs(p, bucket, grams, owners)
    parts = [slice(a, a + TOGETHER) for a in range(0, len(w), TOGETHER)]
    done = [_forward(p, vectors, w[at]) for at in parts] if len(parts) == 1 else []
    logit = np.concatenate([f["logit"] for f in done] or [_forward(p, vectors, w[at])["logit"] for at in parts])
    # A document's logit: its windows', the worst weighing most (the weights are held fixed).
    top = np.full(len(y), -np.inf)
    np.maximum.at(top, bag, logit)
    weight = np.exp(3 * (logit - top[bag]))
    weight /= np.bincount(bag, weight, len(y))[bag]
    whole = np.bincount(bag, weight * logit, len(y))
    d = ((gru.sigmoid(whole) - y) / len(y))[bag] * weight
    d = d.astype(np.float32)[:, None]
    grads, dv = {}, np.zeros_like(vectors)
    for k, at in enumerate(parts):
        own, dx = _backward(p, done[k] if done else _forward(p, vectors, w[at]), d[at], len(bucket))
        grads = {name: grads[name] + g if grads else g for name, g in own.items()}
        dv += dx
    dv[0] = 0
    share = (dv[:, EMBED:] / np.sqrt(n)[:, None])[owners]
    dE, dG = (np.stack([np.bincount(at, x[:, k], 1 << bits) for k in range(EMBED)], 1).astype(np.float32) for at, x, bits in ((bucket, dv[:, :EMBED], WORD_BITS), (grams, share, GRAM_BITS)))
    adam.step(grads | {"E": dE, "G": dG}, rate)


def score(p: dict, s: words.Slab) -> np.ndarray:
    """Each document's score: that of its worst window."""
    if p["const"]:
        return np.zeros(s.docs)
    number, bucket, grams, owners = vocabulary(s)
    vectors, _ = inputs(p, bucket, grams, owners)
    w, doc = windows(number, s.bounds())
    tables = [vectors @ p["W"][d] + p["b"][d] for d in (0, 1)]
    logit = np.empty(len(w), np.float32)
    joint = np.empty((WINDOW, min(ROWS, len(w)), 2 * HIDDEN), np.float32)
    for a in range(0, len(w), ROWS):
        t = np.ascontiguousarray(w[a : a + ROWS].T)
        own = joint[:, : t.shape[1]]

        def ahead(k: int, h: np.ndarray, own=own) -> None:
            own[k, :, :HIDDEN] = h

        def behind(k: int, h: np.ndarray, own=own) -> None:
            own[WINDOW - 1 - k, :, HIDDEN:] = h

        gru.run(tables[0], p["U"][0], t, ahead)
        gru.run(tables[1], p["U"][1], t[::-1], behind)
        attention = (np.tanh(own @ p["A"]) @ p["a"])[:, :, 0]
        e = np.exp(attention - attention.max(0)) * np.maximum(t > 0, t[:1] == 0)
        worth = (own @ p["O"])[:, :, 0]
        logit[a : a + ROWS] = (e * worth).sum(0) / e.sum(0)
    top = np.full(s.docs, -np.inf, np.float32)
    np.maximum.at(top, doc, logit + p["c"][0, 0])
    return gru.sigmoid(top.astype(np.float64))


def learn(docs: DataFrame, labels: DataFrame, per: int = PER_LABEL) -> dict:
    """Train on documents with a label: at most per of each label, by the digest of the id."""
    marks = labels.filter("toxic is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    marks = shared.sample(marks.filter("toxic in (0, 1)"), "toxic", per)
    rows = shared.texts(docs).join(F.broadcast(marks), "doc_id")  # marks: at most 2 * per rows
    rows = rows.orderBy("doc_id", "text").limit(2 * per)
    return shared.train(rows, _train)


def _train(rows: pa.Table) -> dict:
    rows = rows.sort_by([("doc_id", "ascending"), ("text", "ascending")])
    return train(rows.column("text").to_pylist(), rows.column("toxic").to_numpy())


def scores(spark: SparkSession, docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score."""
    held = spark.sparkContext.broadcast(model)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shared.batches(rows):
            own = np.concatenate([score(held.value, s) for s in slabs(batch.column("text"))])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(own)], names=["doc_id", "score"])

    return shared.texts(docs).mapInArrow(run, "doc_id bigint, score double")


def clean_documents(spark: SparkSession, docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score under the threshold, with all their columns; nothing is shuffled."""
    held, column = spark.sparkContext.broadcast(model), docs.columns.index("text")

    def keep(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shared.batches(rows):
            yield batch.filter(pa.array(np.concatenate([score(held.value, s) for s in slabs(batch.column(column))]) < threshold))

    return docs.mapInArrow(keep, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = shared.table(spark, sf_dir, "documents"), shared.table(spark, sf_dir, "labels")
    part = shared.crc_mod(3)
    model = learn(docs, labels.filter(part != 1))
    return scores(spark, docs, model).select("doc_id", (part == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
