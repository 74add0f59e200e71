"""Language-model scores by online logistic mixing of hashed-context bit predictors.

A text is its words (A-Z lower-cased) and an end. Whether a word is new (not among the training words) is
coded first, by the corpus's share of words that occur once and the document's share of new words so far. A
known word's code is then coded bit by bit, by predictors in hashed contexts that reach over word boundaries,
mixed with gated weights that are updated online in the document and refined by the document's own map
(mixer.py); words that share a code are told apart by their shares of the training words and of the
document's words so far. A new word is either one of the document's earlier new words, or is spelled: its
bytes are coded bit by bit in contexts of up to four bytes, mixed with gated weights and refined by an adaptive
probability map. The score is the sum, a proper sequence model's log10 probability of the text.

Tables of contexts have a fixed number of slots and count all training words (all distinct ones for
spelling); each distinct word's own count is exact. Gated weights are learned from every training document while
counting, as foreseen by what its task has counted before (tables are renewed whenever that has grown by half), those
of spelling from every distinct training word, by the counts without its own; both are averaged over all tasks.

Counts of words are exact, so a vocabulary is joined: partitions cut their documents into parts of about
PART bytes, write each document as numbers of its part's word list, and each part is scored in one task.

Defined cases: a null text is empty and has the end alone; without training rows every count is 0, the base
is that of add-one over one token, and every word is new; texts of any length are coded whole, block by block;
there are no ties to break; repeated rows each count and each give a row; a null doc_id hashes as the empty
text; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import mixer, shared, sketches, words

#: log2 of the slots of each spelling context: none (with the place in the word), last byte, last two, last three, last four.
ORDERS = (10, 16, 20, 21, 22)
FIRST = np.cumsum([0, *(1 << b for b in ORDERS)])
SLOTS = int(FIRST[-1])
#: Slots are stored with the table size rounded up to whole chunks.
STORED = -(-SLOTS // sketches.CHUNK) * sketches.CHUNK
PRIOR = 0.3
#: Words that are coded together; bytes that are counted together.
GROUP, COUNTED = 1 << 15, 1 << 20
#: Words behind which spelling weights move: at first, as a share of those before, and at most.
STEP, STEP_SHARE, STEP_MOST = 512, 4, 1 << 13
#: How much what a task has counted must grow before it foresees with new tables.
RENEW = 1.5
#: The curvature to begin with.
CAUTION = 100.0
#: Bins of the spelling map over the stretched probability; their bound; the map's share in the result.
BINS, BOUND, REFINED = 33, 12.0, 0.5
#: Distinct training words that one task counts bits of; bytes of text that share a word list; words that are scored together.
WORDS_A_TASK, PART, TOGETHER = 1 << 20, 1 << 25, 1 << 17
#: Words that the corpus's share of new words counts for beside a document's own; occurrences that a word's share of its code counts for.
STRENGTH, BESIDE = 16.0, 2.0
#: The end's hash, and fixed-point steps of averaged weights.
END, STEPS = int(words.mix(np.array([2024], np.uint64))[0]), float(1 << 20)
_MULT = words.mix(np.arange(1, 9, dtype=np.uint64)) | np.uint64(1)


def _read(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Word, byte and contexts (their own bytes as numbers) of all bytes of the words and the space behind each."""
    size = np.diff(offsets) + 1
    at = np.cumsum(size) - size
    word = np.repeat(np.arange(len(size)), size)
    text = np.full(int(size.sum()), 32, np.uint8)
    inner = np.arange(len(data)) - np.repeat(offsets[:-1], size - 1)
    text[np.repeat(at, size - 1) + inner] = data
    place = np.arange(len(text)) - np.repeat(at, size)
    # The four bytes before, 0 beyond the word's start.
    before = np.zeros((4, len(text)), np.uint64)
    for k in range(4):
        before[k, k + 1 :] = text[: max(len(text) - k - 1, 0)]
        before[k] *= place > k
    two = (before[0] << np.uint64(8)) | before[1]
    three = (two << np.uint64(8)) | before[2]
    return word, text, [np.minimum(place, 2).astype(np.uint64), before[0] + np.uint64(1), two, three, (three << np.uint64(8)) | before[3]]


#: What sets the contexts of two, three and four bytes apart.
_APART = np.array([0, 0, 7, 1 << 40, 1 << 41], np.uint64)


def _context(k: int, own: np.ndarray) -> np.ndarray:
    """What slots of context k are hashed from."""
    return words.mix(own + _APART[k]) if k > 1 else own


def _slots(k: int, context: np.ndarray, node: np.ndarray) -> np.ndarray:
    if k < 2:
        h = (context << np.uint64(8)) | node
        h &= np.uint64((1 << ORDERS[k]) - 1)
    else:
        h = node * _MULT[k]
        h += context
        h *= _MULT[k]
        h >>= np.uint64(64 - ORDERS[k])
    h += np.uint64(FIRST[k])
    return h.view(np.int64)


def bits(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(word, slots (contexts, n), bit, gate place) for each of a byte's eight bits, over all bytes of the words and the space behind each."""
    word, text, own = _read(data, offsets)
    contexts = [_context(k, x) for k, x in enumerate(own)]
    node = np.ones(len(text), np.uint64)
    slots = np.empty((len(ORDERS), len(text)), np.int64)
    for j in range(8):
        for k, c in enumerate(contexts):
            slots[k] = _slots(k, c, node)
        bit = (text >> np.uint8(7 - j)) & np.uint8(1)
        yield word, slots, bit, j
        node = (node << np.uint64(1)) | bit


def count_bits(data: np.ndarray, offsets: np.ndarray, counts: np.ndarray) -> None:
    """Add words' bits to counts (zeros of all slots, then ones): equal bytes in equal contexts are added once, with their number."""
    _, text, contexts = _read(data, offsets)
    for k, own in enumerate(contexts):
        key = (own << np.uint64(8)) | text
        key.sort()
        first = np.flatnonzero(np.diff(key, prepend=key[:1] + np.uint64(1)))
        n, key = np.diff(np.append(first, len(key))).astype(counts.dtype), key[first]
        context, byte, node = _context(k, key >> np.uint64(8)), key & np.uint64(255), np.ones(len(key), np.uint64)
        for j in range(8):
            bit = (byte >> np.uint64(7 - j)) & np.uint64(1)
            np.add.at(counts, _slots(k, context, node) + bit.view(np.int64) * STORED, n)
            node = (node << np.uint64(1)) | bit


def stretch(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.log(ones + PRIOR) - np.log(zeros + PRIOR)


#: Sightings of the last four and the last three bytes from which other weights hold.
SEEN, SEEN3 = np.array([1, 2, 4, 12, 64, 1024]), np.array([1, 16])
GATES = 8 * (len(SEEN) + 1) * (len(SEEN3) + 1)


#: The part of a gate's number that so many sightings give, the word's own left out.
_LEVEL4 = (np.searchsorted(SEEN, np.arange(-1, SEEN[-1] + 1), "right") * (len(SEEN3) + 1)).astype(np.uint8)
_LEVEL3 = np.searchsorted(SEEN3, np.arange(-1, SEEN[-1] + 1), "right").astype(np.uint8)


def gates(j: int, n4: np.ndarray, n3: np.ndarray) -> np.ndarray:
    """Gate numbers, from how often the two long contexts were seen."""
    return gate(j, np.searchsorted(SEEN, n4, "right"), np.searchsorted(SEEN3, n3, "right"))


def gate(j: int, level4: np.ndarray, level3: np.ndarray) -> np.ndarray:
    return (j * (len(SEEN) + 1) + level4) * (len(SEEN3) + 1) + level3


class Learned:
    """Spelling weights (gates, contexts + 1), and what the refining map is made of: ones and all bits (8 places, BINS), learned online."""

    def __init__(self):
        self.weights = np.full((GATES, len(ORDERS) + 1), 0.2, np.float32)
        self.weights[:, -1] = 0
        self.hits, self.tries, self.words = np.zeros((8, BINS)), np.zeros((8, BINS)), 0

    def learn(self, counts: np.ndarray, own: list[bytes] | pa.Array, rng: np.random.Generator) -> None:
        """Word by word in a random order, each once, however many there are; a word's own occurrence is taken out of the counts."""
        own = pa.array(own, pa.binary()) if isinstance(own, list) else own
        self.words += len(own)
        each, size = GATES // 8, len(ORDERS) + 1
        curve = np.tile(np.eye(size) * CAUTION, (8, each, 1, 1))
        # Zeros and ones of a slot side by side.
        both = np.ascontiguousarray(counts.T, np.float32).view(np.int64).ravel()
        order = rng.permutation(len(own))
        a = 0
        while a < len(order):
            chosen = order[a : a + min(STEP_MOST, max(STEP, a // STEP_SHARE))]
            a += len(chosen)
            for _, slots, bit, j in bits(*_bytes(own.take(pa.array(chosen)))):
                self._step(j, np.take(both, slots, mode="clip"), bit, curve[j])

    def _step(self, j: int, both: np.ndarray, bit: np.ndarray, curve: np.ndarray) -> None:
        """An online Newton step for each gate of a byte's bit j: its curvature so far scales its gradient. both: counts of the slots."""
        each, size = GATES // 8, len(ORDERS) + 1
        n = both[3:].view(np.float32)  # zeros and ones in turn
        n3, n4 = np.minimum(n[:, ::2] + n[:, 1::2], np.float32(SEEN[-1] + 1)).astype(np.int64)
        local = np.take(_LEVEL4, n4) + np.take(_LEVEL3, n3)
        order = np.argsort(local, kind="stable")
        cut = np.concatenate([[0], np.cumsum(np.bincount(local, minlength=each))])
        x, bit = np.ones((size, len(order)), np.float32), np.take(bit, order)
        n = np.take(both, order, axis=1, mode="clip").view(np.float32)
        y = bit.astype(np.float32)
        prior = np.full(2 * len(order), PRIOR, np.float32)
        prior[::2] -= 1 - y
        prior[1::2] -= y
        n += prior
        np.maximum(n, np.float32(PRIOR), out=n)
        np.divide(n[:, 1::2], n[:, ::2], out=x[:-1])
        np.log(x[:-1], out=x[:-1])
        np.maximum(x, np.float32(-BOUND), out=x)
        np.minimum(x, np.float32(BOUND), out=x)
        weights = self.weights[j * each : (j + 1) * each]
        z = np.concatenate([weights[k] @ x[:, u:v] for k, (u, v) in enumerate(zip(cut[:-1], cut[1:], strict=True))])
        np.clip(z, -BOUND, BOUND, out=z)
        p = 1 / (1 + np.exp(-z))
        g, curved = y - p, x * np.maximum(p * (1 - p), np.float32(1e-4))
        top = np.zeros((each, size))
        for k, (u, v) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
            if u < v:
                curve[k] += curved[:, u:v] @ x[:, u:v].T
                top[k] = x[:, u:v] @ g[u:v]
        weights += np.linalg.solve(curve, top[:, :, None])[:, :, 0].astype(np.float32)
        cell = np.rint((z + BOUND) / (2 * BOUND) * (BINS - 1)).astype(np.int64)
        found = np.bincount(2 * cell + bit, minlength=2 * BINS).reshape(BINS, 2)
        self.hits[j] += found[:, 1]
        self.tries[j] += found.sum(1)


class Speller:
    """Tables of stretched probabilities and of the long contexts' levels, mixing weights and the refining map (8 places, BINS)."""

    def __init__(self, counts: np.ndarray, learned: Learned):
        self.weights = learned.weights
        prior = 1 / (1 + np.exp(-np.linspace(-BOUND, BOUND, BINS)))
        q = (learned.hits + 20 * prior) / (learned.tries + 20)
        self.map = np.log(q / (1 - q)).astype(np.float32)
        self.table = np.clip(stretch(counts[0], counts[1]), -BOUND, BOUND).astype(np.float16)
        n = counts[:, FIRST[3] : FIRST[5]].sum(0)
        self.level = np.empty(len(n), np.int8)
        self.level[: 1 << ORDERS[3]] = np.searchsorted(SEEN3, n[: 1 << ORDERS[3]], "right")
        self.level[1 << ORDERS[3] :] = np.searchsorted(SEEN, n[1 << ORDERS[3] :], "right")

    def log2(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """log2 of each word's probability, the space behind it included."""
        out = np.zeros(len(offsets) - 1)
        weights = np.ascontiguousarray(self.weights.T)
        for word, slots, bit, j in bits(data, offsets):
            x = [self.table[s].astype(np.float32) for s in slots]
            at = gate(j, self.level[slots[4] - FIRST[3]], self.level[slots[3] - FIRST[3]])
            z = weights[-1][at]
            for k, own in enumerate(x):
                z += weights[k][at] * own
            np.clip(z, -BOUND, BOUND, out=z)
            u = (z + np.float32(BOUND)) * np.float32((BINS - 1) / (2 * BOUND))
            low = np.minimum(u.astype(np.int64), BINS - 2)
            part = u - low
            refined = self.map[j][low] * (1 - part) + self.map[j][low + 1] * part
            z += np.float32(REFINED) * (refined - z)
            # log2 of the coded bit's probability: -log2(1 + exp(-z)) for a one, of -z for a zero.
            z *= 1 - 2 * bit.astype(np.float32)
            out -= np.bincount(word, np.logaddexp(0, z), len(out))
        return out / np.log(2)


def joined(own: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(own), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int64)


class _List:
    """A partition's word list: numbers by hash, in order of appearance."""

    def __init__(self):
        self.hash, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of distinct hashes, and which of them are new."""
        at = np.searchsorted(self.hash, h)
        found = np.zeros(len(h), bool)
        inside = at < len(self.hash)
        found[inside] = self.hash[at[inside]] == h[inside]
        number = np.empty(len(h), np.int64)
        number[found] = self.number[at[found]]
        new = np.flatnonzero(~found)
        number[new] = len(self.hash) + np.arange(len(new))
        self.hash, self.number = np.insert(self.hash, at[new], h[new]), np.insert(self.number, at[new], number[new])
        return number, new


_LISTED = "part bigint, doc_id bigint, held_out boolean, bytes bigint, ids binary, hash bigint, word binary, id int, n bigint, chunk int, counts binary"
_TYPES = {"part": pa.int64(), "doc_id": pa.int64(), "held_out": pa.bool_(), "bytes": pa.int64(), "ids": pa.binary(), "hash": pa.int64(), "word": pa.binary(), "id": pa.int32(), "n": pa.int64(), "chunk": pa.int32(), "counts": pa.binary()}


def _row(size: int, part: int, **own: pa.Array) -> pa.RecordBatch:
    own["part"] = pa.array(np.full(size, part, np.int64))
    return pa.RecordBatch.from_arrays([own[k] if k in own else pa.nulls(size, kind) for k, kind in _TYPES.items()], names=list(_TYPES))


def _cut_out(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Runs of bytes as a binary column."""
    size = ends - starts
    to = np.concatenate([[0], np.cumsum(size)])
    data = buf[np.repeat(starts, size) + np.arange(int(to[-1])) - np.repeat(to[:-1], size)]
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(to.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])


def _distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct numbers in order, where one of each stands, and the number's place among them of every one. np.unique finds the first of each, which takes a slower sort."""
    order = np.argsort(h)
    own = h[order]
    new = np.ones(len(h), bool)
    new[1:] = own[1:] != own[:-1]
    inverse = np.empty(len(h), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return own[new], order[new], inverse


def with_ends(h: np.ndarray, ids: np.ndarray, bound: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words with an end behind each document: hashes, numbers (the end's is end), documents and places."""
    n = np.diff(bound) + 1
    doc = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    return np.insert(h, bound[1:], np.uint64(END)), np.insert(ids, bound[1:], end), doc, place


class _Tally:
    """What a partition counts and learns of training documents."""

    def __init__(self):
        self.counts, self.mixer, self.bits = mixer.Counts(), mixer.Mixer(), 0
        self.tables, self.tabled = mixer.Tables(self.counts), 0

    def add(self, h: np.ndarray, ids: np.ndarray, doc: np.ndarray, place: np.ndarray, train: np.ndarray) -> None:
        """Foresee all training documents, learn from them and count them."""
        context = mixer.contexts(h, doc, place, mixer.seen_before(doc, ids))
        chosen = np.flatnonzero(train[doc])
        if len(chosen):
            if self.bits >= RENEW * self.tabled:
                self.tables, self.tabled = mixer.Tables(self.counts), self.bits
            number = np.cumsum(train) - 1
            mixer.code(self.tables, self.mixer, h[chosen], number[doc[chosen]], place[chosen], context[:, chosen], int(train.sum()), np.ones(len(chosen), bool), True, self.counts)
            self.bits += len(chosen) * mixer.BITS

    def rows(self, part: int) -> pa.RecordBatch:
        self.counts.settle()
        size = -(-len(self.counts.counts) // sketches.CHUNK)
        kept, data = sketches.chunks(np.concatenate([self.counts.counts, np.zeros(size * sketches.CHUNK - len(self.counts.counts), np.int32)]))
        more = np.zeros(sketches.CHUNK, np.int64)
        own = np.concatenate([[1.0], self.mixer.gated.ravel(), self.mixer.stage.ravel()]) * self.bits
        more[: len(own)] = np.rint(own * STEPS).astype(np.int64)
        own, packed = sketches.chunks(more)
        return _row(len(kept) + len(own), part, chunk=pa.array([*kept, *[size] * len(own)], pa.int32()), counts=pa.array(data + packed, pa.binary()))


def _listed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """part, doc_id, held_out, text -> a row for each document with its words' numbers, one for each word of the part's list with its training count (number -1, the empty word, is the end), and the partition's counters."""
    known, counts, pieces, ends, part, size, tally = _List(), np.zeros(0, np.int64), [], 0, None, 0, _Tally()

    def flush() -> Iterator[pa.RecordBatch]:
        for h, number, own in pieces:
            yield _row(len(h), part, hash=pa.array(h), id=pa.array(number), word=own, n=pa.array(counts[number]))
        yield _row(1, part, hash=pa.array(np.array([END], np.uint64).view(np.int64)), id=pa.array([-1], pa.int32()), word=pa.array([b""], pa.binary()), n=pa.array([ends], pa.int64()))

    for batch in shared.batches(rows):
        part = batch.column("part")[0].as_py() << 24 if part is None else part
        train = ~batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        for s in words.slabs(batch.column("text")):
            if size > PART:
                yield from flush()
                known, counts, pieces, ends, part, size = _List(), np.zeros(0, np.int64), [], 0, part + 1, 0
            size += len(s.buf)
            distinct, first, inverse = _distinct(s.hash)
            number, new = known.add(distinct)
            counts = np.concatenate([counts, np.zeros(len(new), np.int64)])
            at = slice(s.first, s.first + s.docs)
            counts[number] += np.bincount(inverse[train[at][s.doc]], minlength=len(distinct))
            ends += int(train[at].sum())
            ids = number[inverse]
            tally.add(*with_ends(s.hash, ids + 1, s.bounds(), 0), train[at])
            ahead = np.concatenate([[0], np.cumsum(s.ends - s.starts + 1)])[s.bounds()]  # a space behind each word, and the end
            # The four bytes of each number: Spark needn't go through them one by one.
            lists = pa.Array.from_buffers(pa.binary(), s.docs, [None, pa.py_buffer((4 * s.bounds()).astype(np.int32).tobytes()), pa.py_buffer(ids.astype(np.int32).tobytes())])
            yield _row(s.docs, part, doc_id=batch.column("doc_id").slice(s.first, s.docs), held_out=batch.column("held_out").slice(s.first, s.docs), bytes=pa.array(np.diff(ahead) + 1), ids=lists)
            if len(new):
                pieces.append((distinct[new].view(np.int64), number[new].astype(np.int32), _cut_out(s.buf, s.starts[first[new]], s.ends[first[new]])))
    if part is not None:
        yield from flush()
        yield tally.rows(part)


def _bytes(own: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column."""
    own = own.cast(pa.large_binary())
    off = np.frombuffer(own.buffers()[1], np.int64)[own.offset : own.offset + len(own) + 1]
    data = np.frombuffer(own.buffers()[2], np.uint8) if own.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def _groups(batch: pa.RecordBatch, column: str) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Bytes and offsets of up to GROUP words at a time."""
    own = batch.column(column)
    for a in range(0, len(own), GROUP):
        part = own.slice(a, GROUP)
        yield slice(a, a + len(part)), *_bytes(part)


def _pieces(own: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes and offsets of words, of about COUNTED bytes at a time."""
    data, offsets = _bytes(own)
    a = 0
    while a < len(own):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + COUNTED, "right")) - 1)
        yield data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def _count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word -> counters of the words' bits; behind them, weights times words, and the map's sums."""
    counts, own = np.zeros(2 * STORED, np.int32), []
    for batch in shared.batches(rows):
        own.append(batch.column("word").cast(pa.large_binary()))
    own = pa.concat_arrays(own) if own else pa.array([], pa.large_binary())
    for data, offsets in _pieces(own):
        count_bits(data, offsets, counts)
    learned = Learned()
    learned.learn(counts.reshape(2, -1), own, np.random.default_rng(1))
    own = np.concatenate([[1.0], learned.weights.ravel()]) * learned.words
    more = np.zeros(sketches.CHUNK, np.int64)
    own = np.concatenate([own, learned.hits.ravel(), learned.tries.ravel()])
    more[: len(own)] = np.rint(own * STEPS).astype(np.int64)
    (kept, data), (at, packed) = sketches.chunks(counts), sketches.chunks(more)
    yield pa.RecordBatch.from_arrays([pa.array([*kept, *[2 * STORED // sketches.CHUNK] * len(at)], pa.int32()), pa.array(data + packed, pa.binary())], names=["chunk", "counts"])


def _sums(rows: DataFrame, size: int, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Counters (size of them, in whole chunks) and the numbers behind them, summed over tasks. rows: (chunk, counts)."""
    last = size // sketches.CHUNK
    more = sketches.total(rows.filter(F.col("chunk") == last).select(F.lit(0).alias("chunk"), "counts"), sketches.CHUNK)
    return sketches.total(rows.filter(F.col("chunk") < last), size, kind), more / STEPS


def spelling(stage: shared.Stage, vocabulary: DataFrame) -> Speller:
    """The speller of a vocabulary (hash, word, c); its tables hold all training words and have a fixed size."""
    learned = vocabulary.filter("c > 0")
    tasks = max(1, -(-learned.count() // WORDS_A_TASK))
    counted = stage.write(learned.select("word").coalesce(tasks).mapInArrow(_count, sketches.SCHEMA), "spelled")
    counts, more = _sums(counted, 2 * STORED, np.int32)
    stage.drop("spelled")
    out, at = Learned(), 1 + GATES * (len(ORDERS) + 1)
    if more[0] > 0:
        out.weights = (more[1:at] / more[0]).reshape(GATES, -1).astype(np.float32)
        out.hits, out.tries = more[at : at + 16 * BINS].reshape(2, 8, BINS)
    return Speller(counts.reshape(2, -1), out)


def context_model(counters: DataFrame) -> tuple[mixer.Tables, mixer.Mixer]:
    """Tables and weights of all partitions."""
    stored = -(-2 * mixer.SLOTS // sketches.CHUNK) * sketches.CHUNK
    counts, more = _sums(counters, stored, np.int64)
    out, size = mixer.Mixer(), mixer.INPUTS * mixer.GATES
    if more[0] > 0:
        out.gated = (more[1 : 1 + size] / more[0]).reshape(mixer.INPUTS, -1).astype(np.float32)
        out.stage = (more[1 + size : 1 + size + mixer.INPUTS * mixer.STAGES] / more[0]).reshape(mixer.INPUTS, -1).astype(np.float32)
    return mixer.Tables(mixer.Counts(counts[: 2 * mixer.SLOTS])), out


_SCORED = "hash bigint, worth bigint"


def _scored(held):
    """hash, word, c -> hash, worth: the count of a word that training has; of another, the log2 of its spelling in STEPS, below zero."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shared.batches(rows):
            worth = batch.column("c").to_numpy().copy()
            new = np.flatnonzero(worth == 0)
            for at, data, offsets in _groups(batch.take(pa.array(new)), "word"):
                worth[new[at]] = np.minimum(np.rint(held.value.log2(data, offsets) * STEPS), -1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("hash"), pa.array(worth)], names=["hash", "worth"])

    return run


def log2_words(known: np.ndarray, coded: np.ndarray, share: np.ndarray, code: np.ndarray, spelled: np.ndarray, before: np.ndarray, doc: np.ndarray, place: np.ndarray, new: float) -> np.ndarray:
    """log2 probability of each word, from whether it is known, its code's, its share of the training words of its code, its spelling's, and how often it occurs earlier in its document. new: the corpus's share of new words."""

    def so_far(x: np.ndarray) -> np.ndarray:
        total = np.cumsum(x) - x
        return total - total[np.arange(len(x)) - place]

    unseen = so_far(~known).astype(np.float64)
    p = (unseen + STRENGTH * new) / (place + STRENGTH)
    with np.errstate(divide="ignore"):
        of_code = (before + BESIDE * share) / (mixer.seen_before(doc, code) + BESIDE)
        old = np.log2(1 - p) + coded + np.log2(np.where(known, of_code, 1))
        # A new word may be one of the document's earlier ones.
        again = np.where(unseen > 0, (so_far(~known & (before > 0)) + 0.5) / (unseen + 1.5), 0)
        own = np.log2(again * before / np.maximum(unseen, 1))
        return np.where(known, old, np.log2(p) + np.logaddexp2(np.log2(1 - again) + spelled, own))


_OUT = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, bits_per_byte double"


def _documents(held, total: int, distinct: int, once: int, of_code: np.ndarray):
    """Documents of a part with its word list -> their scores. held: tables and mixer; of_code: training words of each code."""
    new = min(0.5, max(once, 1) / total) if total else 1.0

    def score(h: np.ndarray, ids: np.ndarray, doc: np.ndarray, place: np.ndarray, c: np.ndarray, spelled: np.ndarray, docs: int) -> np.ndarray:
        tables, weights = held.value
        known, before, code = c > 0, mixer.seen_before(doc, ids), mixer.code_of(h)
        coded = mixer.code(tables, weights, h, doc, place, mixer.contexts(h, doc, place, before), docs, known)
        return np.bincount(doc, log2_words(known, coded, c / np.maximum(of_code[code], 1), code, spelled, before, doc, place, new), docs)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        at = right.column("id").to_numpy() + 1  # the end's number is -1
        h, worth = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        h[at], worth[at] = (right.column(k).to_numpy() for k in ("hash", "worth"))
        h, c, spelled = h.view(np.uint64), np.maximum(worth, 0), np.minimum(worth, 0) / STEPS
        base = np.log10((c + 1) / (total + distinct + 1))
        out: list = [[] for _ in range(4)]
        for chunk in left.column("ids").chunks:
            values, off = _bytes(chunk)
            values, off = values.view(np.int32) + 1, off // 4
            a = 0
            while a < len(off) - 1:
                b = max(a + 1, int(np.searchsorted(off, off[a] + TOGETHER, "right")) - 1)
                own, ids, doc, place = with_ends(h[values[off[a] : off[b]]], values[off[a] : off[b]].astype(np.int64), off[a : b + 1] - off[a], 0)
                n_known = np.bincount(doc[c[ids] > 0], minlength=b - a)
                each, ends = base[ids], off[a : b + 1] - off[a] + np.arange(b - a + 1)
                costs = np.array([each[i:j].sum() for i, j in zip(ends[:-1], ends[1:], strict=True)])
                log2 = score(own, ids, doc, place, c[ids], spelled[ids], b - a)
                for x, v in zip(out, (np.diff(off[a : b + 1]) + 1, n_known, costs, log2 / np.log2(10)), strict=True):
                    x.append(v)
                a = b
        n_tokens, n_known, base_score, score_ = (np.concatenate(x) if x else np.zeros(0) for x in out)
        each = -score_ * np.log2(10) / left.column("bytes").to_numpy()
        columns = [left.column("doc_id"), left.column("held_out"), pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(np.full(len(n_tokens), total, np.int64)), *(pa.array(x, pa.float64()) for x in (base_score, score_, each))]
        return pa.table(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"])

    return run


def score(spark: SparkSession, docs: DataFrame, held_out) -> DataFrame:  # noqa: ANN001
    """held_out: a boolean column over doc_id; rows where it holds aren't learned from. Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    stage = shared.Stage(spark, "lm")
    rows = shared.texts(docs).select(F.spark_partition_id().cast("bigint").alias("part"), "doc_id", held_out.alias("held_out"), "text")
    listed = stage.write(rows.mapInArrow(_listed, _LISTED), "listed")
    lists = listed.filter("hash is not null")
    vocabulary = stage.write(lists.groupBy("hash", "word").agg(F.sum("n").alias("c")), "vocabulary")
    total, distinct, once = map(int, vocabulary.filter("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.when(F.col("c") == 1, 1)), F.lit(0))).first())
    of_code = np.zeros(1 << mixer.BITS, np.int64)
    for code, n in vocabulary.groupBy(F.shiftrightunsigned("hash", 64 - mixer.BITS).alias("code")).agg(F.sum("c")).collect():  # a row for each code
        of_code[code] = n
    held = spark.sparkContext.broadcast(spelling(stage, vocabulary))
    scored = stage.write(vocabulary.select("hash", "word", "c").mapInArrow(_scored(held), _SCORED), "scored")
    held.unpersist()
    stage.drop("vocabulary")
    held = spark.sparkContext.broadcast(context_model(listed.filter("chunk is not null").select("chunk", "counts")))
    own = lists.select(F.col("part").alias("of"), "id", "hash").join(scored, "hash")
    texts = listed.filter("ids is not null").select("part", "doc_id", "held_out", "bytes", "ids")
    return texts.groupBy("part").cogroup(own.groupBy("of")).applyInArrow(_documents(held, total, distinct, once, of_code), _OUT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(spark, shared.table(spark, sf_dir, "documents"), shared.crc_mod(7) == 2)
