"""Online logistic mixing of bit predictors over the words of documents.

A word's code is the first BITS bits of its hash, so every bit of a code is a node of one binary tree.
Each bit is foreseen by several predictors: counts of zeros and ones of its node in hashed contexts that reach
over word boundaries (none, the document's most frequent word so far, the last word, the last two), of all training text,
and the same of the document's own text so far (none, the last word). Their stretched
probabilities are summed with weights that are gated by the bit's place in the code and by how often the
last word's context was seen, plus weights gated by how far the document is, plus the document's own
weights, which are updated online; a map of the document's own, learned as it goes, refines the sum.

Documents are coded in blocks (BLOCKS): a block's bits are foreseen from what was before the block, then
counts, weights and map learn from it. So many documents are coded side by side, and a document's
probability depends on nothing but the document and the tables.
"""

from __future__ import annotations

import numpy as np

from . import words

#: Bits of a word's code.
BITS = 12
#: log2 of the slots of the corpus's contexts: none, the most frequent word so far, the last word, the last two words.
ORDERS = (BITS, 18, 20, 20)
FIRST = np.cumsum([0, *(1 << b for b in ORDERS)])
SLOTS = int(FIRST[-1])
#: log2 of the slots of the document's own contexts: none, the last word.
OWN = (BITS, 12)
OWN_FIRST = np.cumsum([0, *(1 << b for b in OWN)])
INPUTS = len(ORDERS) + len(OWN) + 1
#: Words at which blocks end; behind the last, every LAST words.
BLOCKS, LAST = np.array([8, 24, 56, 120, 248, 504, 1016]), 1024
PRIOR, BOUND = 0.7, 10.0
#: Sightings of the last word's context from which other weights hold.
SEEN = np.array([1, 3, 10, 40, 200])
LEVELS = len(SEEN) + 1
#: The level of so many sightings.
_LEVEL = np.searchsorted(SEEN, np.arange(SEEN[-1] + 1), "right").astype(np.int8)
GATES, STAGES = BITS * LEVELS, len(BLOCKS) + 1
#: Rates at which a document's own weights and the gated weights learn.
RATE, GATED_RATE = 0.002, 0.1
#: Bins of a document's map, the bound of what they cover, sightings that its prior stands for.
BINS, REACH, TRUST = 17, 8.0, 200.0
_MULT = words.mix(np.arange(31, 39, dtype=np.uint64)) | np.uint64(1)
_SPREAD, _NODE = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)
_J = np.arange(BITS, dtype=np.uint32)[:, None]
#: Steps of a stored stretched probability up to its bound; the last bits, which hold a level.
SCALE, _LAST_BITS = 32000, 7
#: Where the gates of a bit's place begin.
_GATE = np.arange(BITS)[:, None] * LEVELS
#: Words that are foreseen together, whole documents of a block, so that what they need stays in a core's cache; words that wait to be counted.
TILE, WAITING = 1 << 12, 1 << 20
#: Words that are looked up together, one table after another, so that a core's cache holds one at a time.
WINDOW = 1 << 15


def rounds(place: np.ndarray) -> np.ndarray:
    """The block of each word, by its place in its document."""
    return np.where(place < BLOCKS[-1], np.searchsorted(BLOCKS, place, "right"), len(BLOCKS) + (place - BLOCKS[-1]) // LAST)


def seen_before(doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    """How often a word's key occurs earlier in its document. Words lie document by document; keys are below 2^40."""
    both = doc.astype(np.int64) << np.int64(40) | key
    wide = int(key.max()).bit_length() if len(key) else 0
    place = (len(both) - 1).bit_length() if len(both) else 0
    if len(both) and int(doc[-1]).bit_length() + wide + place < 63:
        # Places fit beside the keys: numbers are sorted faster than their order is found.
        packed = ((doc.astype(np.int64) << np.int64(wide) | key) << np.int64(place)) | np.arange(len(both))
        packed.sort()
        order = packed & np.int64((1 << place) - 1)
    else:
        order = np.argsort(both, kind="stable")
    own = both[order]
    at = np.arange(len(own))
    first = np.flatnonzero(np.diff(own, prepend=-1))
    out = np.empty(len(own), np.int64)
    out[order] = at - np.repeat(first, np.diff(np.append(first, len(own))))
    return out


def contexts(h: np.ndarray, doc: np.ndarray, place: np.ndarray, before: np.ndarray) -> np.ndarray:
    """(3, words): hashes of the document's most frequent word so far, of the last word and of the last two; 0 where there is none. before: how often the word occurs earlier in its document."""
    out = np.zeros((3, len(h)), np.uint64)
    if len(h):
        mixed = words.mix(h * _MULT[0] + np.uint64(1))
        at = np.arange(len(h))
        # The last of the words that have occurred most often; it must have occurred twice.
        rank = (doc.astype(np.int64) << np.int64(40)) + before
        most = np.maximum.accumulate(rank)
        who = np.maximum.accumulate(np.where(rank == most, at, 0))
        ok = (before[who[:-1]] > 0) & (place[1:] > 0)
        out[0, 1:] = np.where(ok, mixed[who[:-1]], 0)
        out[1, 1:] = np.where(place[1:] > 0, mixed[:-1], 0)
        out[2, 2:] = np.where(place[2:] > 1, words.mix(mixed[1:-1] * _MULT[1] + mixed[:-2]), 0)
    return out


def code_of(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def nodes(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(BITS, words): nodes of the tree and the bits that are taken there."""
    code = code.astype(np.uint32)
    return (np.uint32(1) << _J) | (code >> (np.uint32(BITS) - _J)), (code >> (np.uint32(BITS - 1) - _J)) & np.uint32(1)


def spread(context: np.ndarray, scaled: np.ndarray) -> np.ndarray:
    """Hashes of nodes (times _NODE) in a context; a table's slots are their first bits."""
    h = (context >> np.uint64(32)).astype(np.uint32) + scaled
    h ^= h >> np.uint32(15)
    h *= _SPREAD
    return h


def first_bits(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint32(32 - bits)).ravel().astype(np.int64)


def slots(context: np.ndarray, node: np.ndarray) -> list[np.ndarray]:
    """Slots of the corpus's contexts, flat, each counted from its context's first."""
    scaled = node * _NODE
    return [node.ravel().astype(np.int64), *(first_bits(spread(c, scaled), k) for c, k in zip(context, ORDERS[1:], strict=True))]


def stretch(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.log((ones + np.float32(PRIOR)) / (zeros + np.float32(PRIOR)), dtype=np.float32)


class Counts:
    """Zeros and ones of the corpus's slots, in turn. Words wait until WAITING of them are counted at once."""

    def __init__(self, counts: np.ndarray | None = None):
        self.counts = np.zeros(2 * SLOTS, np.int32) if counts is None else counts
        self.waiting, self.size = [], 0

    def add(self, at: list[np.ndarray], bit: np.ndarray, times: np.ndarray | None = None) -> None:
        for k, s in enumerate(at):
            np.add.at(self.counts[2 * FIRST[k] : 2 * FIRST[k + 1]], 2 * s + bit, np.int32(1) if times is None else times)

    def later(self, context: np.ndarray, code: np.ndarray) -> None:
        """Words to be counted: the upper half of their contexts, which is what slots depend on, and their codes."""
        self.waiting.append((context & np.uint64(0xFFFFFFFF << 32)) | code.astype(np.uint64))
        self.size += len(code)
        if self.size >= WAITING:
            self.settle()

    def settle(self) -> None:
        """Count the words that wait: equal codes in equal contexts are hashed and added once, with their number."""
        waiting, self.waiting, self.size = self.waiting, [], 0
        for k in range(len(ORDERS) if waiting else 0):
            own = np.concatenate([w[max(k - 1, 0)] for w in waiting])
            if k == 0:
                n = np.bincount((own & np.uint64(0xFFFFFFFF)).astype(np.int64), minlength=1 << BITS)
                own = np.flatnonzero(n).astype(np.uint64)
                n = n[own.astype(np.int64)]
            else:
                own.sort()
                first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                n, own = np.diff(np.append(first, len(own))), own[first]
            to = self.counts[2 * FIRST[k] : 2 * FIRST[k + 1]]
            for a in range(0, len(own), TILE):
                part = own[a : a + TILE]
                node, bit = nodes(part & np.uint64(0xFFFFFFFF))
                s = first_bits(spread(part, node * _NODE), ORDERS[k]) if k else node.ravel().astype(np.int64)
                s <<= 1
                s |= bit.ravel()
                np.add.at(to, s, np.tile(n[a : a + TILE].astype(np.int32), BITS))


class Tables:
    """The same for reading only, small enough for a core's cache: stretched probabilities in steps of BOUND / SCALE; those of the last word's context hold its level in their last bits."""

    def __init__(self, counts: Counts):
        counts.settle()
        pairs = counts.counts.reshape(-1, 2)
        # Most slots of a small corpus are empty.
        seen = np.flatnonzero(counts.counts.view(f"i{2 * counts.counts.itemsize}")) if counts.counts.itemsize < 8 else np.flatnonzero(pairs.any(1))
        self.table = np.zeros(SLOTS, np.int16)
        for a in range(0, len(seen), 1 << 16):
            at = seen[a : a + (1 << 16)]
            zeros, ones = np.take(pairs, at, axis=0).T
            x = np.clip(stretch(zeros.astype(np.float32), ones.astype(np.float32)), -BOUND, BOUND)
            x = np.rint(x * np.float32(SCALE / BOUND)).astype(np.int16)
            i, j = np.searchsorted(at, FIRST[2:4])
            own = (x[i:j] + np.int16(_LAST_BITS // 2)) & ~np.int16(_LAST_BITS)
            x[i:j] = own | np.take(_LEVEL, np.minimum(zeros[i:j] + ones[i:j].astype(np.int64), SEEN[-1]))
            self.table[at] = x
        # Without a context a word's nodes are those of its code alone: their values, bit by bit.
        node, _ = nodes(np.arange(1 << BITS))
        self.alone = self.table[node] * np.float32(BOUND / SCALE)

    def find(self, upper: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, ...]:
        """(contexts, BITS, words): values in the corpus's contexts, in steps; (BITS, words): levels, slots of the last word in a document's own counts, nodes and bits. upper: the upper half of contexts. Table by table and bit by bit."""
        node, bit = nodes(code)
        scaled = node * _NODE
        out, own = np.empty((len(upper), *scaled.shape), np.int16), np.empty(scaled.shape, np.uint16)
        for k, c in enumerate(upper):
            table, bits = self.table[FIRST[k + 1] : FIRST[k + 2]], np.uint32(32 - ORDERS[k + 1])
            for j in range(BITS):
                h = c + scaled[j]
                h ^= h >> np.uint32(15)
                h *= _SPREAD
                if k == 1:
                    own[j] = h >> np.uint32(32 - OWN[1])
                h >>= bits
                np.take(table, h.astype(np.int64), out=out[k, j], mode="clip")
        level = out[1] & np.int16(_LAST_BITS)
        out[1] &= ~np.int16(_LAST_BITS)
        return out, level, own, node, bit

    def look(self, at: list[np.ndarray], x: np.ndarray) -> np.ndarray:
        for k, s in enumerate(at):
            own = np.take(self.table[FIRST[k] : FIRST[k + 1]], s, mode="clip")
            if k == 2:
                level = (own & np.int16(_LAST_BITS)).astype(np.int64)
                own &= ~np.int16(_LAST_BITS)
            np.multiply(own, np.float32(BOUND / SCALE), out=x[k])
        return level


class Mixer:
    """Gated weights: by place in the code and level, and by block."""

    def __init__(self):
        self.gated = np.zeros((INPUTS, GATES), np.float32)
        self.gated[: INPUTS - 1] = 0.3
        self.stage = np.zeros((INPUTS, STAGES), np.float32)
        self.gated_seen, self.stage_seen = np.ones((INPUTS, GATES)), np.ones((INPUTS, STAGES))

    def learn(self, sums: np.ndarray, n: np.ndarray, stage: int) -> None:
        """One step of each weight by its mean gradient, smaller the more it has moved. sums, n: gradients and bits of each gate."""
        d = sums / (n + 1e-9)
        self.gated_seen += d * d * 50
        self.gated += (GATED_RATE * 10 * d / np.sqrt(self.gated_seen)).astype(np.float32)
        d = sums.sum(1) / n.sum()
        self.stage_seen[:, stage] += d * d * 50
        self.stage[:, stage] += (GATED_RATE * 5 * d / np.sqrt(self.stage_seen[:, stage])).astype(np.float32)


class _Own:
    """What documents count and learn of their own. beyond: which of them go on behind the first block, as the others count nothing; room: words of the longest one."""

    def __init__(self, beyond: np.ndarray, room: int, maps: bool):
        docs, self.row = len(beyond), np.maximum(np.cumsum(beyond) - 1, 0)
        # Zeros and ones of a slot side by side in one number, wide enough that none overflows.
        self.kind, self.half = (np.uint32, 16) if room * BITS < 1 << 16 else (np.uint64, 32)
        self.counts = np.zeros(max(1, int(beyond.sum())) * int(OWN_FIRST[-1]), self.kind)
        self.weights, self.bits = np.zeros((INPUTS, docs), np.float32), np.zeros(docs)
        self.hits, self.tries = (np.zeros((docs if maps else 0, BINS)) for _ in range(2))

    def look(self, at: np.ndarray) -> np.ndarray:
        both = np.take(self.counts, at, mode="clip").view(np.dtype(f"<u{self.half // 8}"))
        zeros, ones = both[..., ::2].astype(np.float32), both[..., 1::2].astype(np.float32)
        for n in (zeros, ones):
            n += np.float32(PRIOR)
        ones /= zeros
        return np.log(ones, out=ones)


_CENTRES = np.linspace(-REACH, REACH, BINS)
_MIDDLE = 1 / (1 + np.exp(-_CENTRES))


def _tile(found: tuple[np.ndarray, ...], alone: np.ndarray, mixer: Mixer, own: _Own, code: np.ndarray, who: np.ndarray, first: np.ndarray, stage: int, ends: bool, sums: tuple[np.ndarray, np.ndarray] | None) -> np.ndarray | None:
    """Costs of the words that whole documents (who) have in a block, from first[i] to first[i + 1] (with sums: none, but the gates' gradients and bits are added to those); then the documents learn from them, unless the block ends them. Everything lies bit by bit, (BITS, words). found: what tables hold for the words (Tables.find), alone: without a context.

    A bit's gates are few, so sums by gate are products of matrices: a bit is foreseen with the weights of all of them, of which its own is taken.
    """
    values, level, last, node, bit = found
    shape = node.shape
    inputs = INPUTS - 1 if stage else len(ORDERS)  # a document's first block has nothing of its own
    rows = np.append(np.arange(inputs), INPUTS - 1)
    x = np.empty((inputs + 1, *shape), np.float32)
    x[-1] = 1
    np.take(alone, code, axis=1, out=x[0], mode="clip")
    np.multiply(values, np.float32(BOUND / SCALE), out=x[1 : len(ORDERS)])
    words_ = first[1:] - first[:-1]
    first = first[:-1]
    if stage or not ends:
        base = np.repeat(own.row[who] * int(OWN_FIRST[-1]), words_)
        mine = [(node + base).ravel(), (last + (base + OWN_FIRST[1])).ravel()]
    for k in range(len(ORDERS), inputs):
        x[k] = own.look(mine[k - len(ORDERS)]).reshape(shape)
    weights = np.repeat(own.weights[np.ix_(rows, who)] + mixer.stage[rows, stage, None], words_, axis=1)
    every = np.matmul(np.ascontiguousarray(mixer.gated[rows].reshape(-1, BITS, LEVELS).transpose(1, 2, 0)), x.transpose(1, 0, 2))
    gate = level + _GATE
    of_gate = gate * shape[1]
    of_gate += np.arange(shape[1])
    of_gate = of_gate.ravel()
    z = np.take(every.ravel(), of_gate, mode="clip").reshape(shape)
    z += np.einsum("kjw,kw->jw", x, weights)
    np.maximum(z, np.float32(-BOUND), out=z)
    np.minimum(z, np.float32(BOUND), out=z)
    cost = None
    if sums is not None or not ends:
        g = np.negative(z)
        np.exp(g, out=g)
        g += 1
        np.divide(-1, g, out=g)
        g += bit.astype(np.float32)
    if sums is None:
        # Cells are counted from each document's middle one.
        cell = z * np.float32((BINS - 1) / (2 * REACH))
        np.rint(cell, out=cell)
        np.maximum(cell, np.float32(-(BINS // 2)), out=cell)
        np.minimum(cell, np.float32(BINS // 2), out=cell)
        at = cell.astype(np.int64)
        at += np.repeat(np.arange(len(who)) * BINS + BINS // 2, words_)
        right, all_ = own.hits[who], own.tries[who]
        shift = np.log((right + TRUST * _MIDDLE) / (all_ - right + TRUST * (1 - _MIDDLE))) - _CENTRES
        z += np.take(shift.astype(np.float32).ravel(), at, mode="clip")
        # What is refined stays far below where exp ends; a one costs what a zero costs with the other sign.
        z.view(np.uint32)[:] ^= bit << np.uint32(31)
        np.exp(z, out=z)
        z += 1
        np.log(z, out=z)
        cost = z.sum(0, dtype=np.float32)
        if ends:
            return cost
        at <<= 1
        at |= bit
        found = np.bincount(at.ravel(), minlength=2 * BINS * len(who)).reshape(-1, BINS, 2)
        own.hits[who] += found[:, :, 1]
        own.tries[who] += found.sum(2)
    else:
        sums[1][:] += np.bincount(gate.ravel(), minlength=GATES)
        every[:] = 0
        every.ravel()[of_gate] = g.ravel()
        sums[0][rows] += np.matmul(every, x.transpose(1, 2, 0)).reshape(GATES, -1).T
        if ends:
            return None
    # What the block teaches.
    own.bits[who] += words_ * BITS
    rate = (RATE / np.sqrt(1 + own.bits[who] / 100)).astype(np.float32)
    own.weights[np.ix_(rows, who)] += rate * np.add.reduceat(np.einsum("jw,kjw->kw", g, x), first, axis=1)
    one = (bit * np.uint32((1 << 16) - 1)).ravel() + np.uint32(1) if own.half == 16 else (bit.astype(np.uint64) * np.uint64((1 << 32) - 1)).ravel() + np.uint64(1)
    for s in mine:
        np.add.at(own.counts, s, one)
    return cost


def code(tables: Counts | Tables, mixer: Mixer, h: np.ndarray, doc: np.ndarray, place: np.ndarray, context: np.ndarray, docs: int, coded: np.ndarray, learn: bool = False, into: Counts | None = None) -> np.ndarray:
    """log2 probability of the code of each word (0 where coded is false). Words lie document by document. learn: only the mixer's weights learn; the result is 0. into: counts the bits of what is coded."""
    out = np.zeros(len(h))
    turn = rounds(place)
    chosen = np.flatnonzero(coded)
    if not len(chosen):
        return out
    if into is not None:
        into.later(context[:, chosen], code_of(h[chosen]))
    # Block by block, and in each those documents last that end in it: nobody asks what they would learn.
    last = np.zeros(docs, turn.dtype)
    np.maximum.at(last, doc[chosen], turn[chosen])
    key = 2 * turn[chosen] + (turn[chosen] == last[doc[chosen]])
    order = np.argsort(key, kind="stable")
    chosen, key = chosen[order], key[order]
    own = _Own(last > 0, int(place.max()) + 1, not learn)  # the maps don't bear on weights
    tables = Tables(tables) if isinstance(tables, Counts) else tables
    codes, d, upper = code_of(h[chosen]), doc[chosen], np.take((context >> np.uint64(32)).astype(np.uint32), chosen, axis=1)
    first = np.append(np.flatnonzero((np.diff(d, prepend=-1) != 0) | (np.diff(key, prepend=-1) != 0)), len(d))  # where each document's words of a block begin
    who, key = d[first[:-1]], key[first[:-1]]
    cut = np.flatnonzero(np.diff(key, prepend=-1))
    sums, begin, end = None, 0, 0
    for i, b in zip(cut, [*cut[1:], len(who)], strict=True):
        stage, ends = min(int(key[i]) >> 1, STAGES - 1), bool(key[i] & 1)
        if learn and sums is None:
            sums = (np.zeros((INPUTS, GATES)), np.zeros(GATES))
        while i < b:
            u = first[i]
            if i == end:
                begin, end = u, max(i + 1, int(np.searchsorted(first, u + WINDOW, "right")) - 1)
                found = tables.find(upper[:, u : first[end]], codes[u : first[end]])
            j = min(b, end, max(i + 1, int(np.searchsorted(first, u + TILE, "right")) - 1))
            v = first[j]
            cost = _tile(tuple(f[..., u - begin : v - begin] for f in found), tables.alone, mixer, own, codes[u:v], who[i:j], first[i : j + 1] - u, stage, ends, sums)
            if cost is not None:
                out[chosen[u:v]] = cost / -np.log(2)
            i = j
        if learn and (b == len(who) or key[b] >> 1 != key[b - 1] >> 1):
            mixer.learn(*sums, stage)
            sums = None
    return out
