"""Licence scans: a trained paragraph classifier, calibrated, with templates that confirm it.

A paragraph is the words of lines without a blank line between them (a line of comment marks alone is blank). A
sparse logistic regression over word n-grams (hashed, one to three words) gives every window of every paragraph
(of each of WINDOWS words, or the whole of a shorter paragraph, half overlapping) a distribution over licence
families and "none"; sums of weights run through the text once, so a window costs the same whatever its length.
Windows that are less likely none than a threshold join to places. A family that is among the likeliest of a
place's windows stands if the place, with as many words around it as a notice may have, holds CONFIRM of the word
n-grams of one of the family's notices, those aside that a better confirmed family's notice has; a place without any
family is "unknown" if one of its windows, at least half of its words different, passes a second, stricter threshold.

The regression learns from windows over the notices below, cut and put among ordinary words in a fixed random way,
and from ORDINARY windows of a bounded sample of documents. Before, a regression that hasn't seen one whole notice
of each family, nor any of the families of UNSEEN, calibrates the rest: a temperature by the loss over those
notices and other ordinary windows, the threshold, so that one ordinary window in FALSE passes, and the stricter
one, so that nine in ten of the notices pass.

Defined cases: a null text has no paragraphs; a blank text neither; a paragraph of any length is read whole; a
place with the notices of several families gives each that is confirmed; equally likely families go by name; without
documents to learn from, ordinary text is made up; repeated rows each give a row; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared, words

#: Notices as projects print them, by family.
NOTICES = {
    "agpl": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation",
        "licensed under the gnu affero general public license version 3",
        "spdx license identifier agpl 3 0 or later",
    ],
    "all-rights-reserved": ["all rights reserved", "copyright all rights reserved no part of this publication may be reproduced", "proprietary and confidential all rights reserved"],
    "apache-2.0": [
        "licensed under the apache license version 2 0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
        "spdx license identifier apache 2 0",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
        "www apache org licenses license 2 0",
        "see the license for the specific language governing permissions and limitations under the license",
    ],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        "released under the bsd license",
        "licensed under the 3 clause bsd license",
        "spdx license identifier bsd 3 clause",
    ],
    "cc0": ["to the extent possible under law the author has waived all copyright and related rights to this work", "released under cc0 1 0", "this work is dedicated to the public domain under cc0"],
    "cc-by": ["licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license"],
    "cc-by-nc": ["licensed under cc by nc 4 0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"],
    "cc-by-nd": ["licensed under cc by nd 4 0", "this work is licensed under a creative commons attribution noderivatives 4 0 international license"],
    "cc-by-sa": ["licensed under cc by sa 4 0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"],
    "gpl": [
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
        "released under the gnu general public license version 2",
        "spdx license identifier gpl 3 0 or later",
    ],
    "isc": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "released under the isc license", "spdx license identifier isc"],
    "lgpl": ["licensed under the gnu lesser general public license version 3", "under the terms of the gnu lesser general public license as published by the free software foundation", "spdx license identifier lgpl 3 0 or later"],
    "mit": [
        "released under the mit license",
        "licensed under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
        "spdx license identifier mit",
    ],
    "mpl": ["if a copy of the mpl was not distributed with this file you can obtain one at", "this source code form is subject to the terms of the mozilla public license v 2 0", "licensed under the mozilla public license version 2 0", "spdx license identifier mpl 2 0"],
    "unlicense": ["this is free and unencumbered software released into the public domain", "released under the unlicense", "spdx license identifier unlicense"],
}
NONE, UNKNOWN = "none", "unknown"
BITS, ORDERS = 15, (1, 2, 3)
#: Words of windows.
WINDOWS = (8, 24, 64)
#: Documents, and windows of them, to learn ordinary text from; passes; windows made of each notice.
DOCUMENTS, ORDINARY, PASSES, COPIES = 500, 4000, 10, 30
#: Least share of a notice's n-grams that confirms it; families of a window that are compared; families that calibration doesn't see; ordinary windows of which one may pass.
CONFIRM, TOP, UNSEEN, FALSE = 0.8, 3, ("cc0", "isc", "mpl"), 2000
_MULT = words.mix(np.arange(101, 104, dtype=np.uint64)) | np.uint64(1)


def grams(h: np.ndarray, order: int) -> np.ndarray:
    """Hashes of a paragraph's runs of so many words, from the words' hashes."""
    m = len(h) - order + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for k in range(order):
        out += h[k : k + m] * _MULT[k]
    return words.mix(out + np.uint64(order))


def feature(g: np.ndarray) -> np.ndarray:
    return (g >> np.uint64(64 - BITS)).astype(np.int64)


def features(h: np.ndarray) -> np.ndarray:
    """Feature numbers of a window, as often as they occur."""
    return np.concatenate([feature(grams(h, n)) for n in ORDERS])


def hashes(texts: list[str]) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for s in words.slabs(pa.array(texts, pa.string()), words.ALNUM):
        at = s.bounds()
        out += [s.hash[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
    return out


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def windows(size: int) -> np.ndarray:
    """(n, 2): the windows of a paragraph of so many words."""
    out = []
    for w in WINDOWS:
        if size >= w:
            start = np.append(np.arange(0, size - w, w // 2), size - w)
            out.append(np.stack([start, start + w], 1))
    return np.concatenate(out) if out else np.array([[0, size]])


def isin(known: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Whether each of x is in known, which is sorted."""
    at = np.searchsorted(known, x)
    at[at == len(known)] = 0
    return known[at] == x


class Model:
    """Weights, temperature, threshold, and each family's notices as sets of n-grams. missed: held-out notices of which no window passes the stricter threshold; held: all of them."""

    def __init__(self, ordinary: list[str], seed: int = 1):
        rng = np.random.default_rng(seed)
        self.names = [*sorted(NOTICES), NONE]
        own = [hashes(NOTICES[f]) for f in self.names[:-1]]
        self.notices = [[np.unique(grams(h, min(3, len(h)))) for h in family] for family in own]
        self.sizes = [[min(3, len(h)) for h in family] for family in own]
        self.longest = max(len(h) for family in own for h in family)
        self.known = known = np.unique(np.concatenate([x for family in self.notices for x in family]))
        pool = [h for h in hashes(ordinary) if len(h)] or hashes([" ".join(f"word{rng.integers(400)}" for _ in range(3000))])
        text = np.concatenate(pool)
        plain = self._ordinary(pool, known, rng)
        held = {(k, len(family) - 1) for k, family in enumerate(own) if len(family) > 1} | {(k, i) for k, f in enumerate(self.names[:-1]) if f in UNSEEN for i in range(len(own[k]))}
        cut = len(plain) * 4 // 5
        none = len(self.names) - 1
        every = [(k, i, h) for k, family in enumerate(own) for i, h in enumerate(family)]
        self._fit([x for k, i, h in every if (k, i) not in held for x in self._around(k, h, text, rng)] + [(none, h) for h in plain[:cut]], rng)
        self._calibrate([(k, h) for k, i, h in every if (k, i) in held], plain[cut:], rng, text)
        self._fit([x for k, _, h in every for x in self._around(k, h, text, rng)] + [(none, h) for h in plain], rng)

    @staticmethod
    def _ordinary(pool: list[np.ndarray], known: np.ndarray, rng: np.random.Generator) -> list[np.ndarray]:
        """Windows of ordinary text: those without a run of three words of a notice."""
        out = []
        chance = np.cumsum([len(h) for h in pool])
        for _ in range(ORDINARY):
            h = pool[int(np.searchsorted(chance, rng.integers(chance[-1]), "right"))]
            a = int(rng.integers(len(h)))
            part = h[a : a + int(rng.choice(WINDOWS))]
            if not isin(known, grams(part, 3)).any():
                out.append(part)
        return out

    @staticmethod
    def _around(k: int, h: np.ndarray, text: np.ndarray, rng: np.random.Generator) -> Iterator[tuple[int, np.ndarray]]:
        """The notice itself, and windows that hold three fifths of it, or are filled by it, among ordinary words."""
        yield k, h
        for _ in range(COPIES):
            a = rng.integers(0, max(1, len(text) - 128), 2)
            keep = h[rng.random(len(h)) > 0.04]
            whole = np.concatenate([text[a[0] : a[0] + 64], keep, text[a[1] : a[1] + 64]])
            w = int(rng.choice([x for x in WINDOWS if x <= 5 * len(h)] or WINDOWS[:1]))
            need = min(w, -(-len(keep) * 3 // 5))
            # It begins where it holds at least so many words of the notice.
            start = int(rng.integers(max(0, 64 - w + need), max(0, 64 - w + need) + max(1, min(64 + len(keep) - need, len(whole) - w) - max(0, 64 - w + need) + 1)))
            yield k, whole[start : start + w]

    def _fit(self, rows: list[tuple[int, np.ndarray]], rng: np.random.Generator) -> None:
        x, y = [features(h) for _, h in rows], np.array([k for k, _ in rows])
        self.weights = np.zeros((1 << BITS, len(self.names)), np.float32)
        self.bias = np.zeros(len(self.names), np.float32)
        for turn in range(PASSES):
            rate = 1.0 / (1 + 0.2 * turn)
            for at in np.array_split(rng.permutation(len(x)), max(1, len(x) // 64)):
                lengths = np.array([len(x[i]) for i in at])
                flat, row = np.concatenate([x[i] for i in at]), np.repeat(np.arange(len(at)), lengths)
                share = (1 / np.sqrt(np.maximum(lengths, 1))).astype(np.float32)
                own = self.weights[flat] * share[row, None]
                q = softmax(np.stack([np.bincount(row, own[:, k], len(at)) for k in range(own.shape[1])], 1) + self.bias)
                q[np.arange(len(at)), y[at]] -= 1
                np.add.at(self.weights, flat, (-rate * 0.5 * q[row] * share[row, None]).astype(np.float32))
                self.bias -= rate * 0.1 * q.mean(0)

    def _calibrate(self, held: list[tuple[int, np.ndarray]], plain: list[np.ndarray], rng: np.random.Generator, text: np.ndarray) -> None:
        known = [(k, h) for k, h in held if self.names[k] not in UNSEEN]
        rows = [*known, *[(len(self.names) - 1, h) for h in plain]]
        logits, y = np.stack([self.logits(h) for _, h in rows]), np.array([k for k, _ in rows])
        weight = np.concatenate([np.full(len(known), 0.5 / max(1, len(known))), np.full(len(plain), 0.5 / max(1, len(plain)))])
        scales = np.linspace(0.25, 8, 63)
        loss = [-(weight * np.log(softmax(logits * t)[np.arange(len(y)), y] + 1e-12)).sum() for t in scales]
        self.scale = float(scales[int(np.argmin(loss))])
        none = softmax(logits[len(known) :] * self.scale)[:, -1] if plain else np.ones(1)
        #: Windows whose "none" is less likely than this aren't ordinary.
        self.most = float(min(0.5, np.quantile(none, 1 / FALSE)))
        best = np.array([min(softmax(np.stack([self.logits(h[a:b]) for a, b in windows(len(h))]) * self.scale)[:, -1]) for _, h in held])
        #: A place that no notice confirms is "unknown" if a window is less likely none than this: nine in ten held-out notices are.
        self.sure = float(min(self.most, np.quantile(best, 0.9, method="higher")))
        self.held, self.missed = len(held), int((best > self.sure).sum())

    def logits(self, h: np.ndarray) -> np.ndarray:
        f = features(h)
        return self.weights[f].sum(0) / np.sqrt(max(1, len(f))) + self.bias

    def all_logits(self, h: np.ndarray, spans: np.ndarray) -> np.ndarray:
        """logits() of every span (start, end) of a run of words."""
        size = spans[:, 1] - spans[:, 0]
        total, n = np.zeros((len(spans), len(self.names))), np.zeros(len(spans))
        for order in ORDERS:
            run = np.zeros((len(h) + 1, len(self.names)))
            own = self.weights[feature(grams(h, order))]
            np.cumsum(own, axis=0, dtype=np.float64, out=run[1 : len(own) + 1])
            run[len(own) + 1 :] = run[len(own)]
            end = np.maximum(spans[:, 0], spans[:, 1] - order + 1)
            total += run[end] - run[spans[:, 0]]
            n += np.maximum(0, size - order + 1)
        return total / np.sqrt(np.maximum(n, 1))[:, None] + self.bias

    def confirmed(self, k: int, h: np.ndarray) -> float:
        """The largest share of one of the family's notices that a run of words holds."""
        return self._best(k, self._own(h), np.zeros(0, np.uint64))[0]

    @staticmethod
    def _own(h: np.ndarray) -> dict[int, np.ndarray]:
        return {n: np.unique(grams(h, n)) for n in (1, 2, 3)}

    def _best(self, k: int, own: dict[int, np.ndarray], taken: np.ndarray) -> tuple[float, np.ndarray]:
        """The largest share of a notice that is held beside what is taken, and that notice."""
        shares = [float((np.isin(notice, own[n]) & ~np.isin(notice, taken)).mean()) for notice, n in zip(self.notices[k], self.sizes[k], strict=True)]
        at = int(np.argmax(shares))
        return shares[at], self.notices[k][at]

    def families(self, candidates: list[int], h: np.ndarray) -> list[int]:
        """The candidates that a run of words confirms, best first; n-grams of one's notice count for no other."""
        if not isin(self.known, grams(h, 3)).any():
            return []  # no notice is shorter than three words
        own, taken, out = self._own(h), np.zeros(0, np.uint64), []
        order = sorted(candidates, key=lambda k: (-self._best(k, own, taken)[0], k))
        for k in order:
            share, notice = self._best(k, own, taken)
            if share >= CONFIRM:
                out.append(k)
                taken = np.union1d(taken, notice)
        return out


def _places(model: Model, h: np.ndarray, first: int, last: int, spans: np.ndarray, q: np.ndarray) -> Iterator[tuple[int, str, float]]:
    """(words, family, probability) of a paragraph's places. h: a slab's words, of which the paragraph has first..last; spans, q: its windows that aren't ordinary, by start, and their distributions."""
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.flatnonzero(np.concatenate([[True], spans[1:, 0] > reach[:-1]]))
    for a, b in zip(new, [*new[1:], len(spans)], strict=True):
        start, end = int(spans[a, 0]), int(reach[b - 1])
        around = h[max(first, start - model.longest) : min(last, end + model.longest)]
        top = np.unique(np.argsort(-q[a:b, :-1], axis=1, kind="stable")[:, :TOP])
        found = [(model.names[k], float(q[a:b, k].max())) for k in model.families(top.tolist(), around)]
        if not found:
            # A word repeated over and over repeats what it speaks for; a notice's words differ.
            likely = [k for k in range(a, b) if q[k, -1] <= model.sure and 2 * len(np.unique(h[spans[k, 0] : spans[k, 1]])) >= spans[k, 1] - spans[k, 0]]
            found = [(UNKNOWN, float(1 - q[likely, -1].min()))] if likely else []
        for family, p in found:
            yield end - start, family, p


def scan(model: Model, column: pa.Array) -> Iterator[tuple[int, list[tuple[int, int, str, float]]]]:
    """Per text: number of paragraphs, and (paragraph, words, family, probability) of the places that aren't ordinary, a family once a paragraph."""
    shapes: dict[int, np.ndarray] = {}
    for s in words.slabs(column, words.ALNUM):
        found: list = [{} for _ in range(s.docs)]
        count = np.zeros(s.docs, np.int64)
        if len(s.starts):
            line = np.cumsum(s.buf == 10)[s.starts]
            new = np.flatnonzero((np.diff(line, prepend=line[0] - 2) > 1) | (np.diff(s.doc, prepend=-1) != 0))
            ends = np.append(new[1:], len(line))
            count = np.bincount(s.doc[new], minlength=s.docs)
            first = np.concatenate([[0], np.cumsum(count)])
            sizes = ends - new
            for n in np.unique(sizes).tolist():
                if n not in shapes:
                    shapes[n] = windows(n)
            own = [shapes[n] for n in sizes.tolist()]
            which = np.repeat(np.arange(len(new)), [len(x) for x in own])
            spans = np.concatenate(own) + new[which, None]
            logits = model.all_logits(s.hash, spans) * model.scale
            # No window passes whose likeliest family isn't near "none".
            may = np.flatnonzero(logits[:, :-1].max(1) > logits[:, -1] - np.log(len(model.names)))
            q = softmax(logits[may]) if len(may) else logits[may]
            passed = q[:, -1] < model.most if len(may) else np.zeros(0, bool)
            may, q = may[passed], q[passed]
            order = np.lexsort((spans[may, 0], which[may]))
            may, q = may[order], q[order]
            cut = np.flatnonzero(np.diff(which[may], prepend=-1))
            for a, b in zip(cut, [*cut[1:], len(may)], strict=True) if len(may) else ():
                k = int(which[may[a]])
                d, hits = int(s.doc[new[k]]), {}
                for size, family, p in _places(model, s.hash, int(new[k]), int(ends[k]), spans[may[a:b]], q[a:b]):
                    before = hits.get(family, (0, 0.0))
                    hits[family] = (before[0] + size, max(before[1], p))
                if len(hits) > 1:
                    hits.pop(UNKNOWN, None)  # other lines of a notice that is named
                found[d].update({(k - int(first[d]), family): x for family, x in hits.items()})
        for d in range(s.docs):
            yield int(count[d]), [(k, size, family, p) for (k, family), (size, p) in sorted(found[d].items())]


def learn(docs: DataFrame, n: int = DOCUMENTS) -> Model:
    """Learn in a task of its own, with ordinary text from about n documents, by the digest of the id."""
    rows = shared.texts(docs).withColumn("all", F.lit(1))
    return shared.train(shared.sample(rows, "all", n), _train)


def _train(rows: pa.Table) -> Model:
    return Model(rows.sort_by([("doc_id", "ascending"), ("text", "ascending")]).column("text").to_pylist())


def licenses(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, n_paragraphs, licenses (families found, sorted), found: array of (paragraph, words, family, score)."""
    held = spark.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("paragraph", pa.int64()), ("words", pa.int64()), ("family", pa.string()), ("score", pa.float64())]))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shared.batches(rows):
            own = list(scan(held.value, batch.column("text")))
            found = [[dict(zip(("paragraph", "words", "family", "score"), x, strict=True)) for x in f] for _, f in own]
            names = [sorted({x[2] for x in f}) for _, f in own]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([n for n, _ in own], pa.int64()), pa.array(names, pa.list_(pa.string())), pa.array(found, kind)],
                names=["doc_id", "n_paragraphs", "licenses", "found"],
            )

    return shared.texts(docs).mapInArrow(run, "doc_id bigint, n_paragraphs bigint, licenses array<string>, found array<struct<paragraph:bigint,words:bigint,family:string,score:double>>")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents")
    x = licenses(spark, docs, learn(docs))
    places = F.transform("found", lambda f: F.concat_ws(":", f["family"], f["paragraph"].cast("string"), f["words"].cast("string")))
    top = F.coalesce(F.array_max(F.transform("found", lambda f: f["score"])), F.lit(0.0))
    return x.select("doc_id", "n_paragraphs", F.size("found").cast("bigint").alias("n_notices"), F.array_join("licenses", ",").alias("licenses"), F.array_join(places, ",").alias("notices"), top.alias("score"))
