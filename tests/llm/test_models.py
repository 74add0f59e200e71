"""Trained networks: gradients, held-out accuracy on made-up data, the defined cases; and the pipeline."""

import random
import resource
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyfield.llm import gru, language, mixing, shared, toxicity, words

from .test_copies import ITEMS, brute_components, brute_hits, low
from .test_text import brute_targets

SYLLABLES = {"en": "the ing and tion er or th".split(), "de": "sch ung ein ich ver ß keit".split(), "fr": "eau oi elle que è ment ré".split()}
BAD = ["stupid", "moron", "scum"]


def text(rng, lang, n, bad=0):
    own = ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n)]
    for _ in range(bad):
        own[rng.randrange(n)] = rng.choice(BAD)
    return " ".join(own)


def test_gradients():
    rng = np.random.default_rng(0)
    p = gru.init(rng, 3, 4)
    x = rng.standard_normal((2, 5, 2, 3)).astype(np.float32)
    g = rng.standard_normal((2, 5, 2, 4)).astype(np.float32)
    h, cache = gru.forward(p, x)
    grads, dx = gru.backward(p, x, cache, g)
    for name, at in (("W", (0, 1, 2)), ("U", (1, 2, 3)), ("b", (0, 0, 5)), ("U", (0, 3, 11))):
        e = 1e-2
        for sign in (1, -1):
            p[name][at] += sign * e
            value = float((gru.forward(p, x)[0] * g).sum())
            p[name][at] -= sign * e
            up, down = (value, up if sign < 0 else 0) if sign > 0 else (up, value)  # noqa: F821
        assert grads[name][at] == pytest.approx((up - down) / (2 * e), rel=0.05, abs=0.02)
    out = []
    gru.run(np.stack([x[0, t, 0] @ p["W"][0] + p["b"][0, 0] for t in range(5)]), p["U"][0], np.arange(5)[:, None], lambda t, s: out.append(s[0].copy()))
    assert np.allclose(np.stack(out), h[0, :, 0], atol=1e-5)


@pytest.fixture(scope="module")
def language_model():
    rng = random.Random(1)
    rows = [(lang, text(rng, lang, rng.randint(5, 60))) for lang in SYLLABLES for _ in range(60)]
    steps, language.STEPS = language.STEPS, 120
    yield language.train([t for _, t in rows], [n for n, _ in rows])
    language.STEPS = steps


def test_language(spark, edge, language_model):
    rng = random.Random(2)
    rows = [(100 + i, text(rng, lang, 30), lang) for i, lang in enumerate(list(SYLLABLES) * 20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, want string").unionByName(edge.select("doc_id", "text"), allowMissingColumns=True)
    got = language.predict(spark, docs, language_model, "want").collect()
    assert len(got) == docs.count()
    own = [r for r in got if r.want]
    assert sum(r.lang_pred == r.want for r in own) >= 0.95 * len(own)
    blank = [r for r in got if r.doc_id in (1, 2, 3, 9)]
    assert len(blank) == 4 and all((r.lang_pred, r.score) == ("und", 0.0) for r in blank)
    assert all(0 <= r.score <= 1 for r in got)
    assert language.predict(spark, docs.limit(0), language_model).count() == 0
    none = language.learn(edge.limit(0))
    assert {r.lang_pred for r in language.predict(spark, edge, none).collect()} == {"und"}


@pytest.fixture(scope="module")
def toxic_model():
    rng = random.Random(3)
    rows = [(text(rng, rng.choice(list(SYLLABLES)), rng.randint(5, 80), bad=i % 2 * rng.randint(1, 4)), i % 2) for i in range(400)]
    steps, toxicity.STEPS = toxicity.STEPS, 120
    yield toxicity.train([t for t, _ in rows], np.array([y for _, y in rows]))
    toxicity.STEPS = steps


def test_toxicity(spark, edge, toxic_model):
    rng = random.Random(4)
    rows = [(100 + i, text(rng, "en", rng.randint(10, 2000), bad=i % 2)) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").unionByName(edge.select("doc_id", "text"))
    got = {r.doc_id: r.score for r in toxicity.scores(spark, docs, toxic_model).collect() if r.doc_id and r.doc_id >= 100}
    right = sum((s >= 0.7) == (i % 2 == 1) for i, s in got.items())
    assert right >= 0.93 * len(got)
    kept = toxicity.clean_documents(spark, edge, toxic_model)
    assert kept.columns == edge.columns and kept.count() == edge.count()
    assert toxicity.scores(spark, docs.limit(0), toxic_model).count() == 0
    none = toxicity.train([], np.zeros(0))
    assert {r.score for r in toxicity.scores(spark, edge, none).collect()} == {0.0}


def test_toxicity_slabs_agree(toxic_model):
    rng = random.Random(6)
    own = [text(rng, "de", 300, bad=k % 2) for k in range(6)]
    whole = np.concatenate([toxicity.score(toxic_model, s) for s in words.slabs(pa.array(own), words.ALNUM)])
    apart = np.concatenate([toxicity.score(toxic_model, s) for s in words.slabs(pa.array(own), words.ALNUM, 100)])
    assert np.allclose(whole, apart, atol=1e-5)


def plain_gru(p, d, inputs):
    """Hidden states of one direction, one number at a time."""
    hidden = p["U"].shape[1]
    sig = lambda v: 1 / (1 + np.exp(-v))
    h, out = [0.0] * hidden, []
    for x in inputs:
        a = [sum(float(x[i]) * float(p["W"][d, i, k]) for i in range(len(x))) + float(p["b"][d, 0, k]) for k in range(3 * hidden)]
        u = [sum(h[i] * float(p["U"][d, i, k]) for i in range(hidden)) for k in range(3 * hidden)]
        z = [sig(a[k] + u[k]) for k in range(hidden)]
        r = [sig(a[hidden + k] + u[hidden + k]) for k in range(hidden)]
        n = [np.tanh(a[2 * hidden + k] + r[k] * u[2 * hidden + k]) for k in range(hidden)]
        h = [(1 - z[k]) * n[k] + z[k] * h[k] for k in range(hidden)]
        out.append(h)
    return out


def both_ways(p, inputs):
    return [a + b for a, b in zip(plain_gru(p, 0, inputs), plain_gru(p, 1, inputs[::-1])[::-1], strict=True)]


def test_language_equals_plain_numbers(language_model):
    p, texts = language_model, ["Ein sch\u00f6ner Tag", "x", "the ing and tion er or th " * 4]
    data, off = words.raw(pa.array(texts))
    got = language.score(p, words.LOWER[data], off)
    for t, row in zip(texts, got, strict=True):
        b = list(words.LOWER[np.frombuffer(t.encode(), np.uint8)])
        total = np.zeros(len(p["names"]))
        for a in range(0, len(b), language.WINDOW):
            part = [*b[a : a + language.WINDOW]] + [language.PAD] * max(0, language.WINDOW - len(b) + a)
            for x, h in zip(part, both_ways(p, [p["E"][x] for x in part]), strict=True):
                if x != language.PAD:
                    e = np.exp(np.array(h) @ p["O"] + p["c"][0])
                    total += e / e.sum()
        assert np.allclose(row, total / len(b), atol=1e-4)


def test_language_of_short_texts():
    """A language whose texts all have fewer than 16 bytes is learned."""
    rng = random.Random(5)
    rows = [(lang, text(rng, lang, rng.randint(5, 40))) for lang in ("en", "fr") for _ in range(60)] + [("xx", "".join(rng.choice("qzxwk") for _ in range(7))) for _ in range(60)]
    steps, language.STEPS = language.STEPS, 120
    p = language.train([t for _, t in rows], [n for n, _ in rows])
    language.STEPS = steps
    data, off = words.raw(pa.array(["zqxxwkq", "kkzqw", *[text(rng, "en", 20) for _ in range(5)]]))
    best = language.score(p, words.LOWER[data], off).argmax(1)
    assert [p["names"][k] for k in best] == ["xx", "xx", *["en"] * 5]


def test_toxicity_equals_plain_numbers(toxic_model):
    p, own = toxic_model, ["one stupid word", "", " ".join(f"w{i}" for i in range(27)), "moron " * 3 + "x " * 20]
    for s in words.slabs(pa.array(own), words.ALNUM):
        number, bucket, grams, owners = toxicity.vocabulary(s)
        vectors, _ = toxicity.inputs(p, bucket, grams, owners)
        bound, got = s.bounds(), toxicity.score(p, s)
        for d in range(s.docs):
            ids, best = list(number[bound[d] : bound[d + 1]]), -np.inf
            for a in range(0, max(1, len(ids) - toxicity.WINDOW + toxicity.STRIDE), toxicity.STRIDE):
                part = ids[a : a + toxicity.WINDOW]
                part += [0] * (toxicity.WINDOW - len(part))
                states = both_ways(p, [vectors[k] for k in part])
                score = [float(np.tanh(np.array(h) @ p["A"]) @ p["a"][:, 0]) for h in states]
                use = [k > 0 or part[0] == 0 for k in part]
                e = [np.exp(x) * u for x, u in zip(score, use, strict=True)]
                best = max(best, sum(x * float(np.array(h) @ p["O"][:, 0]) for x, h in zip(e, states, strict=True)) / sum(e) + float(p["c"][0, 0]))
            assert got[s.first + d - s.first] == pytest.approx(1 / (1 + np.exp(-best)), abs=1e-4)


def test_training_in_parts(monkeypatch):
    """A batch of more windows than go together learns the same."""
    rng = random.Random(7)
    rows = [(text(rng, "en", rng.randint(5, 60), bad=i % 2), i % 2) for i in range(64)]
    out = []
    for together in (toxicity.TOGETHER, 40):
        monkeypatch.setattr(toxicity, "TOGETHER", together)
        monkeypatch.setattr(toxicity, "STEPS", 5)
        out.append(toxicity.train([t for t, _ in rows], np.array([y for _, y in rows])))
    assert all(np.allclose(out[0][k], out[1][k], atol=2e-3) for k in ("W", "U", "O", "E"))


def test_sample_is_bounded(spark, monkeypatch):
    """Whole rows up to a number of bytes, the most frequent labels."""
    rows = spark.createDataFrame([(i, "x" * 100, f"l{min(i % 20, 5)}") for i in range(400)], "doc_id bigint, text string, lang string")
    monkeypatch.setattr(shared, "LABELS", 2)
    own = shared.sample(rows, "lang", 30)
    assert {r.lang for r in own.collect()} == {"l5", "l0"} and own.count() <= 60
    assert shared.train(rows, lambda t: t.num_rows) == 400


def test_workers_give_memory_back():
    """What a task has freed isn't held by its worker, also below a block that lives on."""
    held_mb = lambda: int(Path("/proc/self/statm").read_text().split()[1]) * resource.getpagesize() / 1e6
    own = [np.ones(12_000) for _ in range(2000)]
    last = own.pop()
    before = held_mb()
    del own
    assert list(shared.batches(iter([]))) == [] and len(last)
    assert before - held_mb() > 100


def test_pipeline(spark, near, edge, toxic_model, monkeypatch, tmp_path):
    docs = near.withColumn("lang", F.lit("en")).withColumn("source", F.concat(F.lit("s"), F.col("doc_id") % 4)).withColumn("n_chars", F.length("text").cast("bigint"))
    more = spark.createDataFrame([(5000, "you moron and scum of the stupid " * 3, "en", "s1", 9), (5001, ITEMS[0][1], "en", "s2", 9), (5002, ITEMS[0][1].upper(), "en", "s2", 9), (5003, None, None, None, None)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = docs.unionByName(more)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(ITEMS[:1], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    monkeypatch.setattr(toxicity, "learn", lambda *a, **k: toxic_model)
    got = {r.doc_id: r.taken for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    scores = {r.doc_id: r.score for r in toxicity.scores(spark, docs, toxic_model).collect()}
    left = [r for r in docs.collect() if scores[r.doc_id] < 0.7]
    assert 5000 not in {r.doc_id for r in left}
    last = {low(r.text): r for r in sorted(left, key=lambda r: r.doc_id)}
    left = list(last.values())
    stay = {i for i, _, c in brute_components(left) if i == c}
    left = [r for r in left if str(r.doc_id) in stay]
    clean = {x[0] for x in brute_hits([(r.doc_id, r.text) for r in left], ITEMS[:1]) if not x[-1]}
    # The mix of what is left, by the operator that has a brute-force test of its own, on rows found by brute force.
    rest = [(r.doc_id, r.text, r.source) for r in left if str(r.doc_id) in clean]
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int")
    mixed = mixing.mix(spark, spark.createDataFrame(rest, "doc_id bigint, text string, source string"), mixing.quality(labels)).collect()
    assert got == {r.doc_id: r.taken for r in mixed if r.taken > 0} and 5001 not in got and 5002 not in got
    sizes, taken = Counter(), Counter()
    for r in mixed:
        sizes[r.source] += r["size"]
        taken[r.source] += got.get(r.doc_id, 0)
    want = brute_targets(sizes, 1.5 * sum(sizes.values()))
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "toxicity" and len(corpus_pipeline.STAGES) == 5


def test_pipeline_of_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
