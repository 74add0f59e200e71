"""Personal data, mixing, pages, licences, language models: against brute force, and the defined cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyfield.llm import html_text, licenses, lm, mixer, mixing, pii, words

from .test_copies import SPACE, low

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute_pii(text):
    out = []
    for k, (kind, p) in enumerate(BASE.items()):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")), "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(out))


def test_pii(spark, edge):
    rng = random.Random(3)
    letters = "0123456789" * 3 + "+-. ()@aZ._%é😀\n"
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 120)))) for i in range(400)]
    rows += [(1001, "1" * 50_000), (1002, "a" * 50_000 + "@b"), (1003, "1-" * 30_000), (1004, "+1" * 20_000), (1005, "1.2.3.4" * 5000), (1006, "id 4111 1111 1111 1111, mail x.y@z.org")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").unionByName(edge.select("doc_id", "text"))
    docs.write.parquet(path := f"{pytest.importorskip('tempfile').mkdtemp()}/documents.parquet")
    got = pii.query(spark, path.rpartition("/")[0])
    want = sorted((str(r.doc_id), hashlib.sha256(brute_pii(r.text).encode()).hexdigest()) for r in docs.collect())
    assert sorted((str(r.doc_id), r.base_sha256) for r in got.collect()) == want


def test_pii_added_kinds(spark):
    text = "IBAN GB82 WEST 1234 5698 7654 32; bad DE89370400440532013001; my ssn 123-45-6789, order 123-45-6789"
    r = pii.find(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert [(s.start, s.end) for s in r.iban] == [(5, 32)] and [(s.start, s.end) for s in r.ssn] == [(69, 80)]
    assert pii.find(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_pii_equals_its_sql(spark, tmp_path):
    """Scores too: context is what lies around a span, in both engines."""
    import duckdb

    texts = ["card no 12, 4111 1111 1111 1111", "IBAN DE89370400440532013000 BIC COBADEFF", "IBAN GB82 WEST 1234 5698 7654 32", "4111 1111 1111 1111 is a sample; 1.2.3.4 host 5.6.7.8 é😀 +49 170 1234567 +49 170 1234567 call"]
    spark.createDataFrame([*enumerate(texts), (9, None)], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got, want = pii.query(spark, str(tmp_path)).toPandas(), con.execute(pii.SQL).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = [x[columns].sort_values("doc_id").astype(str).values.tolist() for x in (got, want)]
    assert rows[0] == rows[1]
    by_id = got.set_index("doc_id")
    assert by_id.top_score[0] == 1.0 and list(by_id.n_iban[[0, 1, 2]]) == [0, 1, 1] and by_id.spans[1] == "iban:5:27"


def test_pii_of_many_matches(spark):
    """Over many chunks of matches, places stay right."""
    n = 5 * pii.CHUNK + 7
    r = pii.find(spark.createDataFrame([(1, "é +49 170 1234567, " * n)], "doc_id bigint, text string")).select("phone").first()
    assert [s.start for s in r.phone] == [2 + 19 * k for k in range(n)] and r.phone[-1].end == 19 * n - 2


def brute_targets(sizes, total):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    out, left, free = {}, total, set(names)
    while free:
        level = left / sum(w[s] for s in free)
        full = {s for s in free if level * w[s] > 2 * sizes[s]}
        if not full:
            return out | {s: level * w[s] for s in free}
        for s in full:
            out[s] = 2 * sizes[s]
            left -= out[s]
        free -= full
    return out


def test_mixing(spark, edge):
    rng = random.Random(1)
    rows = [(i, "x " * rng.randint(0, 40), rng.choice(["a", "b", "c", "ü", None, "hot", "hot", "hot"])) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").unionByName(edge.select("doc_id", "text", "source"))
    got = mixing.mix(spark, docs).collect()
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r["size"]
    want = brute_targets(sizes, 1.5 * sum(sizes.values()))
    assert len(got) == docs.count() and all(target[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= 1 for s in sizes)
    assert sorted(map(str, mixing.mix(spark, docs.repartition(7)).collect())) == sorted(map(str, got))
    assert mixing.mix(spark, docs.limit(0)).count() == 0


def test_mixing_ties_and_clashes(spark, edge):
    """Rows that repeat an id share a key and are ordered by size; null ids don't share one; other columns are ignored."""
    rows = [(None, "x " * k, "a") for k in range(1, 9)] + [(7, "y", "a"), (7, "y y", "a"), (7, "y y", "a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    for c in ("size", "key", "bucket", "target", "u", "rest"):
        docs = docs.withColumn(c, F.lit("x"))
    got = mixing.mix(spark, docs.unionByName(spark.createDataFrame([(9, "z " * 200, "b")], "doc_id bigint, text string, source string"), allowMissingColumns=True)).collect()
    a = [r for r in got if r.source == "a"]
    assert len(a) == 11 and abs(sum(r.taken for r in a) - a[0].target) <= 1 and all(0 <= r.taken <= 2 * r["size"] for r in a)
    again = mixing.mix(spark, docs.repartition(5)).collect()
    assert sorted((str(r.doc_id), r["size"], r.taken) for r in again) == sorted((str(r.doc_id), r["size"], r.taken) for r in mixing.mix(spark, docs).collect())
    assert mixing.mix(spark, edge).count() == edge.count()


def test_clashing_columns(spark, edge):
    """Operators take tables with columns of names that they use inside, and very long texts."""
    from tallyfield.llm import decontaminate, shared

    items = spark.createDataFrame([(1, "one two")], "item_id bigint, text string")
    n = edge.count()
    assert lm.score(spark, edge, shared.crc_mod(7) == 2).count() == n
    assert decontaminate.find(spark, edge, items).count() == n
    assert pii.find(edge).count() == n
    own = licenses.licenses(spark, edge, licenses.Model([])).collect()
    assert len(own) == n and {r.n_paragraphs for r in own if r.doc_id in (6, 7)} == {1} and not any(r.licenses for r in own)


def test_mixing_prefers_weight(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "'x y' as text", "if(id < 1000, 'a', 'b') as source")
    weight = docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0).alias("weight"))
    t = mixing.mix(spark, docs, weight).filter("source = 'b'").groupBy((F.col("doc_id") % 2).alias("k")).agg(F.sum("taken").alias("n"))
    n = {r.k: r.n for r in t.collect()}
    assert n[0] > 1.1 * n[1]


PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var a = "</p>";</script></head><body><nav><ul><li><a href="/x">Menu one</a></li></ul></nav>
<div class="ad">Buy this now</div>%s<div id="comments"><p>Nice one, says a reader.</p></div><aside>Related things</aside><form>Name <input></form><footer>&copy; us</footer></body></html>"""
BODY = "<h1>A  title</h1><p>First &amp; <b>bold</b><br>line<p>Second\n\tline &eacute;.</p><div class='advert'>Sponsored words</div><p>Last one.</p>"
TEXT = "A title First & bold line Second line é. Last one."


def test_pages(spark):
    labelled = [PAGE % f"<article>{BODY}</article>"] * 20
    weight = html_text.weights(html_text.count(labelled))
    assert html_text.extract(labelled[0], weight) == TEXT
    assert html_text.extract(PAGE % f"<div>{BODY}</div>", weight) == TEXT
    assert html_text.extract(PAGE % f"<main>{BODY}<p><a href='/x'>A link</a></p><article class='comment'>No</article></main>", weight) == TEXT + " A link"
    assert html_text.extract(PAGE % f"<div>{BODY}</div>", {}) == TEXT
    for empty in (None, "", "<", "<p", "<!-- x", "<script>x", "<nav>a b</nav>"):
        assert html_text.extract(empty, weight) == ""
    pages = spark.createDataFrame([(1, "u", labelled[0]), (1, "u", labelled[0]), (2, None, None)], "page_id bigint, url string, html string").withColumn("text", F.lit("x"))
    got = html_text.texts(spark, pages, html_text.learn(pages)).collect()
    assert sorted((r.page_id, r.text, r.n_chars) for r in got) == [(1, TEXT, len(TEXT)), (1, TEXT, len(TEXT)), (2, "", 0)]
    assert html_text.texts(spark, pages.limit(0), {}).count() == 0
    assert len(html_text.extract("<p>" + "word " * 200_000, {})) == 999_999


def test_licences(spark, edge):
    rng = random.Random(2)
    plain = [" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(12)) for _ in range(300)]
    m = licenses.Model(plain)
    for t, want in {"Released under the MIT License.": "mit", "Licensed under the Apache License, Version 2.0.": "apache-2.0", "This work is licensed under the GNU General Public License, version 3.": "gpl", "All rights reserved.": "all-rights-reserved",
                    "Licensed under CC BY-NC 4.0.": "cc-by-nc", "Licensed under CC BY-SA 4.0": "cc-by-sa", "SPDX-License-Identifier: MPL-2.0": "mpl"}.items():
        assert families(m, t) == {want}, t
    assert families(m, plain[0]) == set() and families(m, "licensed under the foo bar baz license") <= {"unknown"}
    own = [("Text here\n\nReleased under the MIT License.\nmore", 3, ["mit"]), (None, 0, []), ("", 0, [])]
    docs = spark.createDataFrame([(i, x[0]) for i, x in enumerate(own)], "doc_id bigint, text string").unionByName(edge.select("doc_id", "text"))
    got = licenses.licenses(spark, docs, m).filter("doc_id < 3").orderBy("doc_id").collect()
    assert [(r.n_paragraphs, r.licenses) for r in got if r.doc_id == 0] == [(2, ["mit"])]
    assert licenses.licenses(spark, docs.limit(0), m).count() == 0


def test_language_model(spark, near, edge):
    docs = near.unionByName(edge.select("doc_id", "text"))
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    rows = docs.collect()
    tokens = [[*SPACE.findall(low(r.text)), None] for r in rows]
    c = Counter(w for r, t in zip(rows, tokens, strict=True) if not held(r.doc_id) for w in t)
    n, v = sum(c.values()), len(c)
    from tallyfield.llm import shared

    got = lm.score(spark, docs.repartition(3), shared.crc_mod(7) == 2).collect()
    want = sorted((str(r.doc_id), held(r.doc_id), len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 6)) for r, t in zip(rows, tokens, strict=True))
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and r.bits_per_byte > 0 for r in got)
    assert lm.score(spark, docs.limit(0), shared.crc_mod(7) == 2).count() == 0
    none = lm.score(spark, docs.limit(5), F.lit(True)).collect()
    assert len(none) == 5 and all(r.train_tokens == 0 and r.score < 0 for r in none)


def test_bits_are_a_distribution():
    """A word's bits and the space behind it: over all next bytes, probabilities add up to one."""
    own = [b"the", b"them", b"then", b"a"]
    counts = np.zeros(2 * lm.STORED, np.int64)
    lm.count_bits(*lm.joined(own), counts)
    learned = lm.Learned()
    learned.learn(counts.reshape(2, -1), own, np.random.default_rng(1))
    m = lm.Speller(counts.reshape(2, -1), learned)
    every = [bytes([b]) for b in range(256) if b != 32]
    with_next = m.log2(*lm.joined([b"th" + x for x in every]))
    # P(th + x + space) <= P(th + x ..): summed over x and the end of the word it stays below P(th ..) <= 1.
    assert 0 < np.exp2(with_next).sum() + np.exp2(m.log2(*lm.joined([b"th"])))[0] <= 1
    assert m.log2(*lm.joined([b"the"]))[0] > m.log2(*lm.joined([b"xqz"]))[0]


@pytest.mark.parametrize("n", [40, (1 << 15) + 1])
def test_spelling_learns_once_from_any_number_of_words(monkeypatch, n):
    """Each word is learned from once, however many a task has: no switch by the size."""
    own, seen = [b"w%06d" % i for i in range(n)], []
    counts = np.zeros(2 * lm.STORED, np.int32)
    monkeypatch.setattr(lm.Learned, "_step", lambda self, j, both, bit, *more: seen.append(len(bit)))
    lm.Learned().learn(counts.reshape(2, -1), own, np.random.default_rng(1))
    assert sum(seen) == n * 8 * len(b"w000000 ")


def plain_code(counts, weights, hashes, coded):
    """One document's code probabilities as mixer.code gives them, bit by bit in plain numbers."""
    m, out = mixer, [0.0] * len(hashes)
    u64, u32 = (1 << 64) - 1, (1 << 32) - 1
    mul = [int(x) for x in m._MULT]

    def mix(x):
        return int(words.mix(np.array([x & u64], np.uint64))[0])

    def slot(context, node, bits):
        h = ((context >> 32) + node * 0x85EBCA6B) & u32
        return (((h ^ (h >> 15)) * int(m._SPREAD)) & u32) >> (32 - bits)

    own, delta, hits, tries, seen, lost = Counter(), [0.0] * m.INPUTS, [0.0] * m.BINS, [0.0] * m.BINS, Counter(), 0
    mixed = [mix(h * mul[0] + 1) for h in hashes]
    top, ranks, tops = 0, 0, []
    for i, h in enumerate(hashes):
        tops.append(mixed[top] if ranks > 0 else 0)
        if seen[h] >= ranks:
            top, ranks = i, seen[h]
        seen[h] += 1
    block = {}
    for i in range(len(hashes)):
        block.setdefault(int(m.rounds(np.array([i]))[0]), []).append(i)
    for turn, members in sorted(block.items()):
        stage, learned, grads = min(turn, m.STAGES - 1), [], [0.0] * m.INPUTS
        for i in members:
            if not coded[i]:
                continue
            code, last = hashes[i] >> (64 - m.BITS), mixed[i - 1] if i else 0
            two = mix(mixed[i - 1] * mul[1] + mixed[i - 2]) if i > 1 else 0
            for j in range(m.BITS):
                node, bit = (1 << j) | (code >> (m.BITS - j)), (code >> (m.BITS - 1 - j)) & 1
                at = [node, *(int(m.FIRST[k + 1]) + slot(c, node, m.ORDERS[k + 1]) for k, c in enumerate((tops[i], last, two)))]
                pairs = [(int(counts[2 * s]), int(counts[2 * s + 1])) for s in at]
                mine = [(0, node), (1, slot(last, node, m.OWN[1]))]
                pairs += [(own[s, 0], own[s, 1]) for s in mine]
                x = [max(-m.BOUND, min(m.BOUND, math.log((b + m.PRIOR) / (a + m.PRIOR)))) if k < 4 else math.log((b + m.PRIOR) / (a + m.PRIOR)) if stage else 0.0 for k, (a, b) in enumerate(pairs)] + [1.0]
                level = sum(sum(pairs[2]) >= s for s in m.SEEN)
                w = [float(weights.gated[k][j * m.LEVELS + level]) + float(weights.stage[k][stage]) + delta[k] for k in range(m.INPUTS)]
                z = max(-m.BOUND, min(m.BOUND, sum(a * b for a, b in zip(w, x, strict=True))))
                cell = max(0, min(m.BINS - 1, round((z + m.REACH) * (m.BINS - 1) / (2 * m.REACH))))
                centre = -m.REACH + cell * 2 * m.REACH / (m.BINS - 1)
                middle = 1 / (1 + math.exp(-centre))
                refined = z + math.log((hits[cell] + m.TRUST * middle) / (tries[cell] - hits[cell] + m.TRUST * (1 - middle))) - centre
                out[i] -= math.log2(1 + math.exp(-refined if bit else refined))
                g = bit - 1 / (1 + math.exp(-z))
                grads = [a + g * b for a, b in zip(grads, x, strict=True)]
                learned.append((mine, bit, cell))
        lost += len(learned)
        delta = [a + m.RATE / math.sqrt(1 + lost / 100) * b for a, b in zip(delta, grads, strict=True)]
        for mine, bit, cell in learned:
            hits[cell] += bit
            tries[cell] += 1
            for s in mine:
                own[s, bit] += 1
    return out


def test_mixer_equals_plain_numbers():
    rng = np.random.default_rng(4)
    lexicon = rng.integers(0, 1 << 63, 60, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    docs = [lexicon[np.minimum(rng.geometric(0.08, n) - 1, 59)] for n in (1, 40, 0, 700, 3)]
    h, doc = np.concatenate(docs), np.repeat(np.arange(5), [len(d) for d in docs])
    place = np.concatenate([np.arange(len(d)) for d in docs])
    ids = np.unique(h, return_inverse=True)[1]
    context = mixer.contexts(h, doc, place, mixer.seen_before(doc, ids))
    counts, weights = mixer.Counts(), mixer.Mixer()
    node, bit = mixer.nodes(mixer.code_of(h[:400]))
    counts.add(mixer.slots(context[:, :400], node), bit.ravel().astype(np.int64))
    mixer.code(counts, weights, h[:200], doc[:200], place[:200], context[:, :200], 5, np.ones(200, bool), True)
    coded = rng.random(len(h)) < 0.8
    got = mixer.code(mixer.Tables(counts), weights, h, doc, place, context, 5, coded)
    want = [x for k, d in enumerate(docs) for x in plain_code(counts.counts, weights, [int(x) for x in d], coded[doc == k])]
    assert (got[~coded] == 0).all() and np.allclose(got, want, rtol=0.02, atol=0.05)
    # Another document beside it changes nothing.
    alone = doc == 3
    assert np.allclose(mixer.code(mixer.Tables(counts), weights, h[alone], doc[alone] * 0, place[alone], context[:, alone], 1, coded[alone]), got[alone], atol=1e-3)


def test_gates_are_summed_by_products(monkeypatch):
    """What gates learn from a slab is what the sums over their bits give; the bits aren't summed gate by gate."""
    rng = np.random.default_rng(5)
    docs, n = 12, 30
    h, doc, place = rng.integers(0, 1 << 63, 40, dtype=np.uint64)[rng.integers(0, 40, docs * n)] * np.uint64(2), np.repeat(np.arange(docs), n), np.tile(np.arange(n), docs)
    context = mixer.contexts(h, doc, place, mixer.seen_before(doc, np.unique(h, return_inverse=True)[1]))
    counts = mixer.Counts()
    node, bit = mixer.nodes(mixer.code_of(h))
    at = mixer.slots(context, node)
    counts.add(at, bit.ravel().astype(np.int64))
    tables, weights = mixer.Tables(counts), mixer.Mixer()
    weights.gated += rng.normal(0, 0.1, weights.gated.shape).astype(np.float32)
    x, first = np.ones((mixer.INPUTS, node.size), np.float32), place < 8  # the first block has nothing of its own
    gate = (tables.look(at, x).reshape(node.shape) + mixer._GATE)[:, first]
    x = x.reshape(mixer.INPUTS, *node.shape)[:, :, first]
    x[len(mixer.ORDERS) : -1] = 0
    z = np.clip((weights.gated[:, gate] * x).sum(0), -mixer.BOUND, mixer.BOUND)
    g = bit[:, first] - 1 / (1 + np.exp(-z))
    want = np.array([np.bincount(gate.ravel(), (g * own).ravel(), mixer.GATES) for own in x])
    found = []
    weights.learn = lambda sums, bits, stage: found.append((stage, sums, bits))
    plain = np.bincount
    monkeypatch.setattr(np, "bincount", lambda x, weights=None, minlength=0: plain(x, None if weights is None else pytest.fail("summed gate by gate"), minlength))
    mixer.code(tables, weights, h, doc, place, context, docs, np.ones(len(h), bool), True)
    stage, sums, bits = found[0]
    assert stage == 0 and np.allclose(sums, want, atol=1e-2) and (bits == np.bincount(gate.ravel(), minlength=mixer.GATES)).all()


def test_distinct_and_seen_before_equal_plain_ones():
    rng = np.random.default_rng(3)
    h, doc = rng.integers(0, 50, 400).astype(np.uint64), np.sort(rng.integers(0, 7, 400))
    distinct, one, inverse = lm._distinct(h)
    assert (distinct == np.unique(h)).all() and (h[one] == distinct).all() and (distinct[inverse] == h).all() and not len(lm._distinct(h[:0])[0])
    for shift in (0, 1 << 38):  # the larger keys don't fit beside their places
        for docs in (doc, doc + (1 << 20)):
            seen = Counter()
            want = [seen.update([k]) or seen[k] - 1 for k in zip(docs.tolist(), h.tolist(), strict=True)]
            assert mixer.seen_before(docs, h.astype(np.int64) + shift).tolist() == want


def test_words_are_counted_once_with_their_number():
    """Equal words in equal contexts, counted together, give the counts of all of them bit by bit; those of a long document don't overflow."""
    rng = np.random.default_rng(6)
    h = rng.integers(0, 1 << 63, 30, dtype=np.uint64)[np.minimum(rng.geometric(0.2, 5000) - 1, 29)] * np.uint64(2)
    doc, place = np.zeros(5000, np.int64), np.arange(5000)
    context = mixer.contexts(h, doc, place, mixer.seen_before(doc, np.unique(h, return_inverse=True)[1]))
    want, got = mixer.Counts(), mixer.Counts()
    node, bit = mixer.nodes(mixer.code_of(h))
    want.add(mixer.slots(context, node), bit.ravel().astype(np.int64))
    for a in (0, 2000):
        got.later(context[:, a : a + 3000 if a else 2000], mixer.code_of(h[a : a + 3000 if a else 2000]))
    assert not got.counts.any()
    got.settle()
    got.settle()
    assert (got.counts == want.counts).all() and got.counts.sum() == 5000 * mixer.BITS * len(mixer.ORDERS)
    # One word 70,000 times: a count of 16 bits would begin again at nothing.
    n = 70_000
    same, doc, place = np.full(n, h[0]), np.zeros(n, np.int64), np.arange(n)
    context = mixer.contexts(same, doc, place, place)
    cost = -mixer.code(mixer.Tables(mixer.Counts()), mixer.Mixer(), same, doc, place, context, 1, np.ones(n, bool))
    assert cost[66_000:].max() <= cost[60_000]


def test_blocks_in_tiles(monkeypatch):
    """Documents foreseen together or apart cost the same and teach the same weights, also those that end in a block."""
    rng = np.random.default_rng(7)
    size = rng.integers(1, 700, 20)
    h, doc = rng.integers(0, 1 << 63, 40, dtype=np.uint64)[rng.integers(0, 40, size.sum())] * np.uint64(2), np.repeat(np.arange(20), size)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size)
    context = mixer.contexts(h, doc, place, mixer.seen_before(doc, np.unique(h, return_inverse=True)[1]))
    found = []
    for tile in (1, 1 << 20):
        monkeypatch.setattr(mixer, "TILE", tile)
        counts, weights = mixer.Counts(), mixer.Mixer()
        mixer.code(mixer.Tables(counts), weights, h, doc, place, context, 20, np.ones(len(h), bool), True, counts)
        found.append((weights.gated, weights.stage, mixer.code(mixer.Tables(counts), weights, h, doc, place, context, 20, np.ones(len(h), bool))))
    assert all(np.allclose(a, b, atol=1e-3) for a, b in zip(*found, strict=True))


def test_look_ups_in_windows(monkeypatch):
    """Words that are looked up together or apart cost the same and teach the same weights."""
    rng = np.random.default_rng(8)
    size = rng.integers(1, 300, 12)
    h, doc = rng.integers(0, 1 << 63, 40, dtype=np.uint64)[rng.integers(0, 40, size.sum())] * np.uint64(2), np.repeat(np.arange(12), size)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size)
    context = mixer.contexts(h, doc, place, mixer.seen_before(doc, np.unique(h, return_inverse=True)[1]))
    found = []
    for window in (1, 100, 1 << 20):
        monkeypatch.setattr(mixer, "WINDOW", window)
        counts, weights = mixer.Counts(), mixer.Mixer()
        mixer.code(mixer.Tables(counts), weights, h, doc, place, context, 12, np.ones(len(h), bool), True, counts)
        found.append((weights.gated, weights.stage, mixer.code(mixer.Tables(counts), weights, h, doc, place, context, 12, np.ones(len(h), bool))))
    assert all(np.allclose(a, b, atol=1e-3) for other in found[1:] for a, b in zip(found[0], other, strict=True))


def test_equal_bytes_are_counted_once_with_their_number(monkeypatch):
    """Bits of words that repeat are hashed once, and counted as often as they occur."""
    own, sizes, mix = [b"", "é".encode(), b"abc", *[b"the", b"then"] * 500], [], words.mix
    want = np.zeros(2 * lm.STORED, np.int64)
    for _, slots, bit, _ in lm.bits(*lm.joined(own)):
        for x in slots:
            np.add.at(want, x + bit.astype(np.int64) * lm.STORED, 1)
    monkeypatch.setattr(words, "mix", lambda x: sizes.append(len(x)) or mix(x))
    got = np.zeros(2 * lm.STORED, np.int32)
    lm.count_bits(*lm.joined(own), got)
    assert (got == want).all() and max(sizes) < 20
    got[:] = 0
    lm.count_bits(*lm.joined([]), got)
    assert not got.any()


def test_words_of_a_document():
    """New words, repeated new words, and shares within a code, against plain numbers."""
    ids, known = [5, 5, 7, 5, 9, 9, 7], [True, True, False, True, False, True, False]
    code, share, spelled, coded, new = [1, 1, 2, 1, 2, 1, 2], [0.25, 0.25, 0, 0.25, 0, 0.5, 0], [-30.0] * 7, [-3.0] * 7, 0.1
    want = []
    for i in range(7):
        earlier = ids[:i].count(ids[i])
        unseen = sum(not k for k in known[:i])
        p = (unseen + lm.STRENGTH * new) / (i + lm.STRENGTH)
        if known[i]:
            want.append(math.log2(1 - p) + coded[i] + math.log2((earlier + lm.BESIDE * share[i]) / (code[:i].count(code[i]) + lm.BESIDE)))
        else:
            again = (sum(not known[k] and ids[k] in ids[:k] for k in range(i)) + 0.5) / (unseen + 1.5) if unseen else 0
            want.append(math.log2(p * ((1 - again) * 2 ** spelled[i] + again * earlier / max(unseen, 1))))
    doc, place = np.zeros(7, np.int64), np.arange(7)
    a = np.array
    got = lm.log2_words(a(known), a(coded), a(share), a(code), a(spelled), mixer.seen_before(doc, a(ids)), doc, place, new)
    assert np.allclose(got, want)


def test_context_reaches_over_words(spark):
    """A text costs less than its words in another order, and a repeated passage less than a new one."""
    rng = random.Random(12)
    lexicon = [f"w{i}" for i in range(300)]
    after = {w: rng.sample(lexicon, 3) for w in lexicon}

    def walk(n):
        out = [rng.choice(lexicon)]
        while len(out) < n:
            out.append(rng.choice(after[out[-1]]))
        return out

    own = walk(300)
    mixed = rng.sample(own, len(own))
    docs = spark.createDataFrame([(i, " ".join(walk(300))) for i in range(300)] + [(1000, " ".join(own)), (1001, " ".join(mixed)), (1002, " ".join(own[:150] * 2))], "doc_id bigint, text string")
    got = {r.doc_id: r.score for r in lm.score(spark, docs, F.col("doc_id") >= 1000).filter("doc_id >= 1000").collect()}
    assert got[1000] > 0.9 * got[1001] and got[1002] > got[1000]


def test_weights_learn_from_all_that_is_counted():
    """Every training document and every distinct training word; as it was, each eighth document and each 32nd word."""
    behind = lambda rows, last: sum(lm.sketches._unpack(x)[0] for r in rows for k, x in zip(r["chunk"].to_pylist(), r["counts"].to_pylist(), strict=True) if k == last) / lm.STEPS
    texts = [f"w{i} some words x{i * i} some" for i in range(40)]
    held = np.arange(40) % 7 == 2
    docs = pa.RecordBatch.from_pydict({"part": [0] * 40, "doc_id": range(40), "held_out": held, "text": texts})
    listed = list(lm._listed(iter([docs.slice(0, 15), docs.slice(15)])))
    assert behind([listed[-1]], -(-2 * mixer.SLOTS // lm.sketches.CHUNK)) == mixer.BITS * 6 * (~held).sum()
    own = sorted({w for t in texts for w in t.split()})
    counted = list(lm._count(iter([pa.RecordBatch.from_pydict({"hash": [words.hash_of(w) % 2**62 for w in own], "word": [w.encode() for w in own]})])))
    assert behind(counted, 2 * lm.STORED // lm.sketches.CHUNK) == len(own)


def test_words():
    own = ["Ab  cD x", "", None, "é\tß", "a" * 300_000]
    got = [[] for _ in own]
    for s in words.slabs(pa.array(own), size=8):
        for d, a, b in zip(s.doc, s.starts, s.ends, strict=True):
            got[s.first + d].append(s.buf[a:b].tobytes().decode())
    assert got == [SPACE.findall(low(x)) for x in own]
    one, two = (next(words.slabs(pa.array([x]))).hash for x in ("abc abc", "x abc"))
    assert one[0] == one[1] == two[1] != two[0] == words.hash_of("x")


def test_spelling_has_no_floor(spark):
    """One unknown word of 100 kB costs what its bytes cost; as it was, 1000 bits."""
    rng = random.Random(8)
    long = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(100_000))
    docs = spark.createDataFrame([(i, "the words of a text " * 20) for i in range(20)] + [(99, long), (100, f"the {long} of {long}")], "doc_id bigint, text string")
    got = {r.doc_id: r for r in lm.score(spark, docs, F.col("doc_id") > 50).collect()}
    # 36 letters and digits that are equally likely hold 5.2 bits.
    assert got[99].bits_per_byte > 5 and got[99].score < -100_000
    assert got[100].score == pytest.approx(got[99].score, abs=40)


@pytest.fixture(scope="module")
def licence_model():
    rng = random.Random(2)
    return licenses.Model([" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(12)) for _ in range(300)])


def families(model, text):
    return {x[2] for x in next(licenses.scan(model, pa.array([text])))[1]}


def test_every_notice_is_found(licence_model):
    """Also those without a cue word."""
    missed = [(f, n) for f, own in licenses.NOTICES.items() for n in own if families(licence_model, n) != {f}]
    assert not missed


def test_notices_wrapped_buried_and_joined(licence_model):
    rng = random.Random(4)
    other = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    for family, own in licenses.NOTICES.items():
        for n in own:
            w = n.split()
            assert families(licence_model, "Text\n\n# " + "\n# ".join(" ".join(w[i : i + 9]) for i in range(0, len(w), 9)) + "\n\nmore") == {family}, n
            assert families(licence_model, f"{other(600)} {n} {other(400)}") == {family}, n
    mit, bsd = licenses.NOTICES["mit"][2], licenses.NOTICES["bsd"][0]
    for between in (" ", "\n", f" {other(30)} "):
        assert families(licence_model, mit + between + bsd) == {"mit", "bsd"}
    assert families(licence_model, other(20_000)) == set()


FILES = {
    "mit": "Copyright (c) 2020 A. Person\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software.\n",
    "bsd": "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the following conditions are met:\n#\n# 1. Redistributions of source code must retain the above copyright notice, this\n#    list of conditions and the following disclaimer.\n",
    "apache-2.0": "// Licensed under the Apache License, Version 2.0 (the \"License\");\n// you may not use this file except in compliance with the License.\n// You may obtain a copy of the License at\n//\n//     http://www.apache.org/licenses/LICENSE-2.0\n",
    "mpl": "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n * file, You can obtain one at http://mozilla.org/MPL/2.0/. */\n",
    "gpl": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.\n",
}


def test_wrapped_notices_of_files(licence_model):
    for family, t in FILES.items():
        assert families(licence_model, t) == {family}, family


def test_held_out_notices(licence_model):
    """Whole notices, and whole families, that the calibrating regression hasn't seen."""
    assert licence_model.held >= 20 and licence_model.missed <= 0.1 * licence_model.held


def test_windows_equal_plain_numbers(licence_model):
    """Window logits and confirmed shares against sums over dictionaries."""
    m, rng = licence_model, random.Random(6)
    w = ("one two three licensed under the mit license and more of the gnu general public " * 4).split()
    rng.shuffle(w)
    h = licenses.hashes([" ".join(w)])[0]
    spans = licenses.windows(len(w))
    covered = set()
    for (a, b), got in zip(spans.tolist(), m.all_logits(h, spans), strict=True):
        covered.update(range(a, b))
        rows = [m.weights[int(licenses.feature(licenses.grams(h[i : i + n], n))[0])] for n in licenses.ORDERS for i in range(a, b - n + 1)]
        assert np.allclose(got, np.sum(rows, 0) / math.sqrt(len(rows)) + m.bias, atol=1e-3)
        assert np.allclose(got, m.logits(h[a:b]), atol=1e-3)
    assert covered == set(range(len(w))) and {b - a for a, b in spans.tolist()} == {x for x in licenses.WINDOWS if x <= len(w)}
    for k, family in enumerate(m.names[:-1]):
        text = licenses.NOTICES[family][0].split()[: rng.randint(3, 12)] + w[:5]
        three = lambda x: {tuple(x[i : i + min(3, len(x))]) for i in range(max(1, len(x) - 2))}
        want = max(len(three(n.split()) & three(text)) / len(three(n.split())) for n in licenses.NOTICES[family])
        assert m.confirmed(k, licenses.hashes([" ".join(text)])[0]) == pytest.approx(want)


def test_pages_with_raw_text_and_open_heads():
    body = "<p>First words of it.</p>%s<p>Last words of it.</p>"
    text = "First words of it. Last words of it."
    for inner in ("<script>for(i=0;i<n;i++){}</script>", "<script>a = '<!--';</script>", "<script>a = '<main>'</script>", "<!-- <article> -->", "<style>a{} /* <p */</style>", "<textarea><b</textarea>", "<script src='a'/>x<b</script>"):
        for head in ("<head><title>t</title></head>", "<head><title>A <b</title><meta charset=x>"):
            for start in ("<body>", ""):
                assert html_text.extract(f"<html>{head}{start}{body % inner}</body></html>", {}) == text, (inner, head, start)
    assert html_text.count(["<!-- <main> --><p>words</p>"]) == {}
    # An end tag may stand alone, and a page may end in an open script.
    assert html_text.extract("<p>One two.</p></script><p>Three four.</p><script>x<y", {}) == "One two. Three four."


REGIONS = {
    '<article><p>One two.</p><script>if(a<b){x="it"}</script><p>Three four.</p><script>a<b && c</script><p>Five.</p></article>': "One two. Three four. Five.",
    "<html><head><title>t</title><meta charset=x><article><p>One two.</p></article>": "One two.",
    '<article class="overflow-hidden"><p>One two.</p><p hidden>no</p><div style="display: none">no</div></article>': "One two.",
    '<article><h1 class="header">A title</h1><div class="header"><p>By me.</p></div><p>One two.</p><p class="ad">Buy</p></article>': "A title By me. One two.",
    "<article><p>One two three four five.</p></article><p>A line between</p><article><p>Six seven eight nine ten.</p></article>": "One two three four five. Six seven eight nine ten.",
    '<div class="content"><h1 class="header">A title</h1><p>One two three.</p></div><div class="comments"><p>Hey.</p></div>': "A title One two three.",
}


def test_pages_keep_their_main_text():
    labelled = [PAGE % f"<article>{BODY}</article>"] * 20
    for weight in ({}, html_text.weights(html_text.count(labelled))):
        for page, text in REGIONS.items():
            assert html_text.extract(page, weight) == text, page


#: What stands between two paragraphs of a main text, and what is read of it.
INSIDE = {
    '<section class="discussion"><p>We discuss it.</p></section>': "We discuss it.",
    '<p class="legal">The law says so.</p>': "The law says so.",
    '<p class="popular science">Atoms are small.</p>': "Atoms are small.",
    "<button>Save<p>Middle words.</p>": "Middle words.",
    "<p>Mid <button>Save</p><p>Middle words.</p>": "Mid Middle words.",
    "<button>a<div>b</div></button><p>Middle words.</p>": "Middle words.",
    "<object data=x><p>Middle words.</p>": "Middle words.",
    "<object data=x><p>no</p></object><p>Middle words.</p>": "Middle words.",
    "<svg><g><svg><text>no</text></svg><text>no</text></g></svg><p>Middle words.</p>": "Middle words.",
    "<p>Some <select><option>x<option>y</select> words.</p>": "Some words.",
    "<p>Some <select><option>x<option>y</p><p>words.</p>": "Some words.",
    """<p><a href="x"">alpha beta</a> said "gamma" delta.</p>""": 'alpha beta said "gamma" delta.',
    "<p><a title='it's'>it</a> said 'y' to z.</p>": "it said 'y' to z.",
    """<p><a title="a > b">it</a> = "y" so.</p>""": 'it = "y" so.',
}


@pytest.mark.parametrize("around", ["<article>%s</article>", "<main>%s</main><article><p>A teaser is here.</p></article>", "<body><div>%s</div></body>", '<body><div class="tabs">%s</div></body>'])
def test_main_text_is_neither_lost_nor_added_to(around):
    """Doubtful words of a class, elements left open, stray quotes and articles beside a main."""
    labelled = [PAGE % f"<article>{BODY}</article>"] * 20
    for weight in ({}, html_text.weights(html_text.count(labelled))):
        for inner, text in INSIDE.items():
            page = around % f"<p>The first words of it are here.</p>{inner}<p>The last words of it are here.</p>"
            assert html_text.extract(page, weight) == f"The first words of it are here. {text} The last words of it are here.", page
    assert html_text.extract("<main><nav>a b</nav></main><article><p>A story is here.</p></article>", {}) == "A story is here."


def test_extract_is_the_greatest_run():
    """Of a page without named main text: all runs of its tokens are tried."""
    rng = random.Random(4)
    pieces = ["<p>One two</p>", "<div>three", "</div>", "<a href=x>link it</a>", "<ul><li>item</ul>", "<nav>menu</nav>", "<p class=legal>law", "<div class=ad>buy</div>", "<table><td>cell"]
    weight = html_text.weights(html_text.count([PAGE % f"<article>{BODY}</article>"] * 9))
    for _ in range(200):
        page, own = "".join(rng.choices(pieces, k=rng.randint(0, 9))), rng.choice(({}, weight))
        tokens = html_text.tokens(page)
        gains = [html_text._gain(own, x, False) for x in tokens]
        top = max(sum(gains[i:j]) for i in range(len(gains) + 1) for j in range(i, len(gains) + 1))
        a, b = html_text.best_run(gains)
        assert sum(gains[a:b]) == pytest.approx(top)
        kept = " ".join(" ".join(x[0] for x in tokens[a:b] if x[0] and html_text.stays(own, x, False)).split())
        assert html_text.extract(page, own).replace(" ", "") == kept.replace(" ", "")


def test_class_words_are_learned():
    """A word of no list, seen outside of main text only, keeps its words out of the run; one seen inside brings them in."""
    labelled = ['<div class="teasers"><p>%s</p></div><article><div class="storybody">%s</div></article>' % ("Other words here. " * 5, "Body words here. " * 9)] * 30
    weight = html_text.weights(html_text.count(labelled))
    page = '<div class="teasers"><p>Some teaser words.</p></div><div class="storybody">The story is told here.</div>'
    assert html_text.extract(page, weight) == "The story is told here."


def test_best_run_is_the_greatest_sum():
    rng = random.Random(9)
    for _ in range(300):
        gains = [rng.choice([-3, -2, -1, 0, 1, 2, 3]) for _ in range(rng.randint(0, 14))]
        a, b = html_text.best_run(gains)
        assert sum(gains[a:b]) == max((sum(gains[i:j]) for i in range(len(gains) + 1) for j in range(i, len(gains) + 1)))


def test_pages_of_any_shape(spark):
    """Repeated pages and columns of names that are used inside."""
    rows = [(1, "u", "<p>Same words here.</p>")] * 3 + [(None, None, "x " * 100_000), (2, "v", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for c in ("text", "n_chars", "what", "which", "inside", "n"):
        pages = pages.withColumn(c, F.lit(7))
    got = html_text.texts(spark, pages, html_text.learn(pages)).collect()
    assert sorted((str(r.page_id), r.n_chars) for r in got) == [("1", 16)] * 3 + [("2", 0), ("None", 0)]
    assert html_text.extract("<p>" + "x " * 100_000, {}) == " ".join(["x"] * 100_000)
