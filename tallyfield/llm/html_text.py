"""Main text of web pages as a maximum-scoring run of tokens.

A page is read as one sequence of words and tags. A word scores by the block element it stands in, by the
words of the class, id and role attributes around it (hashed to a fixed number of features), and by the kind
of page furniture that it is in, if any; a tag scores by its name, below zero. The weights are log odds of
being in the main text, counted on labelled pages: those whose markup names the main text (main, or article);
a kind of furniture has a prior weight below zero, which they shift by little, and words of class, id and role that main text uses as
well (such as legal or popular) are features like others, with a small prior. One linear scan finds the contiguous
run of greatest total score; its words are the text, without furniture whose own score is below zero. On a
page that names its main text itself, words outside of it count against the run and are not part of the text,
so several articles are taken together where their words outweigh the gap. Weights that no labelled page
gives are set by rule, so pages without such markup are read in the same way. An article outside of a main that holds words is a teaser.

A quote opens a value only behind an equals sign. Content that isn't read (scripts, buttons, objects and so on) ends at its end tag,
at the end of an element around it, and if it has no end tag at the next block.

Defined cases: null or empty html, or html without words of positive score, gives an empty text with
n_chars 0; unclosed and stray tags are tolerated, a tag or comment cut off at the page's end counts
as markup; of runs of equal score the one that ends first and is longest stays; a page of any length is read
whole, in one pass; repeated pages each give a row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

#: Element names with a fixed role in HTML.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe object svg math head select button".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
MAIN = frozenset(("article", "main"))
#: Furniture by element name.
BY_NAME = {"nav": "menu", "menu": "menu", "header": "header", "footer": "footer", "aside": "sidebar", "form": "form", "dialog": "notice", "fieldset": "form"}
#: Furniture by words of class, id or role. Fixed values, in the order in which they are tried.
BY_WORD = {
    "comment": "comment comments commentlist reply replies respond disqus".split(),
    "advert": "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promoted adsense".split(),
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager".split(),
    "header": "header masthead topbar".split(),
    "footer": "footer copyright colophon contentinfo".split(),
    "sidebar": "sidebar aside widget widgets related recommended recommendations complementary".split(),
    "notice": "notice cookie cookies consent gdpr popup newsletter subscribe paywall".split(),
    "form": "form login signup searchbox".split(),
    "share": "share sharing".split(),
}
#: Words that furniture and main text both use: no kind of their own, but a feature with a weight below zero that counts shift.
DOUBTFUL = frozenset("alert discussion legal modal overlay popular promotion search social subscription tabs toc trending".split())
_KIND = {w: kind for kind, own in BY_WORD.items() for w in own}
_TOKEN = re.compile(r"<!--(?:(?!-->).)*+(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(>|\Z)|<[!?][^>]*+(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SPLIT = re.compile(r"[^a-z0-9]+")
#: How elements end whose content is plain text to a parser, and what may stand in a head.
_ENDS = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in "script style textarea title".split()}
HEAD = frozenset("head title meta link base style script noscript template".split())
#: Bound of a weight; prior weight of a kind of furniture, and how far counts may raise it; hashed attribute words and the bound of their sum.
MOST = 4.0
PRIOR, RAISE = {"header": -3.0, "share": -4.0}, 1.0
FEATURES, SHIFT = 1 << 12, 2.0
DOUBT = -0.5
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_DOUBTED = frozenset(zlib.crc32(w.encode()) % FEATURES for w in DOUBTFUL)


@lru_cache(1 << 14)
def marks(name: str, attributes: str) -> tuple[str, tuple[int, ...]]:
    """The kind of furniture that an element is (or an empty string), and the features of its attribute words."""
    kind, found = BY_NAME.get(name, ""), []
    if attributes and name not in ("body", "html"):
        values = {m[1].lower(): next((x for x in m.groups()[1:] if x is not None), "").lower() for m in _ATTRIBUTE.finditer(attributes)}
        if "hidden" in values or values.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", values.get("style", "")):
            kind = kind or "notice"
        for value in _SPLIT.split(" ".join(values.get(k, "") for k in ("class", "id", "role"))):
            if value:
                found.append(zlib.crc32(value.encode()) % FEATURES)
                own = _KIND.get(value, "")
                if not kind and own and not (own == "header" and name in HEADINGS) and (name not in MAIN or own == "comment"):
                    kind = own
    return kind, tuple(sorted(set(found)))


def tokens(page: str) -> list[tuple[str, str, str, tuple, bool, bool]]:
    """(text, block, kind, features, in main, breaks) of each token in page order; text is empty for tags. block: of a tag its name; breaks: whether a block ends before it.

    The main text is named by main, or where no main holds words by article: articles beside a main are teasers.
    """
    own = list(_tokens(page, MAIN))
    if MAIN <= {t[1] for t in own if not t[0]}:
        narrow = list(_tokens(page, frozenset(("main",))))
        if any(text.strip() and inside and not kind for text, _, kind, _, inside, _ in narrow):
            return narrow
    return own


def _open(page: str, name: str, at: int, never: set[str]) -> bool:
    """Whether an element whose content is skipped is never ended: by no end tag, or a button or list by its next one first. never: names without end tag behind."""
    if name in never:
        return True
    pattern = _NEXT.get(name) or _NEXT.setdefault(name, re.compile(rf"<(/?){name}(?=[\s/>]|\Z)" if name in ("button", "select") else rf"<(/){name}(?=[\s/>]|\Z)", re.I))
    found = pattern.search(page, at)
    if not found:
        never.add(name)
    return not (found and found.group(1))


_NEXT: dict[str, re.Pattern] = {}


def _tokens(page: str, mains: frozenset[str]) -> Iterator[tuple[str, str, str, tuple, bool, bool]]:
    stack: list[tuple[str, str, bool, tuple]] = []  # name, kind (own or inherited), in main, features (own and inherited)
    at, broken, skip, m = 0, True, "", None
    left_open, within, never = False, [], set()  # of what is skipped: whether it has no end tag, and the names open in it
    while m := _TOKEN.search(page, at):
        if m.start() > at and not skip:
            yield (*_place(page[at : m.start()], stack), broken)
            broken = False
        at = m.end()
        name = (m.group(2) or "").lower()
        if not name:
            continue
        if name in _ENDS and not m.group(1) and skip not in ("svg", "math"):
            # Tags inside are text: go on at the element's own end tag.
            end = _ENDS[name].search(page, at)
            at = end.start() if end else len(page)
        if skip == "head" and not (name in HEAD or (m.group(1) and name == "html")):
            skip = ""  # the head's end tag may be left out
        if skip and skip != "head" and skip not in _ENDS:
            # It ends at its own end tag, at the end of an element around it, and without an end tag at a block too.
            if m.group(1):
                if name in within:
                    while within.pop() != name:
                        pass
                    continue
                if name == skip:
                    skip = ""
                    continue
                if not any(name == x for x, *_ in stack):
                    continue
                skip = ""
            elif left_open and name in BLOCKS and name != "option":
                skip = ""
            else:
                if name not in VOID and name not in _ENDS and not m.group(3).rstrip().endswith("/"):
                    within.append(name)
                continue
        if skip:
            if m.group(1) and name == skip:
                skip = ""
            continue
        if name in RAW and not m.group(1):
            if name in _ENDS or not m.group(3).rstrip().endswith("/"):
                skip = name  # its content isn't read; go on at its own end
                left_open, within = name not in _ENDS and _open(page, name, at, never), []
            continue
        broken = broken or name in BLOCKS
        inside = bool(stack) and stack[-1][2]
        yield "", name, stack[-1][1] if stack else "", (), inside, broken
        if m.group(1):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
        elif name not in VOID and not m.group(3).rstrip().endswith("/"):
            if name in BLOCKS:
                # A new block ends an open paragraph, and an item the one before it.
                while stack and (stack[-1][0] not in BLOCKS or stack[-1][0] == "p" or (stack[-1][0] == name and name in ("li", "dt", "dd", "tr", "td", "th", "option"))):
                    stack.pop()
            own, found = marks(name, m.group(3))
            _, kind, inner, more = stack[-1] if stack else ("", "", False, ())
            if own == "header" and inner:
                own = ""  # the heading of the article itself
            stack.append((name, kind or own, inner or name in mains, tuple(sorted({*more, *found})) if found else more))
    if at < len(page) and not skip:
        yield (*_place(page[at:], stack), broken)


def _place(text: str, stack: list) -> tuple[str, str, str, tuple, bool]:
    if not stack:
        return text, "", "", (), False
    _, kind, inside, found = stack[-1]
    linked = False
    for name, *_ in reversed(stack):
        linked = linked or name == "a"
        if name in BLOCKS:
            return text, name + "/a" * linked, kind, found, inside
    return text, "/a" * linked, kind, found, inside


def _named(own: list) -> bool:
    """Whether a page has an element that names its main text."""
    return any(not text and block in MAIN for text, block, *_ in own)


def count(pages: list[str]) -> Counter:
    """On labelled pages: how many words (by block, by kind of furniture, by feature) and tags (by name) are in the main text and outside."""
    out: Counter = Counter()
    for page in pages:
        own = tokens(page or "")
        if not _named(own):
            continue
        for text, block, kind, found, inside, _ in own:
            if text:
                n = len(text.split())
                if kind:
                    out["kind", kind, inside] += n
                else:
                    out["word", block, inside] += n
                for f in found:
                    out["feature", str(f), inside] += n
            else:
                out["tag", block, inside and not kind] += 1
    return out


def weights(counts: dict) -> dict:
    """(what, which) -> log odds, bounded; tags are held below zero."""
    out = {}
    for key in {k[:2] for k in counts}:
        least = 4.0 if key[0] == "feature" else 0.5
        odds = math.log((counts.get((*key, True), 0) + least) / (counts.get((*key, False), 0) + least))
        odds = max(-MOST, min(MOST, odds))
        out[key] = min(odds, -0.1) / 4 if key[0] == "tag" else odds
    return out


def _block_weight(weight: dict, block: str) -> float:
    known = weight.get(("word", block))
    if known is not None:
        return known
    return -1.0 if block.endswith("/a") else {"": -0.5, "div": 0.5, "body": -0.5, "html": -0.5}.get(block, 1.0)


def _kind_weight(weight: dict, kind: str) -> float:
    """What a kind of furniture adds to its block's weight."""
    return PRIOR.get(kind, -6.0) + max(-RAISE, min(RAISE, weight.get(("kind", kind), 0.0)))


def stays(weight: dict, token: tuple, named: bool) -> bool:
    """Whether a word of the best run is part of the text."""
    _, block, kind, _, inside, _ = token
    return (inside or not named) and (not kind or max(0.5, _block_weight(weight, block)) + _kind_weight(weight, kind) >= 0)


def _gain(weight: dict, token: tuple, named: bool) -> float:
    """A token's score. named: whether the page names its main text."""
    text, block, kind, found, inside, _ = token
    if not text:
        return -0.02 if named else min(-0.02, weight.get(("tag", block), -0.1))
    n, base = len(text.split()), _block_weight(weight, block)
    if named and not inside:
        return max(-0.5 * n, -1.0) if kind else -0.5 * n
    if kind and not stays(weight, token, named):
        return -0.02 if named else max(n * (base + _kind_weight(weight, kind)), -1.0)  # what a piece of furniture takes is bounded: text may go on behind it
    if named:
        return n * max(0.5, base)
    return n * (base + max(-SHIFT, min(SHIFT, sum(weight.get(("feature", str(f)), 0.0) for f in found) + (0.0 if _DOUBTED.isdisjoint(found) else DOUBT))))


def best_run(gains: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run of greatest total above zero; (0, 0) if there is none."""
    best, total, start, held = 0.0, 0.0, 0, (0, 0)
    for i, gain in enumerate(gains):
        if total <= 0:
            total, start = 0.0, i
        total += gain
        if total > best:
            best, held = total, (start, i + 1)
    return held


def extract(page: str | None, weight: dict) -> str:
    """The main text of a page."""
    own = tokens(page or "")
    named = _named(own)
    start, end = best_run([_gain(weight, t, named) for t in own])
    blocks: list[list[str]] = []
    broken = True
    for token in own[start:end]:
        broken = broken or token[-1]
        if token[0] and stays(weight, token, named):
            if broken or not blocks:
                blocks.append([])
            blocks[-1].append(entities.unescape(token[0]))
            broken = False
    return " ".join(x for own in blocks if (x := " ".join("".join(own).split())))


_COUNTS = "what string, which string, inside boolean, n bigint"


def _count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter = Counter()
    for batch in shared.batches(rows):
        total += count(batch.column("html").to_pylist())
    keys = sorted(total)
    columns = [pa.array([k[i] for k in keys], pa.bool_() if i == 2 else pa.string()) for i in range(3)]
    yield pa.RecordBatch.from_arrays([*columns, pa.array([total[k] for k in keys], pa.int64())], names=["what", "which", "inside", "n"])


def learn(pages: DataFrame) -> dict:
    """Weights from all labelled pages. Rows sent to the driver: two for each element name, kind of furniture and feature; unknown element names count as one."""
    name = F.regexp_replace("which", "/a$", "")
    known = ~F.col("what").isin("word", "tag") | name.isin(*sorted(BLOCKS | VOID | {"a", "b", "i", "em", "strong", "span", "u", "s", "small", "sub", "sup", "code", "font", "label", "q", "cite", "abbr", "time", "mark", ""}))
    found = pages.select(F.col("html").cast("string").alias("html")).mapInArrow(_count, _COUNTS)
    sums = found.groupBy("what", F.when(known, F.col("which")).otherwise(F.lit("?")).alias("which"), "inside").agg(F.sum("n").alias("n")).collect()
    return weights({(r["what"], r["which"], r["inside"]): r["n"] for r in sums})


def texts(spark: SparkSession, pages: DataFrame, weight: dict) -> DataFrame:
    """Per page: page_id, url, text, n_chars (code points)."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shared.batches(rows):
            own = [extract(x, weight) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(own, pa.string()), pa.array([len(x) for x in own], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = shared.table(spark, sf_dir, "pages")
    return texts(spark, pages, learn(pages))
