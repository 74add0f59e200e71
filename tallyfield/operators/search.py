"""Species search: tokens without case and marks, found by prefix.

`index` has a row for each token. `blocks` is its stored form: posting lists by whole token (kind 0) and by the first 2, 3
and 4 letters (kinds 2 to 4), cut by the identifiers' range so that a list never grows beyond a block, and coded as small offsets from the block's first number.
A word of a query reads the blocks of its own prefix.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.folding import BETWEEN, fold, fold_text

FIELDS = ("name", "sci_name", "search_codes")
#: Prefixes that have lists of their own; a block holds identifiers that agree above so many bits.
PREFIXES, BLOCK_BITS = (2, 3, 4), 12


def tokens(c: Column) -> Column:
    return F.filter(F.split(fold(c), BETWEEN), lambda t: t != "")


def index(species: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """species_id, field, token: distinct, sorted by token when stored, so a prefix reads few row groups."""
    each = [species.select(F.col("id").alias("species_id"), F.lit(f).alias("field"), F.explode(tokens(F.col(f))).alias("token")) for f in fields]
    out = each[0]
    for e in each[1:]:
        out = out.unionByName(e)
    return out.distinct()


def words_of(query: str) -> list[str]:
    """Distinct folded words, in order."""
    return list(dict.fromkeys(w for w in re.split(r"[\W_]+", fold_text(query)) if w))


def _all_words(hits: DataFrame, n: int) -> DataFrame:
    """species_id of those that every one of n words hit. hits: species_id, k."""
    mask = F.expr("bit_or(shiftleft(1L, k))")
    return hits.groupBy("species_id").agg(mask.alias("mask")).filter(F.col("mask") == (1 << n) - 1).select("species_id")


def search(fts: DataFrame, query: str) -> DataFrame:
    """species_id of those where every word of the query begins a token."""
    words = words_of(query)
    if not words:
        return fts.select("species_id").limit(0)
    k = F.array(*[F.when(F.col("token").startswith(w), F.lit(i)) for i, w in enumerate(words)])
    return _all_words(fts.select("species_id", F.explode(F.array_compact(k)).alias("k")), len(words))


def blocks(fts: DataFrame) -> DataFrame:
    """kind, key, block, offsets: the posting lists of an index, ranged and sorted by kind and key."""
    keys = [F.struct(F.lit(0).alias("kind"), F.col("token").alias("key"))]
    keys += [F.when(F.length("token") >= n, F.struct(F.lit(n).alias("kind"), F.substring("token", 1, n).alias("key"))) for n in PREFIXES]
    each = fts.select("species_id", F.explode(F.array_compact(F.array(*keys))).alias("x")).select("x.*", F.shiftright("species_id", BLOCK_BITS).alias("block"), F.col("species_id").bitwiseAND((1 << BLOCK_BITS) - 1).cast("smallint").alias("offset"))
    lists = each.groupBy("kind", "key", "block").agg(F.array_sort(F.collect_set("offset")).alias("offsets"))
    return lists.repartitionByRange("kind", "key", "block").sortWithinPartitions("kind", "key", "block")


def _reads(word: str) -> Column:
    """The blocks of a prefix: one key where there is a list for its length, else a range of keys."""
    n, kind, key = len(word), F.col("kind"), F.col("key")
    if n in PREFIXES:
        return (kind == n) & (key == word)
    whole = (kind == 0) & (key >= word) & key.startswith(word)
    return whole if n > max(PREFIXES) else ((kind == min(PREFIXES)) & key.startswith(word)) | ((kind == 0) & (key == word))


def find(stored: DataFrame, query: str) -> DataFrame:
    """The same as `search`, from stored blocks."""
    words = words_of(query)
    if not words:
        return stored.select(F.col("block").alias("species_id")).limit(0)
    hits = None
    for k, w in enumerate(words):
        own = stored.filter(_reads(w)).select(F.lit(k).alias("k"), "block", "offsets")
        hits = own if hits is None else hits.union(own)
    found = hits.select("k", "block", F.explode("offsets").alias("offset")).select((F.shiftleft("block", BLOCK_BITS) + F.col("offset")).alias("species_id"), "k")
    return _all_words(found, len(words))


def lookup(species: DataFrame) -> DataFrame:
    """Case-folded columns for equality look-ups."""
    return species.select("id", "code", "name", "sci_name", F.lower("sci_name").alias("sci_lower"), F.lower("name").alias("name_lower"), "taxon_order")
