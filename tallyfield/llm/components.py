"""Connected components of an edge list by alternating large and small stars.

Every node hooks onto the smallest node it knows, first its larger neighbours, then its smaller
ones, until each component is a star around its smallest node. A node's minimum is a partial
aggregate joined back; the neighbours of a node that has HUB of them are dealt over SALTS tasks. Each round is
stored in the shared folder.

Defined cases: an empty edge list gives no nodes; edges from a node to itself count for nothing, and repeated
edges, in either direction, count once; ties can't arise, as a node's number is its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Stage


#: Rows of one key from which they are dealt over SALTS tasks; most such keys that are broadcast (those with most rows; adaptive joins split the rest).
HUB, SALTS, HUBS = 256, 8, 1 << 17
#: Edges from which a round looks for hubs; the rows of fewer are few for one task.
SALT_FROM = 200_000


def salt(column: str) -> Column:
    return F.pmod(F.xxhash64(column, F.lit(7)), F.lit(SALTS)).cast("int")


def salted(rows: DataFrame, hubs: DataFrame, key: str, by: str) -> DataFrame:
    """rows with a salt: of hubs' rows (hub) by the column named by, of others 0."""
    return rows.join(F.broadcast(hubs), F.col(key) == F.col("hub"), "left").withColumn("salt", F.when(F.col("hub").isNull(), F.lit(0)).otherwise(salt(by))).drop("hub")


def spread(rows: DataFrame, hot: Column) -> DataFrame:
    """A row for each salt where hot holds, else one of salt 0."""
    return rows.withColumn("salt", F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))


def back(rows: DataFrame, sums: DataFrame, key: str, by: str, many: bool = True) -> DataFrame:
    """Join rows with sums over their key, which hold the number n of its rows, by key and, if there are many, salt."""
    if not many:
        return rows.join(sums.drop("n"), key)
    hubs = sums.filter(F.col("n") >= HUB).orderBy(F.desc("n"), key).limit(HUBS).select(F.col(key).alias("hub"))
    return salted(rows, hubs, key, by).join(spread(sums, F.col("n") >= HUB).drop("n"), [key, "salt"]).drop("salt")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(stage: Stage, edges: DataFrame, name: str = "star") -> DataFrame:
    """edges: (u, v) bigint, any direction. -> (node, label): label is the smallest node of the component; only nodes with edges."""
    e = stage.write(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{name}0")
    before, k = _state(e), 0
    while before[0]:
        k += 1
        many = before[0] >= SALT_FROM
        # Large star: each node's larger neighbours hook onto the smallest of its neighbours and itself.
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
        large = back(both.filter("v > u"), least, "u", "v", many).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: each node and its smaller neighbours hook onto the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        hooked = back(large, least, "u", "v", many).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e2 = stage.write(hooked.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), f"{name}{k}")
        stage.drop(f"{name}{k - 1}")
        e, after = e2, _state(e2)
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
