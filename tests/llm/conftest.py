import random

import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"w{i % 977}" for i in range(40_000))


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, blanks, ties, repeated rows, a very long text, and columns with names that operators use inside."""
    rows = [(1, None, "a"), (2, "", "a"), (3, " \t\n", None), (4, "One two.", "b"), (5, "one TWO.", "b"), (5, "one TWO.", "b"), (5, "another text", "b"), (None, "one two.", None), (None, None, "a"), (6, LONG, "a"), (7, LONG.upper(), "c"), (8, "é " * 50, "ü"), (9, "!!! ###", "c")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    for c in ("row", "n", "cls", "label", "hash", "id", "c", "size", "key", "part", "keep", "digest", "run", "check", "mark", "target", "bucket", "word", "score", "held_out"):
        df = df.withColumn(c, F.lit("x"))
    return df.withColumn("lang", F.when(F.col("doc_id") > 3, "en"))


@pytest.fixture(scope="session")
def near(spark):
    """Texts in groups of near copies, and others."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(6, 80))]
        for _ in range(rng.randint(1, 9)):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((len(rows), " ".join(own)))
    rows += [(1000 + i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 7)))) for i in range(30)]
    return spark.createDataFrame(rows, "doc_id bigint, text string")
