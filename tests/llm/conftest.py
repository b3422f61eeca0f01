"""Small documents with every awkward case."""

from __future__ import annotations

import random

import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, n: int) -> str:
    """Invented words."""
    part = ["an", "th", "er", "on", "re", "is", "ou", "ka", "mi", "lo"]
    return " ".join("".join(rng.choices(part, k=rng.randint(1, 4))) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="session")
def awkward():
    """Rows: prose, copies, near copies, nulls in every column, empties, marks only, one very long text, repeated rows."""
    rng = random.Random(1)
    texts = [prose(rng, rng.randint(5, 120)) for _ in range(60)]
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts)]
    rows += [(100 + i, texts[i], "en", "s0", None) for i in range(8)]
    rows += [(120 + i, texts[20 + i] + " more", None, None, 0) for i in range(5)]
    rows += [(200, None, "en", "s1", None), (201, "", "en", None, 0), (202, " \n\t ", None, "s2", 3), (203, "*** !!!", "en", "s2", 7), (204, "Éa ñ ß 漢字", "de", "s1", 9)]
    rows += [(None, texts[3], "en", "s1", 1), (None, None, None, None, None), (205, prose(rng, 30_000), "en", "s0", 1)]
    rows += [rows[0], rows[0], rows[4]]
    return rows


@pytest.fixture(scope="session")
def documents(spark, awkward):
    """The rows with further columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(awkward, DOCUMENT)
    clash = ["size", "r", "d", "part", "fp", "text_hash", "_hash", "_id", "_n", "score", "draws", "shard", "slot", "y", "target", "_bucket", "quota"]
    return df.select("*", *[F.lit("x").alias(c) for c in clash]).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    """No documents."""
    return spark.createDataFrame([], DOCUMENT)
