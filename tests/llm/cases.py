"""Small tables with the cases every operator must stand: nulls, empty and long texts, ties, repeats, extra columns."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("aeiou") + r.choice("bcdfgklmnprst") for _ in range(r.randint(1, 3))) for _ in range(words))


def rows() -> list[tuple]:
    base = prose(1, 120)
    words = base.split()
    near = " ".join([*words[:60], "changed", *words[61:]])
    out = [
        (1, base, "en", "a", None),
        (2, near, "en", "a", 3),
        (3, base, None, "b", 3),
        (4, None, "en", None, None),
        (5, "", "en", "b", 0),
        (6, " \t\n ", "de", "b", 4),
        (7, "one", "de", "c", 3),
        (8, "One two", "de", "c", 7),
        (9, prose(2, 9000), "fr", "c", 0),
        (10, prose(3, 300) + "\n" + base, "fr", "a", 0),
        (11, "é" * 120, "fr", "a", 120),
        (12, "é" * 121 + "ñ", "fr", "a", 122),
        (13, base, "en", "a", 1),
    ]
    return out + [(100 + i, prose(100 + i, 30 + i), "en", "abc"[i % 3], 0) for i in range(20)]


def docs(spark, extra: bool = False):
    df = spark.createDataFrame(rows(), DOCS)
    if extra:
        for name in ("size", "target", "copies", "score", "host", "shard", "node", "n", "h", "block", "bucket", "rank"):
            df = df.withColumn(name, df["lang"])
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)


def repeated(spark):
    """Rows that repeat id and text, and rows that repeat the id alone."""
    return spark.createDataFrame([*rows(), (1, prose(1, 120), "en", "a", None), (7, "another", "de", "c", 7), (None, prose(50, 40), None, None, None)], DOCS)
