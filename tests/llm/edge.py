"""A table of difficult documents: nulls, empty and long texts, repeats, clashing columns."""

from __future__ import annotations

import random

from pyspark.sql import types as T

NAMES = ["key", "node", "bucket", "text_id", "row", "spans", "_row", "_z", "_text", "size", "n", "bits", "_key"]
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(n, T.StringType()) for n in NAMES]
)


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    parts = ["th", "er", "an", "re", "ing", "ou", "ti", "on", "es", "ha"]
    return " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 4))) for _ in range(words))


def rows() -> list[tuple]:
    long = prose(1, 30_000)
    near = prose(2, 300)
    texts = [
        (1, None), (2, ""), (3, " \t\n\x0b "), (4, "word"), (5, long), (6, long), (7, near), (8, near + " more"),
        (9, near.replace(" ", "\n", 40)), (10, "x y z"), (10, "x y z"), (10, prose(3, 80)), (None, prose(4, 90)),
        (11, "1234 5678"), (12, "é漢字 " * 60), (13, near), (14, "  x Y z "), (15, prose(5, 3)),
    ]
    out = []
    for i, (d, t) in enumerate(texts):
        lang = [None, "en", "xx"][i % 3]
        source = [None, "a", "b", "é", ""][i % 5]
        out.append((d, t, lang, source, None if t is None else len(t), *[f"{n}{i}" for n in NAMES]))
    return out


def docs(spark, parts: int = 3):
    return spark.createDataFrame(rows(), SCHEMA).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
