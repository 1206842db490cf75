"""Language identification by nearest centroid over TF-IDF vectors of character n-grams.

A text becomes counts of its 1- to 3-grams of letters (words padded with blanks, lower case)
in ``DIM`` hashed places, weighted by log(1 + count) and inverse document frequency and scaled
to length one.  Each language is described by several centroids, found by spherical k-means
among its training documents; a text goes to the language of the centroid nearest by cosine.
A text farther from its centroid than all but a few of that centroid's own documents is marked
``rejected``.

The model is fitted on a bounded sample, at most ``SAMPLE`` documents per language: of each of
``SALTS`` parts that a hash deals a language into, those with the least hashes.  Its size is
languages x centroids x DIM floats.  Every text is then read whole.

Defined cases: text that is null or has no letter is ``und`` with score 0 and rejected; so is
every text if there is nothing to learn from; equal similarities go to the language first in
order; repeated rows and ids each give their row; labels that are null are not learned.

Texts are read whole, however long; only the named columns are read, whatever others are called.  Extra
columns that ``predict`` is given must not be called ``lang_pred``, ``score``, ``rejected`` or ``_text``.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crestline.llm.common import read_table, small_batches

DIM = 8_192
SAMPLE = 1_000
SALTS = 20
CENTROIDS = 4
ROUNDS = 12
REJECT_SHARE = 0.005
CHUNK = 1 << 20
UNKNOWN = "und"

_LETTER = 1
_kinds: dict[str, np.ndarray] = {}


def _folded(text: str) -> np.ndarray:
    """Lower-case letters of a text as code points, each run of anything else as one blank."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    table = _kinds.setdefault("letter", np.full(0x110000, 255, np.uint8))
    kind = table[code]
    if (kind == 255).any():
        for c in np.unique(code[kind == 255]).tolist():
            table[c] = unicodedata.category(chr(c))[0] in "LM"
        kind = table[code]
    code = np.where(kind == _LETTER, code, 32)
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] != 32) | (code[:-1] != 32)
    code = code[keep]
    return code[int(len(code) and code[0] == 32) : len(code) - int(len(code) > 1 and code[-1] == 32)]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def counts(text: str, dim: int = DIM) -> np.ndarray:
    """How often each hashed n-gram place is hit, over the whole text in bounded pieces."""
    out = np.zeros(dim, np.int64)
    with np.errstate(over="ignore"):
        for at in range(0, len(text), CHUNK):
            c = _folded(text[at : at + CHUNK]).astype(np.uint32)
            c = np.concatenate([[np.uint32(32)], c, [np.uint32(32)]]).astype(np.uint32)
            one = c * np.uint32(0x9E3779B1)
            two = one[:-1] ^ (c[1:] * np.uint32(0x85EBCA77) + np.uint32(1))
            three = two[:-1] ^ (c[2:] * np.uint32(0xC2B2AE3D) + np.uint32(2))
            for grams, seed in ((one, 0x27D4EB2F), (two, 0x165667B1), (three, 0x2C1B3C6D)):
                h = grams * np.uint32(seed)
                h ^= h >> np.uint32(15)
                h = h * np.uint32(0x2C1B3C6D)
                out += np.bincount(h >> np.uint32(19) if dim == 8192 else h % np.uint32(dim), minlength=dim)
    return out


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    idf: np.ndarray
    centroids: np.ndarray  # one row per centroid
    owner: np.ndarray  # language number of each centroid
    radius: np.ndarray  # least cosine that is not rejected

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        langs, scores, rejected = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
        for at in range(0, len(texts), 64):
            some = [i for i in range(at, min(at + 64, len(texts))) if has_letter(texts[i])]
            if not some or not len(self.centroids):
                continue
            x = weigh(np.stack([counts(texts[i], len(self.idf)) for i in some]), self.idf)
            cosine = np.clip(np.round(x @ self.centroids.T, 6), 0, 1)
            # Sorted by language, so the first of equals is the first in order.
            best = cosine.argmax(1)
            for i, b, row in zip(some, best.tolist(), cosine):
                langs[i], scores[i] = self.languages[self.owner[b]], float(row[b])
                rejected[i] = bool(row[b] < self.radius[b])
        return langs, scores, rejected


def weigh(raw: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (np.log1p(raw) * idf).astype(np.float32)
    length = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.maximum(length, 1e-12)


def cluster(x: np.ndarray, k: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from far-apart starting rows: centroids, and the cosine cut of each."""
    picked = [int((x @ x.mean(0)).argmax())]
    while len(picked) < min(k, len(x)):
        picked.append(int((x @ x[picked].T).max(1).argmin()))
    centre = x[picked]
    for _ in range(rounds):
        own = (x @ centre.T).argmax(1)
        sums = np.stack([x[own == j].sum(0) if (own == j).any() else centre[j] for j in range(len(centre))])
        centre = sums / np.maximum(np.sqrt((sums * sums).sum(1, keepdims=True)), 1e-12)
    near = x @ centre.T
    own = near.argmax(1)
    cut = [float(np.quantile(near[own == j, j], REJECT_SHARE)) if (own == j).any() else 0.0 for j in range(len(centre))]
    return centre, np.array(cut)


def fit(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "lang",
    sample: int = SAMPLE, centroids: int = CENTROIDS,
) -> Model:
    """Model from labelled documents: vectors and k-means run in tasks, one group a language."""
    spark = docs.sparkSession
    small_batches(spark)
    # A language may hold most rows: it is dealt into parts, each sampled by itself.
    mark = F.xxhash64("key", "text")
    least = Window.partitionBy("lang", F.pmod(mark, F.lit(SALTS))).orderBy(mark, "key", "text")
    chosen = (
        docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"), F.col(label).alias("lang"))
        .where("lang is not null and text is not null")
        .withColumn("n", F.row_number().over(least))
        .where(F.col("n") <= max(1, sample // SALTS))
        .select("lang", "text")
    )

    def vectors(batches):
        for b in batches:
            rows = [(g, counts(t)) for g, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if has_letter(t)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([g for g, _ in rows], pa.string()), pa.array([c.astype("<i8").tobytes() for _, c in rows], pa.binary())],
                names=["lang", "counts"],
            )

    def frequencies(batches):
        seen, n = np.zeros(DIM, np.int64), 0
        for b in batches:
            for c in b.column("counts").to_pylist():
                seen += np.frombuffer(c, "<i8") > 0
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([seen.tolist()], pa.list_(pa.int64()))], names=["n", "seen"])

    counted = chosen.mapInArrow(vectors, "lang string, counts binary").persist()
    try:
        parts = counted.mapInArrow(frequencies, "n long, seen array<long>").collect()
        n = sum(p.n for p in parts)
        seen = sum((np.array(p.seen) for p in parts), np.zeros(DIM))
        idf = np.log((n + 1) / (seen + 1)) + 1

        def describe(table: pa.Table) -> pa.Table:
            x = weigh(np.stack([np.frombuffer(c, "<i8") for c in sorted(table["counts"].to_pylist())]), idf)
            centre, cut = cluster(x, centroids)
            return pa.table({
                "lang": pa.array([table["lang"][0].as_py()] * len(cut), pa.string()),
                "cut": pa.array(cut, pa.float64()),
                "centre": pa.array([c.astype("<f4").tobytes() for c in centre], pa.binary()),
            })

        found = sorted(
            counted.groupBy("lang").applyInArrow(describe, "lang string, cut double, centre binary").collect(),
            key=lambda r: (r.lang, bytes(r.centre)),
        )
    finally:
        counted.unpersist()
    languages = tuple(sorted({r.lang for r in found}))
    return Model(
        languages, idf,
        np.stack([np.frombuffer(r.centre, "<f4") for r in found]) if found else np.zeros((0, DIM), np.float32),
        np.array([languages.index(r.lang) for r in found], np.int64),
        np.array([r.cut for r in found]),
    )


def predict(docs: DataFrame, model: Model, *, text: str = "text", extra: list[Column] | None = None) -> DataFrame:
    """The extra columns of every row with lang_pred, score and rejected."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    named = docs.select(*(extra or []), F.col(text).alias("_text"))
    kept = named.columns[:-1]

    def scan(batches):
        for b in batches:
            lang, score, rejected = shared.value.predict(b.column("_text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in kept], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                names=[*kept, "lang_pred", "score", "rejected"],
            )

    schema = ", ".join(f"`{n}` {t}" for n, t in named.dtypes[:-1])
    return named.mapInArrow(scan, f"{schema}{', ' if schema else ''}lang_pred string, score double, rejected boolean")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = fit(docs.where(~held_out))
    return predict(docs, model, extra=[F.col("doc_id"), held_out.alias("held_out")])
