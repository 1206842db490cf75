"""Ranked lexical search over bit-sliced Bloom signatures, exact for every query.

The index is made once, without a look at any query.  Each task deals its documents, by the number
of keys they have, to blocks of similar ones; a key is a term together with one of the frequencies
``LEVELS`` that it reaches in the document.  A block holds a matrix of bits: a column per document, and
rows of which each key sets two.  It is stored by row, so the two rows of a key together tell, for all
documents of the block at once, which may hold it: all that do and some that do not.

A query needs for each of its terms the weight, from the counts of the block vocabularies, and then
for each level the sum of the weights over the rows of its terms.  Those sums, times what a term
gains in that document between one level and the next, bound the document's score from above.
Documents are scored exactly, from their texts in the same block, in the order of their bounds until
the bound falls below the k-th best score so far; every document left out is proved to be out.  One in
``FIRST`` blocks goes first; the k-th best scores found there start the search of the others, which
hand on only what reaches them.

Queries go through in blocks of about ``ITEM_CHARS`` characters, which is all that a task is given of
them; a block of documents is bounded in documents, text and bits, but for a longer single text.

Defined cases: null or empty texts hold no term, are not ranked and do not count in N; a null doc_id
is ranked like others, behind equal scores with an id; repeated rows are documents each, and give
their rows with ranks of their own; an item given twice is asked once, different texts of one item
id are ranked each by itself; null item ids are items; items without terms, or an empty table, give
no rows.  Texts are read whole however long.  Only the named columns are read, whatever others are called.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crestline.llm.common import materialize, read_table, small_batches
from crestline.llm.spans import mix64

K = 20
# Maximal runs of anything but ASCII other than letters and digits; in UTF-8 all other characters
# are bytes from 0x80.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
LEVELS = (1, 2, 3, 5, 9)
ROWS_PER_KEY = 16
BLOCK_DOCS = 4_096
BLOCK_BYTES = 4 << 20
BLOCK_BITS = 1 << 25
FIRST = 16
ITEM_CHARS = 200_000
INDEX_ROWS = 4  # blocks per Arrow batch
_STEP, _M = 0x9E3779B97F4A7C15, (1 << 64) - 1

INDEX = "number long, docs int, rows int, ids array<long>, sizes array<long>, bits binary, ends array<int>, texts binary, terms binary, df array<int>"


def terms_of(text: str | bytes | None) -> list[bytes]:
    """Terms of a text in turn, only A-Z lower-cased."""
    raw = text if isinstance(text, bytes) else (text or "").encode("utf-8", "surrogatepass")
    return TERM.findall(raw.lower())


class _Hashes(dict):
    """Hashes of terms, remembered while there are not too many."""

    def __missing__(self, term: bytes) -> int:
        if len(self) > 1 << 18:
            self.clear()
        self[term] = h = int.from_bytes(hashlib.blake2b(term, digest_size=8).digest(), "little")
        return h


def level_keys(hashes: np.ndarray, level: int) -> np.ndarray:
    return mix64(hashes + np.uint64((level + 1) * _STEP & _M))


def row_pair(keys: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The two rows of each key; ``rows`` is a power of two."""
    mask = np.uint64(rows - 1)
    return (keys & mask).astype(np.int64), ((keys >> np.uint64(32)) & mask).astype(np.int64)


def _saturated(tf: int | np.ndarray, m) -> int | np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def _length(n: int, docs: int, total: int) -> int:
    return 100 - 25 + (25 * n * docs) // total


class _Class:
    """Documents of one task whose number of keys has the same power of two."""

    def __init__(self, rows: int, most: int = BLOCK_DOCS):
        self.rows, self.most, self.bytes = rows, min(most, max(1, BLOCK_BITS // rows)), 0
        self.ids, self.sizes, self.texts, self.keys = [], [], [], []
        self.df: Counter = Counter()

    def full(self) -> bool:
        return len(self.ids) >= self.most or self.bytes >= BLOCK_BYTES

    def add(self, doc_id, size: int, text: bytes, keys: np.ndarray, terms: list[bytes]) -> None:
        self.ids.append(doc_id)
        self.sizes.append(size)
        self.texts.append(text)
        self.keys.append(keys)
        self.df.update(terms)
        self.bytes += len(text)

    def row(self, number: int) -> pa.RecordBatch:
        docs = len(self.ids)
        bits = np.zeros((self.rows, docs), bool)
        for d, keys in enumerate(self.keys):
            for rows in row_pair(keys, self.rows):
                bits[rows, d] = True
        values = [
            number, docs, self.rows, self.ids, self.sizes, np.packbits(bits, axis=1).tobytes(),
            np.cumsum([len(t) for t in self.texts]).tolist(), zlib.compress(b"".join(self.texts), 1),
            b" ".join(self.df), list(self.df.values()),
        ]
        types = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(),
                 pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.list_(pa.int32())]
        names = [c.split()[0] for c in INDEX.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=names)


def index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Blocks of all documents that hold a term, as in ``INDEX``."""
    small_batches(docs.sparkSession)
    most = BLOCK_DOCS

    def build(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        hashes, classes = _Hashes(), {}
        for b in batches:
            for doc_id, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                raw = (t or "").encode("utf-8", "surrogatepass").lower()
                words = TERM.findall(raw)
                if not words:
                    continue
                counts = Counter(words)
                own = np.fromiter(map(hashes.__getitem__, counts), np.uint64, len(counts))
                often = np.fromiter(counts.values(), np.int64, len(counts))
                keys = np.concatenate([level_keys(own[often >= at], i) for i, at in enumerate(LEVELS)])
                power = max(len(keys) - 1, 1).bit_length()
                block = classes.setdefault(power, _Class(ROWS_PER_KEY << power, most))
                block.add(doc_id, len(words), raw, keys, list(counts))
                if block.full():
                    yield classes.pop(power).row(number)
                    number += 1
                elif sum(c.bytes for c in classes.values()) > 4 * BLOCK_BYTES:
                    largest = max(classes, key=lambda p: classes[p].bytes)
                    yield classes.pop(largest).row(number)
                    number += 1
        for block in classes.values():
            yield block.row(number)
            number += 1

    named = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).where("text is not null")
    return materialize(named.mapInArrow(build, INDEX), "lexical-index")


@contextmanager
def _few_blocks_a_batch(spark: SparkSession):
    """Rows of the index are large: what runs in here gets few of them at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(INDEX_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def item_blocks(items: DataFrame, item: str, text: str) -> Iterator[list[tuple]]:
    """Distinct (item id, text) in blocks of bounded volume."""
    named = items.select(F.col(item).cast("long").alias("item_id"), F.col(text).alias("text")).where("text is not null")
    named = materialize(named.distinct(), "lexical-items")
    chars = named.agg(F.sum(F.length("text"))).first()[0] or 0
    count = 1 + chars // ITEM_CHARS
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for i in range(count):
        rows = [(r.item_id, r.text) for r in named.where(part == i).collect()]
        yield sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def document_counts(blocks: DataFrame, wanted: set[bytes]) -> dict[bytes, int]:
    """How many documents hold each wanted term, from the vocabularies of the blocks."""

    def count(batches):
        found: Counter = Counter()
        for b in batches:
            for terms, df in zip(b.column("terms").to_pylist(), b.column("df")):
                for term, n in zip(terms.split(b" "), df.values.to_numpy().tolist()):
                    if term in wanted:
                        found[term] += n
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["term", "n"])

    counted = blocks.select("terms", "df").mapInArrow(count, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {bytes(r.term): r.n for r in counted.collect()}


class Queries:
    """Items of one block with the weights of their terms, ready for all blocks of documents."""

    def __init__(self, items: list[list[bytes]], df: dict[bytes, int], docs: int, total: int, k: int):
        self.docs, self.total, self.k = docs, total, k
        found = {t for words in items for t in words if t in df}
        self.terms = sorted(found)
        number = {t: i for i, t in enumerate(self.terms)}
        hashes = _Hashes()
        own = np.array([hashes[t] for t in self.terms], np.uint64)
        self.keys = [level_keys(own, i) for i in range(len(LEVELS))]
        weight = [math.floor(1000 * math.log((2 * docs + 2) / (2 * df[t] + 1))) for t in self.terms]
        self.items = []
        for words in items:
            of = Counter(number[t] for t in words if t in found)
            self.items.append([(t, weight[t] * n) for t, n in sorted(of.items()) if weight[t]])

    def search(self, sizes: list[int], ids: list, bits: np.ndarray, text_of, least: list[int]) -> Iterator[tuple]:
        """(item, id, score) of the k best documents of a block that reach the item's least score."""
        docs, rows = len(ids), len(bits)
        m = np.array([_length(n, self.docs, self.total) for n in sizes], np.int64)
        # The most a term gives at each level: just before the next one, or in the whole text.
        upper = [np.full(docs, at - 1, np.int64) for at in LEVELS[1:]] + [np.array(sizes, np.int64)]
        most = [_saturated(np.minimum(u, 10**9), m).astype(np.float64) for u in upper]
        gain = [most[0]] + [np.maximum(b - a, 0) for a, b in zip(most, most[1:])]
        maybe = []
        for keys in self.keys:
            one, two = row_pair(keys, rows)
            maybe.append(bits[one] & bits[two])
        wanted, counted = set(self.terms), {}
        for q, terms in enumerate(self.items):
            if not terms:
                continue
            at = np.array([t for t, _ in terms])
            weights = np.array([w for _, w in terms], np.float64)
            bound = np.zeros(docs)
            for level in range(len(LEVELS)):
                packed = maybe[level][at]
                some = packed.any(1)
                if some.any():
                    bound += gain[level] * (weights[some] @ np.unpackbits(packed[some], axis=1, count=docs))
            bound = bound * (1 + 1e-9) + 1
            order = np.flatnonzero(bound >= max(least[q], 1))
            order = order[np.argsort(-bound[order], kind="stable")]
            best: list[tuple] = []
            floor = max(least[q], 1)
            for start in range(0, len(order), 32):
                part = order[start : start + 32].tolist()
                if bound[part[0]] < floor:
                    break
                for d in part:
                    if bound[d] < floor:
                        break
                    tf = counted.get(d)
                    if tf is None:
                        tf = counted[d] = {t: n for t, n in Counter(terms_of(text_of(d))).items() if t in wanted}
                    score, own = 0, int(m[d])
                    for t, w in terms:
                        n = tf.get(self.terms[t])
                        if n:
                            score += w * _saturated(n, own)
                    if score >= floor:
                        best.append((-score, ids[d] is None, ids[d] or 0, d))
                best = sorted(best)[: self.k]
                if len(best) == self.k:
                    floor = max(floor, -best[-1][0])
            for score, _, _, d in best:
                yield q, ids[d], -score

    def over(self, blocks: DataFrame, least: list[int]) -> DataFrame:
        """``search`` of all blocks, written: (q, doc_id, score)."""
        shared = blocks.sparkSession.sparkContext.broadcast((self, least))

        def run(batches):
            queries, least = shared.value
            for b in batches:
                for row in b.to_pylist():
                    bits = np.frombuffer(row["bits"], np.uint8).reshape(row["rows"], -1)
                    ends = [0, *row["ends"]]
                    texts = zlib.decompress(row["texts"])
                    got = list(queries.search(row["sizes"], row["ids"], bits, lambda d: texts[ends[d] : ends[d + 1]], least))
                    if got:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*got)], names=["q", "doc_id", "score"])

        columns = ["docs", "rows", "ids", "sizes", "bits", "ends", "texts"]
        with _few_blocks_a_batch(blocks.sparkSession):
            return materialize(blocks.select(*columns).mapInArrow(run, "q long, doc_id long, score long"), "lexical-found")


def _best(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def search(
    docs: DataFrame, items: DataFrame, *, k: int = K, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item."""
    spark = docs.sparkSession
    blocks = index(docs, key, text)
    n, total = blocks.agg(F.sum("docs"), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    first = F.pmod(F.xxhash64("number"), F.lit(FIRST)) == 0
    for rows in item_blocks(items, item, item_text) if n else []:
        words = [terms_of(t) for _, t in rows]
        with _few_blocks_a_batch(spark):
            df = document_counts(blocks, {t for w in words for t in w})
        queries = Queries(words, df, n, total, k)
        some = queries.over(blocks.where(first), [0] * len(rows))
        least = [0] * len(rows)
        for r in _best(some, k).where(F.col("rank") == k).select("q", "score").collect():
            least[r.q] = r.score
        rest = queries.over(blocks.where(~first), least)
        named = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "q long, item_id long")
        best = _best(some.unionByName(rest), k)
        out = out.unionByName(best.join(F.broadcast(named), "q").select("item_id", "rank", "doc_id", "score"))
    return out


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
LEXICAL_SQL = f"""
WITH words AS (
  SELECT r, doc_id, unnest({_TERMS}) AS t FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)
), tf AS (
  SELECT r, any_value(doc_id) AS doc_id, t, count(*) AS tf FROM words GROUP BY r, t
), sizes AS (
  SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY r
), whole AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes
), weights AS (
  SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, whole GROUP BY t, docs
), items AS (
  SELECT row_number() OVER () AS q, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)
), asked AS (
  SELECT q, any_value(item_id) AS item_id, t, count(*) AS c
  FROM (SELECT q, item_id, unnest({_TERMS}) AS t FROM items) GROUP BY q, t
), lengths AS (
  SELECT r, 100 - 25 + ((25 * n * docs) // total) AS m FROM sizes, whole
), scored AS (
  SELECT q, any_value(item_id) AS item_id, any_value(doc_id) AS doc_id,
         CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN tf USING (t) JOIN weights USING (t) JOIN lengths USING (r)
  GROUP BY q, r
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= {K}"""
