"""Benchmark decontamination by edit distance, found through pigeonholed pieces.

A test item of m characters may differ from a passage of a document by k = rate * m edits.  Cut
into k + 1 pieces, an item within that distance of a passage has a piece left unharmed in it.
All pieces of a block of items are found in one walk over a text (Aho-Corasick); around each
hit the item is verified against the text by Myers' bit-parallel distance.  Nothing else is
looked at and nothing within the budget is missed.

Text and items are compared in lower case, with everything but letters and digits as one blank.

Items are taken in blocks of bounded volume, one pass over the documents each; the pieces of one
block are all that is sent to the tasks.  Documents are neither shuffled nor joined.

Defined cases: null or empty texts match nothing; null or empty items, or items without letters
and digits, match nothing; items with equal text are each reported; an item shorter than
1 / rate characters must match exactly; repeated documents each give their rows; an item repeated
with its id, as normalised, counts once.

Texts are read whole, however long; only the named columns are read, whatever others are called.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crestline.llm.common import materialize, read_table, small_batches

RATE = 0.08
BLOCK_CHARS = 2_000_000
_OTHER = re.compile(r"[\W_]+")


def normalised(text: str | None) -> str:
    return _OTHER.sub(" ", (text or "").lower()).strip()


def cut(item: str, errors: int) -> list[tuple[int, str]]:
    """The item in errors + 1 pieces of nearly equal length, with their places."""
    at = [len(item) * j // (errors + 1) for j in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(at, at[1:])]


def myers(letters: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Least edit distance of a pattern to any passage of a text, and where that passage ends.

    ``letters`` has a bit for each place of a letter in the pattern of m letters.
    """
    mask, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = mask, 0, m
    best, end = m, 0
    get = letters.get
    for i, c in enumerate(text, 1):
        eq = get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(xh | plus) & mask
        down = plus & xh
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = up << 1 & mask, down << 1 & mask
        plus = down | ~(xv | up) & mask
        minus = up & xv
        if score < best:
            best, end = score, i
    return best, end


class Matcher:
    """The items of one block, ready to be looked for."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.items = [(i, t, int(rate * len(t))) for i, t in items]
        self.letters: dict[int, dict[str, int]] = {}
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for n, (_, text, errors) in enumerate(self.items):
            for at, piece in cut(text, errors):
                places[piece].append((n, at))
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, (len(piece), found))
        if places:
            self.automaton.make_automaton()
        self.empty = not places

    def _letters(self, n: int) -> dict[str, int]:
        made = self.letters.get(n)
        if made is None:
            made = self.letters[n] = {}
            for i, c in enumerate(self.items[n][1]):
                made[c] = made.get(c, 0) | 1 << i
        return made

    def find(self, raw: str | None) -> list[tuple[int, int, int]]:
        """Item ids in a text with their distance and the end of the nearest passage."""
        text = normalised(raw)
        if self.empty or not text:
            return []
        windows: dict[int, list[list[int]]] = defaultdict(list)
        for end, (length, found) in self.automaton.iter(text):
            for n, at in found:
                _, item, errors = self.items[n]
                begin = end - length + 1 - at
                a, b = max(0, begin - errors), begin + len(item) + errors
                own = windows[n]
                # Hits come by their end; windows of one item are cut by the place of the piece.
                if own and a <= own[-1][1] and b >= own[-1][0]:
                    own[-1][0], own[-1][1] = min(a, own[-1][0]), max(b, own[-1][1])
                else:
                    own.append([a, b])
        out = []
        for n, own in windows.items():
            key, item, errors = self.items[n]
            best = None
            for a, b in own:
                part = text[a:b]
                at = part.find(item)
                got = (0, a + at + len(item)) if at >= 0 else None
                if got is None:
                    d, e = myers(self._letters(n), len(item), part)
                    got = (d, a + e) if d <= errors else None
                if got and (best is None or got < best):
                    best = got
            if best:
                out.append((key, *best))
        return sorted(out)


def _blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple[int, str]]]:
    """Items by blocks of about BLOCK_CHARS characters, so what the driver holds is bounded."""
    spark = benchmark.sparkSession
    small_batches(spark)

    def normal(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([normalised(t) for t in b.column(1).to_pylist()], pa.string())], names=["i", "t"])

    named = benchmark.select(F.col(item).cast("long").alias("i"), F.col(text).alias("t")).where("i is not null and t is not null")
    # Repeats of an item would all fall into one block.
    named = materialize(named.mapInArrow(normal, "i long, t string").where("t <> ''").distinct(), "decontam-items")
    volume = named.agg(F.sum(F.length("t"))).first()[0] or 0
    count = -(-volume // BLOCK_CHARS)
    for b in range(count):
        rows = named.where(F.pmod(F.xxhash64("i", "t"), F.lit(count)) == b).collect()
        yield sorted((r.i, r.t) for r in rows)


def matches(
    docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", rate: float = RATE,
) -> DataFrame:
    """doc_id, item_id, distance, budget, end: every item within its budget, once a document."""
    spark = docs.sparkSession
    small_batches(spark)
    schema = "doc_id long, item_id long, distance int, budget int, passage_end long"
    found = spark.createDataFrame([], schema)
    named = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    for items in _blocks(benchmark, item, item_text):
        shared = spark.sparkContext.broadcast(items)

        def scan(batches, shared=shared):
            matcher = Matcher(shared.value, rate)
            budget = {i: k for i, _, k in matcher.items}
            for b in batches:
                rows = [
                    (d, i, n, budget[i], e)
                    for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                    for i, n, e in matcher.find(t)
                ]
                cols = list(zip(*rows)) if rows else [[]] * 5
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
                names = ["doc_id", "item_id", "distance", "budget", "passage_end"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

        found = found.unionByName(named.mapInArrow(scan, schema))
    return found


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id",
    item_text: str = "text", rate: float = RATE,
) -> DataFrame:
    """Documents without any item, whole rows as they are."""
    spark = docs.sparkSession
    small_batches(spark)
    at = docs.columns.index(text)
    for items in _blocks(benchmark, item, item_text):
        shared = spark.sparkContext.broadcast(items)

        def scan(batches, shared=shared):
            matcher = Matcher(shared.value, rate)
            for b in batches:
                yield b.filter(pa.array([not matcher.find(t) for t in b.column(at).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(scan, docs.schema)
    return docs


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return matches(docs, read_table(spark, sf_dir, "benchmark"))
