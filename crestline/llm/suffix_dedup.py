"""Removal of every byte that lies in a string of ``LENGTH`` bytes occurring more than once.

Suffix sorting of a whole corpus is cut into shards that hold all suffixes which can share a
prefix of LENGTH bytes, and each shard is sorted by external induced sorting (``induced``).

* Every window of LENGTH bytes has an anchor: its leftmost ``GRAM``-byte string of least hash.
  Equal windows have equal anchors at equal places, so windows are dealt out by anchor.
  Neighbouring windows mostly share theirs; such a run of windows is one *context*.
* A context whose anchor string occurs only once in the corpus holds no repeated window.
* A context that occurs several times as a whole is repeated as a whole.
* The distinct contexts that share an anchor with a different one are brought together by anchor,
  and their suffixes sorted; a suffix with a common prefix of LENGTH with its neighbour is the
  start of a repeated window.

Repeated contexts collapse before they are shuffled, so that groups of copies cost one member;
texts are shuffled only where a bounded Bloom filter cannot rule them out.  Coverage is worked
out once for each distinct text.

Defined cases: null text is empty; texts shorter than LENGTH bytes keep all; a row repeated with
the same text removes that text (of LENGTH bytes or more) from all its rows; ids play no part.

Texts are read whole, however long; only the named columns are read, whatever others are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crestline.llm import bloom, induced
from crestline.llm.common import materialize, read_table, shuffle_partitions, small_batches
from crestline.llm.spans import span_hashes

LENGTH = induced.DEPTH
GRAM = 32
RUN_BYTES = 1 << 20
SEGMENT = 1 << 22
SHARD_BYTES = 4 << 20
_PLACE = np.uint64((1 << 24) - 1)
_CONTEXTS = "gram long, context long, text_id long, at long, size int"


def text_id(raw: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


def _raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _runs(raws: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """(text number, place, bytes) in runs of bounded volume.

    Long texts are cut into segments that overlap by LENGTH - 1, so every window is in one."""
    run, volume = [], 0
    for i, raw in enumerate(raws):
        if len(raw) < LENGTH:
            continue
        for at in range(0, len(raw) - LENGTH + 1, SEGMENT):
            part = raw[at : at + SEGMENT + LENGTH - 1]
            if run and volume + len(part) > RUN_BYTES:
                yield run
                run, volume = [], 0
            run.append((i, at, part))
            volume += len(part)
    if run:
        yield run


def _sliding_least(key: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours, from running minima of blocks both ways."""
    n = len(key) - width + 1
    blocks = -(-len(key) // width) * width
    padded = np.full(blocks, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(key)] = key
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def contexts(raws: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """Hash of the anchor string, hash of the context, text number, place and size of all contexts."""
    for run in _runs(raws):
        data = np.frombuffer(b"".join(p for _, _, p in run), np.uint8)
        ends = np.cumsum([len(p) for _, _, p in run])
        place = np.arange(len(data) - GRAM + 1)
        gram = span_hashes(data, place, place + GRAM)
        # Equal hashes in the leading bits: the place, in the trailing ones, makes it the leftmost.
        least = _sliding_least((gram & ~_PLACE) | place.astype(np.uint64), LENGTH - GRAM + 1)
        anchor = (least & _PLACE).astype(np.int64)
        inside = np.ones(len(anchor), bool)
        for e in ends[:-1].tolist():
            inside[max(e - LENGTH + 1, 0) : e] = False
        new = np.append(True, (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1]))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(anchor)) - 1
        first, last = first[inside[first]], last[inside[first]]
        stop = last + LENGTH
        which = np.searchsorted(ends, first, "right")
        begun = np.append(0, ends[:-1])[which]
        number = np.array([i for i, _, _ in run])[which]
        offset = np.array([a for _, a, _ in run])[which]
        yield (
            gram[anchor[first]].view(np.int64), span_hashes(data, first, stop, 1).view(np.int64),
            number, first - begun + offset, stop - first,
        )


def _all_contexts(docs: DataFrame) -> DataFrame:
    def make(batches):
        for b in batches:
            raws = [_raw(t) for t in b.column(0).to_pylist()]
            ids = np.array([text_id(r) for r in raws], np.int64)
            for gram, context, number, at, size in contexts(raws):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram), pa.array(context), pa.array(ids[number]), pa.array(at.astype(np.int64)), pa.array(size.astype(np.int32))],
                    names=["gram", "context", "text_id", "at", "size"],
                )

    return docs.mapInArrow(make, _CONTEXTS)


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """text_id and text of the distinct texts with the given ids."""
    shared = docs.sparkSession.sparkContext.broadcast(bloom.build(ids.select("text_id")))

    def pick(batches):
        for b in batches:
            texts = b.column(0).to_pylist()
            own = np.array([text_id(_raw(t)) for t in texts], np.int64)
            hit = bloom.maybe(shared.value, own) if len(own) else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[hit]), pa.array([t for t, h in zip(texts, hit.tolist()) if h], pa.string())], names=["text_id", "text"]
            )

    found = docs.mapInArrow(pick, "text_id long, text string")
    return found.groupBy("text_id").agg(F.first("text").alias("text"))


def _cut_out(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """gram, context and bytes of each wanted context, cut from the text that stands for it."""

    def cut(batches):
        for b in batches:
            gram, context, parts = [], [], []
            for text, some in zip(b.column("text").to_pylist(), b.column("some").to_pylist()):
                raw = _raw(text)
                for c in some:
                    gram.append(c["gram"])
                    context.append(c["context"])
                    parts.append(raw[c["at"] : c["at"] + c["size"]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram, pa.int64()), pa.array(context, pa.int64()), pa.array(parts, pa.binary())], names=["gram", "context", "part"]
            )

    grouped = wanted.groupBy("text_id").agg(F.collect_list(F.struct("gram", "context", "at", "size")).alias("some"))
    return texts.join(grouped, "text_id").select("text", "some").mapInArrow(cut, "gram long, context long, part binary")


def _bounds(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(flags.view(np.int8), prepend=0, append=0))
    return edge[0::2], edge[1::2]


def sort_shard(contexts_: list[int], parts: list[bytes]) -> tuple[list[int], list[int], list[int]]:
    """Of the contexts of one shard, the stretches covered by windows that occur elsewhere in it."""
    starts = np.cumsum([0, *(len(p) + 1 for p in parts)])
    t = induced.array(int(starts[-1]), np.uint16)
    for at, p in zip(starts.tolist(), parts):
        t[at : at + len(p)] = np.frombuffer(p, np.uint8)
        t[at : at + len(p)] += 1
        t[at + len(p)] = induced.SEPARATOR
    flags = induced.repeated(t)
    out: tuple[list[int], list[int], list[int]] = ([], [], [])
    for key, at, p in zip(contexts_, starts.tolist(), parts):
        own = flags[at : at + len(p) - LENGTH + 1]
        if own.any():
            for a, b in zip(*(x.tolist() for x in _bounds(own))):
                for column, value in zip(out, (key, a, b - 1 + LENGTH)):
                    column.append(value)
    return out


def _sorted_shards(cut: DataFrame) -> DataFrame:
    def sort(batches):
        keys, parts = [], []
        for b in batches:
            keys += b.column("context").to_pylist()
            parts += b.column("part").to_pylist()
        if parts:
            a, b, c = sort_shard(keys, parts)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, c)], names=["context", "a", "b"])

    return cut.mapInArrow(sort, "context long, a long, b long")


def _summary(texts: DataFrame, covered: DataFrame) -> DataFrame:
    """What is left of each text with covered stretches."""

    def strip(batches):
        for b in batches:
            removed, spans, kept = [], [], []
            for text, some in zip(b.column("text").to_pylist(), b.column("some").to_pylist()):
                raw, rest, at, gone, n = _raw(text), hashlib.sha256(), 0, 0, 0
                merged: list[list[int]] = []
                for a, e in sorted((x["a"], x["b"]) for x in some):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], e)
                    else:
                        merged.append([a, e])
                for a, e in merged:
                    rest.update(raw[at:a])
                    at, gone, n = e, gone + e - a, n + 1
                rest.update(raw[at:])
                removed.append(gone)
                spans.append(n)
                kept.append(rest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("text_id"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.string())],
                names=["text_id", "n_removed", "n_spans", "kept_sha256"],
            )

    # Adjacent or overlapping stretches of a text join; their number is bounded by its length.
    grouped = covered.groupBy("text_id").agg(F.collect_set(F.struct("a", "b")).alias("some"))
    return texts.join(grouped, "text_id").mapInArrow(strip, "text_id long, n_removed long, n_spans long, kept_sha256 string")


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    def read(batches):
        for b in batches:
            raws = [_raw(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([text_id(r) for r in raws], pa.int64()), pa.array([len(r) for r in raws], pa.int64()),
                 pa.array([hashlib.sha256(r).hexdigest() for r in raws], pa.string())],
                names=["key", "text_id", "n_bytes", "whole"],
            )

    named = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return named.mapInArrow(read, "key long, text_id long, n_bytes long, whole string")


def covered_stretches(docs: DataFrame) -> DataFrame:
    """text_id, a, b: stretches of distinct texts (column ``text``) that repeated windows cover."""
    spark = docs.sparkSession
    every = materialize(_all_contexts(docs), "suffix-contexts")
    # Written, so that joins with it can be split where one anchor has many rows.
    again = materialize(
        every.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram"), "suffix-again"
    )
    some = materialize(every.join(again, "gram"), "suffix-candidates")
    distinct = materialize(
        some.groupBy("gram", "context").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("text_id", "at", "size")).alias("one")),
        "suffix-distinct",
    )
    mixed = materialize(
        distinct.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("gram"), "suffix-mixed"
    )
    wanted = materialize(
        distinct.join(mixed, "gram").select("gram", "context", "one.text_id", "one.at", "one.size"), "suffix-wanted"
    )
    volume = wanted.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    shards = max(shuffle_partitions(spark), -(-volume // SHARD_BYTES))
    ids = wanted.select("text_id").distinct()
    cut = _cut_out(_texts_of(docs, ids), wanted)
    marks = materialize(_sorted_shards(cut.repartition(shards, "gram")), "suffix-marks")
    whole = distinct.where("n > 1").select("context", F.lit(0).cast("long").alias("a"), F.col("one.size").cast("long").alias("b"))
    stretches = whole.unionByName(marks)
    members = some.select("context", "text_id", "at").distinct()
    return members.join(stretches, "context").select(
        "text_id", (F.col("at") + F.col("a")).alias("a"), (F.col("at") + F.col("b")).alias("b")
    )


def remove_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(text).alias("text"))
    covered = materialize(covered_stretches(texts), "suffix-covered")
    found = _texts_of(texts, covered.select("text_id").distinct())
    summary = materialize(_summary(found, covered), "suffix-summary")
    return _rows(docs, key, text).join(summary, "text_id", "left").select(
        "key", "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
    )


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).withColumnRenamed("key", "doc_id")
