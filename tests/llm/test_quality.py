from __future__ import annotations

import random
from collections import Counter, defaultdict
from dataclasses import replace
from pathlib import Path
from urllib.parse import urlparse

import edge
import numpy as np
import pytest

from crestline.llm import quality

SF_DIR = "/root/testdata/sf0.001"
S, N = quality.SYMBOLS, quality.ORDER


def brute(texts: list[str]):
    """Probability of a symbol after a context, straight from the definition."""
    table = quality.symbol_table()
    grams: dict[int, Counter] = {N: Counter()}
    for t in texts:
        s = [0] * (N - 1) + [int(table[ord(c)]) for c in t]
        grams[N].update(tuple(s[i - N + 1 : i + 1]) for i in range(N - 1, len(s)))
    for k in range(N - 1, 0, -1):
        grams[k] = Counter(g[1:] for g in grams[k + 1])
    off = {}
    for k, c in grams.items():
        n = Counter(c.values())
        if not n[1]:
            off[k] = [0.5] * 3
            continue
        y = n[1] / (n[1] + 2 * n[2])
        d = [j - (j + 1) * y * n[j + 1] / n[j] if n[j] else j / 2 for j in (1, 2, 3)]
        off[k] = [min(max(x, 0.1), j) for x, j in zip(d, (1, 2, 3))]
    by_context: dict = defaultdict(list)
    for k, c in grams.items():
        for g, n in c.items():
            by_context[g[:-1]].append((g, n, off[k][min(n, 3) - 1]))

    def p(context: tuple, w: int) -> float:
        lower = p(context[1:], w) if context else 1 / S
        own = by_context.get(context)
        if not own:
            return lower
        total = sum(n for _, n, _ in own)
        seen = next((max(n - d, 0) for g, n, d in own if g[-1] == w), 0)
        return seen / total + sum(d for *_, d in own) / total * lower

    return p, table


def test_model_equals_definition(spark):
    texts = [edge.prose(i, 40) for i in range(5)] + ["Aa aa. aa", ""]
    model = quality.fit(spark.createDataFrame([(t,) for t in [*texts, None]], "text string").repartition(2))
    p, table = brute(texts)
    probe = "thererX 9 an\nzz"
    s = [0] * (N - 1) + [int(table[ord(c)]) for c in probe]
    want = -np.mean([np.log2(p(tuple(s[i - N + 1 : i]), s[i])) for i in range(N - 1, len(s))])
    bits = model.bits()
    assert quality.score(bits, [probe, "", None]) == [pytest.approx(want, abs=1e-4), None, None]
    sums = (2.0 ** -bits.reshape(-1, S).astype(np.float64)).sum(1)
    assert np.allclose(sums, 1, atol=1e-3)


def test_texts_do_not_touch(spark):
    model = quality.fit(spark.createDataFrame([(edge.prose(1, 200),)], "text string"))
    bits = model.bits()
    texts = [edge.prose(i, n) for i, n in enumerate([1, 2, 50, 3])] + ["", "a"]
    assert quality.score(bits, texts) == [quality.score(bits, [t])[0] for t in texts]


def test_junk_is_rejected_and_prose_is_kept(spark):
    rows = quality.op4_quality_classifier(spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    good = [r.kept for r in rows if r.doc_id in labels and labels[r.doc_id].quality == 1 and labels[r.doc_id].toxic == 0]
    bad = [r.kept for r in rows if r.doc_id in labels and labels[r.doc_id].quality == 0]
    assert len(rows) == 1000 and np.mean(good) > 0.97 and np.mean(bad) < 0.3


def test_edges(spark):
    docs = edge.docs(spark)
    labels = spark.createDataFrame([(5, 1, 0), (6, 1, 0), (7, 1, 0), (7, 0, 0), (None, 1, 0), (8, None, 0), (9, 1, 0)], "doc_id long, quality int, toxic int")
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    rows, _, _ = quality.classify(docs, labels)
    assert rows.count() == len(edge.rows())
    assert not [r for r in kept.collect() if not r.text]
    nothing = quality.keep_good(docs, labels.where("doc_id = 99"))
    assert nothing.count() == sum(1 for r in edge.rows() if r[1])
    assert quality.keep_good(edge.empty(spark), labels).count() == 0


def brute_words(trusted: list[str], spell):
    """Bits of a word after another, straight from the definition."""
    bits = spell.bits()
    pairs = Counter(p for t in trusted if t for w in [["<", *t.split(), ">"]] for p in zip(w, w[1:]))
    single = Counter(w for _, w in pairs)

    def discounts(c: Counter) -> list[float]:
        n = Counter(c.values())
        y = n[1] / (n[1] + 2 * n[2])
        d = [j - (j + 1) * y * n[j + 1] / n[j] if n[j] else j / 2 for j in (1, 2, 3)]
        return [min(max(x, 0.1), j) for x, j in zip(d, (1, 2, 3))]

    d1, d2 = discounts(single), discounts(pairs)

    def spelled(w: str) -> float:
        s = [quality.BLANK] * (N - 1) + [int(quality.symbol_table()[ord(c)]) for c in w.strip("<>")] + [quality.BLANK]
        codes = [sum(x * S ** (N - 1 - k) for k, x in enumerate(s[i - N + 1 : i + 1])) for i in range(N - 1, len(s))]
        return float(sum(bits[c] for c in codes) + sum(quality.symbol_bits()[x] for x in s[N - 1 :]))

    def p(v: str, w: str) -> float:
        whole = sum(single.values())
        low = sum(d1[min(n, 3) - 1] for n in single.values()) / whole * 2 ** -spelled(w)
        if single[w]:
            low += max(single[w] - d1[min(single[w], 3) - 1], 0) / whole
        own = {b: n for (a, b), n in pairs.items() if a == v}
        if not own:
            return low
        seen = max(own[w] - d2[min(own[w], 3) - 1], 0) if w in own else 0
        return (seen + sum(d2[min(n, 3) - 1] for n in own.values()) * low) / sum(own.values())

    return p


@pytest.mark.parametrize("hot", [0, 20, 1 << 18])
def test_words_equal_definition(spark, monkeypatch, hot):
    monkeypatch.setattr(quality, "HOT", hot)
    trusted = [edge.prose(i, 60) for i in range(6)] + ["Ab 12 ab\tab é", "", " \n"]
    model = quality.fit_words(spark.createDataFrame([(t,) for t in [*trusted, None]], "text string").repartition(2))
    probes = [edge.prose(3, 20), " Ab  12 ab zzz 漢字 ", "new", " ", "Cher, " * 30, "", None]
    docs = spark.createDataFrame(list(enumerate(probes)), "id int, text string").repartition(2)
    got = {r.id: r.bits for r in quality.scored(docs, model, extra=[quality.F.col("id")]).collect()}
    p, dense = brute_words(trusted, model.spell), model.spell.bits()
    for i, t in enumerate(probes):
        if not t:
            assert got[i] is None
            continue
        w = ["<", *t.split(), ">"]
        words = -sum(np.log2(p(a, b)) for a, b in zip(w, w[1:]))
        assert got[i] == pytest.approx((words + quality.score(dense, [t])[0] * len(t)) / 2 / (len(w) - 1), abs=1e-4)


def test_words_are_counted_as_they_stand(spark):
    """Texts alike in every symbol of the spelling are told apart by their words, and the tables grow."""
    r = random.Random(1)
    texts = [" ".join(str(int(100 + 900 * r.random() ** 3)) for _ in range(12)) for _ in range(300)]
    few, many = (quality.fit_words(spark.createDataFrame([(t,) for t in texts[:k]], "text string")) for k in (30, 300))
    size = lambda m: m.gains.count() + len(m.hot[0])
    assert size(many) > 4 * size(few)
    seen = Counter(w for t in texts for w in t.split())
    common, strange = seen.most_common(1)[0][0], next(str(n) for n in range(999, 99, -1) if str(n) not in seen)
    docs = spark.createDataFrame([(common,), (strange,)], "text string")
    got = {r.t: r.bits for r in quality.scored(docs, many, extra=[quality.F.col("text").alias("t")]).collect()}
    assert got[common] < got[strange] - 0.5


def test_no_part_of_the_pairs_is_the_whole(spark, monkeypatch):
    """N-grams are worked on in parts, each of which leaves the disk before the next one comes."""
    sizes, held = [], []

    def written(df, purpose, by=None):
        out = materialize(df, purpose, by)
        if purpose == "quality-pairs":
            sizes.append(out.count())
            held.append(out)
        return out

    materialize = quality.materialize
    monkeypatch.setattr(quality, "materialize", written)
    texts = [edge.prose(i, 100) for i in range(20)]
    model = quality.fit_words(spark.createDataFrame([(t,) for t in texts], "text string"))
    want = {p for t in texts for w in [["<", *t.split(), ">"]] for p in zip(w, w[1:])}
    assert sum(sizes) == len(want) and max(sizes) < len(want) / 2
    assert not any(Path(urlparse(f).path).exists() for df in held for f in df.inputFiles())
    assert model.gains.count() + len(model.hot[0]) >= len(want)


def test_no_portion_of_the_texts_is_the_whole(spark, monkeypatch):
    """N-grams of the texts that are scored take most of the disk, so only some are there at a time."""
    texts = [edge.prose(i, 60) for i in range(30)] + ["", None]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    monkeypatch.setattr(quality, "HOT", 0)
    model = quality.fit_words(docs)
    counts, materialize = [], quality.materialize

    def written(df, purpose, by=None):
        out = materialize(df, purpose, by)
        if purpose == "quality-rows":
            assert not any(Path(urlparse(f).path).exists() for held in counts for f in held[1])
            counts.append((out.count(), [f for f in out.inputFiles() if f"part={quality.SLICES}/" not in f]))
        return out

    monkeypatch.setattr(quality, "materialize", written)
    got = quality.scored(docs, model, extra=[quality.F.col("text").alias("t")]).collect()
    assert sorted(r.t or "" for r in got) == sorted(t or "" for t in texts)
    assert len(counts) > 1 and max(n for n, _ in counts) < 0.7 * sum(n for n, _ in counts)


def test_a_filter_is_filled_by_a_task_for_each_core(spark, monkeypatch):
    tasks, frame = [], type(spark.range(0))
    real = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda df, *a, **k: tasks.append(df.rdd.getNumPartitions()) or real(df, *a, **k))
    cores = spark.sparkContext.defaultParallelism
    made = quality.bloom.build(spark.range(0, 5000, 1, 8 * cores))
    assert tasks == [cores] and quality.bloom.maybe(made, np.arange(5000)).all()


def test_ngrams_of_a_text_are_lists():
    """One row for each part of the n-grams of a text that occur equally often, whatever their number."""
    bits = np.random.default_rng(1).random(S**N).astype(np.float32)
    texts = [edge.prose(1, 400) + " aa" * 9, None, "", " \n", "a", "é 漢字  a b\tc", "Cher, " * 30]
    nothing, everything = (np.zeros(0, np.int64), np.zeros(0)), np.full(512, 255, np.uint8)
    size, _, of, part, n, held, grams = quality._row_scores(bits, 0.0, nothing, everything, texts)
    got = Counter()
    for i, k, c, g in zip(*(np.repeat(x, held).tolist() for x in (of, part, n)), grams.tolist()):
        got[i, k, g] += c
    want = Counter()
    for i, t in enumerate(texts):
        words, _, _ = quality.word_rows(bits, [t], quality.symbols([t]))
        assert size[i] == len(words) - 1
        single, pairs = quality.part_of(words), quality.pair_keys(words[:-1], words[1:])
        if t:
            want.update(zip([i] * len(words), single.tolist(), words.view(np.int64).tolist()))
            want.update(zip([i] * len(pairs), single[1:].tolist(), pairs.view(np.int64).tolist()))
    assert got == want
    assert len(set(zip(of.tolist(), part.tolist(), n.tolist()))) == len(of) < len(grams) / 4


def test_running_characters_equal_scores_of_texts():
    bits = np.random.default_rng(2).random(S**N).astype(np.float32)
    texts = ["", "a", None, "ab", " ", edge.prose(2, 90), "\n\n", "é漢字 x"]
    sums = quality.running(bits, quality.symbols(texts), np.array([len(t or "") for t in texts]))
    assert [round(x / len(t), 6) if t else None for x, t in zip(sums.tolist(), texts)] == quality.score(bits, texts)


def test_small_parts_are_joined_in_one_query():
    assert quality._together([1] * quality.SLICES) == [list(range(quality.SLICES))]
    assert quality._together([quality.FEW] * quality.SLICES) == [[k] for k in range(quality.SLICES)]
    assert quality._together([quality.FEW - 1, 1, 1, 0]) == [[0, 1], [2, 3]]


def test_few_parts_of_the_model_share_a_query(spark, monkeypatch):
    """A small model takes a query for some parts at a time, and is the same as by one part at a time."""
    docs = spark.createDataFrame([(edge.prose(i, 60),) for i in range(12)], "text string")
    monkeypatch.setattr(quality, "HOT", 0)
    written, materialize = [], quality.materialize

    def counted(df, purpose, by=None):
        written.append(purpose)
        return materialize(df, purpose, by)

    monkeypatch.setattr(quality, "materialize", counted)

    def gains(model):
        return sorted((r.gram, round(r.gain, 9)) for r in model.gains.collect())

    some = quality.fit_words(docs)
    tables = [gains(replace(some, parts=[p])) for p in some.parts]
    assert len(some.parts) == quality.SLICES and written.count("quality-gains") < quality.SLICES / 2
    monkeypatch.setattr(quality, "AT_MOST", 1)
    alone = quality.fit_words(docs)
    assert tables == [gains(replace(alone, parts=[p])) for p in alone.parts]
