from __future__ import annotations

import hashlib
import random
from collections import Counter

import edge
import numpy as np
import pytest

from crestline.llm import induced, suffix_dedup

W = suffix_dedup.LENGTH


def brute(texts: list[str | None]) -> list[tuple]:
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + W] for r in raws for i in range(len(r) - W + 1))
    out = []
    for r in raws:
        cover = bytearray(len(r))
        for i in range(len(r) - W + 1):
            if seen[r[i : i + W]] > 1:
                cover[i : i + W] = b"\1" * W
        runs = sum(1 for i, c in enumerate(cover) if c and not (i and cover[i - 1]))
        kept = bytes(c for c, x in zip(r, cover) if not x)
        out.append((len(r), sum(cover), runs, hashlib.sha256(kept).hexdigest()))
    return out


def mixed(seed: int) -> list[str]:
    r = random.Random(seed)
    passages = [edge.prose(s, 60) for s in range(4)]
    texts = []
    for i in range(30):
        parts = [edge.prose(seed * 1000 + i * 10 + k, r.randint(1, 60)) for k in range(r.randint(1, 3))]
        parts.insert(r.randrange(len(parts) + 1), r.choice(passages)[: r.choice([150, 199, 200, 201, 400])])
        texts.append("".join(parts) if r.random() < 0.5 else " ".join(parts))
    return texts + [texts[0], texts[3], "for " * 400, "For " * 90, "a" * 1000, "a" * 199, "b" * 200, "é" * 100, "é" * 101]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed, monkeypatch):
    texts = mixed(seed) + [None, "", "short"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    got = {r.key: tuple(r)[1:] for r in suffix_dedup.remove_repeats(docs).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)


def test_edges(spark):
    texts = [r[1] for r in edge.rows()]
    got = sorted(tuple(r)[1:] for r in suffix_dedup.remove_repeats(edge.docs(spark)).collect())
    want = brute([t if t is None or len(t) < 100_000 else None for t in texts])
    long = texts[4].encode()
    want[4] = want[5] = (len(long), len(long), 1, hashlib.sha256(b"").hexdigest())
    assert got == sorted(want)
    assert suffix_dedup.remove_repeats(edge.empty(spark)).count() == 0


def test_segments_of_long_texts(monkeypatch):
    raw = edge.prose(9, 500).encode()
    whole = [x for part in suffix_dedup.contexts([raw]) for x in zip(*[c.tolist() for c in part])]
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 300)
    cut = [x for part in suffix_dedup.contexts([raw]) for x in zip(*[c.tolist() for c in part])]
    starts = lambda xs: sorted(p for _, _, _, at, size in xs for p in range(at, at + size - W + 1))
    assert starts(whole) == starts(cut) == list(range(len(raw) - W + 1))


@pytest.mark.parametrize("seed", range(60))
def test_induced_sorting_equals_brute_force(seed, monkeypatch):
    r = random.Random(seed)
    depth = r.choice([1, 2, 3, 5, 8, 13])
    monkeypatch.setattr(induced, "DEPTH", depth)
    if seed % 3:
        monkeypatch.setattr(induced, "IN_MEMORY", r.choice([64, 1000]))  # queues and arrays on disk
    alphabet = r.choice([[1], [0, 1], [1, 2], [0, 1, 2, 3], list(range(30))])
    s = [r.choice(alphabet) for _ in range(r.choice([1, 2, 5, 20, 100, 400]))]
    for _ in range(r.randint(0, 6)):
        a, b = r.randrange(len(s)), r.randrange(len(s))
        part = s[a : a + r.randint(1, 3 * depth)]
        s[b : b + len(part)] = part
    flags = induced.repeated(np.array(s, np.uint16))
    seen = Counter(tuple(s[i : i + depth]) for i in range(len(s) - depth + 1))
    for i in range(len(s) - depth + 1):
        assert flags[i] == (seen[tuple(s[i : i + depth])] > 1)


@pytest.mark.parametrize("most", [5, 254, 255, 256])
def test_common_prefixes_equal_brute_force(most, monkeypatch):
    """Any symbols, whether they fit a byte or not, and pairs that reach the end of the text."""
    monkeypatch.setattr(induced, "PAIRS", 50)
    r = random.Random(most)
    s = [r.choice([0, 1, most]) for _ in range(300)]
    s += s[20:250] + [0] * 40
    t = induced._narrow(np.array(s, np.uint16))
    assert t.dtype == (np.uint8 if most < 255 else np.uint16)
    pairs = [(r.randrange(len(s)), r.randrange(len(s))) for _ in range(200)] + [(20, 300), (25, 305), (529, 569), (569, 540)]
    pairs = [(a, b) for a, b in pairs if a != b]
    got = induced._common(t, *(np.array(x) for x in zip(*pairs)))
    for (a, b), n in zip(pairs, got.tolist()):
        assert n == min(next((k for k in range(W) if max(a, b) + k >= len(s) or s[a + k] != s[b + k]), W), W)


def test_texts_are_sorted_eight_bytes_at_a_time(monkeypatch):
    """Contexts of one anchor are alike for long, so the work is that of comparing what they share."""
    word, steps = induced._word, []
    monkeypatch.setattr(induced, "_word", lambda t, at, end: steps.append(t.dtype) or word(t, at, end))
    raw = edge.prose(5, 100).encode()[:400]
    parts = [raw + bytes([97 + i]) * 100 + raw for i in range(20)]
    keys, begun, ended = suffix_dedup.sort_shard(list(range(20)), parts)
    assert sorted(zip(keys, begun, ended)) == [(i, a, a + 400) for i in range(20) for a in (0, 500)]
    assert set(steps) == {np.dtype(np.uint8)} and len(steps) <= -(-W // 8) + 1
