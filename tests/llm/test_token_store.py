from __future__ import annotations

import random
import zlib

import edge
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from crestline.llm import token_store
from crestline.llm.token_store import Encoder, PerfectHash, read_store, write_store

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_encoder_equals_library(tokenizer):
    r = random.Random(1)
    letters = list("ab1 '  \n\t.,st rel é漢\x1c\x85²d'm\u00a0")
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 40))) for _ in range(4000)]
    texts += ["x<|endoftext|>y", "", "don't 's '", "'", " ", "'re", "a'", "'s'd 'll", "a\n't", "''s"]
    got = Encoder(PATH).encode(texts)
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == want
    whole = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert not whole.by_piece and whole.encode(["Hello there"])


def test_pieces_go_to_the_model_alone(tokenizer, monkeypatch):
    """All of the library's bookkeeping for every new word took most of the time."""
    r = random.Random(2)
    letters = [chr(c) for c in range(0x180)] + list("   ''\n\u3000漢😀\u00ad")
    texts = ["".join(r.choice(letters) for _ in range(r.randint(1, 60))) for _ in range(2000)]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    encoder = Encoder(PATH)
    monkeypatch.setattr(encoder, "whole", lambda texts: pytest.fail("whole texts encoded"))
    for _ in range(2):  # new and remembered
        assert [np.frombuffer(g, "<u2").tolist() for g in encoder.encode(texts)] == want


def test_truncating_tokenizers_encode_whole_texts(tokenizer, tmp_path):
    cut = Tokenizer.from_file(PATH)
    cut.enable_truncation(3)
    cut.save(str(tmp_path / "cut.json"))
    encoder = Encoder(str(tmp_path / "cut.json"))
    assert [len(g) // encoder.width for g in encoder.encode(["one two three four five"])] == [3]


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 30_000])
def test_hash_is_perfect_and_minimal(n):
    keys = np.array(random.Random(n).sample(range(-10**15, 10**15), n), np.int64)
    hashed = PerfectHash.build(keys)
    assert sorted(hashed.numbers(keys).tolist()) == list(range(n)) and hashed.size == n
    again, at = PerfectHash.load(memoryview(hashed.dump() + b"tail"))
    assert (again.numbers(keys) == hashed.numbers(keys)).all() and at == len(hashed.dump())


def expected(rows: list[tuple], tokenizer) -> list[tuple]:
    out, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_round_trip_of_the_query(spark, tokenizer):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in token_store.op7_token_store(spark, sf).collect())
    assert got == expected(rows, tokenizer)


def test_edges(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(token_store, "KEYS_PER_BUCKET", 5)
    docs = edge.docs(spark)
    store = write_store(docs, PATH, shards=4)
    assert sum(store.rows) == len(edge.rows())
    got = read_store(store, docs).collect()
    rows = [r[:2] for r in edge.rows()]
    want = expected(rows, tokenizer)
    # Documents of one key are in no order among each other; those without one come first.
    only = lambda xs: sorted(((k, n, c) for k, _, n, c in xs), key=str)
    assert only(map(tuple, got)) == only(want)
    starts = sorted((r.start, r.n_tokens) for r in got)
    assert all(a + n <= b for (a, n), (b, _) in zip(starts, starts[1:]))
    ids = {k: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for k, t in rows}
    assert [x.tolist() for x in store.get(7)] == [ids[7]] and [x.tolist() for x in store.get(1)] == [[0]]
    assert len(store.get(10)) == 3 and store.get(99_999) == [] and store.get(-5) == []


def test_documents_without_a_key_are_returned(spark, tokenizer):
    docs = spark.createDataFrame([(None, "one"), (3, "two"), (None, "three words here")], "doc_id long, text string")
    store = write_store(docs.repartition(2), PATH, shards=2)
    got = sorted(((r.key, r.n_tokens) for r in read_store(store, docs).collect()), key=str)
    size = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1
    assert got == sorted([(3, size("two")), (None, size("one")), (None, size("three words here"))], key=str)
    assert read_store(store, docs.where("doc_id = 3")).count() == 1
    none = docs.where("doc_id is null")
    alone = write_store(none, PATH)
    assert alone.buckets == 0 and read_store(alone, none).count() == 2


def test_pieces_that_collide_under_any_polynomial_hash(tokenizer):
    texts = []
    for n in (512, 1024, 2048, 4096):
        word = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
        texts += [word, word.translate(str.maketrans("ab", "ba")), word]
    got = token_store.Encoder(PATH).encode(texts)
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_repeated_key_spans_shards(spark):
    docs = spark.createDataFrame([(5, f"text {i % 7}") for i in range(60)] + [(1, "a"), (9, "b")], "doc_id long, text string")
    store = write_store(docs.repartition(3), PATH, shards=6)
    assert len(store.get(5)) == 60 and len(store.get(1)) == len(store.get(9)) == 1
    assert read_store(store, docs).count() == 62


def test_empty(spark):
    store = write_store(edge.empty(spark), PATH)
    assert store.buckets == 0 and store.get(1) == [] and read_store(store, edge.docs(spark)).count() == 0


def test_the_driver_loads_no_tokenizer(spark, monkeypatch):
    monkeypatch.setattr(Encoder, "_made", {})
    path = public_tokenizers.path("byte_bpe_50k.json")
    store = write_store(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string"), path)
    assert store.width == 2 and sum(store.rows) == 2 and not Encoder._made
