from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
import test_minhash
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from crestline.llm import decontam, mixing, quality
from crestline.llm.common import materialize

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of each stage."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        done = materialize(stage(spark, docs, SF_DIR), f"test-{name}")
        out[name] = (docs, done)
        docs = done
    return out


def test_all_but_the_last_return_documents(spark, stages):
    columns = spark.read.parquet(f"{SF_DIR}/documents.parquet").columns
    assert [n for n, _ in corpus_pipeline.STAGES] == list(stages) and len(stages) == 5
    assert all(done.columns == columns for _, done in list(stages.values())[:-1])


def test_quality_stage_follows_the_classifier(spark, stages):
    before, after = stages["quality"]
    rows, _, most = quality.classify(before, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    want = {r.key for r in rows.collect() if r.bits is not None and (most.get(r.lang) is None or r.bits <= most[r.lang])}
    assert {r.doc_id for r in after.collect()} == want


def test_dedup_stage_equals_brute_force(stages):
    before, after = stages["near_dedup"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    want = {d for d, _, _, kept in test_minhash.brute(rows, 5) if kept}
    assert {r.doc_id for r in after.collect()} == want and len(want) < len(rows)


def test_decontamination_stage_removes_items(spark, stages):
    before, after = stages["decontaminate"]
    items = [(r.item_id, decontam.normalised(r.text)) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    matcher = decontam.Matcher(items, decontam.RATE)
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect() if not matcher.find(r.text)}


def test_mix_and_token_stages(spark, stages):
    before, after = stages["mix"]
    copies = {r._row.doc_id: r._copies for r in mixing.apply_mix(before, mixing.solve(before)).collect()}
    got: dict[int, int] = {}
    for r in after.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {d: n for d, n in copies.items() if n}
    stored = stages["tokens"][1].collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    crc = {r.doc_id: zlib.crc32(np.array(tokenizer.encode(r.text, add_special_tokens=False).ids + [0], "<u4").tobytes()) for r in after.collect()}
    assert len(stored) == after.count() and all(r.ids_crc32 == crc[r.doc_id] for r in stored)


def test_registered_queries(spark):
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert all(isinstance(sql, str) for sql in contract.oracle_sql().values())
    assert contract.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in contract.oracle_sql()
