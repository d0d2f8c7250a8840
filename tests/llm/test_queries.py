"""Registered queries over the given tables, and the pipeline against brute force."""

import hashlib
import os
import sys
import zlib

import numpy as np
import pytest
from check_oracles import compare, connect
from test_dedup import brute_lines
from test_jaccard import shingles
from tokenizers import Tokenizer

import corpus_pipeline
from creditmill.llm import language_id
from creditmill.llm.queries import ORACLES, QUERIES, TOKENIZER

sys.path.insert(0, os.path.dirname(__file__))


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_encoding_equals_library(spark, sf_dir, con, library):
    rows = dict(con.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())
    ids = {i: library.encode(t, add_special_tokens=False).ids for i, t in rows.items()}
    got = {r.doc_id: r for r in QUERIES["op1_bpe"](spark, sf_dir).collect()}
    assert got.keys() == rows.keys()
    for i, r in got.items():
        assert r.n_tokens == len(ids[i]) and r.ids_sha256 == hashlib.sha256(np.array(ids[i], "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids[i], skip_special_tokens=False).encode()).hexdigest()
    start = 0
    files = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op6_token_files"](spark, sf_dir).collect()}
    for i in sorted(rows):
        told = np.array(ids[i] + [2], "<u4")
        assert files[i] == (start, len(told), zlib.crc32(told.tobytes()))
        start += len(told)


def test_quality_keeps_clean_documents(spark, sf_dir):
    told = QUERIES["op8_quality"](spark, sf_dir).collect()
    passed = [r for r in told if not r.base_failed]
    assert len(passed) > 100 and np.mean([r.kept for r in passed]) > 0.97


def test_pipeline_against_brute_force(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        kept.append((sorted(docs.collect(), key=lambda r: r.doc_id), sorted(out.collect(), key=lambda r: r.doc_id)))
        docs = spark.createDataFrame(kept[-1][1], out.schema).repartition(4)
    # language: what is rejected has no letter or a low score
    before, after = kept[0]
    fitted = language_id.fit_profiles(spark.createDataFrame(before).filter(~language_id.held_out()))
    ranker = language_id.Ranker(fitted)
    assert after == [r for r in before if ranker.predict(r.text)[1] >= corpus_pipeline.MIN_SCORE]
    # lines
    before, after = kept[1]
    want = brute_lines([(r.doc_id, r.text) for r in before])
    assert {r.doc_id: r.text for r in after} == {i: t for i, (t, exact, near) in want.items() if t.split() or not exact + near}
    assert all(r.n_chars == len(r.text) for r in after)
    # near copies: no two that stay are linked, and whatever went is linked with something
    before, after = kept[2]
    sets = {r.doc_id: shingles(r.text) for r in before}
    inverted = {}
    for i, s in sets.items():
        for x in s:
            inverted.setdefault(x, []).append(i)

    def links(i):
        return [j for j in {j for x in sets[i] for j in inverted[x]} - {i} if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]

    stays = {r.doc_id for r in after}
    assert all(not stays & set(links(i)) for i in stays) and all(links(i) for i in sets.keys() - stays)
    # mix: whole documents, at most twice
    before, after = kept[3]
    by_id = {r.doc_id: r for r in before}
    assert all(by_id[r.doc_id] == r for r in after) and max(np.unique([r.doc_id for r in after], return_counts=True)[1]) <= 2
    total = sum(len(r.text.encode().split()) for r in before)
    assert sum(len(r.text.encode().split()) for r in after) == pytest.approx(1.5 * total, rel=0.1)
    last = corpus_pipeline.encoded(spark, docs, sf_dir).collect()
    texts = {r.doc_id: r.text for r in after}
    assert len(last) == len(after) and all(list(r.ids) == library.encode(texts[r.doc_id], add_special_tokens=False).ids for r in last)


def test_the_whole_run(spark, sf_dir):
    """run() gives what the stages give, each on all that the one before kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        docs = spark.createDataFrame(out.collect(), out.schema).repartition(3)
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert sorted(map(tuple, got.drop("ids").collect())) == sorted(map(tuple, docs.drop("ids").collect()))


def test_stages_of_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), docs.schema) if stage is not corpus_pipeline.encoded else docs
        assert docs.count() == 0
    assert corpus_pipeline.encoded(spark, docs, sf_dir).collect() == []
