import zlib

import pytest
from conftest import rows_of
from llm_fixtures import sf  # noqa: F401

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from dimflow.llm import decontaminate, quality, simhash
from dimflow.llm.queries import QUERIES
from dimflow.sources.staging import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES
    assert set(QUERIES) <= set(queries())
    assert not set(oracle_sql()) - set(queries())


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for _, function in corpus_pipeline.STAGES:
        out.append(stage(function(spark, out[-1], sf)))
    return out


def test_columns_and_decisions(spark, sf, stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "pack"]
    docs, good, single, clean, packed = stages
    for frame in (good, single, clean):
        assert frame.columns == COLUMNS
    ids = [{r.doc_id for r in f.select("doc_id").collect()} for f in stages]
    assert ids[0] >= ids[1] >= ids[2] >= ids[3] == ids[4]
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.train(docs, labels)
    scores = dict(rows_of(quality.classify(docs, model), "doc_id", "predicted"))
    assert ids[1] == {d for d, p in scores.items() if p}
    # The stage takes what brute force does: benchmark questions as they are in the text.
    asked = [" ".join(r.text.split()) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    for r in clean.collect():
        plain = " ".join(r.text.split())
        assert not any(q in plain for q in asked)


def test_one_of_each_group_stays(stages):
    from test_simhash import kept_by_hand

    _, good, single, *_ = stages
    assert sorted(r.doc_id for r in single.select("doc_id").collect()) == kept_by_hand(rows_of(good, "doc_id", "text"))


def test_run_equals_its_stages(spark, sf, stages):
    whole = corpus_pipeline.run(spark, sf)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert rows_of(whole, *columns) == rows_of(stages[-1], *columns)


def test_special_documents(spark, sf):
    rows = [(None, "some words", "en", "s", 1), (1, None, None, None, None), (2, "", "en", "s", 0),
            (3, "x y z " * 20_000, "en", "s", 9), (3, "x y z " * 20_000, "en", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for frame in (docs, docs.limit(0)):
        for name, function in corpus_pipeline.STAGES:
            frame = stage(function(spark, frame, sf))
            assert name == "pack" or frame.columns == docs.columns


def test_contract_of_op10_and_op6_queries(spark, sf):
    found = queries()["op10_quality"](spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    six = queries()["op6_simhash"](spark, sf)
    assert six.columns[:3] == ["doc_id", "fingerprint", "component_id"] and simhash and decontaminate
