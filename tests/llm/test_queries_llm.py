"""Registered queries against their SQL, and the pipeline against its stages done by hand."""

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from check import compare, connect
from turbilux.llm.queries import ORACLES, QUERIES
from turbilux.llm import exact_dedup, order_minhash, phrase_index

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    ok, ours, theirs, _, differing, columns = compare(spark, connect(SF_DIR), name, SF_DIR)
    assert columns[0] == columns[1]
    assert ok, differing[:2]


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", ["op5_license_digests", "op6_positional_index"])
def test_native(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_pipeline_rejects_what_the_operator_marks(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    marked = {r.doc_id for r in QUERIES["op7_segment_toxicity"](spark, sf).where("predicted = 1").collect()}
    kept = {r.doc_id for r in corpus_pipeline.toxicity(spark, docs, sf).collect()}
    assert marked and not marked & kept


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    steps = [f for _, f in corpus_pipeline.STAGES]
    calm = steps[0](spark, docs, SF_DIR)
    assert calm.columns == docs.columns and ids(calm) < ids(docs)
    once = steps[1](spark, calm, SF_DIR)
    assert ids(once) == {r.keep_id for r in exact_dedup.exact_groups(calm).collect()}
    unlike = steps[2](spark, once, SF_DIR)
    assert ids(unlike) == {r.class_id for r in order_minhash.near_groups(once).collect()}
    clean = steps[3](spark, unlike, SF_DIR)
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    assert ids(clean) == {r.doc_id for r in phrase_index.contamination(unlike, items).collect() if not r.contaminated}
    assert clean.columns == docs.columns
    assert ids(corpus_pipeline.run(spark, SF_DIR)) == ids(clean)
