import pytest
from plain import documents, pairs, union_find
from pyspark.sql import functions as F
from test_llm_dedup import folded, plain_fingerprint

import __spark_entry__ as entry_module
import corpus_pipeline
from oracle import compare, connect
from sparkloom.llm import packing, pii, quality, queries

FOLDER = "/root/testdata/sf0.01"


def test_queries_are_registered():
    names = [n.split("_")[0] for n in entry_module.queries() if n.startswith("op")]
    assert sorted(names, key=lambda n: int(n[2:])) == [f"op{i}" for i in range(1, 14)]
    assert "pipeline" in entry_module.queries()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_agrees_with_sql(spark, name):
    frame = queries.QUERIES[name](spark, FOLDER)
    assert compare(connect(FOLDER), frame, queries.ORACLE_SQL[name]) == []


def test_stages_do_what_plain_ones_do(spark):
    """Each stage against a plain version over its own input."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "exact_dedup", "near_dedup", "pii", "packing"]
    now = docs
    inputs = {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = now
        now = stage(spark, now, FOLDER)
        if name != "packing":
            assert now.columns == docs.columns and now.dtypes == docs.dtypes
            now = spark.createDataFrame(now.collect(), docs.schema)

    def ids(frame):
        return {r.doc_id for r in frame.select("doc_id").collect()}

    scores = quality.score_quality(docs, labels).filter("predicted = 1")
    assert ids(inputs["exact_dedup"]) == ids(scores)
    bad = {r.doc_id for r in labels.filter("quality = 0").collect()}
    good = {r.doc_id for r in labels.filter("quality = 1").collect()}
    kept = ids(inputs["exact_dedup"])
    assert len(kept & bad) <= 0.1 * len(bad) and len(kept & good) >= 0.98 * len(good)

    latest = {}
    for r in inputs["exact_dedup"].collect():
        latest[folded(r.text)] = max(latest.get(folded(r.text), -1), r.doc_id)
    assert ids(inputs["near_dedup"]) == set(latest.values())

    prints = {r.doc_id: plain_fingerprint(r.text) for r in inputs["near_dedup"].collect()}
    root = union_find(
        prints, [(a, b) for a, b in pairs(prints) if (prints[a] ^ prints[b]).bit_count() <= 4]
    )
    assert ids(inputs["pii"]) == set(root.values())

    before = {r.doc_id: r.text for r in inputs["pii"].collect()}
    redactor = pii.fit(inputs["pii"])
    for r in inputs["packing"].collect():
        assert r.text == pii.redact(before[r.doc_id], redactor.spans(before[r.doc_id]))
        assert not pii.base_spans(r.text) and r.n_chars == len(r.text)

    words = packing.tokenizer(packing_path())
    lengths = {
        r.doc_id: len(next(words.texts([r.text]))) // 4 + 1 for r in inputs["packing"].collect()
    }
    packed = now.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r.doc_id: r.n for r in packed} == lengths


def packing_path():
    import public_tokenizers

    return public_tokenizers.path(queries.WORD_TOKENIZER)


def test_run_equals_its_stages(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, "/root/testdata/sf0.001").collect(), docs.schema)
    again = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted([r[k] for k in key] for r in rows) == sorted([r[k] for k in key] for r in again)
    assert len({r.sequence_id for r in rows}) == len({r.sequence_id for r in again})


def test_stages_with_odd_rows_and_clashing_names(spark):
    rows = [(1, None, None), (2, "", "en"), (3, "x " * 50000, "en"), (4, "a b c", None), (4, "a b c", None), (None, "q", "en")]
    names = ("_doc", "_id", "_text", "_key", "_sha", "kept", "fp", "score", "x", "label")
    for table in (rows, []):
        docs = documents(spark, table, names)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, FOLDER)
            assert out.columns == docs.columns, name
            assert out.count() <= len(table)
        assert (corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() > 0) == bool(table)

