"""The corpus pipeline, stage by stage, and the registered names."""

import hashlib

import corpus_pipeline
from tidemark.llm import quality
from tidemark.llm.common import documents
from tidemark.llm.registry import QUERIES

ROOT = "/root/testdata/sf0.001"


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages(spark):
    docs = documents(spark, ROOT)
    columns, steps = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, ROOT)
        assert after.columns == columns, name
        path_rows = after.collect()
        steps.append((docs.count(), len(path_rows)))
        docs = spark.createDataFrame(path_rows, docs.schema)
    assert all(b <= a for a, b in steps) and steps[0][1] < steps[0][0]
    model = quality.train(documents(spark, ROOT), spark.read.parquet(f"{ROOT}/labels.parquet"))
    rejected = quality.score(spark, documents(spark, ROOT), model).filter("predicted = 0").count()
    assert steps[0] == (200, 200 - rejected)
    seen = set()
    for r in docs.orderBy("doc_id").collect():
        raw = r.text.encode()
        assert r.n_chars == len(r.text)
        seen.add(hashlib.sha256(raw).hexdigest())
    assert len(seen) == docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, ROOT)
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "short clean line of text", None), (None, "no id", "c"), (3, "short clean line of text", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string")
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        after = stage(spark, docs, ROOT)
        assert after.columns == docs.columns and {r.doc_id for r in after.collect()} == {1, 2, 3, None}, name
