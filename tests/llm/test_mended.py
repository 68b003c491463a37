"""Faults found in a review: letters, lines across blocks, rows without an id."""

import numpy as np

from tidemark.llm import common, language, packing, quality


def test_signs_that_are_no_letters(spark, make, sample):
    model = language.train(spark, make([(i, t) for i, t in sample[:40]]))
    rows = make([(1, "½ ²"), (2, "① Ⅷ 7"), (3, "ª"), (4, "漢"), (5, "½ a")])
    got = {r.doc_id: r.lang_pred for r in language.identify(spark, rows, model).collect()}
    assert got[1] == got[2] == "und" and "und" not in (got[3], got[4], got[5])


def test_lines_of_a_long_text_count_whole(monkeypatch):
    text = "\n".join(["the same line of words"] * 40 + [f"line {i} of its own" for i in range(40)] + ["", "end"])
    whole = quality.statistics(text)
    for cut in (16, 50, 64, 333):
        monkeypatch.setattr(common, "CUT", cut)
        assert np.allclose(quality.statistics(text), whole)


def test_rows_without_an_id_are_dealt_evenly(spark):
    pieces = spark.range(40_000).selectExpr("CAST(NULL AS BIGINT) doc_id", "0 piece", "0L start", "300L length", "7L ids_crc32").select(
        "doc_id", "piece", "start", "length", "ids_crc32")
    out = packing.pack(spark, pieces, group=5_000)
    per_group = [r["count"] for r in out.groupBy((out.sequence_id.bitwiseAND(-1) / (1 << 32)).cast("int").alias("g")).count().collect()]
    assert sum(per_group) == 40_000 and max(per_group) < 7_000
    assert out.groupBy("sequence_id").count().agg({"count": "max"}).first()[0] == 3
