"""Rows without a doc_id take nothing from equal documents."""

from tidemark.llm import jaccard


def test_null_id_row_before_its_equal(spark, make):
    words = [f"w{i}" for i in range(60)]
    text, near = " ".join(words), " ".join(words[:-1] + ["other"])
    rows = make([(None, text), (1, text), (2, near)]).coalesce(1)
    got = [(r.doc_id, r.component_id) for r in jaccard.near_groups(spark, rows).collect()]
    assert sorted(got, key=str) == [(1, 1), (2, 1), (None, None)]
