"""More languages than a web crawl's first few dozen."""

import random

from tidemark.llm import language


def test_every_language_is_learned(spark):
    r = random.Random(5)
    rows = []
    for k in range(90):
        words = ["".join(r.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(30)]
        rows += [(100 * k + i, " ".join(r.choice(words) for _ in range(100 if k < 70 else 40)), f"l{k:02}") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {x.doc_id: x.lang_pred for x in language.identify(spark, docs, language.train(spark, docs)).collect()}
    assert all(got[i] == lang for i, _, lang in rows)
