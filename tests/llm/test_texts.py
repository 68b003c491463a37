"""Tokens, packing, language, quality and language-model scores."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from tidemark.llm import bpe, language, mixing, packing, quality

ODD = ["", " ", "  a", "a  b", "a \n b", "\n\n x", "it's  we'll", "漢字 😀 x​", "\x1c \x85", "a" * 3000, " " * 500 + "x", "ab" * 900, "1234 5,6"]


def odd_texts():
    r = random.Random(1)
    return ODD + ["".join(r.choice("aeiothn  \n\t'sS.,!019é漢\x1c\x85  ") for _ in range(r.randint(0, 24))) for _ in range(4000)]


def test_bpe_equals_tiktoken(sample):
    coder = bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    want = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    for text in odd_texts() + [t for _, t in sample]:
        ids = coder.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == want.encode_ordinary(text)
        assert coder.decode(memoryview(ids).cast("I")) == text.encode()


def test_run_encoder_equals_tokenizers(sample):
    coder = packing.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = odd_texts() + [t for _, t in sample[:60]]
    for text, code in zip(texts, want.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == code.ids


def test_packing(spark, make, varied, sample):
    rows = varied + [(1000 + i, t) for i, t in sample]
    out = packing.pack(spark, packing.cut(make(rows))).toPandas()
    coder = packing.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    for doc, text in rows:
        ids = coder.encode(text or "") + (2).to_bytes(4, "little")
        own = out[out.doc_id == doc].sort_values("piece")
        assert own.start.tolist() == np.append(0, own.length.cumsum()[:-1]).tolist() and own.length.sum() == len(ids) // 4
        assert own.length[1:].eq(1024).all() and own.length.max() <= 1024
        assert [zlib.crc32(ids[4 * a:4 * (a + n)]) for a, n in zip(own.start, own.length)] == own.ids_crc32.tolist()
    for _, bin_ in out.sort_values("offset").groupby("sequence_id"):
        assert bin_.offset.tolist() == np.append(0, bin_.length.cumsum()[:-1]).tolist() and bin_.length.sum() <= 1024
    assert out.sequence_id.nunique() <= 1.1 * out.length.sum() / 1024 + 1
    assert packing.pack(spark, packing.cut(make([]))).count() == 0


def test_best_fit_takes_the_tightest_bin():
    assert packing.best_fit([600, 700, 300, 420], 1024, 8) == ([0, 1, 1, 0], [0, 0, 700, 600])
    bins, _ = packing.best_fit([900, 800, 700, 100], 1024, 2)  # the fullest closes first
    assert bins == [0, 1, 2, 1]


def test_language(spark, make, sample):
    root = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{root}/documents.parquet").collect()}
    got = language.op1_language_id(spark, root).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(lang) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(lang[r.doc_id] == r.lang_pred for r in held) >= 0.97 * len(held) and all(0 <= r.score <= 1 for r in got)
    rows = make([(1, None), (2, ""), (3, "12 !!"), (4, "x"), (5, "é" * 3)])
    model = language.train(spark, make([(i, t) for i, t in sample[:40]]))
    assert [r.lang_pred for r in language.identify(spark, rows, model).orderBy("doc_id").collect()] == ["und"] * 3 + ["en"] * 2
    assert {r.lang_pred for r in language.identify(spark, rows, language.train(spark, make([]))).collect()} == {"und"}


def test_long_texts_lose_no_ngram(monkeypatch):
    monkeypatch.setattr(language, "BLOCK", 64)
    raw = language.parts("the quick brown fox " * 40)
    counted = Counter()
    for piece in language.long_parts(raw):
        counted.update(piece[k:k + language.N] for k in range(len(piece) - language.N + 1))
    assert counted == Counter(raw[k:k + language.N] for k in range(len(raw) - language.N + 1))


def test_quality(spark, make):
    root = "/root/testdata/sf0.01"
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{root}/labels.parquet").collect()}
    got = quality.op3_quality(spark, root).collect()
    held = [r for r in got if r.held_out and r.doc_id in label]
    assert len(held) > 50 and sum(r.predicted == label[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(r.predicted == (r.score >= 0.5) for r in got)
    labels = spark.createDataFrame([(1, None), (9, 1)], "doc_id long, quality int")
    rows = make([(1, None), (2, ""), (3, "a b")])
    assert quality.score(spark, rows, quality.train(rows, labels)).count() == 3


def test_trees_learn_a_rule():
    x = np.random.default_rng(5).normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    model = quality.fit(x[:2000], y[:2000])
    assert ((model.scores(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.95


def test_scores(spark):
    root = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{root}/documents.parquet").collect()]
    got = {r.doc_id: r for r in mixing.op6_context_mixing(spark, root).collect()}
    counts, ends = Counter(), 0
    for i, text in rows:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update(text.encode().lower().split())
            ends += 1
    total, kinds = sum(counts.values()) + ends, len(counts) + 1
    for i, text in rows:
        words = text.encode().lower().split()
        base = sum(math.log10((c + 0.5) / (total + 0.5 * (kinds + 1))) for c in [counts[w] for w in words] + [ends])
        r = got[i]
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.n_known == sum(counts[w] > 0 for w in words) + 1
        assert r.n_tokens == len(words) + 1 and r.train_tokens == total and r.score < 0
    held = [r for r in got.values() if r.held_out]
    assert sum(r.bits_per_byte for r in held) / len(held) < 3.2


def test_keys_stop_at_white_space():
    keys, starts = mixing.strings([b"ab cd", b"", b"abcdefghij"])
    assert starts.tolist() == [0, 6, 7] and len(keys) == 18
    as_bytes = [int(k).to_bytes(8, "big").lstrip(b"\0") for k in keys]
    assert as_bytes[:7] == [b"\xffa", b"\xffab", b"\xffab ", b" c", b" cd", b" cd\xff", b"\xff\xff"] and as_bytes[-2] == b"cdefghij"


def test_empty_learning(spark, make):
    from pyspark.sql import functions as F
    rows = make([(1, None), (2, "a b")]).withColumn("held_out", F.lit(True))
    got = mixing.score(spark, rows, rows.limit(0)).orderBy("doc_id").collect()
    assert [r.n_known for r in got] == [0, 0] and [r.n_tokens for r in got] == [1, 3] and defaultdict(int)[0] == 0
