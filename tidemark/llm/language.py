"""Language identification: n-grams looked up in a bit-sliced Bloom filter of language masks."""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import blocks, documents, held_out, learned_from, mix64, staged

N = 5  # bytes of an n-gram
HASHES = 3
BLOCK = 1 << 20
# ASCII other than letters counts as a space.
PLAIN = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def gram_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of each text, a space at both ends, and where each text's begin. A text has at least one."""
    padded = [b" " + t + b" " * (N - 1) for t in texts]
    data = np.frombuffer(b"".join(padded), np.uint8)
    key = np.zeros(len(data) - N + 1, np.uint64)
    for k in range(N):
        key |= data[k:len(data) - N + 1 + k].astype(np.uint64) << np.uint64(8 * k)
    ends = np.cumsum([len(p) for p in padded])
    inner = np.ones(len(data), bool)
    for k in range(1, N):
        inner[ends - k] = False
    counts = np.array([len(p) - N + 1 for p in padded])
    return key[inner[:len(key)]], np.cumsum(counts) - counts


def parts(text: str | None) -> bytes:
    return (text or "").lower().encode().translate(PLAIN)


def long_parts(text: bytes):
    """Pieces of a long text that share N - 1 bytes, so that every n-gram is in one of them."""
    return [text] if len(text) <= BLOCK else [text[k:k + BLOCK + N - 1] for k in range(0, len(text) - N + 1, BLOCK)]


class LanguageFilter:
    """One mask of languages per slot; the masks of an n-gram's slots, ANDed, name all languages that hold it."""

    def __init__(self, languages: list[str], grams: dict[int, np.ndarray], slots_log2: int):
        self.languages = languages
        self.shift = np.uint64(64 - slots_log2)
        n_words = max(1, -(-len(languages) // 8))
        self.slots = np.zeros((n_words, 1 << slots_log2), np.uint8)
        for at, keys in grams.items():
            for slot in self._slots(keys):
                self.slots[at // 8, slot] |= np.uint8(1 << at % 8)
        bits = [np.count_nonzero(self.slots[at // 8] & (1 << at % 8)) for at in range(len(languages))]
        self.false_rate = (np.array(bits) / (1 << slots_log2)) ** HASHES

    def _slots(self, keys: np.ndarray):
        h = mix64(keys)
        for _ in range(HASHES):
            yield (h >> self.shift).astype(np.intp)
            h = h * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)

    def hits(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Per text and language the n-grams found, and per text all n-grams."""
        keys, starts = gram_keys(texts)
        slots = list(self._slots(keys))
        out = np.zeros((len(texts), len(self.languages)))
        for word in range(len(self.slots)):
            mask = self.slots[word][slots[0]]
            for slot in slots[1:]:
                mask &= self.slots[word][slot]
            for bit in range(8 * word, min(8 * word + 8, len(self.languages))):
                out[:, bit] = np.add.reduceat((mask >> np.uint8(bit % 8)) & np.uint8(1), starts, dtype=np.int64)
        return out, np.diff(np.append(starts, len(keys)))


def gram_counts(docs: DataFrame) -> DataFrame:
    """lang, gram, n over whole texts of all learning rows, counted per block before they shuffle."""
    def run(batches):
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            texts = [parts(t) for t in batch.column("text").to_pylist()]
            for lang in sorted(set(langs)):
                pieces = [p for t, own in zip(texts, langs, strict=True) if own == lang and t for p in long_parts(t)]
                for block in blocks(pieces, 8 * BLOCK):
                    keys, counts = np.unique(gram_keys([t for _, t in block])[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(counts.astype(np.int64))],
                        names=["lang", "gram", "n"])

    return docs.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(spark: SparkSession, docs: DataFrame, share: float = 2e-5, rival: float = 8.0,
          slots_log2: int = 20) -> LanguageFilter | None:
    """Filter of the n-grams that make up ``share`` of a language's n-grams or more.

    At most 1 / share n-grams a language pass, and an n-gram that is ``rival`` times as frequent
    in another language is left out: quoted foreign text. Every value of ``lang`` is learned:
    the filter takes 1 / 8 of 2**slots_log2 bytes a language, its n-grams at most 8 / share bytes.
    None if there is nothing to learn from.
    """
    counted = staged(spark, gram_counts(docs.filter("text is not null and lang is not null").select("text", "lang")), "grams")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total")).collect()
    if not totals:
        return None
    table = spark.createDataFrame([(r.lang, r.total) for r in totals], "lang string, total long")
    frequent = (counted.join(F.broadcast(table), "lang").withColumn("share", F.col("n") / F.col("total"))
                .filter(F.col("share") >= share).select("lang", "gram", "share"))
    best = frequent.groupBy("gram").agg(F.max("share").alias("best"))
    own = frequent.join(best, "gram").filter(F.col("share") * rival >= F.col("best")).groupBy("lang").agg(F.collect_list("gram").alias("grams"))
    languages = sorted(r.lang for r in totals)
    place = {lang: at for at, lang in enumerate(languages)}
    grams = {place[r.lang]: np.array(r.grams, np.int64).astype(np.uint64) for r in own.toLocalIterator()}
    return LanguageFilter(languages, grams, slots_log2)


def identify(spark: SparkSession, docs: DataFrame, model: LanguageFilter | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_grams for every row, from its whole text alone.

    Of the n-grams found per language the expected false positives of the filter are taken
    off; the language with most left is predicted (ties: the first by name), its score is its
    share of what is left over all languages. Null texts and texts without a letter are
    ``und`` with score 0, as is every text when nothing was learned.
    """
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            raw = batch.column("text").to_pylist()
            langs, scores, sizes = ["und"] * len(raw), np.zeros(len(raw)), np.zeros(len(raw), np.int64)
            known = [i for i, t in enumerate(raw) if t and any(map(str.isalpha, t))] if m else []
            hits = np.zeros((len(raw), len(m.languages) if m else 1))
            pieces = [(i, p) for i in known for p in long_parts(parts(raw[i]))]
            for block in blocks((p for _, p in pieces), BLOCK):
                rows = np.array([pieces[at][0] for at, _ in block])
                found, n = m.hits([t for _, t in block])
                np.add.at(hits, rows, found)
                np.add.at(sizes, rows, n)
            if known:
                left = np.maximum(0, (hits - sizes[:, None] * m.false_rate) / (1 - m.false_rate))
                best, total = left.argmax(1), left.sum(1)
                for i in known:
                    langs[i] = m.languages[best[i]]
                scores = np.where(total > 0, left[np.arange(len(raw)), best] / np.maximum(total, 1e-9), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores), pa.array(sizes)],
                names=["doc_id", "held_out", "lang_pred", "score", "n_grams"])

    return docs.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double, n_grams long")


def op1_language_id(spark: SparkSession, root: str) -> DataFrame:
    docs = documents(spark, root)
    return identify(spark, docs, train(spark, docs.filter(learned_from("doc_id", 4, 2))))
