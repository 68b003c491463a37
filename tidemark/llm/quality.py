"""Quality classifier: histogram gradient-boosted trees over statistics of whole texts."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import cuts, documents, held_out, learned_from, text_or_empty

FEATURES = ("log_bytes", "letters", "upper", "digits", "spaces", "lines", "marks", "stops", "non_ascii", "word_length",
            "long_words", "distinct_words", "top_word", "repeated_next", "distinct_lines", "marks_in_words", "entropy", "caps_words")


def _classes() -> np.ndarray:
    """Per byte value its membership in eight classes, as columns."""
    c = np.arange(256)
    letter = ((c >= 65) & (c <= 90)) | ((c >= 97) & (c <= 122)) | (c >= 128)
    digit, space = (c >= 48) & (c <= 57), (c == 32) | ((c >= 9) & (c <= 13))
    stop = np.isin(c, list(b".,;:?'\"-()"))
    return np.stack([letter, (c >= 65) & (c <= 90), digit, space, c == 10, ~letter & ~digit & ~space & ~stop & (c > 32), stop,
                     c >= 128], 1).astype(float)


CLASSES = _classes()


def statistics(text: str) -> np.ndarray:
    """Features of one whole text, taken block by block; an empty text has zeros."""
    out = np.zeros(len(FEATURES))
    raw = text.encode()
    if not raw:
        return out
    histogram, words, lines = np.zeros(256), Counter(), Counter()
    repeats = marked = caps = chars = long_words = 0
    last, open_line = None, []  # a line may go on in the next block
    for block in cuts(raw):
        histogram += np.bincount(np.frombuffer(block, np.uint8), minlength=256)
        found = block.split()
        words.update(found)
        first, *more = block.split(b"\n")
        open_line.append(first)
        if more:
            lines[hash(b"".join(open_line))] += 1
            lines.update(map(hash, more[:-1]))
            open_line = [more[-1]]
        repeats += sum(map(bytes.__eq__, found, [last] + found[:-1])) if last is not None else sum(map(bytes.__eq__, found[1:], found))
        last = found[-1] if found else last
    lines[hash(b"".join(open_line))] += 1
    n = sum(words.values())
    for word, times in words.items():
        chars += times * len(word)
        long_words += times * (len(word) > 12)
        caps += times * (len(word) > 1 and word.isupper())
        marked += times * (word[-1:] in b"!#$%&*|@^~=+<>{}[]\\/_" if word else 0)
    share = histogram / len(raw)
    out[0] = np.log1p(len(raw))
    out[1:9] = share @ CLASSES
    n_lines = sum(lines.values())
    out[9:] = (chars / max(n, 1), long_words / max(n, 1), len(words) / max(n, 1), max(words.values(), default=0) / max(n, 1),
               repeats / max(n, 1), len(lines) / max(n_lines, 1), marked / max(n, 1),
               -(share[share > 0] * np.log2(share[share > 0])).sum(), caps / max(n, 1))
    return out


class BoostedTrees:
    """Trees of equal depth in flat arrays: node k has the children 2k + 1 and 2k + 2; leaves follow the nodes."""

    def __init__(self, edges: list[np.ndarray], feature: np.ndarray, cut: np.ndarray, leaf: np.ndarray, base: float, depth: int):
        self.edges, self.feature, self.cut, self.leaf, self.base, self.depth = edges, feature, cut, leaf, base, depth

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)], 1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1; all rows walk all trees level by level."""
        bins, rows, trees = self.binned(x), np.arange(len(x))[:, None], np.arange(len(self.leaf))[None, :]
        node = np.zeros((len(x), len(self.leaf)), np.intp)
        for _ in range(self.depth):
            node = 2 * node + 1 + (bins[rows, self.feature[trees, node]] > self.cut[trees, node])
        total = self.base + self.leaf[trees, node - self.feature.shape[1]].sum(1)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.2, bins: int = 64, l2: float = 1.0) -> BoostedTrees:
    """Logistic boosting with second-order histogram splits, level by level."""
    rows, width = x.shape
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(width)] if rows else [np.zeros(0)] * width
    rate_one = float(np.clip(y.mean() if rows else 0.5, 1e-3, 1 - 1e-3))
    base = float(np.log(rate_one / (1 - rate_one)))
    inner = (1 << depth) - 1
    model = BoostedTrees(edges, np.zeros((trees, inner), np.intp), np.full((trees, inner), bins, np.intp),
                         np.zeros((trees, inner + 1)), base, depth)
    if not rows or y.min() == y.max():
        return model
    binned, total = model.binned(x), np.full(rows, base)
    flat = binned + np.arange(width) * bins
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess, node = p - y, p * (1 - p), np.zeros(rows, np.intp)
        for level in range(depth):
            first, n = (1 << level) - 1, 1 << level
            place = ((node - first)[:, None] * (width * bins) + flat).ravel()
            g, h = (np.bincount(place, np.repeat(v, width), n * width * bins).reshape(n, width, bins).cumsum(2) for v in (grad, hess))
            g_all, h_all = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + l2) + (g_all - g) ** 2 / (h_all - h + l2) - g_all**2 / (h_all + l2)
            gain[(h < 1e-2) | (h_all - h < 1e-2)] = 0
            best = gain.reshape(n, -1).argmax(1)
            some = gain.reshape(n, -1).max(1) > 1e-6
            model.feature[t, first:first + n] = best // bins
            model.cut[t, first:first + n] = np.where(some, best % bins, bins)
            node = 2 * node + 1 + (binned[np.arange(rows), model.feature[t, node]] > model.cut[t, node])
        leaf = node - inner
        model.leaf[t] = -rate * np.bincount(leaf, grad, inner + 1) / (np.bincount(leaf, hess, inner + 1) + l2)
        total += model.leaf[t, leaf]
    return model


def feature_rows(batch: pa.RecordBatch) -> np.ndarray:
    return np.array([statistics(t) for t in batch.column("text").to_pylist()]).reshape(-1, len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> BoostedTrees:
    """Fit on labelled rows that are not held out, at most ``sample`` of them (lowest id hash): the bound of what the driver gets.

    Rows with a null label teach nothing. Without labels, or with one label only, every score is the base rate.
    """
    chosen = (labels.filter("quality is not null").filter(learned_from("doc_id", 3, 1)).select("doc_id", "quality")
              .orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample))
    def run(batches):
        for batch in batches:
            x = feature_rows(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "quality", "x"])

    rows = (docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id")
            .select("doc_id", F.col("quality").cast("int"), "text")
            .mapInArrow(run, "doc_id long, quality int, x array<double>").toPandas().sort_values("doc_id", kind="stable"))
    x = np.stack(rows.x.tolist()) if len(rows) else np.zeros((0, len(FEATURES)))
    return fit(x, (rows.quality.to_numpy() > 0).astype(float))


def score(spark: SparkSession, docs: DataFrame, model: BoostedTrees) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; null text counts as empty. Rows don't depend on each other."""
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            s = shared.value.scores(feature_rows(batch)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), text_or_empty().alias("text")).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int")


def op3_quality(spark: SparkSession, root: str) -> DataFrame:
    docs = documents(spark, root)
    return score(spark, docs, train(docs, spark.read.parquet(f"{root}/labels.parquet")))
