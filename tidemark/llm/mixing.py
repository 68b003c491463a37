"""Language-model scoring: bit predictions of several hashed contexts, mixed logistically with gated weights.

The text is lower-cased (A-Z) and read as bytes, then an end symbol, 0xFF, which UTF-8 never
uses. Each byte is eight binary decisions; contexts of 0 to 5 and of 7 bytes, none reaching
back beyond the white space before the word, each predict them from the counts in a hashed table. A weight vector, chosen by the longest known context, how often it was
seen and the bit's place in the byte, mixes the predictions; an adaptive map from mixed to seen probabilities
refines the result. All counts come from all learning texts: their distinct strings of a byte
and its context, with counts, are summed over the corpus, and tables, weights and map are learned from those.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import blocks, cuts, documents, held_out, learned_from, mix64, staged, text_or_empty
from tidemark.session import settings

CONTEXTS = (0, 1, 2, 3, 4, 5, 7)  # bytes
ORDERS, WIDTH = len(CONTEXTS), 8
SLOTS_LOG2 = 20
END = b"\xff"
GATES = ORDERS * 16 * 8  # longest known context, its count's logarithm, bit of the byte
PRIOR = 0.05
BUCKETS = 32
MAX = (1 << 64) - 1
BLOCK = 2 << 20  # a task's hash table of one block's keys takes some 20 times as much
SCORED = 1 << 20  # the same where the model is held besides
# A task holds the texts of a batch several times over: as they come, lower-cased and as keys.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def strings(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Key of every byte, end symbols included, and where each text's begin.

    The newest byte is lowest, then up to seven before it, back to the white space before the
    word (or the text's begin); places beyond hold 0.
    """
    data = np.frombuffer(END * (WIDTH - 1) + END.join(texts) + END, np.uint8)
    n = len(data) - WIDTH + 1
    key = np.zeros(n, np.uint64)
    for k in range(WIDTH - 1, -1, -1):
        key <<= np.uint64(8)
        key |= data[WIDTH - 1 - k:WIDTH - 1 - k + n]
    last = np.arange(len(data), dtype=np.int32)
    last[~((data == 32) | ((data >= 9) & (data <= 13)) | (data == 255))] = 0
    np.maximum.accumulate(last, out=last)
    back = np.arange(WIDTH - 1, len(data), dtype=np.int32)
    back -= last[WIDTH - 2:-1]
    kept = np.uint64(MAX) >> (np.uint64(8) * (WIDTH - 1 - np.arange(WIDTH)).astype(np.uint64))
    key &= kept[np.minimum(back, WIDTH - 1)]
    lengths = np.array([len(t) + 1 for t in texts])
    return key, np.cumsum(lengths) - lengths


def string_counts(docs: DataFrame) -> DataFrame:
    """(gram, n): distinct keys of all texts with counts, counted per block before they shuffle."""
    def run(batches):
        for batch in batches:
            for block in blocks((t.encode().lower() for t in batch.column("text").to_pylist()), BLOCK):
                code, keys = pd.factorize(strings([t for _, t in block])[0])
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.bincount(code, minlength=len(keys)).astype(np.int64))],
                                                 names=["gram", "n"])

    return docs.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def word_counts(docs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            found = Counter()
            for text in batch.column("text").to_pylist():
                for block in cuts(text.encode().lower()):
                    found.update(block.split())
                if len(found) > 500_000:
                    yield _counted(found)
                    found = Counter()
            yield _counted(found)

    return docs.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _counted(found: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], names=["word", "c"])


def decisions(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Table slots (order, gram, bit), tree nodes (gram, bit) and bits of the newest byte of each key."""
    byte = (grams & np.uint64(255)).astype(np.int64)
    depth = np.arange(8)
    node = (1 << depth) | (byte[:, None] >> (8 - depth))
    bit = (byte[:, None] >> (7 - depth)) & 1
    slots = np.empty((ORDERS, len(grams), 8), np.int64)
    for k, size in enumerate(CONTEXTS):
        context = (grams >> np.uint64(8)) & np.uint64((1 << 8 * size) - 1)
        h = mix64(context * np.uint64(8) + np.uint64(k + 1))[:, None] + node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        slots[k] = ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - SLOTS_LOG2)).astype(np.int64)
    return slots, node, bit


def table_counts(grams: DataFrame) -> DataFrame:
    """(slot, n): order, slot and bit in one number, with the number of times that bit was seen there."""
    def run(batches):
        total = np.zeros(ORDERS << (SLOTS_LOG2 + 1))
        for batch in batches:
            keys, n = batch.column("gram").to_numpy().view(np.uint64), batch.column("n").to_numpy()
            for at in range(0, len(keys), 1 << 15):
                slots, _, bit = decisions(keys[at:at + (1 << 15)])
                times = np.repeat(n[at:at + (1 << 15)], 8).astype(float)
                for k in range(ORDERS):
                    np.add.at(total, ((k << SLOTS_LOG2) + slots[k].ravel()) * 2 + bit.ravel(), times)
        seen = np.flatnonzero(total)
        for at in range(0, len(seen), 1 << 16):
            part = seen[at:at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], names=["slot", "n"])

    return grams.mapInArrow(run, "slot long, n double").groupBy("slot").agg(F.sum("n").alias("n"))


def place(mixed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = (mixed + 12) * (BUCKETS / 24)
    low = np.minimum(x.astype(np.int64), BUCKETS - 1)
    return low, x - low


class Mixer:
    """Fixed-size model: count tables, gated weights, refinement map."""

    def __init__(self, tables: np.ndarray):
        self.tables = tables.reshape(ORDERS, 1 << SLOTS_LOG2, 2)
        # At first the longest known context counts most.
        longest = np.arange(GATES) // (16 * 8)
        self.weights = np.full((GATES, ORDERS), 0.05)
        self.weights[np.arange(GATES), longest] = 0.7
        self.weights[np.arange(GATES), np.maximum(longest - 1, 0)] += 0.1
        self.map = np.zeros((256, BUCKETS + 1, 2))

    def inputs(self, grams: np.ndarray):
        slots, node, bit = decisions(grams)
        stretched = np.empty((ORDERS, *bit.shape))
        longest = np.zeros(bit.shape, np.int64)
        counted = np.zeros(bit.shape)
        for k in range(ORDERS):
            zero, one = self.tables[k, slots[k], 0].astype(float), self.tables[k, slots[k], 1].astype(float)
            zero -= 1 - bit  # this occurrence itself must not predict its bit
            one -= bit
            total = np.maximum(zero, 0) + np.maximum(one, 0)
            stretched[k] = np.where(total > 0, np.log((np.maximum(one, 0) + PRIOR) / (np.maximum(zero, 0) + PRIOR)), 0.0)
            longest[total > 0] = k
            counted = np.where(total > 0, total, counted)
        bucket = np.minimum(np.log2(counted + 1), 15).astype(np.int64)
        return stretched, (longest * 16 + bucket) * 8 + np.arange(8), node, bit

    def mixed(self, stretched, gate) -> np.ndarray:
        return np.clip((stretched * np.moveaxis(self.weights[gate], 2, 0)).sum(0), -12, 12)

    def learn(self, grams: np.ndarray, n: np.ndarray, squares: np.ndarray, rate: float = 0.02) -> None:
        """One online step: refine the map, then the weights, by what the current ones predict."""
        stretched, gate, node, bit = self.inputs(grams)
        mixed, times = self.mixed(stretched, gate), np.repeat(n, 8).reshape(bit.shape).astype(float)
        low, part = place(mixed)
        for step, share in ((0, 1 - part), (1, part)):
            np.add.at(self.map, (node, low + step, bit), times * share)
        error = (bit - 1 / (1 + np.exp(-mixed))) * times
        weight = np.bincount(gate.ravel(), times.ravel(), len(self.weights))
        for k in range(ORDERS):
            slope = np.bincount(gate.ravel(), (error * stretched[k]).ravel(), len(self.weights)) / np.maximum(weight, 1)
            squares[:, k] += slope**2
            self.weights[:, k] += rate * slope / np.sqrt(squares[:, k] + 1e-8)

    def fixed(self) -> Scorer:
        """The model as it is, without its counts."""
        stretched, gates = np.empty(self.tables.shape[:2]), np.empty(self.tables.shape[:2], np.uint8)
        for k in range(ORDERS):
            for at in range(0, 1 << SLOTS_LOG2, 1 << 16):
                part = slice(at, at + (1 << 16))
                zero, one = self.tables[k, part, 0].astype(float), self.tables[k, part, 1].astype(float)
                total = zero + one
                stretched[k, part] = np.where(total > 0, np.log((one + PRIOR) / (zero + PRIOR)), 0.0)
                gates[k, part] = np.where(total > 0, k * 16 + np.minimum(np.log2(total + 1), 15).astype(np.int64), 0)
        grid = 1 / (1 + np.exp(12 - np.arange(BUCKETS + 1) * (24 / BUCKETS)))
        return Scorer(stretched, gates, self.weights, (self.map[..., 1] + 8 * grid) / (self.map.sum(-1) + 8))


class Scorer:
    """A learned model for reading: what :class:`Mixer` works out of the counts of a slot is worked out once."""

    def __init__(self, stretched: np.ndarray, gates: np.ndarray, weights: np.ndarray, refined: np.ndarray):
        self.stretched, self.gates, self.weights, self.refined = stretched, gates, weights, refined

    def __reduce__(self):
        """Sent as plain bytes, which the arrays read then are views of: no second copy where it arrives."""
        return _scorer, tuple(x for a in (self.stretched, self.gates, self.weights, self.refined) for x in (a.tobytes(), a.dtype.str, a.shape))

    def log10(self, grams: np.ndarray) -> np.ndarray:
        """log10 probability of each key's newest byte after the older ones."""
        out = np.empty(len(grams))
        for at in range(0, len(grams), 1 << 14):
            slots, node, bit = decisions(grams[at:at + (1 << 14)])
            gate = self.gates[0][slots[0]]
            for k in range(1, ORDERS):  # the longest known context has the highest number
                np.maximum(gate, self.gates[k][slots[k]], out=gate)
            gate = gate.astype(np.int64) * 8 + np.arange(8)
            mixed = np.zeros(bit.shape)
            for k in range(ORDERS):
                mixed += self.stretched[k][slots[k]] * self.weights[:, k][gate]
            mixed = np.clip(mixed, -12, 12, out=mixed)
            p = 1 / (1 + np.exp(-mixed))
            low, part = place(mixed)
            refined = (1 - part) * self.refined[node, low] + part * self.refined[node, low + 1]
            p = np.clip((p + refined) / 2, 1e-6, 1 - 1e-6)
            out[at:at + (1 << 14)] = np.log10(np.where(bit == 1, p, 1 - p)).sum(1)
        return out


def _scorer(*parts) -> Scorer:
    return Scorer(*[np.frombuffer(raw, kind).reshape(shape) for raw, kind, shape in zip(*[iter(parts)] * 3, strict=True)])


def train(spark: SparkSession, docs: DataFrame) -> Mixer:
    """The model of all texts in ``docs``. The tables have a fixed size, so has what reaches the driver."""
    with settings(spark, BATCHES):
        grams = staged(spark, string_counts(docs), "strings")
    sums = table_counts(grams).withColumn("block", F.expr("slot >> 14")).groupBy("block").agg(
        F.collect_list(F.expr("cast(slot & 16383 as int)")).alias("at"), F.collect_list("n").alias("n"))  # at most 16,384 a block

    def dense(batches):
        for batch in batches:
            rows = []
            for at, n in zip(batch.column("at").to_pylist(), batch.column("n").to_pylist(), strict=True):
                block = np.zeros(1 << 14, np.float32)
                block[at] = n
                rows.append(block.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(rows, pa.binary())], names=["block", "data"])

    tables = np.zeros(ORDERS << (SLOTS_LOG2 + 1), np.float32)
    for row in sums.mapInArrow(dense, "block long, data binary").toLocalIterator():
        tables[row.block << 14:(row.block + 1) << 14] = np.frombuffer(row.data, np.float32)
    model = Mixer(tables)
    shared = spark.sparkContext.broadcast(tables)

    def learn(batches):
        own, squares, seen = Mixer(shared.value), np.zeros((GATES, ORDERS)), 0
        for batch in batches:
            keys, n = batch.column("gram").to_numpy().view(np.uint64), batch.column("n").to_numpy()
            for at in range(0, len(keys), 1 << 13):
                own.learn(keys[at:at + (1 << 13)], n[at:at + (1 << 13)], squares)
            seen += len(keys)
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array([float(seen)]), pa.array([own.weights.ravel().tolist()]), pa.array([own.map.ravel().tolist()])], names=["seen", "weights", "map"])

    # Tasks learn alone; their weights are averaged by what they saw, their maps added. Fixed size a task, summed by position.
    learned = staged(spark, grams.mapInArrow(learn, "seen double, weights array<double>, map array<double>"), "learned")
    total = learned.agg(F.sum("seen")).first()[0]
    if total:
        for name, value, target in (("weights", F.col("value") * F.col("seen") / total, model.weights), ("map", F.col("value"), model.map)):
            summed = learned.select("seen", F.posexplode(name).alias("at", "value")).groupBy("at").agg(F.sum(value).alias("v")).toPandas()
            target.ravel()[summed["at"].to_numpy()] = summed["v"].to_numpy()
    shared.unpersist()
    return model


def score(spark: SparkSession, docs: DataFrame, learning: DataFrame, held: str = "held_out", share: float = 2e-6) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte for every row of ``docs``.

    Null text counts as empty: its end alone is scored. Words that make up ``share`` of the
    learning tokens or more, at most 1 / share, are sent to all tasks; the counts of rarer
    words are joined. With nothing to learn from, counts are 0 and all bytes equally likely.
    """
    learning = learning.select(text_or_empty().alias("text"))
    words = staged(spark, word_counts(learning), "words")
    n_docs = learning.count()
    n_words, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    n_train, n_kinds = n_words + n_docs, distinct + (n_docs > 0)
    floor = max(1.0, share * n_train)
    common = words.filter(F.col("c") >= floor).toPandas()
    model = train(spark, learning)
    known = spark.sparkContext.broadcast(dict(zip(map(bytes, common["word"]), np.log10(common["c"] + 0.5).tolist(), strict=True)))
    shared = spark.sparkContext.broadcast(model.fixed())
    end = float(np.log10(n_docs + 0.5))

    def run(batches):
        m, table = shared.value, known.value
        for batch in batches:
            texts = [t.encode().lower() for t in batch.column("text").to_pylist()]
            model_score = np.zeros(len(texts))
            for block in blocks(texts, SCORED):
                keys, starts = strings([t for _, t in block])
                code, kinds = pd.factorize(keys)
                model_score[[at for at, _ in block]] = np.add.reduceat(m.log10(kinds)[code], starts)
            rows = []
            for text in texts:
                found = Counter()
                for block in cuts(text):
                    found.update(block.split())
                part, hits, rare = end, int(n_docs > 0), []
                for word, n in found.items():
                    value = table.get(word)
                    if value is None:
                        rare.append((word, n))
                    else:
                        part, hits = part + n * value, hits + n
                rows.append((sum(found.values()) + 1, hits, part, len(text), [w for w, _ in rare], [n for _, n in rare]))
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(model_score)]
                + [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [()] * 6, kinds, strict=True)],
                names=["doc_id", "held_out", "score", "n_tokens", "hits", "part", "n_bytes", "rare", "times"])

    scored = docs.select("doc_id", F.col(held).alias("held_out"), text_or_empty().alias("text")).mapInArrow(
        run, "doc_id long, held_out boolean, score double, n_tokens long, hits long, part double, n_bytes long, rare array<binary>, times array<long>")
    with settings(spark, BATCHES):
        scored = staged(spark, scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("row", F.col("w.rare").alias("word"), F.col("w.times").alias("times"))
    joined = rare.join(words.filter(F.col("c") < floor), "word", "left").groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("more_hits"),
        F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("more"))
    scale = float(np.log10(n_train + 0.5 * (n_kinds + 1)))
    return scored.join(joined, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("hits") + F.coalesce("more_hits", F.lit(0))).alias("n_known"), F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("part") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * F.lit(scale)).alias("base_score"), "score",
        (-F.col("score") * float(np.log2(10)) / (F.col("n_bytes") + 1)).alias("bits_per_byte"))


def op6_context_mixing(spark: SparkSession, root: str) -> DataFrame:
    docs = documents(spark, root)
    return score(spark, docs.withColumn("held_out", held_out("doc_id", 5, 1)), docs.filter(learned_from("doc_id", 5, 1)))
