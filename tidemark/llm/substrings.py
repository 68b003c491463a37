"""Removal of byte strings that repeat an earlier place of the corpus, decided by suffix arrays.

Every window of ``length`` bytes belongs to the leftmost of its smallest gram hashes, its
anchor, which depends on the window's content alone: equal windows have equal anchors at equal
offsets. So windows of different anchors need never be compared. What reaches a suffix array
is one copy of each different context (the windows of one anchor occurrence) of anchors that
have several contexts; occurrences whose whole context repeats an earlier one are settled by it.
Anchors with very many different contexts are dealt on by the windows' own content.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, join_counted, mix64, staged, text_or_empty
from tidemark.llm.suffixes import common_prefixes, suffix_array

LENGTH, GRAM = 100, 24
MAX = np.uint64(0xFFFFFFFFFFFFFFFF)
BASE = 0x9E3779B97F4A7C15
SHARD_BYTES = 1 << 20  # a suffix array takes some 80 times as much
HOT = 10_000  # an anchor with more different contexts, of up to 176 bytes, goes to no suffix array


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes at every place, by doubling."""
    n_out = len(data) - gram + 1
    power, width, at = data.astype(np.uint64) + np.uint64(1), 1, 0
    total = np.zeros(n_out, np.uint64)
    while width <= gram:
        if gram & width:
            total = total * np.uint64(pow(BASE, width, 1 << 64)) + power[at:at + n_out]
            at += width
        if 2 * width <= gram:
            power = power[:len(power) - width] * np.uint64(pow(BASE, width, 1 << 64)) + power[width:]
        width *= 2
    return mix64(total)


def sliding(x: np.ndarray, width: int, pick: np.ufunc, fill: np.uint64) -> np.ndarray:
    """Minimum or maximum of every ``width`` neighbours, from running ones over blocks of that width."""
    n = len(x)
    padded = np.full(-(-n // width) * width, fill)
    padded[:n] = x
    padded = padded.reshape(-1, width)
    ahead = pick.accumulate(padded, 1).ravel()
    back = pick.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
    return pick(ahead[width - 1:n], back[:n - width + 1])


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(hash, context hash, first window start, last window start) of every anchor of one text.

    Window starts of an anchor are neighbours, as the leftmost minimum never moves back.
    """
    width = length - gram + 1
    h = gram_hashes(data, gram)
    low = sliding(h, width, np.minimum, MAX)
    # The next place at or after each window start that holds the window's minimum: grams equal
    # to their own window minimum, looked up in order.
    spread = np.concatenate([np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)])
    chosen = np.flatnonzero(sliding(spread, width, np.maximum, np.uint64(0)) == h)
    starts = np.arange(len(low))
    k = np.searchsorted(chosen, starts)
    late = np.flatnonzero(h[chosen[k]] != low)
    while len(late):  # an earlier chosen place of a larger hash lies before the minimum
        k[late] += 1
        late = late[h[chosen[k[late]]] != low[late]]
    own = chosen[k]
    first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    last = np.append(first[1:], len(own)) - 1
    # Context hash: the gram hashes at the context's ends and steps between cover all its bytes.
    size = last - first + length
    code = mix64(size.astype(np.uint64)) ^ mix64((own[first] - first).astype(np.uint64) + np.uint64(977))
    for at in range(0, int(size.max()) - gram + 1, gram):
        inside = at + gram <= size
        code[inside] = mix64(code[inside] * np.uint64(BASE) + h[first[inside] + at])
    code = mix64(code * np.uint64(BASE) + h[last + length - gram])
    return h[own[first]], code, first, last


def anchor_rows(docs: DataFrame) -> DataFrame:
    """hash, code, doc, place (start and number of windows) of all anchors; texts under LENGTH bytes have none."""
    def run(batches):
        for batch in batches:
            parts: list[list[np.ndarray]] = []
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), strict=True):
                raw = text.encode()
                if len(raw) >= LENGTH:
                    h, code, first, last = anchors(np.frombuffer(raw, np.uint8))
                    parts.append([h.view(np.int64), code.view(np.int64), np.full(len(h), doc), first * 128 + (last - first)])
                if len(parts) >= 1000:
                    yield _columns(parts, ("hash", "code", "doc", "place"))
                    parts = []
            if parts:
                yield _columns(parts, ("hash", "code", "doc", "place"))

    return docs.mapInArrow(run, "hash long, code long, doc long, place long")


def _columns(parts: list[list[np.ndarray]], names: tuple[str, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], names=list(names))


def settle(batches):
    """Rows of one partition, sorted by (hash, code, doc, place), to (doc, place, whole): an occurrence whose context
    an earlier one has is settled (whole), the first of each of several contexts of an anchor goes to a suffix array."""
    held = None  # the last first-of-its-context row, and whether it was sent
    sent = False
    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        h, code, doc, place = (batch.column(k).to_numpy() for k in range(4))
        again = np.append(before is not None and (h[0], code[0], doc[0], place[0]) == before,
                          (h[1:] == h[:-1]) & (code[1:] == code[:-1]) & (doc[1:] == doc[:-1]) & (place[1:] == place[:-1]))
        h, code, doc, place = h[~again], code[~again], doc[~again], place[~again]  # a repeated row of the table
        if not len(h):
            continue
        new_hash = np.append(before is None or h[0] != before[0], h[1:] != h[:-1])
        new_code = new_hash | np.append(before is None or code[0] != before[1], code[1:] != code[:-1])
        before = h[-1], code[-1], doc[-1], place[-1]
        first = np.flatnonzero(new_code)
        rows = [np.stack([h[~new_code], doc[~new_code], place[~new_code], np.ones((~new_code).sum(), np.int64)])]
        if len(first):
            firsts = np.stack([h[first], doc[first], place[first]])
            if held is not None:
                if firsts[0, 0] == held[0]:
                    rows += [] if sent else [np.append(held, 0)[:, None]]
            same = firsts[0, 1:] == firsts[0, :-1]
            with_before = np.append(held is not None and firsts[0, 0] == held[0], same)
            several = with_before | np.append(same, False)
            rows.append(np.vstack([firsts[:, several], np.zeros(several.sum(), np.int64)]))
            held, sent = firsts[:, -1], bool(several[-1])
        out = np.concatenate(rows, 1)
        if out.shape[1]:
            yield pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1]), pa.array(out[2]), pa.array(out[3] == 1)],
                                             names=["hash", "doc", "place", "whole"])


def contexts(asked: DataFrame, docs: DataFrame) -> DataFrame:
    """hash, doc, place, context bytes: one row per document joins its text, so no document is read per context."""
    per_doc = asked.groupBy("doc").agg(F.collect_list("hash").alias("hashes"), F.collect_list("place").alias("places"))

    def run(batches):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        rows: list[tuple] = []

        def flushed():
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names=["hash", "doc", "place", "context"])

        for batch in batches:
            for text, doc, hashes, places in zip(*(batch.column(k).to_pylist() for k in ("text", "doc", "hashes", "places")), strict=True):
                raw = text.encode()
                rows += [(h, doc, p, raw[p // 128:p // 128 + p % 128 + LENGTH]) for h, p in zip(hashes, places, strict=True)]
                if len(rows) > 20_000:
                    yield flushed()
        if rows:
            yield flushed()

    return docs.join(per_doc, "doc").select("text", "doc", "hashes", "places").mapInArrow(
        run, "hash long, doc long, place long, context binary")


def shard_runs(contexts_: list[bytes], doc: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, first start, last start) of runs of windows that an earlier place has too, by one suffix array."""
    lengths = np.array([len(c) for c in contexts_])
    data = np.frombuffer(b"\xff".join(contexts_) + b"\xff", np.uint8)  # 0xFF is in no UTF-8 text
    begins = np.cumsum(lengths + 1) - lengths - 1
    row = np.repeat(np.arange(len(lengths)), lengths + 1)
    offset = np.arange(len(data)) - begins[row]
    order = suffix_array(np.append(data.astype(np.int64) + 1, 0), 257)[1:]
    order = order[offset[order] + LENGTH <= lengths[row[order]]]
    shared = common_prefixes(np.concatenate([data, np.zeros(LENGTH + 8, np.uint8)]), order, LENGTH)
    group = np.cumsum(shared[order] < LENGTH)
    at, which = first[row[order]] + offset[order], doc[row[order]]
    by_place = np.lexsort((at, which, group))
    repeated = np.sort(order[by_place[np.append(False, np.diff(group[by_place]) == 0)]])
    if not len(repeated):
        return (np.zeros(0, np.int64),) * 3
    cut = np.append(True, np.diff(repeated) > 1)
    begin, end = repeated[cut], repeated[np.append(cut[1:], True)]
    return row[begin], offset[begin], offset[end]


def compare(batches):
    """Contexts of a partition, sorted by hash, to runs of repeated window starts; anchors share suffix arrays of about SHARD_BYTES."""
    held: list[tuple] = []
    size = 0

    def solve(rows):
        doc = np.array([r[1] for r in rows])
        first = np.array([r[2] for r in rows]) // 128
        row, begin, end = shard_runs([r[3] for r in rows], doc, first)
        return pa.RecordBatch.from_arrays([pa.array(doc[row]), pa.array(first[row] + begin), pa.array(first[row] + end)],
                                          names=["doc", "begin", "end"])

    for batch in batches:
        for r in zip(*(batch.column(k).to_pylist() for k in ("hash", "doc", "place", "context")), strict=True):
            if size >= SHARD_BYTES and r[0] != held[-1][0]:
                yield solve(held)
                held, size = [], 0
            if held and held[-1][:3] == r[:3]:  # a repeated row of the table
                continue
            held.append(r)
            size += len(r[3])
    if held:
        yield solve(held)


def window_rows(near: DataFrame) -> DataFrame:
    """key (anchor and hash of the LENGTH bytes), doc, at: every window of the contexts."""
    def run(batches):
        for batch in batches:
            found = batch.column("context").to_pylist()
            if not found:
                continue
            lengths = np.array([len(c) for c in found])
            code = gram_hashes(np.frombuffer(b"".join(found), np.uint8), LENGTH).view(np.int64)
            n = lengths - LENGTH + 1
            row = np.repeat(np.arange(len(found)), n)
            offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            h, doc, place = (batch.column(c).to_numpy()[row] for c in ("hash", "doc", "place"))
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(code[(np.cumsum(lengths) - lengths)[row] + offset]), pa.array(doc), pa.array(place // 128 + offset)],
                                             names=["hash", "code", "doc", "at"])

    return near.mapInArrow(run, "hash long, code long, doc long, at long").select(F.struct("hash", "code").alias("key"), "doc", "at")


def hot_runs(spark: SparkSession, near: DataFrame) -> DataFrame:
    """Runs (one window each) of contexts of hot anchors: the earliest place of each window's content is found before the
    exchange in each task, and no task gets all contexts of an anchor."""
    windows = staged(spark, window_rows(near), "windows")
    low = windows.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("doc", "at")).alias("first")).filter("n > 1")
    again = join_counted(windows, staged(spark, low, "first"), "key", windows.count()).filter(F.struct("doc", "at") != F.col("first"))
    return again.select("doc", F.col("at").alias("begin"), F.col("at").alias("end"))


def divided(spark: SparkSession, asked: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Contexts of anchors with up to HOT of them, and those of the others, if there are any."""
    hot = staged(spark, asked.groupBy("hash").agg(F.count("*").alias("n")).filter(F.col("n") > HOT).select("hash"), "hot")  # a HOT-th of the rows at most
    if hot.isEmpty():
        return asked, None
    return asked.join(F.broadcast(hot), "hash", "left_anti"), asked.join(F.broadcast(hot), "hash", "left_semi")


def repeated_runs(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc, begin, end: window starts from begin to end whose LENGTH bytes also start earlier in the corpus."""
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    rows = anchor_rows(docs).repartition(int(parts), "hash").sortWithinPartitions("hash", "code", "doc", "place")
    settled = staged(spark, rows.mapInArrow(settle, "hash long, doc long, place long, whole boolean"), "settled")
    whole = settled.filter("whole").select("doc", F.expr("place div 128").alias("begin"), F.expr("place div 128 + place % 128").alias("end"))
    cold, hot = divided(spark, settled.filter("not whole").select("hash", "doc", "place"))
    near = contexts(cold, docs)
    near = near.repartition(int(parts), "hash").sortWithinPartitions("hash", "doc", "place").mapInArrow(
        compare, "doc long, begin long, end long")
    if hot is not None:
        near = near.unionByName(hot_runs(spark, contexts(hot, docs)))
    return staged(spark, whole.unionByName(near), "runs")


def spans_of(begins: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """Byte spans covered by the windows, joined where they meet."""
    out: list[list[int]] = []
    for begin, end in sorted(zip(begins, ends, strict=True)):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end + LENGTH)
        else:
            out.append([begin, end + LENGTH])
    return [(a, b) for a, b in out]


def remove_repeats(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, kept_bytes, spans (arrays of begin and end) for every document that loses bytes."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc"), text_or_empty().alias("text")).filter("doc is not null")
    per_doc = repeated_runs(spark, docs).groupBy("doc").agg(F.collect_list("begin").alias("begins"), F.collect_list("end").alias("ends"))

    def run(batches):
        for batch in batches:
            out = []
            for doc, text, begins, ends in zip(*(batch.column(k).to_pylist() for k in ("doc", "text", "begins", "ends")), strict=True):
                raw, spans = text.encode(), spans_of(begins, ends)
                kept, at = [], 0
                for a, b in spans:
                    kept.append(raw[at:a])
                    at = b
                out.append((doc, b"".join([*kept, raw[at:]]), [a for a, _ in spans], [b for _, b in spans]))
            if out:
                ids, kept, begins, ends = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(kept, pa.binary()), pa.array(begins, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64()))],
                    names=["doc_id", "kept_bytes", "begins", "ends"])

    return docs.join(per_doc, "doc").select("doc", "text", "begins", "ends").mapInArrow(
        run, "doc_id long, kept_bytes binary, begins array<long>, ends array<long>")


def substring_dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row.

    Null text counts as empty; texts under LENGTH bytes, empty ones and rows without a doc_id
    keep everything. Of equal strings the one in the smallest doc_id, then at the earliest
    start, stays. Rows that repeat a doc_id with one text are one document.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text_or_empty()).cast("long").alias("n_bytes"),
                       F.sha2(text_or_empty().cast("binary"), 256).alias("whole_sha"))
    lost = remove_repeats(spark, docs).select(
        "doc_id", F.octet_length("kept_bytes").alias("left"), F.size("begins").alias("spans"), F.sha2("kept_bytes", 256).alias("kept_sha"))
    return base.join(staged(spark, lost, "lost").dropDuplicates(["doc_id"]), "doc_id", "left").select(
        "doc_id", "n_bytes", F.coalesce(F.col("n_bytes") - F.col("left"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("kept_sha", "whole_sha").alias("kept_sha256"))


def op8_suffix_array_dedup(spark: SparkSession, root: str) -> DataFrame:
    return substring_dedup(spark, documents(spark, root))


OP8_SQL = r"""
WITH raw AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (SELECT doc_id, h, length(h) // 2 AS n FROM raw),
starts AS (SELECT doc_id, unnest(range(0, n - 99)) AS place FROM sized WHERE n >= 100),
windows AS (SELECT doc_id, place, md5(substr(h, 2 * place + 1, 200)) AS m FROM starts JOIN sized USING (doc_id)),
again AS (SELECT doc_id, place FROM (SELECT doc_id, place, row_number() OVER (PARTITION BY m ORDER BY doc_id, place) AS nth FROM windows) WHERE nth > 1),
runs AS (
  SELECT doc_id, min(place) AS low, max(place) + 100 AS high
  FROM (SELECT doc_id, place, sum(fresh) OVER (PARTITION BY doc_id ORDER BY place) AS run
        FROM (SELECT doc_id, place, CASE WHEN place <= lag(place) OVER (PARTITION BY doc_id ORDER BY place) + 100 THEN 0 ELSE 1 END AS fresh FROM again))
  GROUP BY doc_id, run),
cut AS (
  SELECT doc_id, high AS low, lead(low) OVER (PARTITION BY doc_id ORDER BY low) AS high FROM runs
  UNION ALL SELECT doc_id, 0, min(low) FROM runs GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * low + 1, 2 * (coalesce(high, n) - low)), '' ORDER BY low) AS rest
  FROM cut JOIN sized USING (doc_id) GROUP BY doc_id),
totals AS (SELECT doc_id, sum(high - low) AS gone, count(*) AS spans FROM runs GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
       sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM sized LEFT JOIN totals USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
