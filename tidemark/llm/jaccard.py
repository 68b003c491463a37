"""Similarity join of documents on word n-grams by parity sketches.

A set's sketch XORs the hashes of its members. A member that only one of two sets holds
changes one chunk of the sketch, so sets that differ in d members have at most d different
chunks: with d + 1 chunks one at least is equal (pigeonhole), and sets that share a chunk are
candidates. Keys that many dissimilar sets share, those of a common passage, give way to the sets'
rarest members (prefix filter). A second sketch of one bit a member, folded to 512 bits, bounds the difference of a
candidate pair from below. What passes is compared member by member.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import component_rounds, cuts, documents, join_counted, mix64, staged

SKETCH_BITS = 512
SLOTS_LOG2, BLOCK = 18, 4096  # counts of members by their highest bits, known to all tasks; slots of one row


class _WordHashes(dict):
    def __missing__(self, word):
        if len(self) >= 1 << 20:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str | None, width: int, memo: _WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; with fewer words one for the whole sequence, without any none."""
    raw = (text or "").encode().lower()
    words = np.concatenate([np.fromiter(map(memo.__getitem__, block.split()), np.uint64) for block in cuts(raw)]
                           or [np.zeros(0, np.uint64)])
    if not len(words):
        return words
    n = min(width, len(words))
    h = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[k:len(words) - n + 1 + k]
    return np.unique(mix64(h))


def bands_of(n: int, percent: int):
    """(band, highest size) of the size bands in which a set of ``n`` members takes part: its own, as either side of a
    pair, and lower ones whose sets it can pair with."""
    low, high, band = 1, 1, 0
    bands = [(0, 1)]
    while high < n:
        low = high + 1
        high = low * 3 // 2
        band += 1
        bands.append((band, high))
    return [b for b in bands if n * percent <= b[1] * 100 or b is bands[-1]]


def sketch_keys(members: np.ndarray, percent: int) -> np.ndarray:
    """Join keys of a set: its sketch chunks in each of its bands.

    There are more chunks than a pair of the band can differ in, with slack for chunks that
    are empty in both sets. A set with more empty chunks than the slack adds its prefix keys:
    sets this similar share a member among the first n - ceil(percent n / 100) + 1, in hash order.
    """
    n, out = len(members), []
    bits = mix64(members ^ np.uint64(0x5851F42D4C957F2D))
    for band, high in bands_of(n, percent):
        differ = (high + high * 100 // percent) * (100 - percent) // (100 + percent)
        slack = 2 + differ // 16
        chunks = differ + 1 + slack
        salt = mix64(np.array([band], np.uint64) + np.uint64(1 << 40))
        chunk = ((members >> np.uint64(32)) * np.uint64(chunks)) >> np.uint64(32)
        first = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1]))
        out.append(mix64(np.bitwise_xor.reduceat(bits, first) + mix64(chunk[first] ^ salt)))
        if chunks - len(first) > slack:
            prefix = members[:n - -(-percent * n // 100) + 1]
            out.append(mix64(prefix + mix64(salt + np.uint64(7))))
    return np.concatenate(out)


def sketched(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, size, fp (set fingerprint), sketch and keys; keys only where the task first meets a set on a row with a doc_id."""
    def run(batches):
        memo, met = _WordHashes(), set()
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                s = shingles(text, width, memo)
                if not len(s):
                    rows.append((0, 0, b"", []))
                    continue
                fp = int(mix64(np.bitwise_xor.reduce(s, keepdims=True) + np.add.reduce(mix64(s), keepdims=True)).view(np.int64)[0])
                fold = np.bincount((mix64(s) & np.uint64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1
                if len(met) > 1 << 20:
                    met.clear()
                rows.append((len(s), fp, np.packbits(fold.astype(np.uint8)).tobytes(),
                             [] if doc is None or fp in met else sketch_keys(s, percent).view(np.int64)))
                if doc is not None:
                    met.add(fp)
            size, fp, sketch, keys = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(fp, pa.int64()), pa.array(sketch, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "size", "fp", "sketch", "keys"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, size long, fp long, sketch binary, keys array<long>")


def shared_only(batches, more=()):
    """Of a partition sorted by (key, fp), the rows of keys that several different sets have, each once; ``more`` are columns to keep."""
    held, sent = None, False  # the last row, and whether it was sent
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch.column(c).to_numpy() for c in ("key", "fp", *more)]
        if held is not None:
            rows = [np.append(h, r) for h, r in zip(held, rows, strict=True)]
        key, fp = rows[:2]
        fresh = np.append(True, (key[1:] != key[:-1]) | (fp[1:] != fp[:-1]))
        rows = [r[fresh] for r in rows]
        key = rows[0]
        same = key[1:] == key[:-1]
        several = np.append(same, False) | np.append(False, same)
        if held is not None and sent:
            several[-1] |= len(key) == 1
        out = several.copy()
        if held is not None and sent:
            out[0] = False
        held, sent = [r[-1] for r in rows], bool(several[-1])
        yield pa.RecordBatch.from_arrays([pa.array(r[out]) for r in rows], names=["key", "node", *more])


def bounded(batches, percent: int):
    """Pairs whose sizes and sketches allow the similarity."""
    for batch in batches:
        sa, sb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, SKETCH_BITS // 8) for c in ("sketch_a", "sketch_b"))
        na, nb = (batch.column(c).to_numpy() for c in ("size_a", "size_b"))
        least = np.bitwise_count(sa ^ sb).sum(1, dtype=np.int64)
        ok = (least * (100 + percent) <= (na + nb) * (100 - percent)) & (np.minimum(na, nb) * 100 >= np.maximum(na, nb) * percent)
        yield batch.select(["a", "b"]).filter(pa.array(ok))


def exact(batches, percent: int):
    """Pairs whose members reach the similarity."""
    for batch in batches:
        ok = []
        for x, y in zip(batch.column("ma").to_pylist(), batch.column("mb").to_pylist(), strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            ok.append(100 * both >= percent * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


def ranked(members: np.ndarray, common: np.ndarray, times: np.ndarray, shift: int = 0) -> np.ndarray:
    """Members from the rarest to the most frequent, equal ones by hash; those that, without their lowest ``shift`` bits,
    aren't among the ``common`` ones, sorted, come first."""
    if not len(common):
        return members
    names = members >> np.uint64(shift)
    at = np.minimum(np.searchsorted(common, names), len(common) - 1)
    return members[np.lexsort((members, np.where(common[at] == names, times[at], 0)))]


def slot_counts(spark: SparkSession, sets: DataFrame) -> np.ndarray:
    """How often members of the sets fall into each slot. A task's counts, and their sums, are rows of BLOCK slots."""
    def added(batches):
        total = np.zeros(((1 << SLOTS_LOG2) // BLOCK, BLOCK), np.int64)
        for batch in batches:
            for block, raw in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                total[block] += np.frombuffer(raw, np.int64)
        yield from _filled(total)

    def counted(batches):
        total = np.zeros(1 << SLOTS_LOG2, np.int64)
        for batch in batches:
            for raw in batch.column("members").to_pylist():
                np.add.at(total, (np.frombuffer(raw, np.uint64) >> np.uint64(64 - SLOTS_LOG2)).astype(np.int64), 1)
        yield from _filled(total.reshape(-1, BLOCK))

    schema = "block int, counts binary"
    sums = sets.select("members").mapInArrow(counted, schema).repartition(8, "block").mapInArrow(added, schema)
    total = np.zeros(1 << SLOTS_LOG2, np.int64)
    for row in sums.collect():  # a row a block
        total[row.block * BLOCK:(row.block + 1) * BLOCK] = np.frombuffer(row.counts, np.int64)
    return total


def _filled(total: np.ndarray):
    """The blocks that hold a count."""
    found = np.flatnonzero(total.any(1))
    yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array([total[b].tobytes() for b in found], pa.binary())], names=["block", "counts"])


def rare_keys(spark: SparkSession, sets: DataFrame, percent: int) -> tuple[DataFrame, str]:
    """(key, node, size, rest) of sets (fp, members): the rarest n - ceil(percent n / 100) + 1 members, one of which similar sets
    share, with the number of members from there on. The first member that two sets share leaves them no more than the lesser
    rest in common, which is the condition on a pair that comes with the keys.

    Any order of all members will do, as long as it is one for all sets: it is that of the
    counts of the members' slots, a table of fixed size, and then of hashes.
    """
    counts = slot_counts(spark, sets)
    common = np.flatnonzero(counts)
    shared = spark.sparkContext.broadcast((common.astype(np.uint64), counts[common]))
    shift = 64 - SLOTS_LOG2

    def prefixes(batches):
        for batch in batches:
            found = [np.frombuffer(m, np.uint64) for m in batch.column("members").to_pylist()]
            if not found:
                continue
            rarest = [ranked(m, *shared.value, shift)[:len(m) - -(-percent * len(m) // 100) + 1] for m in found]
            n, taken = np.array([len(m) for m in found]), np.array([len(r) for r in rarest])
            size, place = np.repeat(n, taken), np.concatenate([np.arange(k) for k in taken])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(rarest).view(np.int64)), pa.array(np.repeat(batch.column("fp").to_numpy(), taken)),
                                              pa.array(size), pa.array(size - place)], names=["key", "fp", "size", "rest"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = sets.select("fp", "members").mapInArrow(prefixes, "key long, fp long, size long, rest long")
    rare = keyed.repartition(parts, "key").sortWithinPartitions("key", "fp").mapInArrow(
        lambda rows: shared_only(rows, ("size", "rest")), "key long, node long, size long, rest long")
    return staged(spark, rare, "rare"), f"least(rest_a, rest_b) * {100 + percent} >= (size_a + size_b) * {percent}"


def similar_sets(spark: SparkSession, marked: DataFrame, sets: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(id, component_id) over set fingerprints."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = marked.select(F.explode("keys").alias("key"), "fp")
    shared = staged(spark, keyed.repartition(parts, "key").sortWithinPartitions("key", "fp").mapInArrow(
        shared_only, "key long, node long"), "shared")
    asked = staged(spark, shared.select(F.col("node").alias("fp")).distinct().join(sets, "fp"), "asked")
    wanted = asked.select("fp", F.col("rep").alias("doc_id"))
    if asked.count() <= 1_000_000:  # 16 bytes a row; more are joined by shuffle
        wanted = F.broadcast(wanted)

    def members(batches):
        memo = _WordHashes()
        for batch in batches:
            found = [shingles(t, width, memo).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("fp"), pa.array(found, pa.binary())], names=["fp", "members"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id").dropDuplicates(["fp"])
    held = staged(spark, texts.select("fp", "text").mapInArrow(members, "fp long, members binary"), "members")
    light = asked.select("fp", "size", "sketch")

    def verify(pairs):
        pairs = pairs.join(light.toDF("a", "size_a", "sketch_a"), "a").join(light.toDF("b", "size_b", "sketch_b"), "b")
        pairs = staged(spark, pairs.mapInArrow(lambda rows: bounded(rows, percent), "a long, b long"), "bounded")
        full = pairs.join(held.toDF("a", "ma"), "a").join(held.toDF("b", "mb"), "b").select("a", "b", "ma", "mb")
        return full.mapInArrow(lambda rows: exact(rows, percent), "a long, b long")

    def rekeyed(nodes):
        wanted = nodes.withColumnRenamed("node", "fp")
        if nodes.count() <= 1_000_000:  # 8 bytes a row
            wanted = F.broadcast(wanted)
        return rare_keys(spark, held.join(wanted, "fp", "left_semi"), percent)

    return component_rounds(spark, shared, verify, rekeyed=rekeyed)


def near_groups(spark: SparkSession, docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id for every row.

    Documents without words have the size 0 and are a component of their own, as are rows
    without a doc_id (null). Documents with equal sets are one node of the join. Sets are
    named by 64-bit fingerprints and members by 64-bit hashes.
    """
    marked = staged(spark, sketched(docs, width, percent), "sketches")
    sets = staged(spark, marked.filter("size > 0 and doc_id is not null").groupBy("fp", "size").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("rep"), F.min("sketch").alias("sketch")), "sets")
    state = similar_sets(spark, marked.filter("size > 0 and doc_id is not null"), sets, docs, width, percent)
    named = sets.join(state.withColumnRenamed("id", "fp"), "fp", "left").select("fp", "n", "rep", F.coalesce("component_id", "fp").alias("part"))
    named = staged(spark, named, "named")
    low = named.groupBy("part").agg(F.min("rep").alias("component_id"), F.count("*").alias("n"))
    sets_n = sets.count()
    final = join_counted(named.withColumnRenamed("n", "copies"), low, "part", sets_n).select("fp", F.col("copies").alias("n"), "component_id")
    rows = marked.select("doc_id", "size", "fp")
    linked = join_counted(rows.filter("size > 0 and doc_id is not null"), staged(spark, final, "final"), "fp", rows.count())
    alone = rows.filter("size = 0 or doc_id is null").select("doc_id", "size", F.col("doc_id").alias("component_id"))
    return linked.select("doc_id", "size", "component_id").unionByName(alone).withColumnRenamed("size", "n_shingles")


def op10_ngram_jaccard(spark: SparkSession, root: str) -> DataFrame:
    return near_groups(spark, documents(spark, root))


OP10_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) BETWEEN 1 AND 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id AS id, doc_id AS root FROM documents UNION SELECT b, root FROM reached JOIN both_ways ON a = id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, root AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT id, min(root) AS root FROM reached GROUP BY id) ON id = d.doc_id
"""
