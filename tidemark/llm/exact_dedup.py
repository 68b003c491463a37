"""Exact deduplication: a two-pass Bloom filter spares unique texts the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import join_counted, staged, text_or_empty


def exact_groups(spark: SparkSession, docs: DataFrame, max_bits: int = 1 << 27) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``.

    Pass one sets the bits of every text hash in a blocked Bloom filter of 64-bit words and
    keeps the bits that were set at least twice. Pass two looks each hash up: a row with a
    bit that was set once has a text of its own and passes straight through. Only the others
    are grouped by hash and joined. The filter has 16 bits a row, at most ``max_bits``
    (2 Mi words, the bound of its broadcast); a fuller filter passes more rows to the
    grouping and never changes the result.

    Null text counts as empty. Of equal texts the largest doc_id stays; a null doc_id stays
    only among nulls. Rows that repeat a doc_id with one text share its verdict. An empty
    table gives an empty result.
    """
    rows = staged(spark, docs.select("doc_id", F.sha2(text_or_empty().cast("binary"), 256).alias("text_sha256")), "hashes")
    total = rows.count()
    bits = 1024
    while bits < min(16 * total, max_bits):
        bits *= 2
    h = F.xxhash64("text_sha256")
    low, high = h.bitwiseAND(63).cast("int"), F.shiftrightunsigned(h, 6).bitwiseAND(63).cast("int")
    keyed = rows.withColumn("word", F.pmod(F.shiftrightunsigned(h, 12), F.lit(bits // 64)))
    slots = keyed.select("word", F.explode(F.array_distinct(F.array(low, high))).alias("bit"))
    twice = slots.groupBy("word", "bit").agg(F.count("*").alias("n")).filter("n > 1")
    words = twice.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("seen"))
    keyed = keyed.withColumns({"low": low, "high": high})
    mask = F.expr("shiftleft(1L, low) | shiftleft(1L, high)")
    tested = keyed.join(F.broadcast(words), "word", "left").withColumn(
        "repeated", F.coalesce(F.col("seen").bitwiseAND(mask) == mask, F.lit(False)))
    tested = staged(spark, tested.select("doc_id", "text_sha256", "repeated"), "tested")
    alone = tested.filter(~F.col("repeated")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
        "text_sha256")
    maybe = tested.filter("repeated").select("doc_id", "text_sha256")
    groups = maybe.groupBy("text_sha256").agg(F.count("*").alias("n"), F.max("doc_id").alias("keep_id"))
    joined = join_counted(maybe, groups.withColumn("group_size", F.col("n")), "text_sha256", total)
    return alone.unionByName(joined.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"))


def op2_exact_dedup(spark: SparkSession, root: str) -> DataFrame:
    return exact_groups(spark, spark.read.parquet(f"{root}/documents.parquet"))


OP2_SQL = """
WITH t AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""
