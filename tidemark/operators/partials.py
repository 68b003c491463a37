"""Mergeable states: partial results per batch that merge into the full result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import ratio, whole


def distinct_rows(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Exact distinct state as rows: one per (keys, value). Any batch may be added."""
    return rows.select(*keys, value).distinct()


def merge_distinct_rows(states: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    return states.groupBy(*keys).agg(F.count_distinct(value).cast("bigint").alias(name))


def distinct_bitmaps(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Exact distinct state of integer ids as bitmaps: a word for 64 ids, so that a key with few ids takes few bytes."""
    at, word = F.col(value).cast("bigint"), F.lit(0).cast("bigint")
    bit = F.expr(f"shiftleft(1L, CAST(CAST(`{value}` AS bigint) & 63L AS int))")
    states = rows.select(*keys, F.shiftright(at, 6).alias("bucket"), F.coalesce(bit, word).alias("bits"))
    return states.groupBy(*keys, "bucket").agg(F.bit_or("bits").alias("bits"))


def merge_distinct_bitmaps(states: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    merged = states.groupBy(*keys, "bucket").agg(F.bit_or("bits").alias("bits"))
    return merged.groupBy(*keys).agg(F.sum(F.bit_count("bits")).cast("bigint").alias(name))


def distinct_sketches(rows: DataFrame, keys: Sequence[str], value: str, lg_k: int = 12) -> DataFrame:
    """Approximate distinct state: a sketch of bounded size per key."""
    return rows.groupBy(*keys).agg(F.hll_sketch_agg(value, lg_k).alias("sketch"))


def merge_distinct_sketches(states: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return states.groupBy(*keys).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).cast("bigint").alias(name))


def sum_states(rows: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """(sum, count) per key: merges into sums, counts and means."""
    return rows.groupBy(*keys).agg(F.sum(measure).cast("decimal(18,2)").alias("total"),
                                   F.count(measure).alias("n"))


def merge_sum_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    return states.groupBy(*keys).agg(
        F.sum("total").cast("decimal(18,2)").alias("total"), whole(F.sum("n")).alias("n"),
        ratio(F.sum("total"), F.sum("n")).alias("mean"))
