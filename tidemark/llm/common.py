"""What the operators share: column choice, folds, text blocks, skew-safe joins, union-find.

Every operator reads only the columns it names, so further columns, whatever their names,
neither disturb it nor reach its result. Rows that repeat a ``doc_id`` are one document.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.versions import remove_folder
from tidemark.session import FREED, fresh_path, settings

# Keys with at least this share of all rows are joined by broadcast: they are at most 1 / share.
HOT_SHARE = 1e-3
CUT = 1 << 20
SPACE = re.compile(rb"[\t-\r ]")
ONE_TASK = 200_000
PAIRED = 32  # members of a group that are all paired with each other


def documents(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/documents.parquet")


def staged(spark: SparkSession, frame: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read again: later steps survive lost executors."""
    path = fresh_path(spark, label)
    with settings(spark, FREED):
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def discard(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete the folders that staged frames are read from; no later step may read them."""
    for frame in frames:
        for folder in {name.rpartition("/")[0] for name in frame.inputFiles()}:
            remove_folder(spark, folder)


def fold(key: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def held_out(key: str, folds: int, remainder: int) -> Column:
    """True for ids kept out of learning; a null id is never held out and never learned from."""
    return F.coalesce(fold(key, folds) == remainder, F.lit(False))


def learned_from(key: str, folds: int, remainder: int) -> Column:
    return F.coalesce(fold(key, folds) != remainder, F.lit(False))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def blocks(texts: Iterable[bytes], size: int) -> Iterator[list[tuple[int, bytes]]]:
    """(row number, text) lists of about ``size`` bytes; a list holds at least one text."""
    held, held_bytes = [], 0
    for at, text in enumerate(texts):
        if held and held_bytes + len(text) > size:
            yield held
            held, held_bytes = [], 0
        held.append((at, text))
        held_bytes += len(text)
    if held:
        yield held


def cuts(raw: bytes):
    """Blocks of a text of about CUT bytes, cut at white space only: a longer word stays whole."""
    at = 0
    while at < len(raw):
        end = at + CUT
        if end < len(raw):
            space = max(raw.rfind(c, at + 1, end) for c in b"\t\n\v\f\r ")
            if space < 0:
                later = SPACE.search(raw, end)
                space = later.start() if later else len(raw)
            end = space
        yield raw[at:end]
        at = end


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit keys (finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def join_counted(left: DataFrame, right: DataFrame, key: str, total: int) -> DataFrame:
    """Inner join with one ``right`` row per key, whose ``n`` counts the rows of ``left``.

    Keys with a share of HOT_SHARE or more, of which there are at most 1 / HOT_SHARE, are
    joined by broadcast, so no task of the shuffle gets a hot key. ``left`` is read twice.
    """
    hot = F.broadcast(right.filter(F.col("n") >= max(2.0, total * HOT_SHARE)).drop("n"))
    cold = right.filter(F.col("n") < max(2.0, total * HOT_SHARE)).drop("n")
    return left.join(hot, key).unionByName(left.join(hot.select(key), key, "left_anti").join(cold, key))


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(id, component_id): smallest id reachable, for every id on an edge (a, b).

    Alternating large-star and small-star rounds: each links the neighbours of a vertex to
    their minimum, until every component is a star. Rounds grow with the logarithm of its
    size. Each round is written to the shared folder; nothing but two sums reaches the driver.
    Up to ONE_TASK edges are read as one partition, so that their rounds need no exchange.
    """
    edges = staged(spark, edges.filter(F.col("a") != F.col("b"))
                   .select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "edges")
    state = None
    while True:
        n, code = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")), F.lit(0))).first()
        if (n, code) == state or n == 0:
            return edges.select(F.col("v").alias("id"), F.col("u").alias("component_id")).unionByName(
                edges.select(F.col("u").alias("id"), F.col("u").alias("component_id"))).distinct()
        state = n, code
        few = n <= ONE_TASK
        edges = edges.coalesce(1) if few else edges
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        both = both.coalesce(1) if few else both
        low = both.groupBy("v").agg(F.count("*").alias("n"), F.least(F.min("u"), F.first("v")).alias("m"))
        joined = both.filter("u > v").join(low, "v") if few else join_counted(both.filter("u > v"), low, "v", 2 * n)
        large = joined.select(F.col("u").alias("v"), F.col("m").alias("u")).filter("u < v").distinct()
        large = large if few else staged(spark, large, "large")
        low = large.groupBy("v").agg(F.count("*").alias("n"), F.min("u").alias("m"))
        joined = large.join(low, "v") if few else join_counted(large, low, "v", n)
        small = joined.select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), F.col("m")))).alias("e"))
        used = [edges] if few else [edges, large]
        edges = staged(spark, small.select(F.col("e.u").alias("v"), F.col("e.m").alias("u")).filter("u < v").distinct(), "small")
        discard(spark, *used)


def component_rounds(spark: SparkSession, shared: DataFrame, verify: Callable[[DataFrame], DataFrame], rounds: int = 2,
                     rekeyed: Callable[[DataFrame], tuple[DataFrame, str]] | None = None, state: DataFrame | None = None, fits: str = "true") -> DataFrame:
    """(id, component_id) of the graph of similar nodes that share a key; ``shared`` holds (key, node), ``verify`` keeps similar pairs (a, b).

    In each round one member of every group, drawn by hash and so the same in most groups of a
    cluster, is compared with the members that are not yet in its component. Groups that hang
    together are done. What is still apart after the rounds is compared in full across
    components: no link between components is lost, yet the members of one component are
    not all paired with each other.

    With ``rekeyed`` that holds for groups of up to PAIRED members only. The nodes of larger ones
    (column node) get keys of a rarer kind from it, of which every similar pair among them must share
    one, and go through the rounds again, from the components found: ``state``. Those rows may have
    more columns, for a condition on a pair, ``fits``, that holds at one of its shared keys at least.
    """
    more = [c for c in shared.columns if c not in ("key", "node")]
    given = shared, state  # what the caller staged stays
    for number in range(rounds + 1):
        named = shared.withColumn("part", F.col("node"))
        if state is not None:
            named = shared.join(state.withColumnRenamed("id", "node"), "node", "left").select(
                "key", "node", *more, F.coalesce("component_id", "node").alias("part"))
        order = F.struct(F.xxhash64("node", F.lit(number)), "node", "part")
        groups = named.groupBy("key").agg(F.count("*").alias("n"), F.min("part").alias("low"), F.max("part").alias("high"),
                                          F.min(order).alias("hub")).filter("low < high").select("key", "n", "hub.node", "hub.part")
        groups = staged(spark, groups.toDF("key", "n", "hub", "hub_part"), "groups")
        total = groups.agg(F.sum("n")).first()[0]
        if not total:
            break
        crowded = None
        if number == rounds and rekeyed is not None and not (large := groups.filter(F.col("n") > PAIRED)).isEmpty():
            crowded = staged(spark, join_counted(named, large.select("key", "n"), "key", total).select("node").distinct(), "crowded")
            groups = groups.filter(F.col("n") <= PAIRED)
        apart = join_counted(named, groups, "key", total)
        if number < rounds:
            pairs = apart.filter("part != hub_part").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
        else:
            apart = staged(spark, apart.select("key", "node", "part", *more), "apart")
            x, y = (apart.toDF("key", side, *[f"{c}_{side}" for c in ("part", *more)]) for side in "ab")
            pairs = x.join(y, "key").filter(f"a < b and part_a != part_b and {fits}").select("a", "b")
        links, used = verify(pairs.distinct()), [groups, *[f for f in (state,) if f is not None and f is not given[1]]]
        if state is not None:
            links = links.unionByName(state.filter("id != component_id").toDF("a", "b"))
        used += [*([apart] if number == rounds else []), *([shared] if shared is not given[0] else [])]
        shared = staged(spark, apart.select("key", "node", *more), "shared") if number < rounds else shared
        state = components(spark, links)
        discard(spark, *used)
        if crowded is not None:
            shared, fits = rekeyed(crowded)
            return component_rounds(spark, shared, verify, rounds, state=state, fits=fits)
    return state if state is not None else shared.select(F.col("node").alias("id"), F.col("node").alias("component_id")).limit(0)
