"""Near-duplicate vectors by a robust-pruned flat graph built on overlapping cluster shards."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import components, join_counted, staged

POOL, DEGREE, ALPHA, BEAM = 48, 20, 1.2, 24
EDGES = 1 << 20  # edges that a search expands at once
SPLIT = 2_000  # a shard of more than two times as many nodes is compared in parts of this size


def unit(rows: list) -> np.ndarray:
    x = np.array(rows, float)
    x /= np.abs(x).max(1, keepdims=True)  # squares of extreme components stay finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def prune(x: np.ndarray) -> np.ndarray:
    """Neighbours (row, DEGREE) of each vector, -1 where there are fewer.

    Candidates are the nearest of the shard, taken in blocks. The nearest one left is kept and
    rules out those that are ALPHA times nearer to it than to the vector itself.
    """
    n = len(x)
    out = np.full((n, DEGREE), -1, np.int64)
    size = min(POOL, n - 1)
    if size < 1:
        return out
    for at in range(0, n, 256):
        own = np.arange(at, min(at + 256, n))
        near = x[own] @ x.T
        near[own - at, own] = -2
        pool = np.argpartition(-near, size - 1, axis=1)[:, :size]
        apart = 2 - 2 * np.take_along_axis(near, pool, 1)
        order = np.argsort(apart, axis=1, kind="stable")
        pool, apart = np.take_along_axis(pool, order, 1), np.take_along_axis(apart, order, 1)
        between = 2 - 2 * np.einsum("bid,bjd->bij", x[pool], x[pool])
        alive = np.ones(pool.shape, bool)
        rows = np.arange(len(own))
        for k in range(DEGREE):
            some = alive.any(1)
            pick = alive.argmax(1)
            out[own[some], k] = pool[rows[some], pick[some]]
            alive &= ALPHA * ALPHA * between[rows, pick] > apart
            alive[rows, pick] = False
    return out


def dots(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows a and b, in blocks."""
    step = 1 << 16
    return np.concatenate([np.einsum("kd,kd->k", x[a[i:i + step]], x[b[i:i + step]]) for i in range(0, len(a), step)] or [np.zeros(0)])


def neighbours(starts: np.ndarray, flat: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``nodes``, neighbour) for every neighbour of the nodes; lists lie in ``flat`` from ``starts``."""
    counts = starts[nodes + 1] - starts[nodes]
    owner = np.repeat(np.arange(len(nodes)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return owner, flat[np.repeat(starts[nodes], counts) + place]


def range_search(x: np.ndarray, starts: np.ndarray, flat: np.ndarray, queries: np.ndarray, least: float, beam: int) -> np.ndarray:
    """Boolean (query, row): found with a cosine of at least ``least``.

    A greedy search from the medoid walks to each query; from what is in range, and from the
    query's own place, the search then expands through every neighbour in range, in blocks of
    EDGES edges.
    """
    n, q = len(x), len(queries)
    rows = np.arange(q)
    medoid = int((x @ x.mean(0)).argmax())
    held = np.full((q, beam), medoid, np.int64)
    near = np.full((q, beam), -3.0)
    done = np.ones((q, beam), bool)
    near[:, 0], done[:, 0] = x[queries] @ x[medoid], False
    met, found = np.zeros((q, n), bool), np.zeros((q, n), bool)
    met[:, medoid], met[rows, queries] = True, True
    found[:, medoid], found[rows, queries] = near[:, 0] >= least, True
    for _ in range(4 * beam):
        pick = np.where(done, -3.0, near).argmax(1)
        active = np.flatnonzero(~done[rows, pick])
        if not len(active):
            break
        done[rows, pick] = True
        owner, to = neighbours(starts, flat, held[active, pick[active]])
        a = active[owner]
        fresh = ~met[a, to]
        a, to = a[fresh], to[fresh]
        met[a, to] = True
        close = dots(x, queries[a], to)
        found[a, to] = close >= least
        counts = np.bincount(a, minlength=q)
        place = np.arange(len(a)) - np.repeat(np.cumsum(counts) - counts, counts)
        new, new_near = np.full((q, counts.max(initial=0)), medoid, np.int64), np.full((q, counts.max(initial=0)), -3.0)
        new[a, place], new_near[a, place] = to, close
        held, near, done = np.concatenate([held, new], 1), np.concatenate([near, new_near], 1), np.concatenate([done, new_near == -3.0], 1)
        order = np.argsort(-near, axis=1, kind="stable")[:, :beam]
        held, near, done = (np.take_along_axis(v, order, 1) for v in (held, near, done))
    front = [np.nonzero(found)]
    while front:
        at, node = front.pop()
        ends = np.cumsum(starts[node + 1] - starts[node])
        if len(at) > 1 and ends[-1] > EDGES:
            half = len(at) // 2
            front += [(at[:half], node[:half]), (at[half:], node[half:])]
            continue
        owner, to = neighbours(starts, flat, node)
        fresh = ~met[at[owner], to]
        codes = np.unique(at[owner[fresh]] * n + to[fresh])
        a, to = codes // n, codes % n
        met[a, to] = True
        ok = dots(x, queries[a], to) >= least
        found[a[ok], to[ok]] = True
        if ok.any():
            front.append((a[ok], to[ok]))
    found[rows, queries] = False
    return found


def parts_of(hit: np.ndarray) -> np.ndarray:
    """Lowest row reachable from each row of a symmetric boolean matrix."""
    low = np.full(len(hit), -1)
    for i in range(len(hit)):
        if low[i] < 0:
            low[i] = i
            front = np.array([i])
            while len(front):
                front = np.flatnonzero(hit[front].any(0) & (low < 0))
                low[front] = i
    return low


def centres(sample: np.ndarray, k: int, least: float, rounds: int = 6) -> np.ndarray:
    """Spherical k-means on the sample, then without the centres that lie within ``least`` of one with more members.

    A hot group of near copies draws many centres, which would part its members; so it keeps one.
    """
    c = sample[np.linspace(0, len(sample) - 1, k).astype(int)]
    for _ in range(rounds):
        own = (sample @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, sample)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), c)
    order = np.argsort(-np.bincount((sample @ c.T).argmax(1), minlength=len(c)), kind="stable")
    c, kept = c[order], []
    for i in range(len(c)):
        if not kept or (c[kept] @ c[i]).max() < least:
            kept.append(i)
    return c[kept]


def homes_of(x: np.ndarray, c: np.ndarray, overlap: int, least: float) -> np.ndarray:
    """The ``overlap`` nearest centres of each vector, nearest first.

    Where no vector within ``least`` can be nearer to another centre, by the triangle inequality of
    angles, the nearest alone is enough: it fills the row.
    """
    near = x @ c.T
    own = np.argsort(-near, axis=1, kind="stable")[:, :overlap]
    if own.shape[1] > 1:
        angle = np.arccos(np.clip(np.take_along_axis(near, own[:, :2], 1), -1, 1))
        alone = angle[:, 1] - angle[:, 0] > 2 * np.arccos(least) + 1e-6
        own[alone] = own[alone, :1]
    return own


def link_vectors(spark: SparkSession, vectors: DataFrame, least: float = 0.9, shard: int = 1000, overlap: int = 3,
                 sample: int = 20_000, audit: int = 500, recall: float = 0.95) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row, labels not read.

    Vectors that are null, zero or hold a null or non-finite component link with nothing and
    are their own component. Equal vectors are one node that stands for all of them. Centres
    come from a bounded sample; every node goes to its ``overlap`` nearest shards. An audit compares up to ``audit``
    nodes with ids divisible by 100 with all nodes; below ``recall``, the overlap is
    widened and the search repeated, at last by comparing all nodes with each other. A vector with another length than most makes its own group.
    """
    good = F.expr("""embedding is not null and size(embedding) > 0 and vec_id is not null
        and forall(embedding, e -> e is not null and not isnan(e) and abs(e) < double('Infinity')) and exists(embedding, e -> e != 0)""")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = staged(spark, rows.withColumn("usable", F.coalesce(good, F.lit(False))).withColumn(
        "embedding", F.when(F.col("usable"), F.transform("embedding", lambda e: e + F.lit(0.0)))), "vectors")
    nodes = staged(spark, rows.filter("usable").groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")), "nodes")
    n = nodes.count()
    links = None
    if n > 1:
        asked = audit_counts(spark, nodes, least, audit)
        for wide in (overlap, 2 * overlap, 4 * overlap, None):
            links = staged(spark, shard_links(spark, nodes, n, least, shard, wide, sample), "links")
            if wide is None or audited(links, asked) >= recall:
                break
    plain = rows.select("vec_id", "embedding")
    if links is None:
        counted = nodes.select("embedding", F.col("copies").alias("n"), F.col("id").alias("component_id"), F.lit(0).cast("long").alias("more"))
    else:
        more = links.groupBy("a").agg(F.sum("more").alias("more")).withColumnRenamed("a", "id")
        state = components(spark, links.select("a", "b"))
        counted = nodes.join(more, "id", "left").join(state, "id", "left").select(
            "embedding", F.col("copies").alias("n"), F.coalesce("component_id", "id").alias("component_id"), F.coalesce("more", F.lit(0)).cast("long").alias("more"))
    counted = staged(spark, counted.withColumn("copies", F.col("n")), "counted")
    joined = join_counted(plain.filter("embedding is not null"), counted, "embedding", max(n, rows.count()))
    result = joined.select("vec_id", (F.col("copies") - 1 + F.col("more")).alias("n_links"), "component_id")
    alone = plain.filter("embedding is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return result.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def shard_links(spark: SparkSession, nodes: DataFrame, n: int, least: float, shard: int, overlap: int | None, sample: int) -> DataFrame:
    """For each node and shard: a, b (lowest id of a's component there), n and more (linked nodes and vectors).

    Links are counted where they are found and never sent: a pair that meets in several
    shards counts in the lowest one. A shard with a hot group is cut into parts, and every
    two parts are one group, so that no task holds more than about 2 * SPLIT nodes.
    Without an ``overlap``, all nodes of one length are one shard and are compared exactly.
    """
    drawn = nodes.orderBy(F.xxhash64("id"), "id").limit(sample).select("embedding").toPandas()["embedding"]
    by_size: dict[int, list] = {}
    for v in drawn:
        by_size.setdefault(len(v), []).append(v)
    shards = {} if overlap is None else {size: centres(unit(list(v)), max(1, min(len(v), -(-n * len(v) // len(drawn) // shard), 4096)), least) for size, v in by_size.items()}
    shared = spark.sparkContext.broadcast(shards)

    def assign(batches):
        for batch in batches:
            ids, vectors, copies = (batch.column(c).to_pylist() for c in ("id", "embedding", "copies"))
            for size in sorted({len(v) for v in vectors}):
                at = [i for i, v in enumerate(vectors) if len(v) == size]
                x = unit([vectors[i] for i in at])
                c = shared.value.get(size)
                own = homes_of(x, c, overlap, least) if c is not None else np.zeros((len(x), 1), np.int64)
                sent = [(k, s) for k, row in enumerate(own.tolist()) for s in dict.fromkeys(row)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{size}-{s}" for _, s in sent]), pa.array([s for _, s in sent], pa.int64()),
                     pa.array([own[k] for k, _ in sent], pa.list_(pa.int64())),
                     pa.array([ids[at[k]] for k, _ in sent], pa.int64()), pa.array([copies[at[k]] for k, _ in sent], pa.int64()),
                     pa.array([x[k] for k, _ in sent], pa.list_(pa.float64()))], names=["shard", "own", "homes", "id", "copies", "x"])

    placed = staged(spark, nodes.select("id", "embedding", "copies").mapInArrow(
        assign, "shard string, own long, homes array<long>, id long, copies long, x array<double>"), "placed")
    large = placed.groupBy("shard").count().filter(F.col("count") > 2 * SPLIT)  # one row a shard at most, and shards are bounded
    cut = placed.join(F.broadcast(large), "shard", "left").withColumn("parts", F.ceil(F.coalesce("count", F.lit(1)) / SPLIT))
    cut = cut.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    placed = cut.select(F.concat_ws("/", "shard", F.least("part", "other"), F.greatest("part", "other")).alias("shard"),
                        "own", "homes", "id", "copies", "x", "part")

    def built(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        order = np.argsort(ids)
        ids, x = ids[order], np.array(table.column("x").to_pylist())[order]
        graph = prune(x)
        a, k = np.nonzero(graph >= 0)
        b = graph[a, k]
        # Edges go both ways; a node keeps the nearest DEGREE of those that point to it.
        nearest = np.lexsort((-dots(x, a, b), b))
        back = b[nearest]
        nearest = nearest[np.arange(len(back)) - np.searchsorted(back, back) < DEGREE]
        return pa.table({"a": np.concatenate([ids[a], ids[b[nearest]]]), "b": np.concatenate([ids[b], ids[a[nearest]]])})

    if overlap is None:
        walked = placed
    else:
        edges = placed.select("shard", "id", "x").groupBy("shard").applyInArrow(built, "a long, b long").distinct()
        lists = staged(spark, edges.groupBy("a").agg(F.collect_list("b").alias("to")), "graph")
        walked = placed.join(lists.withColumnRenamed("a", "id"), "id", "left")

    def searched(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        order = np.argsort(ids)
        table, ids = table.take(pa.array(order)), ids[order]
        x = np.array(table.column("x").to_pylist())
        if overlap is None:
            hit = np.concatenate([x[at:at + 512] @ x.T >= least for at in range(0, len(ids), 512)])
            np.fill_diagonal(hit, False)
        else:
            lists = [np.array(to or [], np.int64) for to in table.column("to").to_pylist()]
            local = [np.searchsorted(ids, to[np.isin(to, ids)]) for to in lists]
            starts = np.concatenate([[0], np.cumsum([len(to) for to in local])])
            flat = np.concatenate(local).astype(np.int64)
            hit = np.concatenate([range_search(x, starts, flat, np.arange(at, min(at + 512, len(ids))), least, BEAM) for at in range(0, len(ids), 512)])
        hit |= hit.T
        low = parts_of(hit)
        # Pairs that share a lower shard are counted there; those of one part in the group of that part alone.
        homes, own = np.array(table.column("homes").to_pylist()), table.column("own")[0].as_py()
        lower = np.unique(homes[homes < own])
        if len(lower):
            inside = (homes[:, :, None] == lower).any(1).astype(np.float32)
            hit &= inside @ inside.T == 0
        part = table.column("part").to_numpy()
        if part.min() != part.max():
            hit &= part[:, None] != part
        elif table.column("shard")[0].as_py().rsplit("/", 2)[1:] != [str(part[0])] * 2:
            hit[:] = False
        copies = table.column("copies").to_numpy()
        return pa.table({"a": ids, "b": ids[low], "n": hit.sum(1), "more": np.array([copies[row].sum() for row in hit], np.int64)})

    return walked.groupBy("shard").applyInArrow(searched, "a long, b long, n long, more long")


def audit_counts(spark: SparkSession, nodes: DataFrame, least: float, audit: int) -> DataFrame:
    """a, true: links of a bounded set of query nodes, by comparison with all nodes in blocks.

    Nodes are drawn by a hash of their id, those with an id divisible by 100 first, so that there are always some.
    """
    asked = nodes.orderBy(F.col("id") % 100 != 0, F.xxhash64("id"), "id").limit(audit).select("id", "embedding").toPandas()
    shared = spark.sparkContext.broadcast((asked["id"].to_numpy(), [np.array(v) for v in asked["embedding"]]))

    def run(batches):
        ids, vectors = shared.value
        total = np.zeros(len(ids), np.int64)
        for batch in batches:
            rows = batch.column("embedding").to_pylist()
            for size in sorted({len(v) for v in rows} & {len(v) for v in vectors}):
                at = [i for i, v in enumerate(rows) if len(v) == size]
                own = [i for i, v in enumerate(vectors) if len(v) == size]
                near = unit([vectors[i] for i in own]) @ unit([rows[i] for i in at]).T >= least + 1e-9
                near &= ids[own][:, None] != batch.column("id").to_numpy()[at]
                total[own] += near.sum(1)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total)], names=["a", "true"])

    return staged(spark, nodes.select("id", "embedding").mapInArrow(run, "a long, true long").groupBy("a").agg(F.sum("true").alias("true")), "asked")


def audited(links: DataFrame, asked: DataFrame) -> float:
    """Share of the links of the query nodes that was found, or the mean of the nodes' own shares if that is lower."""
    got = links.groupBy("a").agg(F.sum("n").alias("n"))
    both = asked.filter(F.col("true") > 0).join(got, "a", "left").select("true", F.least("true", F.coalesce("n", F.lit(0))).alias("found"))
    of_links, of_nodes = both.agg(F.sum("found") / F.sum("true"), F.avg(F.col("found") / F.col("true"))).first()
    return 1.0 if of_links is None else min(of_links, of_nodes)


def op7_embedding_near_dedup(spark: SparkSession, root: str) -> DataFrame:
    return link_vectors(spark, spark.read.parquet(f"{root}/embeddings.parquet"))
