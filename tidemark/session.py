"""Session settings and the shared folder that jobs may write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that hold from a laptop to a large cluster. Partition counts are left
# to adaptive execution: it starts from the initial number and merges small ones.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a swollen join partition even where an aggregation on the join key
    # follows and then needs an exchange of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A reducer gets that much of a shuffle, and so sorts and hashes a bounded number of rows.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


# So many partitions at least leave a map task, to be merged to the size above; up to 200 are written without a sort.
INITIAL_PARTITIONS = 64
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def build_session(app: str = "tidemark", master: str | None = None, shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or fetch) a session. On a cluster leave ``master`` unset."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
        conf[INITIAL] = str(max(INITIAL_PARTITIONS, shuffle_partitions))
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# What a step has shuffled is not needed once its rows are written.
FREED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

# State of several columns per key (``transformWithState``) needs this store, whatever the session has.
STATE_STORE = {k: v for k, v in BASE_CONF.items() if k.endswith(".stateStore.providerClass")}

# The settings above that a running session of someone else may take on.
RUNTIME_CONF = {k: v for k, v in BASE_CONF.items()
                if k.startswith("spark.sql.adaptive.") or k == "spark.sql.session.timeZone"}


def adopt(spark: SparkSession) -> SparkSession:
    """Give an existing session the settings the plans rely on."""
    for key, value in (RUNTIME_CONF | adaptive(spark)).items():
        spark.conf.set(key, value)
    return spark


def adaptive(spark: SparkSession) -> dict[str, str]:
    """The adaptive settings, with an initial number of partitions not below that of the session."""
    return {k: v for k, v in RUNTIME_CONF.items() if k.startswith("spark.sql.adaptive.")} | {INITIAL: str(max(INITIAL_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions"))))}


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Settings that hold while a streaming query starts: the query keeps them, the session has its own again."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a session without that setting (a local test) gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
