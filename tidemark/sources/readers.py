"""Sources: table snapshots, change-event streams and where to start reading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_TEXT = T.StructType([T.StructField("value", T.StringType())])
KEYED_TEXT = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType()),
                           T.StructField("partition", T.IntegerType())])


def jdbc_options(url: str, table: str, lower: int, upper: int, partitions: int, key: str = "id",
                 fetch_size: int = 10_000, **more: str) -> dict[str, str]:
    """Options of a parallel table read, cut into ranges of the key."""
    return {"url": url, "dbtable": table, "partitionColumn": key, "lowerBound": str(lower),
            "upperBound": str(upper), "numPartitions": str(partitions), "fetchsize": str(fetch_size),
            "sessionInitStatement": "SET time_zone = '+00:00'", **more}


def read_table(spark: SparkSession, schema: T.StructType, path: str | None = None,
               jdbc: dict[str, str] | None = None) -> DataFrame:
    """A source table from files or over JDBC, with its fixed column list."""
    if jdbc is not None:
        return spark.read.format("jdbc").options(**jdbc).load().select(*schema.names)
    return spark.read.schema(schema).parquet(path)


def snapshot_and_changes(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """Initial start: all rows as they are, then the changes."""
    return snapshot.select("value").unionByName(changes.select("value"))


def _field(path: str, sql_type: str = "string"):
    return F.get_json_object("value", path).try_cast(sql_type)


def start_at_timestamp(events: DataFrame, ts_ms: int) -> DataFrame:
    """Changes from a moment on. Events without a readable time drop out."""
    return events.filter(_field("$.ts_ms", "bigint") >= ts_ms)


def start_at_offset(events: DataFrame, file: str, pos: int) -> DataFrame:
    """Changes from a position of the source log on. Log files count up by the number at the end of their names."""
    def number(name):
        return F.regexp_extract(name, r"(\d+)$", 1).try_cast("bigint")
    name = _field("$.source.file")
    at, start = number(name), number(F.lit(file))
    return events.filter((at > start) | ((at == start) & (_field("$.source.pos", "bigint") >= pos)))


def kafka_options(servers: str, topic: str, start: str = "latest", max_per_trigger: int | None = 500_000,
                  start_ts_ms: int | None = None, group_prefix: str | None = None) -> dict[str, str]:
    """Options of a topic stream. ``start`` counts on the first run only; later runs
    resume from the checkpoint."""
    out = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start,
           "failOnDataLoss": "true", "kafka.session.timeout.ms": "30000"}
    if start_ts_ms is not None:
        out["startingTimestamp"] = str(start_ts_ms)
    if max_per_trigger is not None:
        out["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if group_prefix:
        out["groupIdPrefix"] = group_prefix
    return out


def change_stream(spark: SparkSession, topic: str, path: str | None = None, servers: str | None = None,
                  start: str = "latest", max_files_per_trigger: int = 1000, keyed: bool = False, **kafka: object) -> DataFrame:
    """A stream of event texts: a topic, or text files below ``path/topic``; ``keyed`` files hold (key, value) by partition.

    A micro-batch takes a bounded number of offsets or files, which bounds what a
    stateful step shuffles, a backlog and a flood of copies included.

    Adds ``ingest_ts``: broker time for a topic, arrival time for files. A file
    stream always starts at the earliest file; ``start='latest'`` is a matter of
    :func:`start_at_timestamp` there.
    """
    if servers is not None:
        raw = spark.readStream.format("kafka").options(**kafka_options(servers, topic, start, **kafka)).load()
        return raw.select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("ingest_ts"))
    reader = (spark.readStream.format("json" if keyed else "text").schema(KEYED_TEXT if keyed else EVENT_TEXT)
              .option("maxFilesPerTrigger", max_files_per_trigger))
    if keyed:  # the folders below the partition, one a batch, are no columns of the topic
        reader = reader.option("basePath", path)
        return reader.load(f"{path}/{topic}").select(*KEYED_TEXT.names, F.current_timestamp().alias("ingest_ts"))
    return reader.load(f"{path}/{topic}").withColumn("ingest_ts", F.current_timestamp())


def table_stream(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A parquet table of the sample schema as a stream of its files."""
    path = f"{root}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    # A glob, because a stream takes a folder or a pattern but not one file.
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000)
            .parquet(f"{root}/{name}.parque[t]"))


def event_files(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """The same event texts as a finished set of rows (replay from the beginning)."""
    return spark.read.schema(EVENT_TEXT).text(f"{path}/{topic}")
