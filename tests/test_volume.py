"""What a step reads, writes and holds at once stays in proportion to its work."""

import json

from pyspark.sql import functions as F

from tests.test_streaming import drop_file
from tidemark import session
from tidemark.sources import readers, writers
from tidemark.streaming import jobs


def test_a_keyed_topic_is_written_without_a_sort(spark, tmp_path):
    texts = [json.dumps({"op": "u", "after": {"id": i % 40, "n": i}, "source": {"table": "orders"}}) for i in range(800)]
    drop_file(tmp_path / "source" / "changes", "1.txt", texts)
    plans, base = [], str(tmp_path)
    write = writers.settings

    def spy(session_, conf):
        plans.append(conf)
        return write(session_, conf)

    writers.settings = spy
    try:
        stream = readers.change_stream(spark, "changes", path=f"{base}/source")
        jobs.capture(stream, f"{base}/c", path=f"{base}/topics", every=None, one_topic="all", partitions=4).awaitTermination()
    finally:
        writers.settings = write
    assert plans and all(int(p["spark.sql.maxConcurrentOutputFileWriters"]) >= 4 for p in plans)
    got = [json.loads(r.value) for r in spark.read.json(f"{base}/topics/topic=all").orderBy(F.input_file_name()).collect()]
    assert len(got) == 800
    for f in (tmp_path / "topics" / "topic=all").rglob("part-*"):
        seen = {}
        for line in f.read_text().splitlines():
            image = json.loads(json.loads(line)["value"])["after"]
            assert seen.get(image["id"], -1) < image["n"]  # in the order in which they came
            seen[image["id"]] = image["n"]


def test_a_session_of_few_partitions_gets_reducers_of_bounded_size(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.shuffle.partitions", "12")
    session.adopt(other)
    assert int(other.conf.get(session.INITIAL)) == session.INITIAL_PARTITIONS and other.conf.get("spark.sql.shuffle.partitions") == "12"
    other.conf.set("spark.sql.shuffle.partitions", "600")
    assert int(session.adopt(other).conf.get(session.INITIAL)) == 600


def test_written_steps_leave_no_shuffle_files_and_a_keyed_topic_may_be_compressed(spark, tmp_path):
    from tests.llm.test_freed import shuffle_bytes
    from tidemark.operators import versions
    rows = spark.range(300_000).selectExpr("id % 100000 as id", "id as cdc_ts_ms", "timestamp_seconds(id * 40) as created_at", "uuid() as note")
    before = shuffle_bytes(spark)
    path = str(tmp_path / "t")
    versions.write_by_month(versions.latest(rows), path)
    versions.compact_changes(spark, path, rows.withColumn("cdc_ts_ms", F.col("cdc_ts_ms") + 1))
    assert shuffle_bytes(spark) - before < 100_000
    drop_file(tmp_path / "source" / "changes", "1.txt", ['{"op":"u","after":{"id":1},"source":{"table":"orders"}}'] * 50)
    stream = readers.change_stream(spark, "changes", path=f"{tmp_path}/source")
    jobs.capture(stream, f"{tmp_path}/c", path=f"{tmp_path}/topics", every=None, one_topic="all", partitions=2, compression="gzip").awaitTermination()
    files = list((tmp_path / "topics" / "topic=all").rglob("part-*"))
    assert files and all(f.suffix == ".gz" for f in files) and spark.read.json(f"{tmp_path}/topics/topic=all").count() == 50
