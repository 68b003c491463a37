"""Steps whose cost per row must stay small on larger tables."""

import gzip

from pyspark.sql import functions as F

from tidemark.operators import partials
from tidemark.sources import readers, writers
from tidemark.streaming import jobs


def test_bitmap_states_of_scattered_ids_stay_small(spark):
    rows = spark.createDataFrame([(1, v) for v in (5, 5, 64, -1, 10_000_000, 2**40)] + [(2, None), (2, 63), (3, None)], "k long, v long")
    states = partials.distinct_bitmaps(rows, ["k"], "v")
    assert states.schema["bits"].dataType.simpleString() == "bigint"  # 8 bytes, not the 4,096 of a bitmap function
    got = partials.merge_distinct_bitmaps(states.unionByName(states), ["k"], "n")
    assert {(r.k, r.n) for r in got.collect()} == {(1, 5), (2, 1), (3, 0)}


def test_topic_files_are_compressed_and_read_back(spark, tmp_path):
    events = spark.range(2000).select(F.concat(F.lit('{"op":"c","after":{"status":"PENDING","id":'), "id", F.lit("}}")).alias("value"))
    writers.write_topic(events, str(tmp_path), "orders-cdc")
    files = list((tmp_path / "orders-cdc").glob("part-*"))
    assert files and all(f.suffix == ".gz" for f in files)
    assert sum(f.stat().st_size for f in files) * 3 < sum(len(gzip.open(f).read()) for f in files)
    assert {r.value for r in readers.event_files(spark, str(tmp_path), "orders-cdc").collect()} == {r.value for r in events.collect()}


def test_a_published_text_topic_is_compressed(spark, tmp_path):
    (tmp_path / "source").mkdir()
    (tmp_path / "source" / "1.txt").write_text('{"op":"c","after":{"id":1},"source":{"table":"orders"}}\n' * 3)
    events = readers.change_stream(spark, "source", path=str(tmp_path))
    jobs.capture(events, str(tmp_path / "c"), path=str(tmp_path / "topics"), every=None).awaitTermination()
    files = list((tmp_path / "topics" / "topic=orders-cdc").glob("part-*"))
    assert files and all(f.suffix == ".gz" for f in files)
    assert readers.event_files(spark, str(tmp_path / "topics"), "topic=orders-cdc").count() == 3
