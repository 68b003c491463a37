"""Compaction of a table by month: what a change is newer than decides what is rewritten."""

from pyspark.sql import functions as F

from tests.test_months import by_month, files  # noqa: F401
from tidemark.operators import versions


def test_changes_that_are_not_newer_rewrite_nothing(spark, by_month):  # noqa: F811
    path = by_month[0]
    before, rows = files(path), spark.read.parquet(path).drop("yyyymm")
    old = spark.createDataFrame(rows.collect(), rows.schema)
    late = old.withColumns({"cdc_ts_ms": F.lit(1).cast("long"), "created_at": F.col("created_at") - F.expr("INTERVAL 2 MONTH")})
    assert versions.compact_changes(spark, path, late.unionByName(old)) == []
    assert files(path) == before


def test_compaction_of_null_keys_repeats_and_equal_versions(spark, tmp_path):
    schema = "id long, v string, created_at timestamp, cdc_ts_ms long"
    def at(month):
        return F.to_timestamp(F.lit(f"2025-{month:02d}-03"))
    def rows(*values):
        return spark.createDataFrame([(i, v, None, n) for i, v, _, n in values], schema).withColumn("created_at", F.coalesce(
            *[F.when(F.col("v") == v, at(m)) for _, v, m, _ in values if m is not None], F.lit(None).cast("timestamp")))
    stored = rows((None, "a", 1, 5), (1, "b", 1, 5), (2, "c", 2, 5), (3, "d", 3, None), (4, "e", None, 5), (5, "f", 4, 9))
    changes = rows((None, "A", 5, 6), (None, "late", 6, 1), (1, "same", 7, 5), (2, "C1", 8, 7), (2, "C2", 2, 8), (3, "D", 3, 0), (4, "E", None, 6), (5, "old", 9, 8), (6, "new", 1, None))
    path = str(tmp_path / "t")
    versions.write_by_month(stored, path)
    for again in (False, True):
        touched = versions.compact_changes(spark, path, changes.unionByName(changes))
        assert touched == ([] if again else [None, 202501, 202502, 202503, 202505])
        got = {(r.id, r.v, r.yyyymm) for r in spark.read.parquet(path).collect()}
        assert got == {(None, "A", 202505), (1, "b", 202501), (2, "C2", 202502), (3, "D", 202503), (4, "E", None), (5, "f", 202504), (6, "new", 202501)}
