"""Versioned rows: every change is a row, the newest version of a key wins."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import calendar as cal
from tidemark.operators.staging import staged
from tidemark.schemas import TIE
from tidemark.session import FREED, settings


def not_deleted(prefix: str = "") -> Column:
    """Hard deletes out; a missing change code counts as alive."""
    return ~F.col(prefix + "cdc_op").eqNullSafe("d")


def not_soft_deleted(prefix: str = "") -> Column:
    return F.col(prefix + "deleted_at").isNull()


def latest(log: DataFrame, key: str = "id", version: str = "cdc_ts_ms", ties: Sequence[str] = ()) -> DataFrame:
    """One row per key, the one of the highest version.

    ``row_number() = 1`` lets Catalyst prune unused columns and put a group limit
    before the exchange, so a key with very many versions leaves each map task as
    one row.
    """
    order = [F.col(version).desc_nulls_last()] + [F.col(t).desc_nulls_last() for t in ties]
    ranked = log.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def earliest(log: DataFrame, key: str = "id", version: str = "cdc_ts_ms", ties: Sequence[str] = ()) -> DataFrame:
    """One row per key, the one of the lowest version."""
    order = [F.col(version).asc_nulls_last()] + [F.col(t).asc_nulls_last() for t in ties]
    ranked = log.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def active(current: DataFrame) -> DataFrame:
    """Rows neither hard- nor soft-deleted."""
    return current.filter(not_deleted() & not_soft_deleted())


def with_deleted(current: DataFrame, deleted: str = "exclude") -> DataFrame:
    """Read policy on soft-deleted rows: ``exclude``, ``include`` or ``only``."""
    if deleted == "include":
        return current
    if deleted == "only":
        return current.filter(~not_soft_deleted())
    if deleted == "exclude":
        return current.filter(not_soft_deleted())
    raise ValueError(f"unknown policy: {deleted}")


def distinct_versions(log: DataFrame, key: str = "id", version: str = "cdc_ts_ms") -> DataFrame:
    """Drop repeats of one (key, version)."""
    return log.dropDuplicates([key, version])


def merge_changes(current: DataFrame, changes: DataFrame, key: str = "id", version: str = "cdc_ts_ms",
                  ties: Sequence[str] = ()) -> DataFrame:
    """Upsert without MERGE: the newest of the stored and the incoming rows."""
    return latest(current.unionByName(changes), key, version, ties)


def compact(spark: SparkSession, log_path: str, out_root: str, key: str = "id", version: str = "cdc_ts_ms",
            ties: Sequence[str] = (), keep_months: int | None = None, as_of=None) -> str:
    """Rewrite a change log as a snapshot of current rows and return its folder.

    The snapshot goes to a folder of its own and is then named in a manifest, so
    readers see either the old snapshot or the new one. Of a log that a stream wrote, only
    accepted rows count, and of one version the later source position wins.
    """
    rows = spark.read.parquet(log_path)
    if "rejected" in rows.columns:
        rows = rows.filter("not rejected").drop("run", "batch_id", "rejected", "yyyymm")
    rows = latest(rows, key, version, ties or [c for c in (TIE.name,) if c in rows.columns])
    if keep_months is not None:
        rows = retain_months(rows, as_of, keep_months)
    folder = f"{out_root}/snapshot-{uuid.uuid4().hex}"
    write_by_month(rows, folder, key)
    (spark.range(1).select(F.lit(folder).alias("folder"), F.current_timestamp().alias("written_at"))
     .write.mode("append").parquet(f"{out_root}/manifest"))
    return folder


def read_snapshot(spark: SparkSession, out_root: str) -> DataFrame:
    """The snapshot named last in the manifest."""
    last = spark.read.parquet(f"{out_root}/manifest").agg(F.max_by("folder", "written_at")).head()[0]
    return spark.read.parquet(last)


def write_by_month(rows: DataFrame, path: str, key: str = "id", mode: str = "overwrite", rows_per_file: int = 5_000_000) -> None:
    """Write by ``yyyymm``; row groups sorted by key so that point reads can skip.

    The rebalance hint gathers a month into few files, and splits a month that
    holds most of the data into as many files as its size asks for.
    """
    spread = rows.withColumn("yyyymm", cal.yyyymm(F.col("created_at"))).hint("rebalance", "yyyymm").sortWithinPartitions("yyyymm", key)
    with settings(rows.sparkSession, FREED):
        spread.write.mode(mode).option("maxRecordsPerFile", rows_per_file).option("compression", "zstd").partitionBy("yyyymm").parquet(path)


def months_of(rows: DataFrame) -> list[int | None]:
    """The months rows lie in: one value per calendar month, None for rows without a time."""
    return [r[0] for r in rows.select(cal.yyyymm(F.col("created_at"))).distinct().collect()]


def in_months(months: Sequence[int | None], column: str = "yyyymm") -> Column:
    """Rows of these months, also of the one without a time. As a filter on a folder column it prunes."""
    known = [m for m in months if m is not None]
    keep = F.col(column).isin(known) if known else F.lit(False)
    return keep | F.col(column).isNull() if None in months else keep


def month_folder(path: str, month: int | None) -> str:
    return f"{path}/yyyymm={'__HIVE_DEFAULT_PARTITION__' if month is None else month}"


def overwrite_months(spark: SparkSession, rows: DataFrame, path: str, months: Sequence[int | None], key: str = "id") -> None:
    """Replace the named months of a table by ``rows``, which may hold no others; all other folders keep their files.

    ``rows`` may read the table itself: new files take the place of the old ones when all are written, and
    ``rows`` are worked out once. Months that have no rows left are removed last, so that a reader meets the
    new rows no later than the old ones go. A run that is cut off is made good by running it again with the
    same changes.
    """
    spread = rows.withColumn("yyyymm", cal.yyyymm(F.col("created_at"))).hint("rebalance", "yyyymm").sortWithinPartitions("yyyymm", key)
    before = {month: _files(spark, month_folder(path, month)) for month in months}
    with settings(spark, FREED):
        (spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
         .partitionBy("yyyymm").parquet(path))
    for month, names in before.items():
        if names and _files(spark, month_folder(path, month)) == names:  # nothing was written there
            remove_folder(spark, month_folder(path, month))


def _files(spark: SparkSession, path: str) -> set[str]:
    """The names in a folder of the shared store, none if there is no such folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return {f.getPath().getName() for f in store.listStatus(place)} if store.exists(place) else set()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store, if it exists."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def compact_changes(spark: SparkSession, path: str, changes: DataFrame, key: str = "id", version: str = "cdc_ts_ms",
                    ties: Sequence[str] = ()) -> list[int | None]:
    """Bring a table of current rows, kept by month, up to date with new versions; returns the months it rewrote.

    Only months into which a newer version falls, and months in which its key lay before, are
    replaced. Which ones comes from key, version, ties and month alone. Of the table only
    months are read in whole that keep a row, or hold the row to which a change is not newer.
    Changes that are older than what is there, or came before, leave everything as it is, so
    they may be given again.
    """
    month = cal.yyyymm(F.col("created_at"))
    current = spark.read.parquet(path)
    stored = current.withColumns({"_held": F.lit(1), "_month": F.col("yyyymm").cast("int")}).drop("yyyymm")
    new = staged(changes, "compaction-changes").withColumns({"_held": F.lit(0), "_month": month}).select(stored.columns)
    order, held = [version, *ties, "_held", "_month"], F.col("_held") == 1
    fates = stored.unionByName(new).groupBy(key).agg(
        F.max(F.struct(*order)).alias("_top"), F.collect_set(F.when(held, F.struct("_month"))).alias("_in"), F.min("_held").alias("_asked"))
    won = F.col("_top._held") == 0
    lies = F.when(won, F.concat("_in", F.array(F.struct(F.col("_top._month").alias("_month"))))).otherwise(F.col("_in"))
    with settings(spark, FREED):
        by_month = (fates.select(won.alias("won"), (F.col("_asked") == 0).alias("asked"), F.explode(lies).alias("m")).groupBy("m._month")
                    .agg(F.max("won").alias("touched"), F.max(~F.col("won")).alias("keeps"), F.max(~F.col("won") & F.col("asked")).alias("asked"))
                    .collect())  # a row per calendar month
    months = sorted((r[0] for r in by_month if r.touched), key=lambda m: (m is not None, m))
    if months:
        read = [r[0] for r in by_month if r.asked or (r.touched and r.keeps)]
        rows = latest(stored.filter(in_months(read, "_month")).unionByName(new), key, version, order[1:])
        overwrite_months(spark, rows.filter(in_months(months, "_month")).drop("_held", "_month"), path, months, key)
    return months


def remove_expired_months(spark: SparkSession, path: str, as_of, months: int) -> int:
    """Delete the month folders that :func:`retain_months` drops, of a table or of a log that a stream wrote; returns their number.

    Nothing is read or rewritten: the month stands in the folder name. Rows without a time stay.
    """
    oldest = spark.range(1).select(cal.yyyymm(cal.month_start(F.add_months(cal.day_of(as_of), -months)))).first()[0]
    removed = 0
    for pattern in (f"{path}/yyyymm=*", f"{path}/run=*/batch_id=*/rejected=*/yyyymm=*"):
        place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
        store = place.getFileSystem(spark._jsc.hadoopConfiguration())
        for found in store.globStatus(place) or ():
            month = found.getPath().getName().partition("=")[2]
            if month.isdigit() and int(month) < oldest:
                store.delete(found.getPath(), True)
                removed += 1
    return removed


def read_months(spark: SparkSession, path: str, first, last) -> DataFrame:
    """Read a time range; the month predicate prunes folders, the other one rows."""
    lo, hi = cal.moment(first), cal.moment(last)
    return (spark.read.parquet(path)
            .filter(F.col("yyyymm").between(cal.yyyymm(lo), cal.yyyymm(hi)))
            .filter(F.col("created_at").between(lo, hi)))


def retain_months(rows: DataFrame, as_of, months: int) -> DataFrame:
    """Keep the months not older than ``months`` before ``as_of`` (whole months)."""
    oldest = cal.month_start(F.add_months(cal.day_of(as_of), -months))
    return rows.filter(F.col("created_at") >= oldest.cast("timestamp"))


def expired_months(rows: DataFrame, as_of, months: int) -> DataFrame:
    """The months that :func:`retain_months` drops, with their row counts."""
    oldest = cal.month_start(F.add_months(cal.day_of(as_of), -months))
    return (rows.filter(F.col("created_at") < oldest.cast("timestamp"))
            .groupBy(cal.yyyymm(F.col("created_at")).cast("bigint").alias("yyyymm"))
            .agg(F.count("*").alias("row_count")))


def purge_soft_deleted(rows: DataFrame, as_of, months: int = 6) -> DataFrame:
    """Drop rows soft-deleted more than ``months`` ago."""
    limit = cal.moment(as_of) - F.expr(f"INTERVAL {months} MONTH")
    return rows.filter(F.col("deleted_at").isNull() | (F.col("deleted_at") >= limit))


def restore_versions(current: DataFrame, as_of) -> DataFrame:
    """New versions that bring soft-deleted rows back; hard deletes stay deleted."""
    now = cal.moment(as_of)
    return (current.filter(not_deleted() & ~not_soft_deleted())
            .withColumn("deleted_at", F.lit(None).cast("timestamp"))
            .withColumn("updated_at", now)
            .withColumn("cdc_op", F.lit("u"))
            .withColumn("cdc_ts_ms", F.greatest(F.unix_millis(now), F.col("cdc_ts_ms") + 1)))


def signed_totals(pairs: DataFrame, keys: Sequence[str], measures: Sequence[str], sign: str = "sign") -> DataFrame:
    """Collapse +1/-1 pairs: sums of ``sign * measure`` over groups that remain."""
    return (pairs.groupBy(*keys)
            .agg(F.sum(sign).alias("row_count"),
                 *[F.sum(F.col(sign) * F.col(m)).cast("decimal(18,2)").alias(m) for m in measures])
            .filter("row_count <> 0"))
