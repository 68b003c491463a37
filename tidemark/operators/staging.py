"""Intermediate results that several later steps read."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.session import FREED, fresh_path, settings


def staged(rows: DataFrame, label: str) -> DataFrame:
    """Write rows once to the shared folder and read them back.

    This cuts the lineage with files that outlive any executor, gives the planner
    real sizes, and lets each reader fetch only the columns it needs.
    """
    path = fresh_path(rows.sparkSession, label)
    with settings(rows.sparkSession, FREED):
        rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
