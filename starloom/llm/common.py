"""Helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.operators.graph import connected_components
from starloom.plans.scratch import cut, remove, shared_dir

__all__ = ["WORD", "bounded_batches", "connected_components", "cut", "remove", "shared_dir", "table"]

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """df, with the session's Arrow batches held to `rows`: a batch holds whole texts, and tasks hold some batches."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= rows:
        conf.set(key, str(rows))
    return df
