"""Scratch tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where the session names none, a temporary folder in local mode and an error on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all nodes share")
        base = "file://" + tempfile.mkdtemp(prefix="starloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def cut(df: DataFrame, name: str, done: tuple[DataFrame, ...] = (), by: tuple[str, ...] = ()) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends here and lost executors cost nothing.

    done: tables of earlier cuts that nothing reads any more once this one is written; they are removed.
    by: columns whose values get folders of their own, so that what is kept of them reads no other.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    for old in done:
        remove(old)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def remove(table: DataFrame) -> None:
    """Delete the files of a table that cut() made; other DataFrames are left alone."""
    path = getattr(table, "scratch_path", None)
    if path:
        spark = table.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        table.scratch_path = None
