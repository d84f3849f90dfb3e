"""The JSON and text files that stand beside a session's frames, read and written by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.schema import TRANSFORMS_FILE
from starloom.sources.fits import read_fits


def shots_info(spark: SparkSession, pattern: str) -> DataFrame | None:
    """path and the fields of every shotsInfo.json that the pattern matches; None if there is none."""
    found = spark.read.format("binaryFile").load(pattern) if _exists(spark, pattern) else None
    if found is None:
        return None
    kind = spark.read.option("multiLine", True).json(pattern).schema
    return found.select("path", F.from_json(F.col("content").cast("string"), kind).alias("info")).select("path", "info.*")


def _exists(spark: SparkSession, pattern: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


# Where a session keeps its stack in colours, the finished one before the cached one.
COLOUR_STACKS = ("stacked/master_rgb.fits", "cache/stack_rgb_linear.fits")


def colour_stack(spark: SparkSession, path: str, hdu: int = 0) -> DataFrame | None:
    """The stack in colours of a session's folder, or the file itself where path names one; None if there is none."""
    found = [path] if path.endswith(".fits") else [f"{path.rstrip('/')}/{name}" for name in COLOUR_STACKS]
    found = [p for p in found if _exists(spark, p)]
    return read_fits(spark, found[0], hdu=hdu) if found else None


def transforms(spark: SparkSession, pattern: str) -> DataFrame:
    """path, version, reference, metadata and one row per transform of every file that the pattern matches."""
    found = spark.read.format("binaryFile").load(pattern)
    own = found.select("path", F.from_json(F.col("content").cast("string"), TRANSFORMS_FILE).alias("f"))
    return own.select("path", "f.version", "f.reference", "f.metadata", F.inline("f.transforms"))


def write_frame_list(kept: DataFrame, path: str, session: list[str], name: str = "name", order: str = "frame_id") -> None:
    """A text file per session below path: the kept names in discovery order, one a line."""
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, name))), lambda s: s[name]), "\n")
    kept.groupBy(*session).agg(lines.alias("value")).write.mode("overwrite").partitionBy(*session).text(path)
