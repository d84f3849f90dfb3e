"""Incremental stacking with Structured Streaming; an addition, the batch operators do not depend on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def live_moments(frames: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, n, mean, m2 of a stream of pixel rows: central moments that Spark keeps as state and merges per micro-batch.

    Sums of squares would cancel at the levels of a camera; the moments about the mean do not.
    """
    v = F.col(value).cast("double")
    return frames.groupBy(*keys).agg(F.count(v).alias("n"), F.avg(v).alias("mean"), (F.var_pop(v) * F.count(v)).alias("m2"))


def windowed_flux(events: DataFrame, time: str = "ts", value: str = "value", width: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """window start, event_type, n, total of an event stream, closed once the watermark has passed."""
    return (
        events.withWatermark(time, late)
        .groupBy(F.window(time, width).alias("w"), "event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
        .select(F.col("w.start").alias("start"), "event_type", "n", "total")
    )


def mean_and_deviation(moments: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n, mean, deviation (of the population)."""
    return moments.select(*keys, "n", "mean", F.sqrt(F.col("m2") / F.nullif(F.col("n"), F.lit(0))).alias("deviation"))
