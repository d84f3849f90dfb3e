"""Frame quality: noise, saturation, score. Frame rows hold a frame each, so scoring needs no shuffle.

A frame's medians come from a vectorised function over its array: sorting millions of boxed values in an array
expression, once for each mention of it, is far slower.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def scored(
    frames: DataFrame,
    keys: list[str],
    data: str = "data",
    saturation: float = 0.95,
    full_scale: float = 65535.0,
    stars: Column | None = None,
) -> DataFrame:
    """keys, background_median, background_mad, noise_proxy, saturation_fraction, n_stars, composite_score.

    composite = (1 + stars) / (max(noise, 1) (1 + 10 saturated) (1 + median / full scale)); frames without a finite
    pixel have null scores and drop out of a ranking.
    """
    level = saturation * full_scale

    @F.pandas_udf("median double, mad double, saturated double")
    def measured(d: pd.Series) -> pd.DataFrame:
        out = []
        for a in d:
            v = np.zeros(0) if a is None else np.asarray(a, float)
            own = v[np.isfinite(v)]
            middle = np.median(own) if len(own) else np.nan
            out.append((middle, np.median(np.abs(own - middle)) if len(own) else np.nan, (v >= level).mean() if len(v) else np.nan))
        return pd.DataFrame(out, columns=["median", "mad", "saturated"])

    def known(c: str) -> Column:
        return F.when(~F.isnan(f"_m.{c}"), F.col(f"_m.{c}"))

    out = frames.select(
        *keys, measured(data).alias("_m"), F.coalesce(stars if stars is not None else F.lit(0), F.lit(0)).cast("long").alias("n_stars")
    ).select(
        *keys,
        "n_stars",
        known("median").alias("background_median"),
        known("mad").alias("background_mad"),
        known("saturated").alias("saturation_fraction"),
    )
    out = out.withColumn("noise_proxy", 1.4826 * F.col("background_mad"))
    composite = (1 + F.col("n_stars")) / (
        F.greatest(F.col("noise_proxy"), F.lit(1.0))
        * (1 + 10 * F.col("saturation_fraction"))
        * (1 + F.col("background_median") / full_scale)
    )
    return out.withColumn("composite_score", composite).select(
        *keys, "background_median", "background_mad", "noise_proxy", "saturation_fraction", "n_stars", "composite_score"
    )


def with_stars(scores: DataFrame, lists: DataFrame, keys: list[str]) -> DataFrame:
    """scores of frames with their stars counted: n_stars of lists (keys, n_stars), 0 where there is none, and the score times 1 + n_stars.

    What is joined is a row of numbers a frame, so the frames' data are not dealt out for it.
    """
    n = F.coalesce("_stars", F.lit(0))
    own = scores.join(lists.select(*keys, F.col("n_stars").alias("_stars")), keys, "left")
    return own.withColumns({"n_stars": n, "composite_score": F.col("composite_score") * (1 + n)}).drop("_stars")


def grouped_mad(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, median, mad, noise over pixel rows (any grouping): the deviation's median over one partitioning."""
    w = Window.partitionBy(*keys)
    off = F.abs(F.col(value) - F.median(value).over(w))
    return (
        df.select(*keys, value, off.alias("_off"))
        .groupBy(*keys)
        .agg(F.median(value).alias("median"), F.median("_off").alias("mad"), (1.4826 * F.median("_off")).alias("noise"))
    )


def ranked(scores: DataFrame, session: list[str], name: str, score: str = "composite_score") -> DataFrame:
    """scores with rank within the session, best first, equal scores by name; null scores are left out."""
    order = Window.partitionBy(*session).orderBy(F.desc(score), F.asc(name))
    return scores.where(F.col(score).isNotNull()).withColumn("rank", F.row_number().over(order))


def selected(scores: DataFrame, session: list[str], name: str, keep: float = 0.92, at_least: int = 1) -> DataFrame:
    """ranked scores with kept: the first max(at_least, int(n * keep)) of the session."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*session))
    most = F.greatest(F.lit(at_least), F.floor(n * keep))
    return ranked(scores, session, name).withColumn("kept", F.col("rank") <= most)


def reference_frame(scores: DataFrame, session: list[str], name: str, strategy: str = "best") -> DataFrame:
    """session and its reference: the best score (equal ones by name) or the first name."""
    if strategy == "best":
        best = F.min_by(F.col(name), F.struct(-F.col("composite_score"), F.col(name)))
    elif strategy == "first":
        best = F.min(name)
    else:
        raise ValueError(f"unknown strategy {strategy}")
    return scores.groupBy(*session).agg(best.alias("reference"))


def ends(scores: DataFrame, session: list[str], name: str, n: int = 5) -> DataFrame:
    """The n best and, in sessions of more than n, the n worst of a ranking; place is top or bottom."""
    total = F.count(F.lit(1)).over(Window.partitionBy(*session))
    own = ranked(scores, session, name).withColumn("_n", total)
    top = own.where(F.col("rank") <= n).withColumn("place", F.lit("top"))
    bottom = own.where((F.col("_n") > n) & (F.col("rank") > F.col("_n") - n)).withColumn("place", F.lit("bottom"))
    return top.unionByName(bottom).drop("_n")


def systematic_sample(frames: DataFrame, session: list[str], name: str, size: int = 5) -> DataFrame:
    """Frames at the whole parts of `size` even steps from the first to the last by name, once each."""
    order = Window.partitionBy(*session).orderBy(name)
    own = frames.withColumn("_i", F.row_number().over(order) - 1).withColumn(
        "_n", F.count(F.lit(1)).over(Window.partitionBy(*session))
    )
    steps = F.transform(
        F.sequence(F.lit(0), F.lit(size - 1)), lambda k: F.floor(k * (F.col("_n") - 1) / F.lit(max(size - 1, 1)))
    )
    return own.where(F.array_contains(steps, F.col("_i").cast("long"))).drop("_i", "_n")


def failure_runs(results: DataFrame, session: list[str], order: str, success: str, most: int) -> DataFrame:
    """session, n_failed, longest_run, aborted_at: the order of the first frame that makes `most` failures in a row."""
    line = Window.partitionBy(*session).orderBy(order)
    own = results.withColumn("_ok", F.sum(F.when(F.col(success), 1).otherwise(0)).over(line))
    run = F.sum(F.when(F.col(success), 0).otherwise(1)).over(
        Window.partitionBy(*session, "_ok").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    )
    own = own.withColumn("_run", F.when(F.col(success), 0).otherwise(run))
    return own.groupBy(*session).agg(
        F.count_if(~F.col(success)).alias("n_failed"),
        F.max("_run").alias("longest_run"),
        F.min(F.when(F.col("_run") >= most, F.col(order))).alias("aborted_at"),
    )
