"""Stacking: grouped robust aggregates over the frames of each pixel, and what is read off a stack.

An image stack is the case keys = (session, y, x); the operators take any keys. The clipping rounds are windows over
one partitioning, so a stack costs one exchange whatever the number of rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def finite(v: Column) -> Column:
    d = v.cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != float("inf")), d)


def clipped(
    df: DataFrame,
    keys: list[str],
    values: list[str],
    sigma: float = 3.0,
    rounds: int = 5,
    centre: str = "median",
    valid: Column | None = None,
) -> DataFrame:
    """df with each value set to null where it is clipped: |v - centre| > sigma * population deviation, `rounds` times.

    centre is median or mean of what is left; values clip independently; null, NaN and infinite values, and rows that
    are not valid, are left out from the start. Rounds after convergence change nothing.
    """
    if centre not in ("median", "mean"):
        raise ValueError(f"unknown centre {centre}")
    w = Window.partitionBy(*keys)
    middle = F.median if centre == "median" else F.avg
    out = df
    for v in values:
        own = finite(F.col(v))
        out = out.withColumn(v, own if valid is None else F.when(valid, own))
    for _ in range(rounds):
        out = out.withColumns(
            {f"_c_{v}": middle(v).over(w) for v in values} | {f"_s_{v}": F.stddev_pop(v).over(w) for v in values}
        )
        out = out.withColumns(
            {v: F.when(F.abs(F.col(v) - F.col(f"_c_{v}")) <= sigma * F.col(f"_s_{v}"), F.col(v)) for v in values}
        )
    return out.drop(*[f"_{k}_{v}" for k in "cs" for v in values])


def sigma_clip_mean(
    df: DataFrame, keys: list[str], values: list[str], sigma: float = 3.0, rounds: int = 5, centre: str = "median"
) -> DataFrame:
    """keys, the clipped mean of each value, n (rows) and n_kept (the least count kept over the values)."""
    kept = [F.count(v) for v in values]
    return (
        clipped(df, keys, values, sigma, rounds, centre)
        .groupBy(*keys)
        .agg(
            *[F.avg(v).alias(v) for v in values],
            F.count(F.lit(1)).alias("n"),
            (F.least(*kept) if len(kept) > 1 else kept[0]).alias("n_kept"),
        )
    )


def mask_aware_clip(
    df: DataFrame,
    keys: list[str],
    values: list[str],
    weight: str,
    sigma: float = 3.0,
    rounds: int = 5,
    threshold: float = 0.5,
) -> DataFrame:
    """keys, weighted means of the clipped values (0 without weight) and coverage (kept rows of the first value).

    Valid is weight > threshold; mean and population deviation of the valid decide; the weights count in the mean only.
    """
    w = F.coalesce(F.col(weight), F.lit(0.0))
    out = clipped(df, keys, values, sigma, rounds, "mean", w > threshold)

    def mean(v: str) -> Column:
        total = F.sum(F.when(F.col(v).isNotNull(), w))
        return F.when(total > 1e-6, F.sum(F.col(v) * w) / F.nullif(total, F.lit(0.0))).otherwise(F.lit(0.0))

    return out.groupBy(*keys).agg(
        *[mean(v).alias(v) for v in values], F.count(F.when(F.col(values[0]).isNotNull(), 1)).alias("coverage")
    )


def two_pass_clip(
    df: DataFrame,
    keys: list[str],
    values: list[str],
    weight: str | None = None,
    sigma: float = 3.0,
    epsilon: float = 1e-6,
    strict: bool = False,
    always: Column | None = None,
) -> DataFrame:
    """keys, means of the rows that all values keep, and coverage; one pass for mean and sample deviation, one to clip.

    Kept: |v - mean| <= sigma * s + epsilon for every value, or strictly |v - mean| / (s + 1e-10) < sigma; rows for which
    `always` holds (a reference frame) are kept whatever they are. Pixels without a kept row are 0.
    """
    valid = F.lit(True) if weight is None else F.coalesce(F.col(weight), F.lit(0.0)) > 0.5
    own = df.select(*df.columns, valid.alias("_valid"))
    moments = own.where("_valid").groupBy(*keys).agg(
        *[F.avg(v).alias(f"_m_{v}") for v in values],
        *[F.coalesce(F.stddev_samp(v), F.lit(0.0)).alias(f"_s_{v}") for v in values],
    )

    def keep(v: str) -> Column:
        off = F.abs(F.col(v) - F.col(f"_m_{v}"))
        return off / (F.col(f"_s_{v}") + 1e-10) < sigma if strict else off <= sigma * F.col(f"_s_{v}") + epsilon

    kept = keep(values[0])
    for v in values[1:]:
        kept = kept & keep(v)
    if always is not None:
        kept = kept | always
    joined = own.join(moments, keys, "left").withColumn("_kept", F.coalesce(F.col("_valid") & kept, F.lit(False)))
    return joined.groupBy(*keys).agg(
        *[F.coalesce(F.avg(F.when(F.col("_kept"), F.col(v))), F.lit(0.0)).alias(v) for v in values],
        F.count_if("_kept").alias("coverage"),
    )


def covered_only(stacked: DataFrame, image: list[str], values: list[str], share: float = 0.5) -> DataFrame:
    """Values set to 0 where the coverage is below int(share * greatest coverage of the image)."""
    least = F.floor(share * F.max("coverage").over(Window.partitionBy(*image)))
    return stacked.withColumns({v: F.when(F.col("coverage") < least, F.lit(0.0)).otherwise(F.col(v)) for v in values})


def mask_aware_mean(df: DataFrame, keys: list[str], values: list[str], weight: str) -> DataFrame:
    """keys, sum(v w) / sum(w) (0 where no weight) and coverage, the whole part of sum(w)."""
    total = F.sum(weight)
    return df.groupBy(*keys).agg(
        *[F.coalesce(F.try_divide(F.sum(F.col(v) * F.col(weight)), total), F.lit(0.0)).alias(v) for v in values],
        F.coalesce(F.floor(total), F.lit(0)).cast("int").alias("coverage"),
    )


def weighted_mean(df: DataFrame, weights: DataFrame, frame: str, keys: list[str], value: str) -> DataFrame:
    """keys and the mean weighted by frame; frames without a weight are an error in the result: they count as null."""
    joined = df.join(weights.select(frame, "weight"), frame)
    return joined.groupBy(*keys).agg(
        F.try_divide(F.sum(F.col(value) * F.col("weight")), F.sum("weight")).alias(value)
    )


def median_stack(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.median(value).alias(value))


def stack_statistics(stacked: DataFrame, image: list[str], value: str, n_frames: int | str, exposure: float) -> DataFrame:
    """image, n_frames, total_exposure_s, mean_clipped_fraction, snr_proxy = median / (1.4826 MAD), 0 if the MAD is 0."""
    n = F.col(n_frames) if isinstance(n_frames, str) else F.lit(n_frames)
    w = Window.partitionBy(*image)
    off = F.abs(F.col(value) - F.median(value).over(w))
    noise = 1.4826 * F.median("_off")
    return (
        stacked.select(*image, value, "n_kept", n.alias("_n"), off.alias("_off"))
        .groupBy(*image)
        .agg(
            F.max("_n").alias("n_frames"),
            (F.max("_n") * exposure).alias("total_exposure_s"),
            (1 - F.avg("n_kept") / F.max("_n")).alias("mean_clipped_fraction"),
            F.when(noise > 0, F.median(value) / F.nullif(noise, F.lit(0.0))).otherwise(F.lit(0.0)).alias("snr_proxy"),
        )
    )


def joint_statistics(rgb: DataFrame, image: list[str], n_frames: str, exposure: float, clipped: float = 0.03) -> DataFrame:
    """image, n_frames, total_exposure_s, mean_clipped_fraction (as given), snr_proxy over all channels' values as one.

    The medians are grouped aggregates over the values, joined back, so no image is gathered in one window.
    """
    long = rgb.select(*image, F.col(n_frames).alias("_n"), F.explode(F.array("r", "g", "b")).alias("_v"))
    middle = long.groupBy(*image).agg(F.median("_v").alias("_m"), F.max("_n").alias("n_frames"))
    off = long.join(middle.select(*image, "_m"), image).groupBy(*image).agg((1.4826 * F.median(F.abs(F.col("_v") - F.col("_m")))).alias("_noise"))
    return middle.join(off, image).select(
        *image, "n_frames", (F.col("n_frames") * exposure).alias("total_exposure_s"), F.lit(clipped).alias("mean_clipped_fraction"),
        F.when(F.col("_noise") > 0, F.col("_m") / F.nullif(F.col("_noise"), F.lit(0.0))).otherwise(F.lit(0.0)).alias("snr_proxy"),
    )


def coverage_bounds(stacked: DataFrame, image: list[str], share: float = 0.8) -> DataFrame:
    """image, y0, y1, x0, x1 (ends excluded): the box of coverage >= share * greatest; everything if nothing is covered."""
    w = Window.partitionBy(*image)
    most = F.max("coverage").over(w)
    marked = stacked.withColumn("_in", (most <= 0) | (F.col("coverage") >= share * most))
    return (
        marked.where("_in")
        .groupBy(*image)
        .agg(
            F.min("y").alias("y0"), (F.max("y") + 1).alias("y1"), F.min("x").alias("x0"), (F.max("x") + 1).alias("x1")
        )
    )


def cropped(stacked: DataFrame, image: list[str], share: float = 0.8) -> DataFrame:
    """The pixels in the coverage box, y and x counted from its corner."""
    box = coverage_bounds(stacked, image, share)
    inside = (F.col("y") >= F.col("y0")) & (F.col("y") < F.col("y1")) & (F.col("x") >= F.col("x0")) & (F.col("x") < F.col("x1"))
    return (
        stacked.join(box, image)
        .where(inside)
        .withColumns({"y": F.col("y") - F.col("y0"), "x": F.col("x") - F.col("x0")})
        .drop("y0", "y1", "x0", "x1")
    )


def partial_moments(frames_as_tiles: DataFrame, keys: list[str], data: str = "data") -> DataFrame:
    """keys, n, mean, m2: mergeable moments of tiles, formed per task before the shuffle and merged by Chan's formula.

    keys name the tile (session, ty, tx). What is shuffled is one partial per tile and task, not the frames.
    """
    fields = [frames_as_tiles.schema[k] for k in keys]
    many = T.ArrayType(T.DoubleType())
    kind = T.StructType([*fields, T.StructField("n", T.LongType()), T.StructField("mean", many), T.StructField("m2", many)])
    arrow = to_arrow_schema(kind)

    def merge(a: tuple, b: tuple) -> tuple:
        n = a[0] + b[0]
        delta = b[1] - a[1]
        return n, a[1] + delta * (b[0] / n), a[2] + b[2] + delta**2 * (a[0] * b[0] / n)

    def gathered(rows) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(
            [dict(zip(keys, k)) | {"n": n, "mean": m.tolist(), "m2": s.tolist()} for k, (n, m, s) in rows.items()], arrow
        )

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        for b in batches:
            for r in b.to_pylist():
                v = np.asarray(r[data], float)
                k = tuple(r[x] for x in keys)
                one = (1, v, np.zeros_like(v))
                held[k] = merge(held[k], one) if k in held else one
            if len(held) > 64:
                yield gathered(held)
                held = {}
        yield gathered(held)

    def total(block: pa.Table) -> pa.Table:
        rows = block.to_pylist()
        got = None
        for r in rows:
            one = (r["n"], np.asarray(r["mean"], float), np.asarray(r["m2"], float))
            got = one if got is None else merge(got, one)
        return pa.Table.from_batches([gathered({tuple(rows[0][x] for x in keys): got})])

    parts = frames_as_tiles.select(*keys, data).mapInArrow(partial, kind)
    return parts.groupBy(*keys).applyInArrow(total, kind)
