"""Stacks over tiles: frames are cut into runs of pixels inside the tasks, and each run is stacked as arrays.

Frames of a camera have millions of pixels; as pixel rows they would be billions. A tile is a run of row-major places of
all frames of an image. Its length follows from the number of frames, so that what one task gathers of a tile stays
under a bound however many frames there are: one exchange of the arrays, then every clipping round in memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from starloom.operators.pixels import computed_once

#: A reduction takes a stack (frames, places) by name, weights alike, and which frames are always kept; it gives arrays by name.
Reduction = Callable[[dict[str, np.ndarray], np.ndarray, np.ndarray], dict[str, np.ndarray]]

MANY = T.ArrayType(T.DoubleType())


def span_of(frames: Column, values: int, tile_bytes: int = 64 << 20) -> Column:
    """Places of a tile, so that what a task forms of `values` doubles of every frame, some six times as much, fits into tile_bytes."""
    return F.greatest(F.lit(1), F.floor(F.lit(tile_bytes) / (48 * values * frames))).cast("int")


def with_span(frames: DataFrame, image: list[str], values: int, tile_bytes: int = 64 << 20) -> DataFrame:
    """frames with span, the places of a tile of their image."""
    n = frames.groupBy(*image).agg(F.count(F.lit(1)).alias("_n"))
    return frames.join(n.select(*image, span_of(F.col("_n"), values, tile_bytes).alias("span")), image)


def starts_of(size: int, span: int) -> list[int]:
    """Where the tiles of so many places begin, and the end."""
    return [*range(0, size, span), size]


def in_tiles(frames: DataFrame, carried: list[str], arrays: list[str]) -> DataFrame:
    """carried, tile and the arrays' runs of `span` places (a column of frames) for every frame; slices of its arrays, no copies."""
    kind = T.StructType([*(frames.schema[c] for c in carried), T.StructField("tile", T.IntegerType()), *(T.StructField(a, MANY) for a in arrays)])
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                row = {c: b.column(k)[i] for k, c in enumerate(b.schema.names)}
                own = [row[a].values for a in arrays]
                size = max((len(v) for v in own if v is not None), default=0)
                starts = starts_of(size, row["span"].as_py())
                cut = [v if v is not None else pa.nulls(size, pa.float64()) for v in own]
                for k, (s, e) in enumerate(zip(starts, starts[1:])):
                    lists = [pa.ListArray.from_arrays(pa.array([0, e - s], pa.int32()), v.slice(s, e - s)).cast(arrow.field(a).type) for v, a in zip(cut, arrays)]
                    head = [pa.array([row[c].as_py()], arrow.field(c).type) for c in carried]
                    yield pa.RecordBatch.from_arrays([*head, pa.array([k], pa.int32()), *lists], schema=arrow)

    return frames.select(*dict.fromkeys([*carried, "span", *arrays])).mapInArrow(run, kind)


def stacked_tiles(
    tiles: DataFrame, image: list[str], frame: str, values: list[str], reduction: Reduction, results: list[str],
    weight: str | None = None, always: str | None = None,
) -> DataFrame:
    """image, width, span, tile and the result arrays of every tile.

    tiles has a row a frame and tile with width, span, tile, an array per value and per weight; frames of an image have one
    size. always marks frames that the reduction keeps whatever they are; nulls in arrays are no values, without weight.
    """
    keys = [*image, "width", "span", "tile"]
    kind = T.StructType([*(tiles.schema[k] for k in keys), *(T.StructField(r, MANY) for r in results)])
    arrow = to_arrow_schema(kind)

    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column(frame).to_numpy(), kind="stable")  # sums do not depend on the order of arrival
        n = len(table)
        v = {a: flat(table.column(a)).reshape(n, -1)[order] for a in values}
        size = v[values[0]].shape[1]
        w = np.nan_to_num(flat(table.column(weight)).reshape(n, -1)[order]) if weight else np.ones((n, size))
        kept = table.column(always).to_numpy()[order].astype(bool) if always else np.zeros(n, bool)
        got = reduction(v, w, kept)
        first = [table.column(k)[:1].combine_chunks() for k in keys]
        cols = [pa.ListArray.from_arrays(pa.array([0, size], pa.int32()), pa.array(np.asarray(got[r], float), from_pandas=True)) for r in results]
        return pa.Table.from_arrays([*first, *(c.cast(arrow.field(r).type) for c, r in zip(cols, results))], schema=arrow)

    needed = [*keys, frame, *values, *([weight] if weight else []), *([always] if always else [])]
    return tiles.select(*needed).groupBy(*keys).applyInArrow(run, kind)


def tile_pixels(stacked: DataFrame, image: list[str], results: dict[str, str]) -> DataFrame:
    """image, y, x and the results (name -> kind) as pixel rows; only a stack's own pixels become rows, not the frames'."""
    rows = stacked.select(*image, "width", "span", "tile", F.posexplode(F.arrays_zip(*results)).alias("_i", "_v"))
    place = F.col("tile").cast("long") * F.col("span") + F.col("_i")
    return rows.select(
        *image, F.floor(place / F.col("width")).cast("int").alias("y"), (place % F.col("width")).cast("int").alias("x"),
        *[F.col(f"_v.{r}").cast(kind).alias(r) for r, kind in results.items()],
    )


def tile_images(stacked: DataFrame, image: list[str], results: list[str]) -> DataFrame:
    """image, height, width and the results' whole arrays: one row a stack."""
    packed = F.array_sort(F.collect_list(F.struct("tile", *results)))
    rows = stacked.groupBy(*image, "width").agg(packed.alias("_t"))
    whole = rows.select(*image, "width", *[F.flatten(F.col("_t").getField(r)).alias(r) for r in results])
    return computed_once(whole, *results).select(*image, (F.size(results[0]) / F.col("width")).cast("int").alias("height"), "width", *results)


def flat(column: pa.ChunkedArray) -> np.ndarray:
    """The values of a column of lists one after the other, nulls as NaN."""
    return np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]).astype(float)


def finite(v: np.ndarray) -> np.ndarray:
    return np.where(np.isfinite(v), v, np.nan)


def quietly(f: Callable, v: np.ndarray) -> np.ndarray:
    """A statistic over the frames that is NaN where there is none."""
    out = np.full(v.shape[1], np.nan)
    some = ~np.isnan(v).all(axis=0)
    out[some] = f(v[:, some], axis=0)
    return out


def clipped(v: np.ndarray, valid: np.ndarray, sigma: float, rounds: int, centre: str) -> np.ndarray:
    """v with NaN where it is not valid, not finite, or farther than sigma population deviations from the centre, by rounds."""
    out = np.where(valid, finite(v), np.nan)
    middle = np.nanmedian if centre == "median" else np.nanmean
    for _ in range(rounds):
        with np.errstate(invalid="ignore"):
            off = np.abs(out - quietly(middle, out)) > sigma * quietly(np.nanstd, out)
        if not off.any():
            break
        out[off] = np.nan
    return out


def clip_mean(sigma: float = 3.0, rounds: int = 5, centre: str = "median", threshold: float | None = None) -> Reduction:
    """Means of what clipping keeps; n frames (with a threshold, those of more weight), n_kept the least kept over the values."""
    if centre not in ("median", "mean"):
        raise ValueError(f"unknown centre {centre}")

    def reduce(v, w, always):
        valid = np.ones(w.shape, bool) if threshold is None else w > threshold
        kept = {a: clipped(x, valid, sigma, rounds, centre) for a, x in v.items()}
        counts = np.min([(~np.isnan(x)).sum(axis=0) for x in kept.values()], axis=0)
        return {a: quietly(np.nanmean, x) for a, x in kept.items()} | {"n": valid.sum(axis=0), "n_kept": counts}

    return reduce


def masked_clip_mean(sigma: float = 3.0, rounds: int = 5, threshold: float = 0.5) -> Reduction:
    """Weighted means of what clipping by mean keeps of the valid (weight > threshold); 0 without weight; coverage of the first value."""

    def reduce(v, w, always):
        out, coverage = {}, None
        for a, x in v.items():
            x = clipped(x, w > threshold, sigma, rounds, "mean")
            own = np.where(np.isnan(x), 0.0, w)
            total = own.sum(axis=0)
            out[a] = np.where(total > 1e-6, (np.nan_to_num(x) * own).sum(axis=0) / np.where(total > 1e-6, total, 1), 0.0)
            coverage = (~np.isnan(x)).sum(axis=0) if coverage is None else coverage
        return out | {"coverage": coverage}

    return reduce


def two_pass(sigma: float = 3.0, epsilon: float = 1e-6, strict: bool = False) -> Reduction:
    """Means of the frames that all values keep: within sigma sample deviations of the mean of the valid; and coverage."""

    def reduce(v, w, always):
        valid = w > 0.5
        keep = np.ones(w.shape, bool)
        for x in v.values():
            x = np.where(valid, x, np.nan)
            mean = quietly(np.nanmean, x)
            n = (~np.isnan(x)).sum(axis=0)
            square = np.nansum((x - mean) ** 2, axis=0)
            s = np.where(n > 1, np.sqrt(square / np.maximum(n - 1, 1)), 0.0)
            with np.errstate(invalid="ignore"):
                off = np.abs(x - mean)
                keep &= off / (s + 1e-10) < sigma if strict else off <= sigma * s + epsilon
        keep = valid & (keep | always[:, None])
        out = {a: np.nan_to_num(quietly(np.nanmean, np.where(keep, x, np.nan))) for a, x in v.items()}
        return out | {"coverage": keep.sum(axis=0)}

    return reduce
