"""Robust background: clipped medians of sky cells, polynomial models fitted by grouped sums, subtraction."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def robust_median(
    df: DataFrame, keys: list[str], value: str, sigma: float = 2.5, rounds: int = 5, least: int = 100
) -> DataFrame:
    """keys, the median after clipping, n: rounds of |v - median| < sigma * 1.4826 MAD (strict).

    A group stops when its noise is below 1e-6 or fewer than `least` values would stay.
    """
    w = Window.partitionBy(*keys)
    out = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"), F.lit(True).alias("_go"))
    for _ in range(rounds):
        out = out.withColumn("_m", F.median("_v").over(w))
        out = out.withColumn("_n", 1.4826 * F.median(F.abs(F.col("_v") - F.col("_m"))).over(w))
        stays = F.abs(F.col("_v") - F.col("_m")) < sigma * F.col("_n")
        out = out.withColumn("_left", F.count(F.when(stays, 1)).over(w))
        out = out.withColumn("_go", F.col("_go") & (F.col("_n") >= 1e-6) & (F.col("_left") >= least))
        out = out.withColumn("_v", F.when(~F.col("_go") | stays, F.col("_v")))
    return out.groupBy(*keys).agg(F.median("_v").alias(value), F.count("_v").alias("n"))


def corner_pixels(rgb: DataFrame, image: list[str], share: int = 8) -> DataFrame:
    """The pixels of the four corner squares of side min(height, width) // share."""
    edges = rgb.groupBy(*image).agg((F.max("y") + 1).alias("_h"), (F.max("x") + 1).alias("_w"))
    side = F.floor(F.least("_h", "_w") / share)
    near_y = (F.col("y") < side) | (F.col("y") >= F.col("_h") - side)
    near_x = (F.col("x") < side) | (F.col("x") >= F.col("_w") - side)
    return rgb.join(edges, image).where(near_y & near_x).drop("_h", "_w")


def unpivoted(rgb: DataFrame, keys: list[str], channels: list[str]) -> DataFrame:
    """keys, channel, v: a row per channel, so that one plan serves all channels."""
    return rgb.select(*keys, F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in channels]), F.array(*channels))).alias("channel", "v"))


def sky_levels(rgb: DataFrame, image: list[str], sigma: float = 2.5, rounds: int = 5, least: int = 100) -> DataFrame:
    """image, bg_r, bg_g, bg_b: robust medians of the corners."""
    long = unpivoted(corner_pixels(rgb, image), image, ["r", "g", "b"])
    levels = robust_median(long, [*image, "channel"], "v", sigma, rounds, least)
    return levels.groupBy(*image).agg(
        *[F.max(F.when(F.col("channel") == c, F.col("v"))).alias(f"bg_{c}") for c in ("r", "g", "b")]
    )


def masked_sky_levels(rgb: DataFrame, mask: DataFrame, image: list[str], sigma: float = 2.5, rounds: int = 5, least: int = 100) -> DataFrame:
    """The same over the pixels outside mask (m); an image with fewer than `least` of them takes its plain medians."""
    own = rgb.join(mask.select(*image, "y", "x", "m"), [*image, "y", "x"])
    sky = F.count(F.when(~F.col("m"), 1)).over(Window.partitionBy(*image))
    own = own.withColumn("_sky", sky).where(~F.col("m") | (F.col("_sky") < least))
    plain = own.where(F.col("_sky") < least)
    levels = robust_median(unpivoted(own.where(F.col("_sky") >= least), image, ["r", "g", "b"]), [*image, "channel"], "v", sigma, rounds, least)
    wide = levels.groupBy(*image).agg(*[F.max(F.when(F.col("channel") == c, F.col("v"))).alias(f"bg_{c}") for c in "rgb"])
    return wide.unionByName(plain.groupBy(*image).agg(*[F.median(c).alias(f"bg_{c}") for c in "rgb"]))


def cells(pixels: DataFrame, image: list[str], cell: int = 256) -> DataFrame:
    """pixels once per cell that holds them, with the cell's place (cy, cx) and centre (yc, xc).

    max(4, size // cell) centres lie evenly from half a cell after the start to half a cell before the end; cells may
    overlap. The cells of a pixel come from arithmetic on its place, so no range join is needed.
    """
    half = cell // 2
    edges = pixels.groupBy(*image).agg((F.max("y") + 1).alias("_h"), (F.max("x") + 1).alias("_w"))
    own = pixels.join(edges, image)

    def centres(size: Column, at: Column) -> Column:
        n = F.greatest(F.lit(4), F.floor(size / cell)).cast("int")
        step = (size - half - half) / (n - 1).cast("double")
        all_ = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(i.alias("i"), (half + i * step).cast("double").alias("c")))
        return F.filter(all_, lambda s: (at >= s["c"].cast("int") - half) & (at < s["c"].cast("int") + half))

    own = own.withColumn("_cy", F.explode(centres(F.col("_h"), F.col("y")))).withColumn(
        "_cx", F.explode(centres(F.col("_w"), F.col("x")))
    )
    return own.withColumns(
        {"cy": F.col("_cy.i"), "cx": F.col("_cx.i"), "yc": F.col("_cy.c"), "xc": F.col("_cx.c")}
    ).drop("_cy", "_cx")


def cell_backgrounds(
    pixels: DataFrame, image: list[str], value: str, cell: int = 256, sigma: float = 2.5, rounds: int = 5, mask: str | None = None
) -> DataFrame:
    """image, cy, cx, yc, xc, height, width, level, n of every cell with 10 sky pixels or more."""
    keys = [*image, "cy", "cx", "yc", "xc", "_h", "_w"]
    own = cells(pixels.select(*image, "y", "x", value, *([mask] if mask else [])), image, cell)
    if mask is not None:
        own = own.where(~F.coalesce(F.col(mask), F.lit(False)))
    levels = robust_median(own.withColumn("_x", F.col(value)), keys, "_x", sigma, rounds, 10)
    return levels.where(F.col("n") >= 10).select(
        *image, "cy", "cx", "yc", "xc", F.col("_h").alias("height"), F.col("_w").alias("width"), F.col("_x").alias("level"), "n"
    )


def _terms(x: Column, y: Column, order: int) -> list[Column]:
    if order not in (1, 2):
        raise ValueError("the order must be 1 or 2")
    own = [F.lit(1.0), x, y]
    return own if order == 1 else [*own, x * x, y * y, x * y]


def solved(matrix: list[list[Column]], right: list[Column]) -> list[Column]:
    """Solution of a small linear system by Cramer's rule as column expressions; null if it is singular."""

    def det(m: list[list[Column]]) -> Column:
        if len(m) == 1:
            return m[0][0]
        out = None
        for j, v in enumerate(m[0]):
            part = v * det([[row[i] for i in range(len(row)) if i != j] for row in m[1:]])
            out = part if out is None else out + part if j % 2 == 0 else out - part
        return out

    whole = det(matrix)
    safe = F.when(F.abs(whole) > 1e-12, whole)
    return [det([[right[r] if c == k else matrix[r][c] for c in range(len(matrix))] for r in range(len(matrix))]) / safe for k in range(len(right))]


def plane_fit(levels: DataFrame, image: list[str]) -> DataFrame:
    """image, c0, c1, c2 and the median level: weighted least squares plane by one grouped aggregate.

    Coordinates are (place - size / 2) / size, weights the cells' pixel counts. Where fewer than three cells are valid,
    or the system is singular, the coefficients are the median and zeros.
    """
    x = (F.col("xc") - F.col("width") / 2.0) / F.col("width")
    y = (F.col("yc") - F.col("height") / 2.0) / F.col("height")
    terms = _terms(x, y, 1)
    w = F.col("n").cast("double")
    sums = [F.sum(w * terms[i] * terms[j]).alias(f"_a{i}{j}") for i in range(3) for j in range(i, 3)]
    sums += [F.sum(w * t * F.col("level")).alias(f"_b{i}") for i, t in enumerate(terms)]
    got = levels.groupBy(*image).agg(*sums, F.median("level").alias("median"), F.count(F.lit(1)).alias("_cells"))
    a = [[F.col(f"_a{min(i, j)}{max(i, j)}") for j in range(3)] for i in range(3)]
    coef = solved(a, [F.col(f"_b{i}") for i in range(3)])
    good = (F.col("_cells") >= 3) & coef[0].isNotNull()
    return got.select(
        *image,
        *[F.when(good, c).otherwise(F.col("median") if i == 0 else F.lit(0.0)).alias(f"c{i}") for i, c in enumerate(coef)],
        "median",
    )


def polynomial_fit(levels: DataFrame, image: list[str], order: int = 2) -> DataFrame:
    """image and coefs, the array of 3 or 6 coefficients: normal-equation sums per image, solved per image in a task."""
    x = (F.col("xc") - F.col("width") / 2.0) / F.col("width")
    y = (F.col("yc") - F.col("height") / 2.0) / F.col("height")
    terms = _terms(x, y, order)
    k = len(terms)
    w = F.col("n").cast("double")
    a = F.array(*[F.sum(w * s * t) for s in terms for t in terms])
    b = F.array(*[F.sum(w * t * F.col("level")) for t in terms])
    sums = levels.groupBy(*image).agg(a.alias("a"), b.alias("b"), F.median("level").alias("median"), F.count(F.lit(1)).alias("_cells"))

    @F.pandas_udf("array<double>")
    def solve(a: pd.Series, b: pd.Series, median: pd.Series, n: pd.Series) -> pd.Series:
        out = []
        for p, q, m, cells_ in zip(a, b, median, n):
            flat = [float(m)] + [0.0] * (k - 1)
            if cells_ >= 3:
                flat = np.linalg.lstsq(np.reshape(p, (k, k)), np.asarray(q), rcond=None)[0].tolist()
            out.append(flat)
        return pd.Series(out)

    return sums.select(*image, solve("a", "b", "median", "_cells").alias("coefs"))


def modelled(pixels: DataFrame, fit: DataFrame, image: list[str], order: int = 2) -> DataFrame:
    """pixels with background, the model at each pixel."""
    edges = pixels.groupBy(*image).agg((F.max("y") + 1).alias("_h"), (F.max("x") + 1).alias("_w"))
    x = (F.col("x") - F.col("_w") / 2.0) / F.col("_w")
    y = (F.col("y") - F.col("_h") / 2.0) / F.col("_h")
    value = F.lit(0.0)
    for i, t in enumerate(_terms(x, y, order)):
        value = value + F.col("coefs")[i] * t
    return pixels.join(fit.join(edges, image), image).withColumn("background", value).drop("coefs", "_h", "_w")


def cubic_pieces(n: int) -> np.ndarray:
    """(n - 1, 4, n): coefficients, lowest power first, of the spline through n values at 0, 1, ..., by piece and value.

    The interpolating cubic spline whose third derivative is continuous at the second and the last but one place as well.
    The system of its second derivatives has a row a place, so it is solved once for all unit vectors.
    """
    system, right = np.zeros((n, n)), np.zeros((n, n))
    for i in range(1, n - 1):
        system[i, i - 1 : i + 2] = 1, 4, 1
        right[i, i - 1 : i + 2] = 6, -12, 6
    system[0, :3] = system[-1, -3:] = 1, -2, 1
    bend, unit = np.linalg.solve(system, right), np.eye(n)
    slope = unit[1:] - unit[:-1] - (2 * bend[:-1] + bend[1:]) / 6
    return np.stack([unit[:-1], slope, bend[:-1] / 2, (bend[1:] - bend[:-1]) / 6], axis=1)


def _centres(size: Column, cell: int) -> Column:
    return F.greatest(F.lit(4), F.floor(size / cell)).cast("int")


def spline_patches(levels: DataFrame, image: list[str], cell: int) -> DataFrame:
    """image, sy, sx, patch: the 16 coefficients of the tensor-product spline through the cells' levels, by piece.

    A cell without a level has the median of the others. One row of levels an image, as many as it has cells, is all that
    a task needs; pixels meet the pieces in a join.
    """
    grid = levels.groupBy(*image).agg(
        F.collect_list(F.struct("cy", "cx", "level")).alias("cells"), F.median("level").alias("median"),
        F.max(_centres(F.col("height"), cell)).alias("ny"), F.max(_centres(F.col("width"), cell)).alias("nx"),
    )

    @F.pandas_udf("array<struct<sy:int,sx:int,patch:array<double>>>")
    def solve(cells_: pd.Series, median: pd.Series, ny: pd.Series, nx: pd.Series) -> pd.Series:
        out = []
        for own, fill, h, w in zip(cells_, median, ny, nx):
            g = np.full((int(h), int(w)), float(fill))
            for c in own:
                g[c["cy"], c["cx"]] = c["level"]
            patches = np.einsum("sai,tbj,ij->stab", cubic_pieces(int(h)), cubic_pieces(int(w)), g)
            out.append([{"sy": i, "sx": j, "patch": p.ravel().tolist()} for i, row in enumerate(patches) for j, p in enumerate(row)])
        return pd.Series(out)

    return grid.select(*image, F.inline(solve("cells", "median", "ny", "nx")))


def splined(pixels: DataFrame, patches: DataFrame, image: list[str], cell: int) -> DataFrame:
    """pixels with background, the spline at each pixel; beyond the outer centres the value there, 0 without any level.

    An axis too short for its centres to lie apart has the value of its first centre.
    """
    edges = pixels.groupBy(*image).agg((F.max("y") + 1).alias("_h"), (F.max("x") + 1).alias("_w"))
    half = cell // 2

    def at(place: Column, size: Column) -> Column:
        step = (size - 2 * half) / (_centres(size, cell) - 1)
        return F.when(step > 0, F.least(F.greatest((place - half) / step, F.lit(0.0)), (_centres(size, cell) - 1).cast("double"))).otherwise(F.lit(0.0))

    own = pixels.join(edges, image).withColumns({"_u": at(F.col("y"), F.col("_h")), "_v": at(F.col("x"), F.col("_w"))})
    own = own.withColumns({"sy": F.least(F.floor("_u"), _centres(F.col("_h"), cell) - 2).cast("int"), "sx": F.least(F.floor("_v"), _centres(F.col("_w"), cell) - 2).cast("int")})
    joined = own.join(patches, [*image, "sy", "sx"], "left").withColumns({"_u": F.col("_u") - F.col("sy"), "_v": F.col("_v") - F.col("sx")})

    def powers(c: list[Column], x: str) -> Column:
        return c[0] + F.col(x) * (c[1] + F.col(x) * (c[2] + F.col(x) * c[3]))

    value = powers([powers([F.col("patch")[4 * i + j] for j in range(4)], "_v") for i in range(4)], "_u")
    return joined.withColumn("background", F.coalesce(value, F.lit(0.0))).drop("_h", "_w", "_u", "_v", "sy", "sx", "patch")


def estimated(
    pixels: DataFrame, image: list[str], value: str, cell: int = 256, order: int = 2, mask: str | None = None, model: str = "polynomial"
) -> DataFrame:
    """pixels with background: cells, robust medians, and a polynomial of order 1 or 2 or a bicubic spline through them."""
    levels = cell_backgrounds(pixels, image, value, cell, mask=mask)
    if model == "spline":
        return splined(pixels, spline_patches(levels, image, cell), image, cell)
    if model != "polynomial":
        raise ValueError(f"unknown model {model}")
    if order == 1:
        fit = plane_fit(levels, image).select(*image, F.array("c0", "c1", "c2").alias("coefs"))
    else:
        fit = polynomial_fit(levels, image, order)
    return modelled(pixels, fit, image, order)


def without_background(pixels: DataFrame, image: list[str], value: str, mode: str = "subtract") -> DataFrame:
    """value less background, shifted so that the least is 0; or value / max(background, 1) * median background."""
    w = Window.partitionBy(*image)
    if mode == "none":
        return pixels.drop("background")
    if mode == "subtract":
        less = pixels.withColumn(value, F.col(value) - F.col("background"))
        return less.withColumn(value, F.col(value) - F.min(value).over(w)).drop("background")
    if mode == "divide":
        level = F.median("background").over(w)
        return pixels.withColumn(value, F.col(value) / F.greatest(F.col("background"), F.lit(1.0)) * level).drop("background")
    raise ValueError(f"unknown mode {mode}")
