"""Neighbourhood operators on pixel rows (image keys, y, x, value): filters, morphology, labels, masks."""

from __future__ import annotations

from math import ceil, exp

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.tone import luma
from starloom.operators.graph import connected_components


def line_filter(pixels: DataFrame, image: list[str], value: str, weights: list[float], axis: str) -> DataFrame:
    """Weighted sum along y or x with edges reflected (edge pixel repeated); weights has odd length.

    A line of the image becomes one array, so the shuffle carries each pixel once whatever the width of the filter.
    """
    other = "x" if axis == "y" else "y"
    reach = len(weights) // 2
    lines = pixels.groupBy(*image, other).agg(
        F.array_sort(F.collect_list(F.struct(F.col(axis).alias("at"), F.col(value).cast("double").alias("v")))).alias("line")
    )
    lines = lines.select(*image, other, F.col("line.at").alias("at"), F.col("line.v").alias("v"))
    n = F.size("v")
    kernel = F.array(*[F.lit(w) for w in weights])

    def reflected(i: Column) -> Column:
        k = F.pmod(i, 2 * n)
        return F.when(k < n, k).otherwise(2 * n - 1 - k).cast("int")

    def at(i: Column) -> Column:
        taps = F.transform(F.sequence(F.lit(0), F.lit(2 * reach)), lambda k: F.get(kernel, k) * F.get(F.col("v"), reflected(i + k - reach)))
        return F.aggregate(taps, F.lit(0.0), lambda s, t: s + t)

    smoothed = F.transform(F.sequence(F.lit(0), n - 1), at)
    return lines.select(*image, other, F.inline(F.arrays_zip(F.col("at").alias(axis), smoothed.alias(value)))).select(
        *image, "y", "x", value
    )


def gaussian_weights(sigma: float, truncate: float = 4.0) -> list[float]:
    reach = int(truncate * sigma + 0.5)
    raw = [exp(-0.5 * (k / sigma) ** 2) for k in range(-reach, reach + 1)]
    total = sum(raw)
    return [w / total for w in raw]


def gaussian(pixels: DataFrame, image: list[str], value: str, sigma: float) -> DataFrame:
    """image, y, x, value smoothed by a separable Gaussian cut at 4 sigma, edges reflected."""
    weights = gaussian_weights(sigma)
    return line_filter(line_filter(pixels, image, value, weights, "y"), image, value, weights, "x")


def _extent(pixels: DataFrame, image: list[str]) -> DataFrame:
    return pixels.groupBy(*image).agg((F.max("y") + 1).alias("_h"), (F.max("x") + 1).alias("_w"))


def _around(pixels: DataFrame, image: list[str], offsets: list[tuple[int, int]]) -> DataFrame:
    """Each pixel once per offset: its columns, and _ty, _tx = where the offset leads."""
    steps = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in offsets])
    out = pixels.withColumn("_o", F.explode(steps))
    return out.withColumns({"_ty": F.col("y") + F.col("_o.dy"), "_tx": F.col("x") + F.col("_o.dx")})


def median_filter(pixels: DataFrame, image: list[str], values: list[str], size: int = 3) -> DataFrame:
    """image, y, x and the median of each value over size x size, edges reflected (edge pixel repeated)."""
    low, high = -(size // 2), size - size // 2
    box = [(dy, dx) for dy in range(low, high) for dx in range(low, high)]
    edges = _extent(pixels, image)
    wanted = _around(pixels.select(*image, "y", "x"), image, box).join(edges, image)

    def reflected(i: Column, n: Column) -> Column:
        k = F.pmod(i, 2 * n)
        return F.when(k < n, k).otherwise(2 * n - 1 - k)

    wanted = wanted.select(
        *image, "y", "x", reflected(F.col("_ty"), F.col("_h")).alias("_sy"), reflected(F.col("_tx"), F.col("_w")).alias("_sx")
    )
    source = pixels.select(*image, F.col("y").alias("_sy"), F.col("x").alias("_sx"), *values)
    joined = wanted.join(source, [*image, "_sy", "_sx"])
    return joined.groupBy(*image, "y", "x").agg(*[F.median(v).alias(v) for v in values])


def distances(mask: DataFrame, image: list[str], flag: str, metric: str = "steps") -> DataFrame:
    """image, y, x, d: how far the nearest set pixel is, 0 at set ones, null in an image without any.

    steps counts moves to the four neighbours, straight is the Euclidean distance. Two passes over lines of the image, first
    along columns, then along rows over what the first gave; work and shuffle do not depend on how far anything is.
    """
    if metric not in ("steps", "straight"):
        raise ValueError(f"unknown metric {metric}")
    own = mask.select(*image, "y", "x", F.coalesce(flag, F.lit(False)).alias("_set"))
    column = Window.partitionBy(*image, "x").orderBy("y")
    up = F.max(F.when(F.col("_set"), F.col("y"))).over(column.rowsBetween(Window.unboundedPreceding, 0))
    down = F.min(F.when(F.col("_set"), F.col("y"))).over(column.rowsBetween(0, Window.unboundedFollowing))
    lines = own.select(*image, "y", "x", F.least(F.col("y") - up, down - F.col("y")).cast("double").alias("_g"))
    if metric == "steps":
        row = Window.partitionBy(*image, "y").orderBy("x")
        left = F.min(F.col("_g") - F.col("x")).over(row.rowsBetween(Window.unboundedPreceding, 0)) + F.col("x")
        right = F.min(F.col("_g") + F.col("x")).over(row.rowsBetween(0, Window.unboundedFollowing)) - F.col("x")
        return lines.select(*image, "y", "x", F.least(left, right).alias("d"))

    def straight(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("x")
        return p.drop(columns="_g").assign(d=lower_envelope(p["x"].to_numpy(float), p["_g"].to_numpy(float)))

    kinds = ", ".join(f"`{c}` {t}" for c, t in lines.dtypes if c != "_g")
    return lines.groupBy(*image, "y").applyInPandas(straight, f"{kinds}, d double")


def lower_envelope(x: np.ndarray, g: np.ndarray) -> np.ndarray:
    """sqrt of the least (x - x')^2 + g(x')^2 over x' at every x (ascending), by the parabolas' lower envelope; NaN is no parabola."""
    known = np.flatnonzero(~np.isnan(g))
    if not len(known):
        return np.full(len(x), np.nan)
    at, height = x[known].tolist(), (g[known] ** 2 + x[known] ** 2).tolist()
    kept, starts = [0], [-np.inf]
    for i in range(1, len(at)):
        while True:  # where parabola i gets below the last one kept
            j = kept[-1]
            cross = (height[i] - height[j]) / (2 * (at[i] - at[j]))
            if cross > starts[-1]:
                break
            kept.pop()
            starts.pop()
        kept.append(i)
        starts.append(cross)
    own = known[np.array(kept)[np.searchsorted(np.array(starts), x, side="right") - 1]]
    return np.sqrt((x - x[own]) ** 2 + g[own] ** 2)


def dilated(mask: DataFrame, image: list[str], flag: str, rounds: int = 1) -> DataFrame:
    """image, y, x, flag: `rounds` dilations with the cross, i.e. what lies within that many steps of a set pixel."""
    near = F.coalesce(F.col("d") <= rounds, F.lit(False))
    return distances(mask, image, flag).select(*image, "y", "x", near.alias(flag))


def eroded(mask: DataFrame, image: list[str], flag: str, rounds: int = 1) -> DataFrame:
    """The same for erosion; beyond the image counts as false."""
    edges = _extent(mask, image)
    off = dilated(mask.withColumn(flag, ~F.coalesce(flag, F.lit(False))), image, flag, rounds).join(edges, image)
    inside = (
        (F.col("y") >= rounds) & (F.col("y") < F.col("_h") - rounds) & (F.col("x") >= rounds) & (F.col("x") < F.col("_w") - rounds)
    )
    return off.select(*image, "y", "x", (~F.col(flag) & inside).alias(flag))


def labelled(mask: DataFrame, image: list[str], flag: str) -> DataFrame:
    """image, y, x, label of the pixels that are set: 4-connected components, labelled within and over images.

    Set pixels of a row that touch form a run; runs of neighbouring rows that overlap are linked; the components of the
    run graph are the labels. Runs, not pixels, enter the graph, so it is about as small as the outlines.
    """
    line = Window.partitionBy(*image, "y").orderBy("x")
    on = mask.where(flag).select(*image, "y", "x")
    run_start = F.max(F.when(F.coalesce(F.col("x") - F.lag("x").over(line), F.lit(2)) > 1, F.col("x"))).over(
        line.rowsBetween(Window.unboundedPreceding, 0)
    )
    pixels = on.withColumn("_from", run_start).withColumn("_run", F.xxhash64(*image, "y", "_from"))
    below = pixels.select(*image, (F.col("y") - 1).alias("y"), "x", F.col("_run").alias("b"))
    links = pixels.select(*image, "y", "x", F.col("_run").alias("a")).join(below, [*image, "y", "x"]).select("a", "b").distinct()
    roots = connected_components(links)
    return pixels.join(roots, pixels["_run"] == roots["node"], "left").select(
        *image, "y", "x", F.coalesce("root", "_run").alias("label")
    )


def threshold_mask(pixels: DataFrame, image: list[str], value: str, sigma: float, flag: str = "m") -> DataFrame:
    """pixels with flag: value > median + sigma * 1.4826 MAD of the image; nothing is set where the MAD is 0."""
    w = Window.partitionBy(*image)
    off = pixels.withColumn("_med", F.median(value).over(w)).withColumn("_off", F.abs(F.col(value) - F.col("_med")))
    noise = 1.4826 * F.median("_off").over(w)
    return off.withColumn("_noise", noise).withColumn(
        flag, (F.col("_noise") >= 1e-6) & (F.col(value) > F.col("_med") + sigma * F.col("_noise"))
    ).drop("_med", "_off", "_noise")


def large_components(mask: DataFrame, image: list[str], flag: str, least: int, most: int | None = None) -> DataFrame:
    """image, y, x, label of the components whose area is within the bounds."""
    labels = labelled(mask, image, flag)
    area = labels.groupBy(*image, "label").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least)
    if most is not None:
        area = area.where(F.col("_n") <= most)
    return labels.join(area.select(*image, "label"), [*image, "label"], "left_semi").select(*image, "y", "x", "label")


def star_counts(pixels: DataFrame, image: list[str], value: str, sigma: float = 5.0, least: int = 4) -> DataFrame:
    """image, n_stars: components of bright pixels with `least` pixels or more (0 where there are none)."""
    found = large_components(threshold_mask(pixels, image, value, sigma), image, "m", least)
    counted = found.groupBy(*image).agg(F.countDistinct("label").alias("n_stars"))
    return pixels.select(*image).distinct().join(counted, image, "left").withColumn("n_stars", F.coalesce("n_stars", F.lit(0)))


def marked(mask: DataFrame, image: list[str], lit: DataFrame, flag: str) -> DataFrame:
    """image, y, x, flag of mask's grid: true at the pixels of lit."""
    return mask.select(*image, "y", "x").join(
        lit.select(*image, "y", "x").distinct().withColumn(flag, F.lit(True)), [*image, "y", "x"], "left"
    ).withColumn(flag, F.coalesce(flag, F.lit(False)))


def star_mask(pixels: DataFrame, image: list[str], value: str, sigma: float = 5.0, least: int = 9, grow: int = 3) -> DataFrame:
    found = large_components(threshold_mask(pixels, image, value, sigma), image, "m", least)
    return dilated(marked(pixels, image, found, "m"), image, "m", grow)


def united(a: DataFrame, b: DataFrame, image: list[str], flag: str = "m") -> DataFrame:
    other = b.select(*image, "y", "x", F.col(flag).alias("_other"))
    return a.join(other, [*image, "y", "x"]).select(*image, "y", "x", (F.col(flag) | F.col("_other")).alias(flag))


def object_mask(
    pixels: DataFrame, image: list[str], value: str, star_sigma: float = 5.0, extended_sigma: float = 2.0,
    least: int = 9, smooth: float = 30.0, star_grow: int = 5, extended_grow: int = 10,
) -> DataFrame:
    """Stars and extended objects: bright components, and what stands out of the smoothed image, both grown."""
    extended = threshold_mask(gaussian(pixels, image, value, smooth), image, value, extended_sigma)
    return united(
        star_mask(pixels, image, value, star_sigma, least, star_grow), dilated(extended, image, "m", extended_grow), image
    )


def extended_mask(
    df: DataFrame, image: list[str], star_sigma: float = 5.0, sigma: float = 1.5, smooth: float = 50.0, star_grow: int = 5, grow: int = 20
) -> DataFrame:
    """image, y, x, m from r, g, b: bright pixels of any area, and what stands out of the smoothed luma, both grown."""
    own = df.select(*image, "y", "x", luma(*(F.col(c) for c in "rgb")).alias("_l"))
    stars = dilated(threshold_mask(own, image, "_l", star_sigma), image, "m", star_grow)
    wide = dilated(threshold_mask(gaussian(own, image, "_l", smooth), image, "_l", sigma), image, "m", grow)
    return united(stars, wide, image)


def filled(mask: DataFrame, image: list[str], flag: str) -> DataFrame:
    """Holes set: unset components that do not reach the border of the image."""
    edges = _extent(mask, image)
    off = mask.select(*image, "y", "x", (~F.coalesce(flag, F.lit(False))).alias("_off"))
    labels = labelled(off, image, "_off").join(edges, image)
    border = (F.col("y") == 0) | (F.col("x") == 0) | (F.col("y") == F.col("_h") - 1) | (F.col("x") == F.col("_w") - 1)
    holes = labels.groupBy(*image, "label").agg(F.bool_or(border).alias("_open")).where(~F.col("_open"))
    inside = labels.join(holes.select(*image, "label"), [*image, "label"], "left_semi")
    return united(mask.select(*image, "y", "x", flag), marked(mask, image, inside, flag), image, flag)


def galaxy_mask(
    pixels: DataFrame, image: list[str], value: str, sigma: float = 1.5, scales=(50.0, 100.0, 200.0), grow: int = 50, least_share: float = 0.01
) -> DataFrame:
    """Extended light at several scales against the corners' background, grown, holes filled."""
    edges = _extent(pixels, image)
    side = F.floor(F.least("_h", "_w") / 8)
    own = pixels.join(edges, image)
    corner = ((F.col("y") < side) | (F.col("y") >= F.col("_h") - side)) & ((F.col("x") < side) | (F.col("x") >= F.col("_w") - side))
    corners = own.where(corner).select(*image, F.col(value).alias("_v"))
    w = Window.partitionBy(*image)
    level = (
        corners.withColumn("_m", F.median("_v").over(w))
        .groupBy(*image)
        .agg(F.first("_m").alias("_sky"), (1.4826 * F.median(F.abs(F.col("_v") - F.col("_m")))).alias("_noise"))
    )
    out = pixels.select(*image, "y", "x", F.lit(False).alias("m"))
    for scale in scales:
        smooth = gaussian(pixels, image, value, scale).join(level, image)
        bright = smooth.withColumn("m", F.col(value) > F.col("_sky") + sigma * F.col("_noise"))
        share = F.avg(F.col("m").cast("double")).over(w)
        bright = bright.withColumn("_share", share).withColumn("m", F.col("m") & (F.col("_share") >= least_share))
        out = united(out, bright.select(*image, "y", "x", "m"), image)
    return filled(dilated(out, image, "m", grow), image, "m")


def feathered(mask: DataFrame, image: list[str], weight: str, width: int = 10) -> DataFrame:
    """image, y, x, weight: min(1, distance to the nearest unset pixel / width); a plain copy if width <= 0.

    Set means weight > 0.5; an image without unset pixels stays 1 all over (its border is no edge).
    """
    own = mask.select(*image, "y", "x", (F.coalesce(F.col(weight), F.lit(0.0)) > 0.5).alias("_on"))
    if width <= 0:
        return own.select(*image, "y", "x", F.col("_on").cast("double").alias(weight))
    off = distances(own.withColumn("_off", ~F.col("_on")), image, "_off", "straight")
    return off.select(*image, "y", "x", F.least(F.coalesce(F.col("d") / width, F.lit(1.0)), F.lit(1.0)).alias(weight))


def soft_mask(mask: DataFrame, image: list[str], flag: str, radius: float = 10.0) -> DataFrame:
    own = mask.select(*image, "y", "x", F.col(flag).cast("double").alias("soft"))
    return gaussian(own, image, "soft", radius)


def chroma_cleaned(rgb: DataFrame, image: list[str], size: int = 3) -> DataFrame:
    """image, y, x, r, g, b with the colour differences median filtered and the luminance kept."""
    luma = 0.299 * F.col("r") + 0.587 * F.col("g") + 0.114 * F.col("b")
    own = rgb.select(*image, "y", "x", luma.alias("l"), (F.col("b") - luma).alias("cb"), (F.col("r") - luma).alias("cr"))
    clean = own.select(*image, "y", "x", "l").join(median_filter(own, image, ["cb", "cr"], size), [*image, "y", "x"])
    zero = F.lit(0.0)
    r, b = F.greatest(F.col("l") + F.col("cr"), zero), F.greatest(F.col("l") + F.col("cb"), zero)
    return clean.select(
        *image, "y", "x", r.alias("r"), F.greatest((F.col("l") - 0.299 * r - 0.114 * b) / 0.587, zero).alias("g"), b.alias("b")
    )


def bilateral(pixels: DataFrame, image: list[str], value: str, reach: int, sigma_value: str, sigma_space: float) -> DataFrame:
    """image, y, x, value: mean of the window weighted by nearness in place and value (column sigma_value)."""
    box = [(dy, dx) for dy in range(-reach, reach + 1) for dx in range(-reach, reach + 1)]
    source = pixels.select(*image, F.col("y").alias("_ty"), F.col("x").alias("_tx"), F.col(value).alias("_v"))
    near = _around(pixels, image, box).join(source, [*image, "_ty", "_tx"])
    space = (F.col("_o.dy") * F.col("_o.dy") + F.col("_o.dx") * F.col("_o.dx")) / (2.0 * sigma_space**2)
    off = F.col("_v") - F.col(value)
    weight = F.exp(-space) * F.when(F.col(sigma_value) > 0, F.exp(-off * off / (2 * F.col(sigma_value) * F.col(sigma_value)))).otherwise(1.0)
    return near.groupBy(*image, "y", "x").agg((F.sum(F.col("_v") * weight) / F.sum(weight)).alias(value))


def background_denoised(
    pixels: DataFrame, image: list[str], value: str, method: str = "median", size: int = 3, mask: DataFrame | None = None, feather: float = 10.0
) -> DataFrame:
    """image, y, x, value: filtered where the soft mask is 0, as it was where it is 1."""
    if method == "median":
        calm = median_filter(pixels, image, [value], size)
    elif method == "gaussian":
        calm = gaussian(pixels, image, value, size / 2.0)
    elif method == "bilateral":
        w = Window.partitionBy(*image)
        off = pixels.withColumn("_off", F.abs(F.col(value) - F.median(value).over(w)))
        calm = bilateral(off.withColumn("_s", 2 * 1.4826 * F.median("_off").over(w)), image, value, ceil(size / 2), "_s", size)
    else:
        raise ValueError(f"unknown method {method}")
    calm = calm.withColumnRenamed(value, "_calm")
    own = pixels.select(*image, "y", "x", value).join(calm, [*image, "y", "x"])
    if mask is None:
        return own.select(*image, "y", "x", F.col("_calm").alias(value))
    soft = soft_mask(mask, image, "m", feather)
    kept = F.col("soft") * F.col(value) + (1 - F.col("soft")) * F.col("_calm")
    return own.join(soft, [*image, "y", "x"]).select(*image, "y", "x", kept.alias(value))


def local_contrast(
    pixels: DataFrame, image: list[str], value: str, scale: float = 50.0, strength: float = 0.5, stars: DataFrame | None = None
) -> DataFrame:
    """image, y, x, value + strength * (value - smoothed), within [0, 1]; strength 0.2 on stars."""
    smooth = gaussian(pixels, image, value, scale).withColumnRenamed(value, "_smooth")
    own = pixels.select(*image, "y", "x", value).join(smooth, [*image, "y", "x"])
    if stars is None:
        own = own.withColumn("m", F.lit(False))
    else:
        own = own.join(stars.select(*image, "y", "x", "m"), [*image, "y", "x"])
    k = F.when(F.col("m"), F.lit(0.2)).otherwise(F.lit(float(strength)))
    out = F.col(value) + k * (F.col(value) - F.col("_smooth"))
    return own.select(*image, "y", "x", F.least(F.greatest(out, F.lit(0.0)), F.lit(1.0)).alias(value))
