"""Colour of linear images: white balance, calibration, stars and their photometry, image-wide stretches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions import tone
from starloom.operators.background import sky_levels
from starloom.operators.stencil import eroded, gaussian, large_components, threshold_mask

RGB = ("r", "g", "b")


def cols() -> tone.Rgb:
    return tuple(F.col(c) for c in RGB)


def with_rgb(df: DataFrame, rgb: tone.Rgb) -> DataFrame:
    return df.withColumns(dict(zip(RGB, rgb)))


def image_max(df: DataFrame, image: list[str]) -> Column:
    return F.max(F.greatest(*RGB)).over(Window.partitionBy(*image))


def percentiles(df: DataFrame, image: list[str], value: Column, shares: dict[str, float]) -> DataFrame:
    """image and the exact percentiles (linear interpolation) of value."""
    return df.select(*image, value.alias("_p")).groupBy(*image).agg(
        *[F.percentile("_p", F.lit(share / 100.0)).alias(name) for name, share in shares.items()]
    )


def percentile_stretched(
    df: DataFrame, image: list[str], value: str, low: float = 1.0, high: float = 99.5, a: float | None = 0.1, quantiles=percentiles
) -> DataFrame:
    """value through the percentile asinh stretch of its image (linear if a is None).

    quantiles may be plans.order.exact_quantiles, for images too large for one aggregate's buffer.
    """
    bounds = quantiles(df, image, F.col(value), {"_low": low, "_high": high})
    x = tone.normalised(F.col(value), F.col("_low"), F.col("_high"))
    out = x if a is None else tone.percentile_asinh(F.col(value), F.col("_low"), F.col("_high"), a)
    return df.join(bounds, image).withColumn(value, out).drop("_low", "_high")


def over_max(df: DataFrame, image: list[str], value: str) -> DataFrame:
    top = F.max(value).over(Window.partitionBy(*image))
    return df.withColumn(value, F.when(top > 0, F.col(value) / F.nullif(top, F.lit(0.0))).otherwise(F.col(value)))


def soft_stretched(df: DataFrame, image: list[str], value: str, black: float = 0.0, stretch: float = 0.1) -> DataFrame:
    return over_max(df.withColumn(value, tone.soft_asinh(F.col(value), black, stretch)), image, value)


def two_stage_stretched(
    df: DataFrame, image: list[str], value: str, core: float = 99.5, faint_stretch: float = 0.05, core_stretch: float = 0.5,
    blend: float = 0.1, smooth: float = 10.0,
) -> DataFrame:
    """image, y, x, value: a strong stretch below the core threshold, a gentle one above, over a smoothed blend mask."""
    bounds = percentiles(df, image, F.col(value), {"_low": 0.5, "_high": 99.9})
    own = df.select(*image, "y", "x", value).join(bounds, image)
    own = own.withColumn("_n", tone.normalised(F.col(value), F.col("_low"), F.col("_high"), 0.0)).drop("_low", "_high")
    own = own.join(percentiles(own, image, F.col("_n"), {"_t": core}), image)
    own = own.withColumns({"_f": F.col("_n"), "_c": F.col("_n")})
    own = soft_stretched(soft_stretched(own, image, "_f", 0.0, faint_stretch), image, "_c", 0.0, core_stretch)
    own = own.withColumn("_b", tone.clip((F.col("_n") - F.col("_t")) / (blend * F.col("_t") + 1e-6)))
    mask = gaussian(own, image, "_b", smooth)
    joined = own.drop("_b").join(mask, [*image, "y", "x"])
    return joined.select(*image, "y", "x", ((1 - F.col("_b")) * F.col("_f") + F.col("_b") * F.col("_c")).alias(value))


def linked_stretched(df: DataFrame, image: list[str], low: float = 0.5, high: float = 99.9, stretch: float = 0.1) -> DataFrame:
    """One stretch for all channels, from percentiles of the luminance, over the image maximum."""
    bounds = percentiles(df, image, tone.luma(*cols()), {"_low": low, "_high": high})
    white = F.when(F.col("_high") <= F.col("_low"), F.col("_low") + 1).otherwise(F.col("_high"))
    own = df.join(bounds, image)
    rgb = tuple(tone.soft_asinh((c - F.col("_low")) / (white - F.col("_low")), 0.0, stretch) for c in cols())
    own = with_rgb(own, rgb).drop("_low", "_high")
    top = F.nullif(image_max(own, image), F.lit(0.0))
    return with_rgb(own.withColumn("_top", top), tuple(F.coalesce(tone.clip(c / F.col("_top")), F.lit(0.0)) for c in cols())).drop("_top")


def bayer_compensated(df: DataFrame, image: list[str], r_gain: float | None = None, b_gain: float | None = None) -> DataFrame:
    """Red and blue brought to green by medians of the image, or by the gains that are given."""
    if r_gain is not None or b_gain is not None:
        return df.withColumns({"r": F.col("r") * (r_gain or 1.0), "b": F.col("b") * (b_gain or 1.0)})
    med = df.groupBy(*image).agg(*[F.median(c).alias(f"_m{c}") for c in RGB])

    def gain(c: str) -> Column:
        return F.when(F.col(f"_m{c}") > 0, F.col("_mg") / F.nullif(F.col(f"_m{c}"), F.lit(0.0))).otherwise(F.lit(1.0))

    own = df.join(med, image)
    return own.withColumns({"r": F.col("r") * gain("r"), "b": F.col("b") * gain("b")}).drop("_mr", "_mg", "_mb")


def common_footprint(df: DataFrame, image: list[str], share: float = 0.01, rounds: int = 3) -> DataFrame:
    """image, y, x, m: where every channel exceeds share of the image maximum, eroded; all of an image without light."""
    own = df.withColumn("_top", image_max(df, image))
    lit = F.least(*RGB) > share * F.col("_top")
    marked = own.select(*image, "y", "x", lit.alias("m"), (F.col("_top") <= 0).alias("_dark"))
    shrunk = eroded(marked, image, "m", rounds)
    dark = marked.select(*image, "y", "x", "_dark")
    return shrunk.join(dark, [*image, "y", "x"]).select(*image, "y", "x", (F.col("m") | F.col("_dark")).alias("m"))


def scaled_gains(gains: tone.Rgb) -> tone.Rgb:
    top = F.greatest(*gains)
    return tuple(g / top for g in gains)


def gray_world(df: DataFrame, image: list[str], levels: DataFrame | None = None) -> DataFrame:
    """image, wb_r, wb_g, wb_b: channel medians (less sky levels, at least 1, if given) to their mean; greatest gain 1."""
    med = df.groupBy(*image).agg(*[F.median(c).alias(f"_m{c}") for c in RGB])
    if levels is None:
        mean = (F.col("_mr") + F.col("_mg") + F.col("_mb")) / 3
        dark = F.col("_mg") < 1e-6
        raw = tuple(F.when(F.col(f"_m{c}") > 0, mean / F.nullif(F.col(f"_m{c}"), F.lit(0.0))).otherwise(F.lit(1.0)) for c in RGB)
        gains = tuple(F.when(dark, F.lit(1.0)).otherwise(g) for g in scaled_gains(raw))
    else:
        med = med.join(levels, image)
        own = tuple(F.greatest(F.col(f"_m{c}") - F.col(f"bg_{c}"), F.lit(1.0)) for c in RGB)
        gains = scaled_gains(tuple((own[0] + own[1] + own[2]) / 3 / m for m in own))
    return med.select(*image, *[g.alias(f"wb_{c}") for c, g in zip(RGB, gains)])


def star_ratios_balance(ratios: DataFrame, fallback: DataFrame, image: list[str], least: int = 5) -> DataFrame:
    """image, wb_r, wb_g, wb_b from star fluxes (r_flux, g_flux, b_flux); images with fewer than `least` fall back."""
    got = ratios.where("g_flux > 0").groupBy(*image).agg(
        F.count(F.lit(1)).alias("_n"), F.median(F.col("r_flux") / F.col("g_flux")).alias("_rg"), F.median(F.col("b_flux") / F.col("g_flux")).alias("_bg")
    )
    gain = lambda c: F.when(F.col(c) > 0.1, 1.0 / F.nullif(F.col(c), F.lit(0.0))).otherwise(F.lit(1.0))
    gains = scaled_gains((gain("_rg"), F.lit(1.0), gain("_bg")))
    own = got.where(F.col("_n") >= least).select(*image, *[g.alias(f"s_{c}") for c, g in zip(RGB, gains)])
    return fallback.join(own, image, "left").select(*image, *[F.coalesce(f"s_{c}", f"wb_{c}").alias(f"wb_{c}") for c in RGB])


def reference_stars(
    df: DataFrame, image: list[str], sigma: float = 5.0, least: int = 16, most: int = 500, saturation: float = 0.95, n_stars: int = 50
) -> DataFrame:
    """image, y, x, r_flux, g_flux, b_flux of stars for colour: components in the area bounds, unsaturated, fluxes >= 1.

    By green flux: of more than 2 n_stars those from the first quarter on, of more than n_stars the dimmest n_stars.
    """
    own = df.withColumn("_l", tone.luma(*cols())).withColumn("_top", image_max(df, image))
    labels = large_components(threshold_mask(own, image, "_l", sigma), image, "m", least, most)
    stars = labels.join(own, [*image, "y", "x"]).groupBy(*image, "label").agg(
        F.floor(F.avg("y")).cast("int").alias("y"),
        F.floor(F.avg("x")).cast("int").alias("x"),
        *[F.sum(c).alias(f"{c}_flux") for c in RGB],
        F.max(F.greatest(*RGB)).alias("_peak"),
        F.max("_top").alias("_top"),
    )
    good = stars.where((F.col("_peak") <= saturation * F.col("_top")) & (F.least("r_flux", "g_flux", "b_flux") >= 1))
    return picked_stars(good.select(*image, "y", "x", "r_flux", "g_flux", "b_flux"), image, n_stars)


def picked_stars(stars: DataFrame, image: list[str], n_stars: int) -> DataFrame:
    order = Window.partitionBy(*image).orderBy("g_flux", "y", "x")
    own = stars.withColumn("_i", F.row_number().over(order) - 1).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*image)))
    start = F.when(F.col("_n") > 2 * n_stars, F.floor(F.col("_n") / 4)).otherwise(F.lit(0))
    many = F.col("_n") > n_stars
    return own.where(~many | ((F.col("_i") >= start) & (F.col("_i") < start + n_stars))).drop("_i", "_n")


def aperture_fluxes(
    stars: DataFrame, df: DataFrame, image: list[str], radius: int = 4, inner: int = 6, outer: int = 10, least_area: int = 5, least_ring: int = 15
) -> DataFrame:
    """image, y, x, r_flux, g_flux, b_flux: aperture sums less the clipped annulus median; rejected stars are left out.

    Rejected are stars near the border, with too faint a flux, or with fewer pixels than least_area and least_ring in the
    aperture and the annulus.

    Stars meet pixels by blocks of the image (an equi-join on image and block), never by a range join.
    """
    block = 2 * outer + 1
    edges = df.groupBy(*image).agg((F.max("y") + 1).alias("_h"), (F.max("x") + 1).alias("_w"))
    margin = outer + 1
    own = stars.select(*image, F.col("y").alias("sy"), F.col("x").alias("sx")).join(edges, image).where(
        (F.col("sy") >= margin) & (F.col("sy") < F.col("_h") - margin) & (F.col("sx") >= margin) & (F.col("sx") < F.col("_w") - margin)
    )
    around = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    own = own.withColumn("_k", F.explode(around)).select(
        *image, "sy", "sx", (F.floor(F.col("sy") / block) + F.col("_k.a")).alias("_by"), (F.floor(F.col("sx") / block) + F.col("_k.b")).alias("_bx")
    )
    pixels = df.withColumns({"_by": F.floor(F.col("y") / block), "_bx": F.floor(F.col("x") / block)})
    dist = F.sqrt(((F.col("y") - F.col("sy")) * (F.col("y") - F.col("sy")) + (F.col("x") - F.col("sx")) * (F.col("x") - F.col("sx"))).cast("double"))
    near = own.join(pixels, [*image, "_by", "_bx"]).withColumn("_d", dist).where(F.col("_d") <= outer)
    keys = [*image, "sy", "sx"]
    long = near.select(*keys, "_d", F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in RGB]), F.array(*RGB))).alias("channel", "v"))
    w = Window.partitionBy(*keys, "channel")
    ring = F.when(F.col("_d") >= inner, F.col("v"))
    long = long.withColumn("_ring", ring).withColumn("_m", F.median("_ring").over(w))
    long = long.withColumn("_s", 1.4826 * F.median(F.abs(F.col("_ring") - F.col("_m"))).over(w))
    kept = F.when((F.col("_s") > 0) & (F.abs(F.col("_ring") - F.col("_m")) < 2.5 * F.col("_s")), F.col("_ring"))
    net = long.withColumn("_kept", kept).groupBy(*keys, "channel").agg(
        F.sum(F.when(F.col("_d") <= radius, F.col("v"))).alias("flux"),
        F.count(F.when(F.col("_d") <= radius, 1)).alias("area"),
        F.count(F.when(F.col("_d") >= inner, 1)).alias("ring"),
        F.when(F.count("_kept") > 10, F.median("_kept")).otherwise(F.max("_m")).alias("sky"),
    )
    net = net.withColumn("net", F.col("flux") - F.col("area") * F.col("sky"))
    wide = net.groupBy(*keys).agg(
        *[F.max(F.when(F.col("channel") == c, F.col("net"))).alias(f"{c}_flux") for c in RGB], F.max("area").alias("_area"), F.max("ring").alias("_ring")
    )
    enough = (F.col("_area") >= least_area) & (F.col("_ring") >= least_ring)
    good = wide.where(enough & (F.least("r_flux", "g_flux", "b_flux") >= 0.5 * F.col("_area")))
    return good.select(*image, F.col("sy").alias("y"), F.col("sx").alias("x"), "r_flux", "g_flux", "b_flux")


def calibrated(
    df: DataFrame, image: list[str], balance: str = "gray_world", background: str = "common",
    gains: tuple[float, float, float] | None = None, least: int = 100,
) -> DataFrame:
    """df with r, g, b less the sky (none, common, per_channel) and times the gains; gains given win over measured ones."""
    if background not in ("none", "common", "per_channel"):
        raise ValueError(f"unknown background {background}")
    levels = sky_levels(df, image, least=least)
    if gains is not None or balance == "none":
        wb = levels.select(*image, *[F.lit(float(g)).alias(f"wb_{c}") for c, g in zip(RGB, gains or (1.0, 1.0, 1.0))])
    elif balance == "gray_world":
        wb = gray_world(df, image, levels)
    elif balance == "stars":
        wb = star_ratios_balance(aperture_fluxes(reference_stars(df, image), df, image), gray_world(df, image, levels), image)
    else:
        raise ValueError(f"unknown balance {balance}")
    own = df.join(levels.join(wb, image), image)
    low = F.least("bg_r", "bg_g", "bg_b")
    out = []
    for c in RGB:
        v = F.col(c)
        if background != "none":
            v = F.greatest(v - (low if background == "common" else F.col(f"bg_{c}")), F.lit(0.0))
        out.append(v * F.col(f"wb_{c}"))
    return with_rgb(own, tuple(out)).drop(*[f"{k}_{c}" for k in ("bg", "wb") for c in RGB])


def corner_box_balance(df: DataFrame, image: list[str], rows: tuple[int, int], columns: tuple[int, int], right_gap: int, least: int) -> DataFrame:
    """Green brought to the mean of red and blue by medians of two sky boxes, where they hold over `least` lit pixels."""
    edges = df.groupBy(*image).agg((F.max("x") + 1).alias("_w"))
    in_rows = (F.col("y") >= rows[0]) & (F.col("y") < rows[1])
    span = columns[1]
    left = (F.col("x") >= columns[0]) & (F.col("x") < span)
    right = (F.col("x") >= F.col("_w") - span) & (F.col("x") < F.col("_w") - right_gap)
    sky = df.join(edges, image).where(in_rows & (left | right) & (F.col("r") + F.col("g") + F.col("b") > 0))
    got = sky.groupBy(*image).agg(F.count(F.lit(1)).alias("_n"), *[F.median(c).alias(f"_m{c}") for c in RGB])
    gain = F.when((F.col("_n") > least) & (F.col("_mg") > 0), (F.col("_mr") + F.col("_mb")) / 2 / F.nullif(F.col("_mg"), F.lit(0.0)))
    own = df.join(got.select(*image, gain.alias("_gain")), image, "left")
    return own.withColumn("g", F.col("g") * F.coalesce("_gain", F.lit(1.0))).drop("_gain")


def script_stretched(df: DataFrame, image: list[str], low: float = 0.05, high: float = 0.999, a: float = 0.1) -> DataFrame:
    """df with r, g, b stretched alike: from the low to the high percentile of luma > 0, asinh, over the greatest value."""
    luma = tone.luma(*cols())
    marks = df.groupBy(*image).agg(*[F.percentile(F.when(luma > 0, luma), p).alias(n) for n, p in (("_low", low), ("_high", high))])
    scale = F.asinh(F.lit(1.0 / a))
    own = df.join(marks, image)
    own = with_rgb(own, tuple(F.asinh(F.greatest((c - F.col("_low")) / F.nullif(F.col("_high") - F.col("_low"), F.lit(0.0)), F.lit(0.0)) / a) / scale for c in cols()))
    top = own.groupBy(*image).agg(F.nullif(F.max(F.greatest(*RGB)), F.lit(0.0)).alias("_top"))
    own = own.join(top, image)
    return with_rgb(own, tuple(F.coalesce(F.least(c / F.col("_top"), F.lit(1.0)), F.lit(0.0)) for c in cols())).drop("_low", "_high", "_top")


def combined_lrgb(lum: DataFrame, rgb: DataFrame, image: list[str], method: str = "lab", weight: float = 1.0, chroma: float = 1.0) -> DataFrame:
    """image, y, x, r, g, b: luminance l joined to colour by place; each over its maximum where that exceeds 1.

    Images of different sizes are an error: a place that one of the two lacks fails the query.
    """
    w = Window.partitionBy(*image)
    top_l = F.greatest(F.max("l").over(w), F.lit(1.0))
    own = lum.select(*image, "y", "x", (F.col("l") / top_l).alias("l"))
    top = F.greatest(image_max(rgb, image), F.lit(1.0))
    scaled = with_rgb(rgb.withColumn("_top", top), tuple(c / F.col("_top") for c in cols())).drop("_top")
    sides = own.withColumn("_a", F.lit(1)), scaled.select(*image, "y", "x", *RGB, F.lit(1).alias("_b"))
    joined = sides[0].join(sides[1], [*image, "y", "x"], "full")
    alike = F.when(F.col("_a").isNull() | F.col("_b").isNull(), F.raise_error(F.lit("luminance and colour differ in size")).cast("int")).otherwise(F.col("y"))
    return joined.select(*image, alike.alias("y"), "x", *[c.alias(n) for n, c in zip(RGB, tone.lrgb(F.col("l"), cols(), method, weight, chroma))])
