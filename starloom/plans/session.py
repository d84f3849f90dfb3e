"""Whole plans: a session from frames to a stacked master, luminance processing, colour processing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import mosaic, tone
from starloom.operators import background, colour, stack, stencil, tiles
from starloom.operators.pixels import to_pixels
from starloom.plans import align
from starloom.schema import LuminanceSettings, StackSettings

SESSION = ["session"]


@dataclass
class StackResult:
    scores: DataFrame
    references: DataFrame
    transforms: DataFrame
    master: DataFrame
    statistics: DataFrame


def stacked_session(frames: DataFrame, settings: StackSettings | None = None, exposure: float = 15.0) -> StackResult:
    """frames (session, frame_id, height, width, data) -> scores, reference, transforms, master, statistics.

    Scores count stars; settings.align and settings.debayer say how frames are registered and stacked (see
    align.registered). Without demosaicing the master has v, n (frames that lie there) and n_kept, clipped about the
    median; else it is that of align.aligned_session, whose statistics name the usual clipped share. Frames are cut into
    tiles, and only the pixels of the stack become rows. Frames of a session have one size; those without data drop out.
    """
    s = (settings or StackSettings()).validate()
    got = align.registered(frames, s)
    n = got.transforms.where("success").groupBy(*SESSION).agg(F.count(F.lit(1)).alias("n_stacked"))
    if s.debayer != "none":
        master = align.colour_stack(got, s)
        return StackResult(got.scores, got.references, got.transforms, master, stack.joint_statistics(master.join(n, SESSION), SESSION, "n_stacked", exposure))
    if s.align == "none":  # places mean the same as they are: nothing to resample
        whole = tiles.with_span(got.frames.withColumnRenamed("data", "v"), SESSION, 1)
        cut, weight, threshold = tiles.in_tiles(whole, [*align.KEYS, "width", "span"], ["v"]), None, None
    else:
        cut, weight, threshold = align.warped_tiles(got.frames, got.transforms, "mono", half=False), "mask", 0.5
    stacked = tiles.stacked_tiles(cut, SESSION, "frame_id", ["v"], tiles.clip_mean(s.sigma, s.maxiters, threshold=threshold), ["v", "n", "n_kept"], weight)
    master = tiles.tile_pixels(stacked, SESSION, {"v": "double", "n": "long", "n_kept": "long"})
    return StackResult(got.scores, got.references, got.transforms, master, stack.stack_statistics(master.join(n, SESSION), SESSION, "v", "n_stacked", exposure))


def colour_master(frames: DataFrame, settings: StackSettings | None = None) -> DataFrame:
    """session, y, x, r, g, b: frames are demosaiced row by row, then stacked per channel."""
    s = settings or StackSettings()
    h, w, d = F.col("height"), F.col("width"), F.col("data")
    rgb = frames.select(*SESSION, "frame_id", "height", "width", *[mosaic.bilinear(d, h, w, c).alias(c) for c in "rgb"])
    pixels = to_pixels(rgb, [*SESSION, "frame_id"], {c: c for c in "rgb"})
    return stack.sigma_clip_mean(pixels, [*SESSION, "y", "x"], ["r", "g", "b"], s.sigma, s.maxiters)


def processed_luminance(image: DataFrame, keys: list[str], value: str, settings: LuminanceSettings | None = None) -> DataFrame:
    """keys, y, x, value in [0, 1]: background, noise, stretch, local contrast."""
    s = (settings or LuminanceSettings()).validate()
    out = image.select(*keys, "y", "x", value)
    if s.subtract_bg:
        out = background.without_background(background.estimated(out, keys, value, s.bg_cell_size, model=s.bg_model), keys, value)
    if s.reduce_noise:
        mask = stencil.object_mask(out, keys, value)
        out = stencil.background_denoised(out, keys, value, s.noise_method, s.noise_filter_size, mask)
    if s.stretch_mode == "single":
        out = colour.soft_stretched(out, keys, value, 0.0, s.asinh_stretch)
    else:
        out = colour.two_stage_stretched(out, keys, value)
    if s.enhance_contrast:
        stars = stencil.star_mask(out, keys, value, 3.0) if s.protect_stars else None
        out = stencil.local_contrast(out, keys, value, float(s.contrast_scale), s.contrast_strength, stars)
    return out


def processed_colour(
    rgb: DataFrame, keys: list[str], balance: str = "gray_world", sky: str = "common", matrix: str = "neutral",
    green: float = 0.5, saturation: float = 1.2, luminance: DataFrame | None = None, method: str = "lab", least: int = 100,
) -> DataFrame:
    """keys, y, x, r, g, b in [0, 1]: calibration, colour matrix, green removal, saturation, linked stretch or LRGB."""
    out = colour.calibrated(rgb.select(*keys, "y", "x", "r", "g", "b"), keys, balance, sky, least=least)
    out = colour.with_rgb(out, tone.colour_corrected(colour.cols(), matrix))
    out = colour.with_rgb(out, tone.scnr(colour.cols(), green))
    out = out.withColumn("_top", colour.image_max(out, keys))
    out = colour.with_rgb(out, tone.saturated(colour.cols(), F.col("_top"), saturation)).drop("_top")
    out = colour.linked_stretched(out, keys)
    return out if luminance is None else colour.combined_lrgb(luminance, out, keys, method)
