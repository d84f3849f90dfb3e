"""Sessions registered by their stars: transforms, warps with validity masks, and the stacks over them.

A frame stays one row from the sensor to the warped planes: star detection, demosaicing and resampling look at one frame
each and shuffle nothing but star lists. Warped frames are cut into tiles where they are warped, tiles are dealt out once
and stacked as arrays; only the pixels of the stack become rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import mosaic, tone
from starloom.operators import colour, quality, register, stack, stencil, tiles
from starloom.operators.pixels import computed_once, to_pixels
from starloom.plans.scratch import cut
from starloom.schema import StackSettings

SESSION = ["session"]
KEYS = ["session", "frame_id"]
STARS = "array<struct<flux:double,y:double,x:double>>"


def lit_groups(lit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and columns of the set pixels and the number of their 4-connected component (its smallest pixel's place)."""
    y, x = np.nonzero(lit)
    at = np.full(lit.shape, -1)
    at[y, x] = np.arange(len(y))
    right = at[y, np.minimum(x + 1, lit.shape[1] - 1)]
    down = at[np.minimum(y + 1, lit.shape[0] - 1), x]
    own = np.arange(len(y))
    a = np.concatenate((own[right > own], own[down > own]))
    b = np.concatenate((right[right > own], down[down > own]))
    root = own.copy()
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return y, x, root


def stars_of(image: np.ndarray, sigma: float, least: int) -> list[tuple[float, float, float]]:
    """(flux above the median, y, x), the brightest first: components of pixels over median + sigma * 1.4826 MAD."""
    good = image[np.isfinite(image)]
    if not len(good):
        return []
    middle = np.median(good)
    noise = 1.4826 * np.median(np.abs(good - middle))
    if noise < 1e-6:
        return []
    y, x, group = lit_groups(np.nan_to_num(image, nan=-np.inf) > middle + sigma * noise)
    names, flat, size = np.unique(group, return_inverse=True, return_counts=True)
    weight = image[y, x] - middle
    flux = np.bincount(flat, weight, len(names))
    rows, columns = np.bincount(flat, weight * y, len(names)) / flux, np.bincount(flat, weight * x, len(names)) / flux
    return sorted(((float(f), float(v), float(u)) for f, v, u, n in zip(flux, rows, columns, size) if n >= least), reverse=True)


def star_lists(
    frames: DataFrame, sigma: float = 5.0, least: int = 4, method: str | Callable[[np.ndarray], np.ndarray] | None = "superpixel"
) -> DataFrame:
    """session, frame_id, n_stars, stars of every frame; method makes luminance of mosaics first, None takes data as it is.

    method may be a function of a frame's 2-D array, which runs in the task that looks for the stars. A frame without
    data, or flat, has no stars. Places are those of the luminance (half-size for the named methods).
    """
    own_luma = method if callable(method) else None
    half = method is not None and own_luma is None
    luma = mosaic.luminance(F.col("data"), F.col("height"), F.col("width"), method) if half else F.col("data")
    h, w = ((F.floor(F.col(c) / 2) if half else F.col(c)).cast("int").alias(c) for c in ("height", "width"))
    # the sizes get their new names in a step of their own: a lambda would take them for those of the mosaic
    src = frames.select(*KEYS, "height", "width", luma.alias("luma")).select(*KEYS, h, w, "luma")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            images = [None if a is None else np.asarray(a, float).reshape(int(h), int(w)) for a, h, w in zip(p["luma"], p["height"], p["width"])]
            own = [[] if i is None else stars_of(i if own_luma is None else own_luma(i), sigma, least) for i in images]
            yield p[KEYS].assign(n_stars=[len(s) for s in own], stars=[[dict(zip(("flux", "y", "x"), s)) for s in every] for every in own])

    keys = ", ".join(f"{c} {t}" for c, t in src.dtypes if c in KEYS)
    return src.mapInPandas(run, f"{keys}, n_stars long, stars {STARS}")


def transforms_by_stars(lists: DataFrame, references: DataFrame) -> DataFrame:
    """session, frame_id, success, error_message, matrix, n_matches against the session's reference (column reference)."""
    rows = lists.select(*KEYS, F.explode("stars").alias("s")).select(*KEYS, "s.flux", "s.y", "s.x")
    got = register.star_transforms(rows, references, SESSION)
    still = lists.select(*KEYS).join(references, SESSION).join(got, KEYS, "left")
    own = F.col("frame_id") == F.col("reference")
    identity = F.array(*[F.array(*[F.lit(float(i == j)) for j in range(3)]) for i in range(3)])
    return still.select(
        *KEYS,
        (own | F.coalesce("success", F.lit(False))).alias("success"),
        F.when(own, F.lit("")).otherwise(F.coalesce("error_message", F.lit("no stars"))).alias("error_message"),
        F.when(own, identity).otherwise(F.col("matrix")).alias("matrix"),
        F.coalesce("n_matches", F.lit(0)).alias("n_matches"),
    )


def within_failures(transforms: DataFrame, most: int) -> DataFrame:
    """The transforms of sessions in which fewer than `most` frames in a row (by id) fail; others give none."""
    runs = quality.failure_runs(transforms, SESSION, "frame_id", "success", most)
    return transforms.join(runs.where("aborted_at is null").select(*SESSION), SESSION, "left_semi")


@dataclass(frozen=True)
class Planes:
    """An own way from a frame's mosaic to planes: names, whether they are half-size, and a function of its 2-D array."""

    names: tuple[str, ...]
    half: bool
    of: Callable[[np.ndarray], Sequence[np.ndarray]]


def planes_of(kind: str | Planes) -> tuple[list[str], bool]:
    """Names of the warped planes and whether they are half-size."""
    if isinstance(kind, Planes):
        return list(kind.names), kind.half
    kinds = {"superpixel": (["r", "g", "b"], True), "planes": (["r", "g1", "g2", "b"], True), "bilinear": (["r", "g", "b"], False), "mosaic": (["v"], False), "mono": (["v"], False)}
    if kind not in kinds:
        raise ValueError(f"unknown kind of planes {kind}")
    return kinds[kind]


def separated(image: np.ndarray, kind: str | Planes) -> list[np.ndarray]:
    """The planes of a mosaic: half-size superpixels, half-size sensor planes, full-size colours, the mosaic itself, or own ones."""
    if isinstance(kind, Planes):
        planes = [np.asarray(p, float) for p in kind.of(image)]
        size = tuple(n // 2 for n in image.shape) if kind.half else image.shape
        if len(planes) != len(kind.names) or any(p.shape != size for p in planes):
            raise ValueError(f"{len(kind.names)} planes of {size} were announced, {[p.shape for p in planes]} came")
        return planes
    if kind in ("mosaic", "mono"):
        return [image]
    if kind == "bilinear":
        return [mosaic.window_means(image, mosaic.colour_planes(*image.shape, c)) for c in "rgb"]
    h, w = image.shape[0] // 2 * 2, image.shape[1] // 2 * 2
    r, g1, g2, b = (image[y:h:2, x:w:2] for y in (0, 1) for x in (0, 1))
    return [r, (g1 + g2) / 2, b] if kind == "superpixel" else [r, g1, g2, b]


def warped_planes(frames: DataFrame, transforms: DataFrame, kind: str | Planes = "superpixel", order: int = 1, half: bool = True) -> DataFrame:
    """session, frame_id, height, width, the planes and mask of the frames that have a successful transform.

    Matrices take (x, y) of a frame to the reference's; half tells that they are in half-size pixels, so that full-size
    planes get them with doubled translations. order 1 resamples bilinearly, higher ones by splines; beyond the frame
    planes are 0, mask is 1 where the nearest source pixel lies within.
    """
    names, small = planes_of(kind)
    matrix = F.col("matrix") if small == half else register.scaled_transform(F.col("matrix"), 2.0 if half else 0.5)
    good = transforms.where("success").select(*KEYS, register.affine_inverse(matrix).alias("_inverse"))
    src = frames.select(*KEYS, "height", "width", "data").join(good, KEYS)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            rows = [warped_frame(*x, kind, order) for x in zip(p["data"], p["height"], p["width"], p["_inverse"])]
            shapes = [r[0].shape for r in rows]
            out = {"height": [h for h, _ in shapes], "width": [w for _, w in shapes]}
            yield p[KEYS].assign(**out, **{n: [r[i].ravel() for r in rows] for i, n in enumerate((*names, "mask"))})

    keys = ", ".join(f"{c} {t}" for c, t in src.dtypes if c in KEYS)
    arrays = ", ".join(f"{n} array<double>" for n in (*names, "mask"))
    return src.mapInPandas(run, f"{keys}, height int, width int, {arrays}")


def warped_frame(data: np.ndarray, height: int, width: int, inverse: np.ndarray, kind: str | Planes, order: int) -> list[np.ndarray]:
    """The planes of one frame on the reference's places, and the mask of those whose nearest source pixel lies within."""
    planes = separated(np.asarray(data, float).reshape(int(height), int(width)), kind)
    v, u = register.source_places(planes[0].shape, np.stack(inverse))
    out = [(register.bilinear_at if order == 1 else register.spline_at(order))(p, v, u) for p in planes]
    y, x = np.rint(v), np.rint(u)
    inside = (y >= 0) & (y < planes[0].shape[0]) & (x >= 0) & (x < planes[0].shape[1])
    return [*out, inside.astype(float)]


def warped_tiles(
    frames: DataFrame, transforms: DataFrame, kind: str | Planes = "superpixel", order: int = 1, half: bool = True, tile_bytes: int = 64 << 20
) -> DataFrame:
    """session, frame_id, width, span, tile, the planes and mask of the tiles of warped_planes, cut in the same task.

    The length of a tile follows from the session's number of successful transforms; no frame is warped to count them.
    """
    names, small = planes_of(kind)
    matrix = F.col("matrix") if small == half else register.scaled_transform(F.col("matrix"), 2.0 if half else 0.5)
    good = transforms.where("success")
    n = good.groupBy(*SESSION).agg(F.count(F.lit(1)).alias("_n"))
    good = good.select(*KEYS, register.affine_inverse(matrix).alias("_inverse"))
    src = frames.select(*KEYS, "height", "width", "data").join(good, KEYS)
    src = src.join(n.select(*SESSION, tiles.span_of(F.col("_n"), len(names) + 1, tile_bytes).alias("span")), SESSION)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            for i in range(len(p)):
                row = p.iloc[i]
                arrays = warped_frame(row["data"], row["height"], row["width"], row["_inverse"], kind, order)
                flat = [a.ravel() for a in arrays]
                starts = tiles.starts_of(len(flat[0]), int(row["span"]))
                cut = {m: [a[s:e] for s, e in zip(starts, starts[1:])] for m, a in zip((*names, "mask"), flat)}
                own = {k: row[k] for k in KEYS} | {"width": arrays[0].shape[1], "span": row["span"]}
                yield pd.DataFrame({k: [x] * (len(starts) - 1) for k, x in own.items()} | {"tile": range(len(starts) - 1)} | cut)

    keys = ", ".join(f"{c} {t}" for c, t in src.dtypes if c in KEYS)
    arrays = ", ".join(f"{m} array<double>" for m in (*names, "mask"))
    return src.mapInPandas(run, f"{keys}, width int, span int, tile int, {arrays}")


def warped_pixels(planes: DataFrame, names: list[str]) -> DataFrame:
    """session, frame_id, y, x, the planes' values and w, the mask, as pixel rows."""
    return to_pixels(planes, KEYS, {**{n: n for n in names}, "w": "mask"}).drop("pos")


def rgb_stack(frames: DataFrame, transforms: DataFrame, kind: str | Planes = "superpixel", sigma: float = 3.0, rounds: int = 5) -> DataFrame:
    """session, y, x, the planes (r, g, b of the named kinds), coverage: demosaiced, warped with masks, clipped where they are valid."""
    names = planes_of(kind)[0]
    cut = warped_tiles(frames, transforms, kind)
    got = tiles.stacked_tiles(cut, SESSION, "frame_id", names, tiles.masked_clip_mean(sigma, rounds), [*names, "coverage"], "mask")
    return tiles.tile_pixels(got, SESSION, dict.fromkeys(names, "double") | {"coverage": "long"})


def plane_stack(
    frames: DataFrame, transforms: DataFrame, references: DataFrame, sigma: float = 3.0, coverage: float = 0.5, order: int = 4, cleanup: bool = True
) -> DataFrame:
    """session, y, x, r, g, b at full size from sensor planes stacked at half size.

    The four planes of a frame are warped and clipped together, the reference frame is always kept, places with little
    coverage are 0; the mosaic of the stacked planes is demosaiced and its chroma cleaned by 3 x 3 medians.
    """
    names = ["r", "g1", "g2", "b"]
    cut = warped_tiles(frames, transforms, "planes", order).join(references, SESSION).withColumn("_always", F.col("frame_id") == F.col("reference"))
    got = tiles.stacked_tiles(cut, SESSION, "frame_id", names, tiles.two_pass(sigma, strict=True), [*names, "coverage"], "mask", "_always")
    half = tiles.tile_images(got, SESSION, [*names, "coverage"])
    least = F.floor(coverage * F.array_max("coverage"))
    half = half.withColumn("_least", least)
    covered = [F.zip_with(n, "coverage", lambda v, c: F.when(c < F.col("_least"), F.lit(0.0)).otherwise(v)).alias(n) for n in names]
    half = computed_once(half.select(*SESSION, "height", "width", *covered), *names)
    full = half.select(*SESSION, "height", "width", mosaic.from_planes(*[F.col(n) for n in names], F.col("height"), F.col("width")).alias("v"))
    full = full.select(*SESSION, (F.col("height") * 2).alias("height"), (F.col("width") * 2).alias("width"), "v")
    rgb = full.select(*SESSION, "width", *[mosaic.bilinear(F.col("v"), F.col("height"), F.col("width"), c).alias(c) for c in "rgb"])
    out = to_pixels(rgb, SESSION, {c: c for c in "rgb"}).drop("pos")
    return stencil.chroma_cleaned(out, SESSION) if cleanup else out


def full_resolution_stack(frames: DataFrame, transforms: DataFrame, sigma: float = 3.0) -> DataFrame:
    """session, y, x, r, g, b, coverage: bilinear demosaic, transforms doubled, two passes over all frames alike."""
    cut = warped_tiles(frames, transforms, "bilinear")
    got = tiles.stacked_tiles(cut, SESSION, "frame_id", ["r", "g", "b"], tiles.two_pass(sigma), ["r", "g", "b", "coverage"], "mask")
    return tiles.tile_pixels(got, SESSION, {"r": "double", "g": "double", "b": "double", "coverage": "long"})


def bayer_stack(frames: DataFrame, transforms: DataFrame, sigma: float = 3.0, rounds: int = 5) -> DataFrame:
    """session, y, x, v, n, n_kept: raw mosaics warped by the doubled half-size transforms (mixing colours) and clipped."""
    cut = warped_tiles(frames, transforms, "mosaic")
    got = tiles.stacked_tiles(cut, SESSION, "frame_id", ["v"], tiles.clip_mean(sigma, rounds), ["v", "n", "n_kept"])
    return tiles.tile_pixels(got, SESSION, {"v": "double", "n": "long", "n_kept": "long"})


def auto_valid(pixels: DataFrame, image: list[str], threshold: float = 0.01) -> DataFrame:
    """pixels (r, g, b) with valid: luma above threshold times the image's greatest; all of an image without light.

    The greatest luma is a partial aggregate joined back, so an image is not gathered in one task.
    """
    luma = tone.luma(F.col("r"), F.col("g"), F.col("b"))
    top = pixels.groupBy(*image).agg(F.max(luma).alias("_top"))
    return pixels.join(top, image).withColumn("valid", (F.col("_top") <= 0) | (luma > threshold * F.col("_top"))).drop("_top")


def with_masks(pixels: DataFrame, image: list[str], weight: str | None = None, threshold: float = 0.01) -> DataFrame:
    """pixels with w: the weight given, or where none is, 1 for the valid pixels of each image and 0 for the others."""
    if weight is not None:
        return pixels.withColumn("w", F.col(weight).cast("double"))
    return auto_valid(pixels, image, threshold).withColumn("w", F.col("valid").cast("double")).drop("valid")


def mounted(transforms: DataFrame, mount: str = "altaz", threshold: float = 0.1, sample: int = 5) -> DataFrame:
    """transforms with rotation and strategy, and their matrices as the mount asks for, session by session in one plan.

    altaz and eq_robust take the transforms as they are (affine). eq measures the greatest rotation over a systematic
    sample of each session's successful transforms: above the threshold (degrees) its transforms stay (robust_affine),
    below they become moves by whole even pixels (integer_shift), so that no colours mix.
    """
    if mount not in ("altaz", "eq", "eq_robust"):
        raise ValueError(f"unknown mount {mount}")
    turned = register.field_rotation(transforms, SESSION, "frame_id", sample)
    own = transforms.join(turned, SESSION, "left").withColumn("rotation", F.coalesce("rotation", F.lit(0.0)))
    still = F.lit(mount == "eq") & (F.col("rotation") <= threshold)
    matrix = F.when(still & F.col("matrix").isNotNull(), register.rounded_transform(F.col("matrix"), True, threshold)).otherwise(F.col("matrix"))
    strategy = F.when(still, F.lit("integer_shift")).otherwise(F.lit("affine" if mount == "altaz" else "robust_affine"))
    return own.withColumns({"matrix": matrix, "strategy": strategy})


@dataclass
class Registered:
    """The kept frames of sessions and how they lie: scores, references (session, reference), frames, transforms."""

    scores: DataFrame
    references: DataFrame
    frames: DataFrame
    transforms: DataFrame


def registered(frames: DataFrame, settings: StackSettings | None = None) -> Registered:
    """frames (session, frame_id, height, width, data) scored with their stars, selected and registered as the settings say.

    Star lists, scores and transforms are tables in the shared folder, each made once. align: astroalign by star patterns,
    integer by phase correlation (whole pixels, of mosaics even ones), none. Sessions in which max_align_fail frames in a
    row fail have no transforms.
    """
    s = (settings or StackSettings()).validate()
    mono = s.debayer == "none"
    lists = cut(star_lists(frames, method=None if mono else "superpixel"), "star-lists")  # the stars of a frame are looked for once
    plain = quality.scored(frames, KEYS, saturation=s.saturation_threshold, full_scale=s.full_scale)
    scores = cut(quality.selected(quality.with_stars(plain, lists, KEYS), SESSION, "frame_id", s.keep_fraction), "scores")
    kept = scores.where("kept").select(*KEYS)
    references = quality.reference_frame(scores.where("kept"), SESSION, "frame_id", s.reference)
    own = frames.join(kept, KEYS, "left_semi")
    if s.align == "none":
        identity = F.array(*[F.array(*[F.lit(float(i == j)) for j in range(3)]) for i in range(3)])
        return Registered(scores, references, own, kept.select(*KEYS, F.lit(True).alias("success"), F.lit("").alias("error_message"), identity.alias("matrix"), F.lit(0).alias("n_matches")))
    if s.align == "integer":
        ref = frames.join(references, SESSION).where("frame_id = reference").drop("reference")
        moved = register.integer_shifts(own, ref, SESSION, even=not mono)
        step = 1.0 if mono else 0.5  # whole pixels of the mosaic are half ones of its planes
        rows = [[F.lit(1.0), F.lit(0.0), F.col("dx") * step], [F.lit(0.0), F.lit(1.0), F.col("dy") * step], [F.lit(0.0), F.lit(0.0), F.lit(1.0)]]
        transforms = moved.select(*KEYS, "success", F.col("error").alias("error_message"), F.array(*[F.array(*r) for r in rows]).alias("matrix"), F.lit(0).alias("n_matches"))
    elif s.align == "astroalign":
        transforms = transforms_by_stars(lists.join(kept, KEYS, "left_semi"), references)
    else:
        raise ValueError(f"unknown alignment {s.align}")
    return Registered(scores, references, own, cut(within_failures(transforms, s.max_align_fail), "transforms"))


def colour_stack(got: Registered, s: StackSettings) -> DataFrame:
    """The colour master of registered frames: planes (r, g, b at full size), else superpixel or bilinear with coverage."""
    if s.debayer == "planes":
        return plane_stack(got.frames, got.transforms, got.references, s.sigma)
    return rgb_stack(got.frames, got.transforms, s.debayer, s.sigma, s.maxiters)


@dataclass
class AlignedSession:
    scores: DataFrame
    references: DataFrame
    transforms: DataFrame
    master: DataFrame


def aligned_session(frames: DataFrame, settings: StackSettings | None = None) -> AlignedSession:
    """frames (session, frame_id, height, width, data) -> scores, reference, transforms and master, as the settings say.

    See registered. debayer: none (mono), superpixel, bilinear or planes. Sessions without transforms give no master.
    Frames of more than one size in a session fail at once, since places would not mean the same.
    """
    s = (settings or StackSettings()).validate()
    got = registered(frames, s)
    if s.debayer == "none":
        px = warped_tiles(got.frames, got.transforms, "mono", half=False)
        stacked = tiles.stacked_tiles(px, SESSION, "frame_id", ["v"], tiles.masked_clip_mean(s.sigma, s.maxiters), ["v", "coverage"], "mask")
        master = tiles.tile_pixels(stacked, SESSION, {"v": "double", "coverage": "long"})
    else:
        master = colour_stack(got, s)
    return AlignedSession(got.scores, got.references, got.transforms, master)


@dataclass
class ProcessedSession:
    scores: DataFrame
    linear: DataFrame
    calibrated: DataFrame
    stretched: DataFrame
    statistics: DataFrame


def process_session(
    frames: DataFrame, settings: StackSettings | None = None, exposure: float = 15.0, cached: DataFrame | None = None, balance: str = "gray_world", least: int = 100,
    mount: str = "altaz",
) -> ProcessedSession:
    """A session from frames to a stretched colour image: score, align, plane stack, calibrate, stretch, count.

    cached transforms (session, frame_id, success, error_message, matrix, n_matches), if given, stand in for a search; only
    those of kept frames count. mount says how an equatorial mount's sessions are registered (see mounted). The statistics name the clipped share of a plane stack as given, as the scripts do.
    """
    s = replace(settings or StackSettings(), debayer="planes").validate()
    got = aligned_session(frames, s if cached is None else replace(s, align="none"))
    scores = got.scores
    kept = scores.where("kept").select(*KEYS)
    found = got.transforms if cached is None else cached.join(kept, KEYS, "left_semi")
    transforms = mounted(found, mount)
    linear = plane_stack(frames.join(kept, KEYS, "left_semi"), transforms, got.references, s.sigma)
    linear = cut(linear, "linear")  # read by all that follows
    n = transforms.where("success").groupBy(*SESSION).agg(F.count(F.lit(1)).alias("n_stacked"))
    calibrated = colour.calibrated(linear, SESSION, balance, least=least)
    return ProcessedSession(
        scores, linear, calibrated, colour.script_stretched(calibrated, SESSION), stack.joint_statistics(linear.join(n, SESSION), SESSION, "n_stacked", exposure)
    )
