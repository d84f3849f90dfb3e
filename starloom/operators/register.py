"""Registration of frames to a reference: shifts, transforms, warps, star matching.

Geometry that is arithmetic on places runs as joins on pixel rows or array expressions. Phase correlation and triangle
matching look at a whole frame, so frames (one row each) meet their session's reference by a join and small numpy
helpers work on one pair at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb, factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scaled_transform(matrix: Column, factor: float = 2.0) -> Column:
    """A 3 x 3 matrix with its translation times factor (from half to full resolution)."""

    def row(i: int) -> Column:
        r = matrix[i]
        return F.array(r[0], r[1], r[2] * factor) if i < 2 else F.array(r[0], r[1], r[2])

    return F.array(row(0), row(1), row(2))


def rotation_degrees(matrix: Column) -> Column:
    return F.degrees(F.atan2(matrix[1][0], matrix[0][0]))


def rounded_transform(matrix: Column, even: bool = True, least_rotation: float = 0.1) -> Column:
    """Translation to whole (even) pixels, halves to even; the linear part becomes identity below the rotation."""
    still = F.abs(rotation_degrees(matrix)) < least_rotation
    step = 2.0 if even else 1.0

    def row(i: int) -> Column:
        r = matrix[i]
        linear = [F.when(still, F.lit(float(i == j))).otherwise(r[j]) for j in range(2)]
        return F.array(*linear, step * F.rint(r[2] / step))

    return F.array(row(0), row(1), F.array(*[matrix[2][j] for j in range(3)]))


def field_rotation(transforms: DataFrame, session: list[str], name: str, size: int = 5) -> DataFrame:
    """session, rotation: greatest |rotation| in degrees over a systematic sample of successful transforms, or 0."""
    from starloom.operators.quality import systematic_sample

    sample = systematic_sample(transforms, session, name, size)
    turn = F.abs(rotation_degrees(F.col("matrix")))
    return sample.groupBy(*session).agg(F.coalesce(F.max(F.when(F.col("success"), turn)), F.lit(0.0)).alias("rotation"))


def shifted(pixels: DataFrame, frame: list[str], values: list[str], dy: Column, dx: Column, fill: float = 0.0) -> DataFrame:
    """frame, y, x, values: out[y + dy, x + dx] = in[y, x]; what is exposed is `fill`. dy, dx are columns per frame."""
    grid = pixels.select(*frame, "y", "x")
    moved = pixels.select(*frame, (F.col("y") + dy).alias("y"), (F.col("x") + dx).alias("x"), *values)
    return grid.join(moved, [*frame, "y", "x"], "left").select(
        *frame, "y", "x", *[F.coalesce(F.col(v), F.lit(fill)).alias(v) for v in values]
    )


def source_places(shape: tuple[int, int], inverse: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) in the source of each output pixel."""
    y, x = np.indices(shape, dtype=float)
    return inverse[1][0] * x + inverse[1][1] * y + inverse[1][2], inverse[0][0] * x + inverse[0][1] * y + inverse[0][2]


def bilinear_at(image: np.ndarray, v: np.ndarray, u: np.ndarray) -> np.ndarray:
    """The image at fractional places; beyond it 0."""
    h, w = image.shape
    y0, x0 = np.floor(v).astype(int), np.floor(u).astype(int)
    out = np.zeros(v.shape)
    for dy in (0, 1):
        for dx in (0, 1):
            y, x = y0 + dy, x0 + dx
            inside = (y >= 0) & (y < h) & (x >= 0) & (x < w)
            part = (v - y0 if dy else 1 - v + y0) * (u - x0 if dx else 1 - u + x0)
            out += np.where(inside, image[y.clip(0, h - 1), x.clip(0, w - 1)], 0.0) * part
    return out


def bspline(t: np.ndarray, order: int) -> np.ndarray:
    """The centred B-spline of an order: alternating truncated powers."""
    half = (order + 1) / 2
    total = sum((-1) ** k * comb(order + 1, k) * np.maximum(t + half - k, 0.0) ** order for k in range(order + 2))
    return np.where(np.abs(t) < half, total / factorial(order), 0.0)


@lru_cache(maxsize=16)
def spline_filter(n: int, order: int) -> np.ndarray:
    """The matrix that turns n samples, mirrored at the ends, into the coefficients of the spline through them."""
    reach, at = order // 2, np.arange(n)
    basis, period = np.zeros((n, n)), max(2 * (n - 1), 1)
    for k in range(-reach, reach + 1):
        place = np.abs(at + k) % period
        np.add.at(basis, (at, np.minimum(place, period - place) if n > 1 else at), bspline(np.array(float(k)), order))
    return np.linalg.inv(basis)


def spline_at(order: int):
    """A function like bilinear_at that interpolates with splines of the order; mirrored at the ends, beyond them 0."""

    def at(image: np.ndarray, v: np.ndarray, u: np.ndarray) -> np.ndarray:
        h, w = image.shape
        coefficients = spline_filter(h, order) @ image @ spline_filter(w, order).T
        middle = (np.rint(v), np.rint(u)) if order % 2 == 0 else (np.floor(v), np.floor(u))
        low, high = (-(order // 2), order // 2) if order % 2 == 0 else (-(order // 2), order // 2 + 1)
        sides = []
        for place, centre, n in zip((v, u), middle, (h, w)):
            period, steps = max(2 * (n - 1), 1), []
            for k in range(low, high + 1):
                i = np.abs(centre.astype(int) + k) % period
                steps.append((np.minimum(i, period - i) if n > 1 else 0 * i, bspline(place - centre - k, order)))
            sides.append(steps)
        out = sum(wy * sum(wx * coefficients[y, x] for x, wx in sides[1]) for y, wy in sides[0])
        inside = (v >= 0) & (v <= h - 1) & (u >= 0) & (u <= w - 1)
        return np.where(inside, out, 0.0)

    return at


def warped(data: Column, height: Column, width: Column, inverse: Column) -> Column:
    """An array image resampled bilinearly: out(x, y) = in(inverse (x, y)); outside is 0. One row in, one row out."""

    @F.pandas_udf("array<double>")
    def warp(d: pd.Series, h: pd.Series, w: pd.Series, m: pd.Series) -> pd.Series:
        out = []
        for a, rows, columns, inv in zip(d, h, w, m):
            if a is None or inv is None:
                out.append(None)
                continue
            image = np.asarray(a, float).reshape(int(rows), int(columns))
            out.append(bilinear_at(image, *source_places(image.shape, np.stack(inv))).ravel())
        return pd.Series(out)

    return warp(data, height, width, inverse)


def warp_mask(height: Column, width: Column, inverse: Column) -> Column:
    """1 where the nearest source pixel of a warp lies inside the image, else 0."""

    @F.pandas_udf("array<double>")
    def mask(h: pd.Series, w: pd.Series, m: pd.Series) -> pd.Series:
        out = []
        for rows, columns, inv in zip(h, w, m):
            v, u = (np.rint(p) for p in source_places((int(rows), int(columns)), np.stack(inv)))
            out.append(((v >= 0) & (v < rows) & (u >= 0) & (u < columns)).astype(float).ravel())
        return pd.Series(out)

    return mask(height, width, inverse)


def affine_inverse(matrix: Column) -> Column:
    a, b, c = (matrix[0][j] for j in range(3))
    d, e, f = (matrix[1][j] for j in range(3))
    det = F.nullif(a * e - b * d, F.lit(0.0))
    return F.array(
        F.array(e / det, -b / det, (b * f - e * c) / det),
        F.array(-d / det, a / det, (d * c - a * f) / det),
        F.array(F.lit(0.0), F.lit(0.0), F.lit(1.0)),
    )


def phase_shift(source: np.ndarray, reference: np.ndarray) -> tuple[int, int]:
    """(dy, dx) that moves source onto reference: the peak of the whitened cross power spectrum."""
    product = np.fft.fft2(reference) * np.conj(np.fft.fft2(source))
    peak = np.abs(np.fft.ifft2(product / np.maximum(np.abs(product), 1e-12)))
    at = np.unravel_index(int(np.argmax(np.round(peak, 9))), peak.shape)
    return tuple(int(p - n if p > n // 2 else p) for p, n in zip(at, peak.shape))


def integer_shifts(frames: DataFrame, references: DataFrame, session: list[str], even: bool = True) -> DataFrame:
    """session, frame_id, dy, dx, success, error of every frame against its session's reference (column ref).

    frames and references hold height, width, data; each row is one image. Unequal sizes and missing data fail with a
    message. even rounds to 2 * round(d / 2), halves to even.
    """
    ref = references.select(*session, F.col("data").alias("ref"), F.col("height").alias("rh"), F.col("width").alias("rw"))
    joined = frames.select(*session, "frame_id", "height", "width", "data").join(ref, session)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            out = []
            for r in p.itertuples(index=False):
                try:
                    if (r.height, r.width) != (r.rh, r.rw):
                        raise ValueError("image sizes differ")
                    shape = (int(r.height), int(r.width))
                    dy, dx = phase_shift(np.reshape(r.data, shape).astype(float), np.reshape(r.ref, shape).astype(float))
                    if even:
                        dy, dx = (int(2 * np.rint(d / 2)) for d in (dy, dx))
                    out.append((dy, dx, True, ""))
                except (ValueError, TypeError) as e:
                    out.append((0, 0, False, str(e)))
            yield p[[*session, "frame_id"]].assign(**dict(zip(("dy", "dx", "success", "error"), map(list, zip(*out)))))

    keys = ", ".join(f"{c} {t}" for c, t in joined.dtypes if c in (*session, "frame_id"))
    return joined.mapInPandas(run, f"{keys}, dy int, dx int, success boolean, error string")


def triangles(points: np.ndarray, neighbours: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Triangles of each point with its nearest neighbours: side ratios, and vertex order by opposite side."""
    apart = np.linalg.norm(points[:, None] - points[None], axis=2)
    seen = set()
    for i in range(len(points)):
        near = np.argsort(apart[i], kind="stable")[: neighbours + 1]
        seen |= {tuple(sorted((i, int(j), int(k)))) for a, j in enumerate(near) for k in near[a + 1 :] if i not in (j, k)}
    shapes, order = [], []
    for t in sorted(seen):
        sides = sorted((apart[t[1], t[2]], t[0]) if v == 0 else (apart[t[0], t[2]], t[1]) if v == 1 else (apart[t[0], t[1]], t[2]) for v in range(3))
        if sides[0][0] > 0:
            shapes.append((sides[2][0] / sides[1][0], sides[1][0] / sides[0][0]))
            order.append([v for _, v in sides])
    return np.array(shapes).reshape(-1, 2), np.array(order, int).reshape(-1, 3)


def similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least-squares similarity (rotation, scale, shift) from points a to b as a 3 x 3 matrix on (x, y)."""
    rows, right = [], []
    for (x, y), (u, v) in zip(a, b):
        rows += [[x, -y, 1, 0], [y, x, 0, 1]]
        right += [u, v]
    p, q, tx, ty = np.linalg.lstsq(np.array(rows, float), np.array(right, float), rcond=None)[0]
    return np.array([[p, -q, tx], [q, p, ty], [0, 0, 1]])


def matched_transform(a: np.ndarray, b: np.ndarray, tolerance: float = 2.0, rounds: int = 500, seed: int = 4) -> tuple[np.ndarray | None, int]:
    """Similarity from stars a to stars b by triangle shapes and consensus; None if fewer than three stars agree."""
    if min(len(a), len(b)) < 3:
        return None, 0
    (sa, oa), (sb, ob) = triangles(a), triangles(b)
    if not len(sa) or not len(sb):
        return None, 0
    off = np.linalg.norm(sa[:, None] - sb[None], axis=2)
    pairs = np.argwhere(off < 0.05)
    pairs = pairs[np.argsort(off[tuple(pairs.T)], kind="stable")][:2000]
    rng = np.random.default_rng(seed)
    best, most, closest = None, 0, 0.0
    for k in rng.permutation(len(pairs))[:rounds]:
        i, j = pairs[k]
        m = similarity(a[oa[i]], b[ob[j]])
        moved = a @ m[:2, :2].T + m[:2, 2]
        gap = np.linalg.norm(moved[:, None] - b[None], axis=2)
        near = gap.argmin(axis=1)
        agree = np.flatnonzero(gap[np.arange(len(a)), near] < tolerance)
        fit = (1 - gap[agree, near[agree]] / tolerance).sum()  # close pairs count more than those that happen to be near
        if fit > closest and len(set(near[agree])) >= 3:
            most, closest, best = len(agree), fit, similarity(a[agree], b[near[agree]])
    if most < 3:
        return None, 0
    for finer in (tolerance / 2, tolerance / 4):  # pairs that only happen to lie close drop out
        gap = np.linalg.norm((a @ best[:2, :2].T + best[:2, 2])[:, None] - b[None], axis=2)
        near = gap.argmin(axis=1)
        agree = np.flatnonzero(gap[np.arange(len(a)), near] < finer)
        if len(set(near[agree])) < 3:
            break
        best, most = similarity(a[agree], b[near[agree]]), len(agree)
    return best, most


def star_transforms(stars: DataFrame, references: DataFrame, session: list[str]) -> DataFrame:
    """session, frame_id, success, error_message, matrix, n_matches from star lists.

    stars: session, frame_id, y, x, flux rows; references: session, reference (a frame_id). A list holds the brightest
    50 stars of a frame, so the rows that meet in a join are short.
    """
    lists = stars.groupBy(*session, "frame_id").agg(
        F.slice(F.sort_array(F.collect_list(F.struct("flux", "x", "y")), False), 1, 50).alias("s")
    )
    ref = lists.join(references, session).where(F.col("frame_id") == F.col("reference")).select(*session, F.col("s").alias("ref"))
    joined = lists.join(ref, session).select(*session, "frame_id", "s.x", "s.y", F.col("ref.x").alias("rx"), F.col("ref.y").alias("ry"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            got = [matched_transform(np.column_stack((r.x, r.y)).astype(float), np.column_stack((r.rx, r.ry)).astype(float)) for r in p.itertuples(index=False)]
            yield p[[*session, "frame_id"]].assign(
                success=[m is not None for m, _ in got],
                error_message=["" if m is not None else "too few matching stars" for m, _ in got],
                matrix=[None if m is None else m.tolist() for m, _ in got],
                n_matches=[n for _, n in got],
            )

    keys = ", ".join(f"{c} {t}" for c, t in joined.dtypes if c in (*session, "frame_id"))
    return joined.mapInPandas(run, f"{keys}, success boolean, error_message string, matrix array<array<double>>, n_matches int")
