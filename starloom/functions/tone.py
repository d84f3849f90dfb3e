"""Per-pixel tone and colour as column expressions; they stay in whole-stage code generation."""

from __future__ import annotations

from math import asinh

from pyspark.sql import Column
from pyspark.sql import functions as F

# Colour correction matrices by name (rows give r, g, b).
CCM = {
    "neutral": ((1.0, 0.0, 0.0), (0.0, 1.0, 0.0), (0.0, 0.0, 1.0)),
    "rich": ((1.45, -0.35, -0.10), (-0.15, 1.35, -0.20), (-0.05, -0.25, 1.30)),
    "vivid": ((1.60, -0.40, -0.20), (-0.20, 1.60, -0.40), (-0.10, -0.30, 1.40)),
    "ha_emission": ((1.10, -0.10, 0.00), (-0.10, 1.10, 0.00), (0.00, 0.00, 1.00)),
}

# Colour stops of the palettes, evenly spaced over [0, 1].
PALETTES = {
    "grayscale": ((0, 0, 0), (1, 1, 1)),
    "cool": ((0, 0, 0.1), (0.1, 0.1, 0.4), (0.2, 0.4, 0.6), (0.4, 0.6, 0.8), (0.7, 0.85, 1.0), (1.0, 1.0, 1.0)),
    "warm": ((0.05, 0, 0), (0.3, 0.05, 0), (0.6, 0.15, 0), (0.8, 0.4, 0.1), (1.0, 0.7, 0.3), (1.0, 0.95, 0.8)),
    "blue_gold": ((0, 0, 0.15), (0.1, 0.15, 0.4), (0.4, 0.3, 0.2), (0.7, 0.5, 0.1), (1.0, 0.85, 0.4), (1.0, 1.0, 0.9)),
    "h_alpha": ((0, 0, 0), (0.2, 0, 0.05), (0.5, 0.05, 0.1), (0.8, 0.15, 0.2), (1.0, 0.4, 0.4), (1.0, 0.8, 0.8)),
    "oiii": ((0, 0, 0), (0, 0.15, 0.1), (0, 0.35, 0.25), (0.1, 0.6, 0.5), (0.4, 0.85, 0.7), (0.8, 1.0, 0.95)),
}

# BT.601 luma, linear RGB to XYZ (D65) and back, white point, Lab knee.
LUMA = (0.299, 0.587, 0.114)
TO_XYZ = ((0.4124564, 0.3575761, 0.1804375), (0.2126729, 0.7151522, 0.0721750), (0.0193339, 0.1191920, 0.9503041))
TO_RGB = ((3.2404542, -1.5371385, -0.4985314), (-0.9692660, 1.8760108, 0.0415560), (0.0556434, -0.2040259, 1.0572252))
WHITE = (0.95047, 1.00000, 1.08883)
KNEE = 6 / 29

Rgb = tuple[Column, Column, Column]


def clip(x: Column, low: float | None = 0.0, high: float | None = 1.0) -> Column:
    """x held between low and high; a bound that is None doesn't hold. Null stays null."""
    bounded = x if low is None else F.when(x < low, F.lit(float(low))).otherwise(x)
    return bounded if high is None else F.when(bounded > high, F.lit(float(high))).otherwise(bounded)


def luma(r: Column, g: Column, b: Column, method: str = "weighted") -> Column:
    if method == "weighted":
        return LUMA[0] * r + LUMA[1] * g + LUMA[2] * b
    if method == "average":
        return (r + g + b) / 3.0
    raise ValueError(f"unknown luminance method {method}")


def normalised(x: Column, low: Column, high: Column, least: float = 1e-10) -> Column:
    """(x - low) / (high - low) held to [0, 1]; 0 where the range is below `least`."""
    return F.when(high - low < least, F.lit(0.0)).otherwise(clip((x - low) / F.nullif(high - low, F.lit(0.0))))


def percentile_asinh(x: Column, low: Column, high: Column, a: float = 0.1) -> Column:
    """asinh(a n) / asinh(a) of the value normalised by two percentiles."""
    return F.asinh(normalised(x, low, high) * a) / asinh(a)


def soft_asinh(x: Column, black: float | Column = 0.0, stretch: float = 0.1) -> Column:
    """asinh(v / s) / asinh(1 / s) of the value above black; v itself if s <= 0."""
    v = clip(x - black, 0.0, None)
    return F.asinh(v / stretch) / asinh(1 / stretch) if stretch > 0 else v


def quantised(x: Column, levels: int = 255) -> Column:
    """[0, 1] to whole steps, truncated."""
    return F.floor(clip(x) * levels).cast("int")


def ccm_rows(matrix: str | tuple | None, saturation: float = 1.0, keep_luminance: bool = True) -> list[list[float]]:
    """The matrix in use: moved from identity by `saturation`, rows brought to sum 1 where they are off by over 0.01."""
    if isinstance(matrix, str):
        if matrix not in CCM:
            raise ValueError(f"unknown matrix {matrix}")
        matrix = CCM[matrix]
    rows = [list(map(float, row)) for row in (matrix if matrix is not None else CCM["neutral"])]
    if len(rows) != 3 or any(len(row) != 3 for row in rows):
        raise ValueError("the matrix must be 3 x 3")
    if saturation != 1.0:
        rows = [[(i == j) + saturation * (v - (i == j)) for j, v in enumerate(row)] for i, row in enumerate(rows)]
    if keep_luminance and any(abs(sum(row) - 1) > 0.01 for row in rows):
        rows = [[v / (sum(row) or 1.0) for v in row] for row in rows]
    return rows


def times(m, rgb: Rgb) -> Rgb:
    return tuple(sum((row[j] * rgb[j] for j in (1, 2)), row[0] * rgb[0]) for row in m)


def colour_corrected(
    rgb: Rgb, matrix: str | tuple | None = "rich", saturation: float = 1.0, clip_negatives: bool = True, keep_luminance: bool = True
) -> Rgb:
    out = times(ccm_rows(matrix, saturation, keep_luminance), rgb)
    return tuple(clip(c, 0.0, None) for c in out) if clip_negatives else out


def scnr(rgb: Rgb, strength: float = 0.5, method: str = "average") -> Rgb:
    """Green above the neutral of red and blue is taken back by `strength`."""
    r, g, b = rgb
    if method not in ("average", "additive", "maximum"):
        raise ValueError(f"unknown method {method}")
    neutral = F.greatest(r, b) if method == "maximum" else (r + b) / 2.0
    return r, clip(g - strength * clip(g - neutral, 0.0, None), 0.0, None), b


def rgb_to_lab(rgb: Rgb) -> Rgb:
    def f(t: Column) -> Column:
        return F.when(t > KNEE**3, F.cbrt(t)).otherwise(t / (3 * KNEE**2) + 4 / 29)

    x, y, z = (f(c / w) for c, w in zip(times(TO_XYZ, rgb), WHITE))
    return 116 * y - 16, 500 * (x - y), 200 * (y - z)


def lab_to_rgb(lab: Rgb) -> Rgb:
    def f(t: Column) -> Column:
        return F.when(t > KNEE, t * t * t).otherwise(3 * KNEE**2 * (t - 4 / 29))

    fy = (lab[0] + 16) / 116
    xyz = tuple(f(t) * w for t, w in zip((lab[1] / 500 + fy, fy, fy - lab[2] / 200), WHITE))
    return tuple(clip(c) for c in times(TO_RGB, xyz))


def rgb_to_hsv(rgb: Rgb) -> Rgb:
    r, g, b = rgb
    top, low = F.greatest(r, g, b), F.least(r, g, b)
    spread = top - low
    part = F.nullif(spread, F.lit(0.0))
    hue = (
        F.when(spread == 0, F.lit(0.0))
        .when(top == r, (g - b) / part)
        .when(top == g, 2.0 + (b - r) / part)
        .otherwise(4.0 + (r - g) / part)
    )
    h = hue / 6.0
    return h - F.floor(h), F.when(top == 0, F.lit(0.0)).otherwise(spread / F.nullif(top, F.lit(0.0))), top


def hsv_to_rgb(hsv: Rgb) -> Rgb:
    h, s, v = hsv
    sector = F.floor(h * 6.0)
    f = h * 6.0 - sector
    p, q, t = v * (1.0 - s), v * (1.0 - s * f), v * (1.0 - s * (1.0 - f))
    k = F.pmod(sector, F.lit(6))

    def pick(*by: Column) -> Column:
        out = F.when(k == 0, by[0])
        for i in range(1, 5):
            out = out.when(k == i, by[i])
        return out.otherwise(by[5])

    return pick(v, q, p, p, t, v), pick(t, v, v, q, p, p), pick(p, p, t, v, v, q)


def saturated(rgb: Rgb, top: Column, factor: float) -> Rgb:
    """Saturation times `factor` in HSV of the image over its maximum."""
    scale = F.nullif(top, F.lit(0.0))
    h, s, v = rgb_to_hsv(tuple(c / scale for c in rgb))
    return tuple(F.coalesce(c * top, F.lit(0.0)) for c in hsv_to_rgb((h, clip(s * factor), v)))


def lrgb(lum: Column, rgb: Rgb, method: str = "lab", weight: float = 1.0, chroma: float = 1.0) -> Rgb:
    """A luminance with the colour of rgb; all within [0, 1]."""
    if method == "lab":
        lightness, a, b = rgb_to_lab(rgb)
        return lab_to_rgb((weight * 100 * lum + (1 - weight) * lightness, a * chroma, b * chroma))
    if method == "hsv":
        h, s, _ = rgb_to_hsv(rgb)
        return tuple(clip(c) for c in hsv_to_rgb((h, clip(s * chroma), lum)))
    if method == "direct":
        scaled = tuple(c * lum / F.greatest(luma(*rgb), F.lit(1e-6)) for c in rgb)
        if chroma != 1.0:
            gray = luma(*scaled)
            scaled = tuple(gray + chroma * (c - gray) for c in scaled)
        return tuple(clip(c) for c in scaled)
    raise ValueError(f"unknown method {method}")


def interpolated(x: Column, stops) -> Rgb:
    """Piecewise linear colour at x in [0, 1]."""
    if len(stops) < 2:
        raise ValueError("a palette needs two colours")
    scaled = x * float(len(stops) - 1)
    segment = F.least(F.floor(scaled), F.lit(len(stops) - 2))
    t = scaled - segment

    def channel(c: int) -> Column:
        values = F.array(*[F.lit(float(s[c])) for s in stops])
        at = segment.cast("int")
        return F.get(values, at) * (1.0 - t) + F.get(values, at + 1) * t

    return channel(0), channel(1), channel(2)


def palette_names(external: tuple[str, ...] = ()) -> list[str]:
    """The names of all palettes, and of those that an external library offers, once each, in order."""
    return sorted({*PALETTES, *external})


def colormap(x: Column, low: Column, high: Column, palette: str = "cool") -> Rgb:
    if palette not in PALETTES:
        raise ValueError(f"unknown palette {palette}")
    return interpolated(normalised(x, low, high), PALETTES[palette])


def blended(coloured: Rgb, lum: Column, strength: float = 0.5) -> Rgb:
    return tuple(clip(c * (1.0 - strength) + lum * strength) for c in coloured)


def bicolor(x: Column, low, high, threshold: float = 0.5, softness: float = 0.2) -> Rgb:
    """Two colours mixed around a threshold, times the brightness x."""
    mask = clip((x - threshold) / (2 * softness) + 0.5) if softness > 0 else F.when(x > threshold, 1.0).otherwise(0.0)
    return tuple(clip(x * (a * (1.0 - mask) + b * mask)) for a, b in zip(low, high))
