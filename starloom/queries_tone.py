"""Queries: stretches, colour matrices, colour spaces, palettes, balance, calibration."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom import fixtures as fx
from starloom.functions import tone
from starloom.operators import background as bg
from starloom.operators import colour as co
from starloom.registry import query, rounded, tidy

IMAGE = ["session"]
KEYS = ["session", "y", "x"]
HEAD = "session::BIGINT AS session, y, x"


def clip_sql(x: str) -> str:
    return f"least(greatest({x}, 0.0::DOUBLE), 1.0::DOUBLE)"


PCT = f"{fx.MASTER}, p AS (SELECT *, quantile_cont(v, 0.01::DOUBLE) OVER (PARTITION BY session) AS lo, quantile_cont(v, 0.995::DOUBLE) OVER (PARTITION BY session) AS hi FROM mos)"
NORM = f"CASE WHEN hi - lo < 1e-10 THEN 0.0::DOUBLE ELSE {clip_sql('(v - lo) / nullif(hi - lo, 0)')} END"


@query("percentile_stretch", f"WITH {PCT} SELECT {HEAD}, {rounded(f'asinh({NORM} * 0.1::DOUBLE) / asinh(0.1::DOUBLE) AS a', f'{NORM} AS l')} FROM p")
def percentile_stretch(spark, sf):
    m = fx.master(spark, sf).withColumns({"a": F.col("v"), "l": F.col("v")})
    return tidy(co.percentile_stretched(co.percentile_stretched(m, IMAGE, "a"), IMAGE, "l", a=None).drop("v"))


@query("event_stretch", f"WITH p AS (SELECT *, quantile_cont(value, 0.01::DOUBLE) OVER (PARTITION BY event_type) AS lo, quantile_cont(value, 0.995::DOUBLE) OVER (PARTITION BY event_type) AS hi FROM events) SELECT event_id, {rounded('asinh(' + NORM.replace('(v -', '(value -') + ' * 0.1::DOUBLE) / asinh(0.1::DOUBLE) AS value')} FROM p")
def event_stretch(spark, sf):
    own = fx.table(spark, sf, "events").select("event_id", "event_type", "value")
    return tidy(co.percentile_stretched(own, ["event_type"], "value").select("event_id", "value"))


@query(
    "soft_stretch",
    f"WITH {fx.MASTER}, s AS (SELECT *, asinh(greatest(v - 19000, 0) / 100.0::DOUBLE) / asinh(1 / 100.0::DOUBLE) AS s FROM mos), t AS (SELECT *, max(s) OVER (PARTITION BY session) AS top FROM s) "
    f"SELECT {HEAD}, {rounded('CASE WHEN top > 0 THEN s / top ELSE s END AS v')} FROM t",
)
def soft_stretch(spark, sf):
    return tidy(co.soft_stretched(fx.master(spark, sf), IMAGE, "v", 19000.0, 100.0))


def _two_stage_sql() -> str:
    from starloom.queries_stencil import gauss_sql

    def soft(a: str) -> str:
        return f"asinh(n / {a}::DOUBLE) / asinh(1 / {a}::DOUBLE)"

    return (
        f"WITH {fx.MASTER}, p AS (SELECT *, quantile_cont(v, 0.005::DOUBLE) OVER (PARTITION BY session) AS lo, quantile_cont(v, 0.999::DOUBLE) OVER (PARTITION BY session) AS hi FROM mos), "
        "nm AS (SELECT session, y, x, least(greatest((v - lo) / (hi - lo), 0), 1) AS n FROM p), th AS (SELECT *, quantile_cont(n, 0.995::DOUBLE) OVER (PARTITION BY session) AS t FROM nm), "
        f"st AS (SELECT session, y, x, {soft('0.05')} / max({soft('0.05')}) OVER (PARTITION BY session) AS f, {soft('0.5')} / max({soft('0.5')}) OVER (PARTITION BY session) AS c, "
        "least(greatest((n - t) / (0.1::DOUBLE * t + 1e-6), 0), 1)::DOUBLE AS b FROM th), "
        f"{gauss_sql('st', 'session', 'b', 1.0, 'sm')} SELECT st.session::BIGINT AS session, st.y, st.x, {rounded('(1 - sm.b) * st.f + sm.b * st.c AS v')} FROM st JOIN sm USING (session, y, x)"
    )


@query("two_stage_stretch", _two_stage_sql())
def two_stage_stretch(spark, sf):
    return tidy(co.two_stage_stretched(fx.master(spark, sf), IMAGE, "v", smooth=1.0))


LUMA = "0.299::DOUBLE * r + 0.587::DOUBLE * g + 0.114::DOUBLE * b"


@query(
    "linked_stretch",
    f"WITH {fx.RGB_MASTER}, p AS (SELECT *, quantile_cont({LUMA}, 0.005::DOUBLE) OVER (PARTITION BY session) AS lo, quantile_cont({LUMA}, 0.999::DOUBLE) OVER (PARTITION BY session) AS h0 FROM rgbm), "
    "q AS (SELECT * , CASE WHEN h0 <= lo THEN lo + 1 ELSE h0 END AS hi FROM p), s AS (SELECT session, y, x, "
    + ", ".join(f"asinh(greatest(({c} - lo) / (hi - lo), 0) / 0.1::DOUBLE) / asinh(10.0::DOUBLE) AS {c}" for c in "rgb")
    + " FROM q), t AS (SELECT *, max(greatest(r, g, b)) OVER (PARTITION BY session) AS top FROM s) "
    f"SELECT {HEAD}, {rounded(*[f'coalesce({clip_sql(f'{c} / nullif(top, 0)')}, 0) AS {c}' for c in 'rgb'])} FROM t",
)
def linked_stretch(spark, sf):
    return tidy(co.linked_stretched(fx.rgb_master(spark, sf), IMAGE))


@query("quantised", f"WITH {fx.UNIT_RGB} SELECT {HEAD}, floor({clip_sql('r')} * 255)::BIGINT AS r8, floor({clip_sql('g')} * 65535)::BIGINT AS g16 FROM u")
def quantised(spark, sf):
    u = fx.unit_rgb(spark, sf)
    return tidy(u.select(*KEYS, tone.quantised(F.col("r")).alias("r8"), tone.quantised(F.col("g"), 65535).alias("g16")))


def matrix_sql(m, low: bool = True) -> list[str]:
    rows = []
    for row, c in zip(m, "rgb"):
        x = " + ".join(f"({v!r}::DOUBLE) * {p}" for v, p in zip(row, "rgb"))
        rows.append(f"{f'greatest({x}, 0.0::DOUBLE)' if low else x} AS {c}")
    return rows


for _name in tone.CCM:
    _rows = tone.ccm_rows(_name, 1.0)

    def _ccm(spark, sf, name=_name):
        u = fx.unit_rgb(spark, sf)
        return tidy(co.with_rgb(u, tone.colour_corrected(co.cols(), name)))

    query(f"ccm_{_name}", f"WITH {fx.UNIT_RGB} SELECT {HEAD}, {rounded(*matrix_sql(_rows))} FROM u")(_ccm)


@query("ccm_boosted", f"WITH {fx.UNIT_RGB} SELECT {HEAD}, {rounded(*matrix_sql(tone.ccm_rows('rich', 1.3)))} FROM u")
def ccm_boosted(spark, sf):
    return tidy(co.with_rgb(fx.unit_rgb(spark, sf), tone.colour_corrected(co.cols(), "rich", 1.3)))


for _method, _neutral in (("average", "(r + b) / 2"), ("maximum", "greatest(r, b)")):

    def _scnr(spark, sf, method=_method):
        return tidy(co.with_rgb(fx.unit_rgb(spark, sf), tone.scnr(co.cols(), 0.5, method)))

    query(f"scnr_{_method}", f"WITH {fx.UNIT_RGB} SELECT {HEAD}, {rounded('r', f'greatest(g - 0.5::DOUBLE * greatest(g - {_neutral}, 0), 0) AS g', 'b')} FROM u")(_scnr)


def _xyz(i: int) -> str:
    return "(" + " + ".join(f"{v!r}::DOUBLE * {c}" for v, c in zip(tone.TO_XYZ[i], "rgb")) + f") / {tone.WHITE[i]!r}::DOUBLE"


_F = "CASE WHEN {t} > {k3!r}::DOUBLE THEN cbrt({t}) ELSE {t} / {a!r}::DOUBLE + {b!r}::DOUBLE END"


def _f(t: str) -> str:
    return _F.format(t=t, k3=tone.KNEE**3, a=3 * tone.KNEE**2, b=4 / 29)


LAB = (
    f"{fx.UNIT_RGB}, xyz AS (SELECT session, y, x, {_xyz(0)} AS tx, {_xyz(1)} AS ty, {_xyz(2)} AS tz FROM u), f AS (SELECT session, y, x, {_f('tx')} AS fx, {_f('ty')} AS fy, {_f('tz')} AS fz FROM xyz), "
    "lab AS (SELECT session, y, x, 116 * fy - 16 AS l, 500 * (fx - fy) AS a, 200 * (fy - fz) AS b FROM f)"
)


def _lab_back(source: str, l: str = "l", a: str = "a", b: str = "b") -> str:  # noqa: E741
    inv = "CASE WHEN {t} > %r::DOUBLE THEN {t} * {t} * {t} ELSE %r::DOUBLE * ({t} - %r::DOUBLE) END" % (tone.KNEE, 3 * tone.KNEE**2, 4 / 29)
    rows = ", ".join(
        clip_sql(" + ".join(f"({v!r}::DOUBLE) * {p}" for v, p in zip(row, ("bx", "by_", "bz")))) + f" AS {c}" for row, c in zip(tone.TO_RGB, "rgb")
    )
    return (
        f"g1 AS (SELECT session, y, x, ({l} + 16) / 116 AS fy, ({a}) / 500 + ({l} + 16) / 116 AS fx, ({l} + 16) / 116 - ({b}) / 200 AS fz FROM {source}), "
        f"g2 AS (SELECT session, y, x, ({inv.format(t='fx')}) * {tone.WHITE[0]!r}::DOUBLE AS bx, ({inv.format(t='fy')}) AS by_, ({inv.format(t='fz')}) * {tone.WHITE[2]!r}::DOUBLE AS bz FROM g1), "
        f"back AS (SELECT session, y, x, {rows} FROM g2)"
    )


@query("lab", f"WITH {LAB} SELECT {HEAD}, {rounded('l', 'a', 'b')} FROM lab")
def lab(spark, sf):
    u = fx.unit_rgb(spark, sf)
    return tidy(u.select(*KEYS, *[c.alias(n) for n, c in zip("lab", tone.rgb_to_lab(co.cols()))]))


@query("lab_roundtrip", f"WITH {LAB}, {_lab_back('lab')} SELECT {HEAD}, {rounded('r', 'g', 'b')} FROM back")
def lab_roundtrip(spark, sf):
    u = fx.unit_rgb(spark, sf).select(*KEYS, *[c.alias(n) for n, c in zip("lab", tone.rgb_to_lab(co.cols()))])
    return tidy(u.select(*KEYS, *[c.alias(n) for n, c in zip("rgb", tone.lab_to_rgb(tuple(F.col(n) for n in "lab")))]))


HSV = (
    f"{fx.UNIT_RGB}, h0 AS (SELECT *, greatest(r, g, b) AS v, least(r, g, b) AS m FROM u), h1 AS (SELECT *, CASE WHEN v = m THEN 0 WHEN v = r THEN (g - b) / (v - m) "
    "WHEN v = g THEN 2 + (b - r) / (v - m) ELSE 4 + (r - g) / (v - m) END / 6 AS h, CASE WHEN v = 0 THEN 0 ELSE (v - m) / v END AS s FROM h0), "
    "hsv AS (SELECT session, y, x, r, g, b, h - floor(h) AS h, s, v FROM h1)"
)


def _rgb_sql(source: str, s: str, v: str) -> str:
    return (
        f"k0 AS (SELECT session, y, x, h, {s} AS s, {v} AS v, floor(h * 6) AS k, h * 6 - floor(h * 6) AS f FROM {source}), k1 AS (SELECT session, y, x, v, v * (1 - s) AS p, v * (1 - s * f) AS q, v * (1 - s * (1 - f)) AS t, k % 6 AS k FROM k0), "
        "rgb2 AS (SELECT session, y, x, CASE k WHEN 0 THEN v WHEN 1 THEN q WHEN 2 THEN p WHEN 3 THEN p WHEN 4 THEN t ELSE v END AS r, CASE k WHEN 0 THEN t WHEN 1 THEN v WHEN 2 THEN v WHEN 3 THEN q ELSE p END AS g, "
        "CASE k WHEN 0 THEN p WHEN 1 THEN p WHEN 2 THEN t WHEN 3 THEN v WHEN 4 THEN v ELSE q END AS b FROM k1)"
    )


@query("hsv_saturation", f"WITH {HSV}, {_rgb_sql('hsv', 'least(s * 1.4::DOUBLE, 1.0)', 'v')} SELECT {HEAD}, {rounded('r', 'g', 'b')} FROM rgb2")
def hsv_saturation(spark, sf):
    h, s, v = tone.rgb_to_hsv(co.cols())
    return tidy(co.with_rgb(fx.unit_rgb(spark, sf), tone.hsv_to_rgb((h, tone.clip(s * 1.4), v))))


_TOP = f"{fx.RGB_MASTER}, tp AS (SELECT *, max(greatest(r, g, b)) OVER (PARTITION BY session) AS top FROM rgbm), u AS (SELECT session, y, x, r / top AS r, g / top AS g, b / top AS b FROM tp)"


@query(
    "saturated_over_max",
    f"WITH {_TOP}, {HSV.removeprefix(fx.UNIT_RGB + ', ')}, {_rgb_sql('hsv', 'least(s * 1.4::DOUBLE, 1.0)', 'v')} "
    f"SELECT {HEAD}, {rounded('r * top AS r', 'g * top AS g', 'b * top AS b')} FROM rgb2 JOIN (SELECT DISTINCT session, top FROM tp) USING (session)",
)
def saturated_over_max(spark, sf):
    u = fx.rgb_master(spark, sf).withColumn("top", co.image_max(None, IMAGE))
    return tidy(co.with_rgb(u, tone.saturated(co.cols(), F.col("top"), 1.4)).drop("top"))


LUM = "lum AS (SELECT session, y, x, sqrt(v / 65536.0::DOUBLE) AS l FROM mos)"


def _lum(spark, sf):
    return fx.master(spark, sf).select(*KEYS, F.sqrt(F.col("v") / 65536.0).alias("l"))


@query("lrgb_lab", f"WITH {LAB}, {LUM}, j AS (SELECT lab.session, lab.y, lab.x, 0.8::DOUBLE * 100 * lum.l + (1 - 0.8::DOUBLE) * lab.l AS l, a * 1.1::DOUBLE AS a, b * 1.1::DOUBLE AS b FROM lab JOIN lum USING (session, y, x)), {_lab_back('j')} SELECT {HEAD}, {rounded('r', 'g', 'b')} FROM back")
def lrgb_lab(spark, sf):
    return tidy(co.combined_lrgb(_lum(spark, sf), fx.unit_rgb(spark, sf), IMAGE, "lab", 0.8, 1.1))


@query("lrgb_hsv", f"WITH {HSV}, {LUM}, j AS (SELECT hsv.* REPLACE (lum.l AS v) FROM hsv JOIN lum USING (session, y, x)), {_rgb_sql('j', 'least(s * 1.2::DOUBLE, 1.0)', 'v')} SELECT {HEAD}, {rounded(*[f'{clip_sql(c)} AS {c}' for c in 'rgb'])} FROM rgb2")
def lrgb_hsv(spark, sf):
    return tidy(co.combined_lrgb(_lum(spark, sf), fx.unit_rgb(spark, sf), IMAGE, "hsv", 1.0, 1.2))


@query("lrgb_direct", f"WITH {fx.UNIT_RGB}, {LUM}, j AS (SELECT u.session, u.y, u.x, r * l / greatest({LUMA}, 1e-6) AS r, g * l / greatest({LUMA}, 1e-6) AS g, b * l / greatest({LUMA}, 1e-6) AS b FROM u JOIN lum USING (session, y, x)) SELECT {HEAD}, {rounded(*[f'{clip_sql(c)} AS {c}' for c in 'rgb'])} FROM j")
def lrgb_direct(spark, sf):
    return tidy(co.combined_lrgb(_lum(spark, sf), fx.unit_rgb(spark, sf), IMAGE, "direct"))


def _stops(palette: str, x: str) -> list[str]:
    stops = tone.PALETTES[palette]
    n = len(stops)
    out = []
    for c in range(3):
        a = "[" + ", ".join(f"{float(s[c])!r}::DOUBLE" for s in stops) + "]"
        seg = f"least(floor({x} * {n - 1}), {n - 2})"
        out.append(f"{a}[CAST({seg} AS INT) + 1] * (1 - ({x} * {n - 1} - {seg})) + {a}[CAST({seg} AS INT) + 2] * ({x} * {n - 1} - {seg}) AS {'rgb'[c]}")
    return out


for _palette in tone.PALETTES:

    def _map(spark, sf, palette=_palette):
        m = fx.master(spark, sf)
        own = m.join(co.percentiles(m, IMAGE, F.col("v"), {"lo": 1.0, "hi": 99.5}), IMAGE)
        return tidy(co.with_rgb(own, tone.colormap(F.col("v"), F.col("lo"), F.col("hi"), palette)).select(*KEYS, "r", "g", "b"))

    query(f"palette_{_palette}", f"WITH {PCT}, n AS (SELECT session, y, x, {NORM} AS t FROM p) SELECT {HEAD}, {rounded(*_stops(_palette, 't'))} FROM n")(_map)


@query("colorbar", f"WITH n AS (SELECT e.label AS session, x, x / 63.0::DOUBLE AS t FROM (SELECT DISTINCT label FROM embeddings) e, range(64) t(x)) SELECT session::BIGINT AS session, x, {rounded(*_stops('oiii', 't'))} FROM n")
def colorbar(spark, sf):
    bars = fx.names(spark, sf).select("session").distinct().withColumn("x", F.explode(F.sequence(F.lit(0), F.lit(63))))
    return tidy(co.with_rgb(bars, tone.interpolated(F.col("x") / 63.0, tone.PALETTES["oiii"])))


@query("palette_blend", f"WITH {PCT}, n AS (SELECT session, y, x, {NORM} AS t FROM p), c AS (SELECT session, y, x, t, {', '.join(_stops('warm', 't'))} FROM n) SELECT {HEAD}, {rounded(*[f'{clip_sql(f'{c} * (1 - 0.3::DOUBLE) + t * 0.3::DOUBLE')} AS {c}' for c in 'rgb'])} FROM c")
def palette_blend(spark, sf):
    m = fx.master(spark, sf)
    own = m.join(co.percentiles(m, IMAGE, F.col("v"), {"lo": 1.0, "hi": 99.5}), IMAGE)
    t = tone.normalised(F.col("v"), F.col("lo"), F.col("hi"))
    own = co.with_rgb(own.withColumn("t", t), tone.interpolated(t, tone.PALETTES["warm"]))
    return tidy(co.with_rgb(own, tone.blended(co.cols(), F.col("t"), 0.3)).select(*KEYS, "r", "g", "b"))


@query("bicolor", f"WITH {PCT}, n AS (SELECT session, y, x, {NORM} AS t FROM p), m AS (SELECT *, {clip_sql('(t - 0.5) / 0.4::DOUBLE + 0.5')} AS m FROM n) SELECT {HEAD}, {rounded('t * (0.1::DOUBLE * (1 - m) + 1.0 * m) AS r', 't * (0.3::DOUBLE * (1 - m) + 0.8::DOUBLE * m) AS g', 't * (0.9::DOUBLE * (1 - m) + 0.2::DOUBLE * m) AS b')} FROM m")
def bicolor(spark, sf):
    m = fx.master(spark, sf)
    own = m.join(co.percentiles(m, IMAGE, F.col("v"), {"lo": 1.0, "hi": 99.5}), IMAGE)
    t = tone.normalised(F.col("v"), F.col("lo"), F.col("hi"))
    return tidy(co.with_rgb(own, tone.bicolor(t, (0.1, 0.3, 0.9), (1.0, 0.8, 0.2))).select(*KEYS, "r", "g", "b"))


MED = "md AS (SELECT session, median(r) AS mr, median(g) AS mg, median(b) AS mb FROM rgbm GROUP BY 1)"


@query("bayer_compensation", f"WITH {fx.RGB_MASTER}, {MED} SELECT {HEAD}, {rounded('r * CASE WHEN mr > 0 THEN mg / mr ELSE 1 END AS r', 'g', 'b * CASE WHEN mb > 0 THEN mg / mb ELSE 1 END AS b')} FROM rgbm JOIN md USING (session)")
def bayer_compensation(spark, sf):
    return tidy(co.bayer_compensated(fx.rgb_master(spark, sf), IMAGE))


@query("gray_world", f"WITH {fx.RGB_MASTER}, {MED}, w AS (SELECT session, (mr + mg + mb) / 3 / mr AS r, (mr + mg + mb) / 3 / mg AS g, (mr + mg + mb) / 3 / mb AS b FROM md) SELECT session::BIGINT AS session, {rounded('r / greatest(r, g, b) AS wb_r', 'g / greatest(r, g, b) AS wb_g', 'b / greatest(r, g, b) AS wb_b')} FROM w")
def gray_world(spark, sf):
    return tidy(co.gray_world(fx.rgb_master(spark, sf), IMAGE))


def robust_sql(source: str, keys: str, sigma: float, rounds: int, least: int) -> str:
    """CTE rob (keys, v, n) from source (keys, v)."""
    out = [f"q0 AS (SELECT {keys}, v, true AS go FROM {source} WHERE v IS NOT NULL)"]
    w = f"OVER (PARTITION BY {keys})"
    for i in range(rounds):
        out += [
            f"qa{i} AS (SELECT *, median(v) {w} AS m FROM q{i})",
            f"qb{i} AS (SELECT *, 1.4826::DOUBLE * median(abs(v - m)) {w} AS s FROM qa{i})",
            f"qc{i} AS (SELECT *, abs(v - m) < {sigma}::DOUBLE * s AS st, count(*) FILTER (WHERE abs(v - m) < {sigma}::DOUBLE * s) {w} AS lf FROM qb{i})",
            f"q{i + 1} AS (SELECT {keys}, CASE WHEN NOT (go AND s >= 1e-6 AND lf >= {least}) OR st THEN v END AS v, go AND s >= 1e-6 AND lf >= {least} AS go FROM qc{i})",
        ]
    return ", ".join(out) + f", rob AS (SELECT {keys}, median(v) AS v, count(v) AS n FROM q{rounds} GROUP BY ALL)"


@query("robust_median", f"WITH {robust_sql('(SELECT event_type, value AS v FROM events)', 'event_type', 2.5, 5, 100)} SELECT event_type, {rounded('v AS value')}, n FROM rob")
def robust_median(spark, sf):
    return tidy(bg.robust_median(fx.table(spark, sf, "events"), ["event_type"], "value"))


CORNER = "(y < 2 OR y >= 6) AND (x < 2 OR x >= 6)"
SKY = (
    f"{fx.RGB_MASTER}, cp AS (SELECT session, unnest(['r', 'g', 'b']) AS channel, unnest([r, g, b]) AS v FROM rgbm WHERE {CORNER}), "
    + robust_sql("cp", "session, channel", 2.5, 5, 4)
    + ", sky AS (SELECT session, " + ", ".join(f"max(v) FILTER (WHERE channel = '{c}') AS bg_{c}" for c in "rgb") + " FROM rob GROUP BY 1)"
)


def _sky(spark, sf):
    own = bg.corner_pixels(fx.rgb_master(spark, sf), IMAGE, 4)
    levels = bg.robust_median(bg.unpivoted(own, IMAGE, ["r", "g", "b"]), [*IMAGE, "channel"], "v", least=4)
    return levels.groupBy(*IMAGE).agg(*[F.max(F.when(F.col("channel") == c, F.col("v"))).alias(f"bg_{c}") for c in "rgb"])


@query("sky_corners", f"WITH {SKY} SELECT session::BIGINT AS session, {rounded('bg_r', 'bg_g', 'bg_b')} FROM sky")
def sky_corners(spark, sf):
    return tidy(_sky(spark, sf))


SKY8 = SKY.replace(CORNER, "(y < 1 OR y >= 7) AND (x < 1 OR x >= 7)")


def calibrated_sql(background: str) -> str:
    off = {"common": ["least(bg_r, bg_g, bg_b)"] * 3, "per_channel": ["bg_r", "bg_g", "bg_b"]}[background]
    gains = ", ".join(f"(greatest(mr - bg_r, 1) + greatest(mg - bg_g, 1) + greatest(mb - bg_b, 1)) / 3 / greatest(m{c} - bg_{c}, 1) AS w{c}" for c in "rgb")
    out = rounded(*[f"greatest({c} - {o}, 0) * (w{c} / greatest(wr, wg, wb)) AS {c}" for c, o in zip("rgb", off)])
    return f"WITH {SKY8}, {MED}, w AS (SELECT *, {gains} FROM md JOIN sky USING (session)) SELECT rgbm.session::BIGINT AS session, y, x, {out} FROM rgbm JOIN w USING (session)"


for _kind in ("common", "per_channel"):

    def _cal(spark, sf, kind=_kind):
        return tidy(co.calibrated(fx.rgb_master(spark, sf), IMAGE, background=kind, least=4))

    query(f"calibrate_{_kind}", calibrated_sql(_kind))(_cal)


@query("calibrate_gains", f"WITH {fx.RGB_MASTER} SELECT {HEAD}, {rounded('r * 1.2::DOUBLE AS r', 'g', 'b * 0.9::DOUBLE AS b')} FROM rgbm")
def calibrate_gains(spark, sf):
    return tidy(co.calibrated(fx.rgb_master(spark, sf), IMAGE, background="none", gains=(1.2, 1.0, 0.9), least=4))


@query("box_balance", f"WITH {fx.RGB_MASTER}, k AS (SELECT session, count(*) AS n, median(r) AS mr, median(g) AS mg, median(b) AS mb FROM rgbm WHERE y >= 1 AND y < 6 AND ((x >= 0 AND x < 3) OR (x >= 5 AND x < 7)) AND r + g + b > 0 GROUP BY 1) SELECT {HEAD}, {rounded('r', 'g * CASE WHEN n > 10 AND mg > 0 THEN (mr + mb) / 2 / mg ELSE 1 END AS g', 'b')} FROM rgbm LEFT JOIN k USING (session)")
def box_balance(spark, sf):
    return tidy(co.corner_box_balance(fx.rgb_master(spark, sf), IMAGE, (1, 6), (0, 3), 1, 10))


@query("star_balance", f"WITH s AS (SELECT l_suppkey % 20 AS session, l_extendedprice AS r, l_extendedprice * (1 - l_discount) AS g, l_extendedprice * (1 + l_tax) AS b FROM lineitem), m AS (SELECT session, median(r / g) AS rg, median(b / g) AS bg FROM s GROUP BY 1), w AS (SELECT session, 1 / rg AS wr, 1.0::DOUBLE AS wg, 1 / bg AS wb FROM m) SELECT session, {rounded('wr / greatest(wr, wg, wb) AS wb_r', 'wg / greatest(wr, wg, wb) AS wb_g', 'wb / greatest(wr, wg, wb) AS wb_b')} FROM w")
def star_balance(spark, sf):
    price = F.col("l_extendedprice")
    own = fx.table(spark, sf, "lineitem").select((F.col("l_suppkey") % 20).alias("session"), price.alias("r_flux"), (price * (1 - F.col("l_discount"))).alias("g_flux"), (price * (1 + F.col("l_tax"))).alias("b_flux"))
    base = own.select("session").distinct().select("session", *[F.lit(1.0).alias(f"wb_{c}") for c in "rgb"])
    return tidy(co.star_ratios_balance(own, base, IMAGE))


@query("picked_stars", "WITH s AS (SELECT l_suppkey % 50 AS session, l_orderkey AS y, l_linenumber::BIGINT AS x, l_extendedprice AS g, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY l_suppkey % 50) AS n FROM lineitem WINDOW w AS (PARTITION BY l_suppkey % 50 ORDER BY l_extendedprice, l_orderkey, l_linenumber)) SELECT session, y, x FROM s WHERE n <= 50 OR (n > 100 AND i >= floor(n / 4) AND i < floor(n / 4) + 50) OR (n > 50 AND n <= 100 AND i < 50)")
def picked_stars(spark, sf):
    own = fx.table(spark, sf, "lineitem").select((F.col("l_suppkey") % 50).alias("session"), F.col("l_orderkey").alias("y"), F.col("l_linenumber").alias("x"), F.col("l_extendedprice").alias("g_flux"))
    return tidy(co.picked_stars(own, IMAGE, 50).select("session", "y", "x"))
