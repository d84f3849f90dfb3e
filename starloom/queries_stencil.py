"""Queries: neighbourhoods, masks, labels, background models, stars, registration, whole plans."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from starloom import fixtures as fx
from starloom.operators import background as bg
from starloom.operators import colour as co
from starloom.operators import quality as ql
from starloom.operators import register as rg
from starloom.operators import stencil as sc
from starloom.operators.pixels import to_pixels
from starloom.plans import report, session
from starloom.registry import query, rounded, tidy
from starloom.schema import LuminanceSettings, StackSettings

IMAGE = ["session"]
FRAME = ["frame_id"]
HEAD = "session::BIGINT AS session, y, x"
LIT = "lit AS (SELECT frame_id, y, x, v > 21500 AS m FROM px)"


def _lit(spark, sf):
    return fx.pixels(spark, sf).select("frame_id", "y", "x", (F.col("v") > 21500).alias("m"))


def _near(op: str, radius: int, empty: str) -> str:
    return (
        f"SELECT a.frame_id, a.y, a.x, {op}(b.m) AS m FROM lit a JOIN lit b ON a.frame_id = b.frame_id AND abs(a.y - b.y) + abs(a.x - b.x) <= {radius} GROUP BY ALL"
        if not empty
        else f"SELECT a.frame_id, a.y, a.x, {op}(b.m) AND least(a.y, a.x, 7 - a.y, 7 - a.x) >= {radius} AS m FROM lit a JOIN lit b ON a.frame_id = b.frame_id "
        f"AND abs(a.y - b.y) + abs(a.x - b.x) <= {radius} GROUP BY a.frame_id, a.y, a.x"
    )


@query("dilated_masks", f"WITH {fx.PX}, {LIT} {_near('bool_or', 2, '')}")
def dilated_masks(spark, sf):
    return tidy(sc.dilated(_lit(spark, sf), FRAME, "m", 2))


@query("eroded_masks", f"WITH {fx.PX}, lit AS (SELECT frame_id, y, x, v > 18500 AS m FROM px) {_near('bool_and', 1, 'border')}")
def eroded_masks(spark, sf):
    own = fx.pixels(spark, sf).select("frame_id", "y", "x", (F.col("v") > 18500).alias("m"))
    return tidy(sc.eroded(own, FRAME, "m", 1))


def gauss_sql(source: str, keys: str, value: str, sigma: float, out: str) -> str:
    w = sc.gaussian_weights(sigma)
    r = len(w) // 2
    taps = "[" + ", ".join(f"{x!r}::DOUBLE" for x in w) + "]"
    k = "((({p} + k - {r}) % 16) + 16) % 16"

    def place(p: str) -> str:
        m = k.format(p=p, r=r)
        return f"CASE WHEN {m} < 8 THEN {m} ELSE 15 - {m} END"

    on = " AND ".join(f"a.{x} = b.{x}" for x in keys.split(", "))
    own = ", ".join(f"a.{x}" for x in keys.split(", "))
    return (
        f"gy_{out} AS (SELECT {own}, a.y, a.x, sum(b.{value} * {taps}[k + 1]) AS {value} FROM {source} a, range({2 * r + 1}) t(k) JOIN {source} b ON true WHERE {on} AND b.x = a.x AND b.y = {place('a.y')} GROUP BY {own}, a.y, a.x), "
        f"{out} AS (SELECT {own}, a.y, a.x, sum(b.{value} * {taps}[k + 1]) AS {value} FROM gy_{out} a, range({2 * r + 1}) t(k) JOIN gy_{out} b ON true WHERE {on} AND b.y = a.y AND b.x = {place('a.x')} GROUP BY {own}, a.y, a.x)"
    )


@query("gaussian_filter", f"WITH {fx.MASTER}, {gauss_sql('mos', 'session', 'v', 1.5, 'sm')} SELECT {HEAD}, {rounded('v')} FROM sm")
def gaussian_filter(spark, sf):
    return tidy(sc.gaussian(fx.master(spark, sf), IMAGE, "v", 1.5))


@query(
    "median_filter",
    f"WITH {fx.MASTER}, o AS (SELECT a.session, a.y, a.x, least(greatest(a.y + dy.d, 0), 7) AS sy, least(greatest(a.x + dx.d, 0), 7) AS sx FROM mos a, range(-1, 2) dy(d), range(-1, 2) dx(d)) "
    f"SELECT o.session::BIGINT AS session, o.y, o.x, {rounded('median(v) AS v')} FROM o JOIN mos b ON o.session = b.session AND sy = b.y AND sx = b.x GROUP BY ALL",
)
def median_filter(spark, sf):
    return tidy(sc.median_filter(fx.master(spark, sf), IMAGE, ["v"]))


CHROMA = (
    f"{fx.RGB_MASTER}, l AS (SELECT session, y, x, 0.299::DOUBLE * r + 0.587::DOUBLE * g + 0.114::DOUBLE * b AS l, r, b FROM rgbm), o AS (SELECT a.session, a.y, a.x, a.l, least(greatest(a.y + dy.d, 0), 7) AS sy, "
    "least(greatest(a.x + dx.d, 0), 7) AS sx FROM l a, range(-1, 2) dy(d), range(-1, 2) dx(d)), c AS (SELECT o.session, o.y, o.x, o.l, median(b.b - b.l) AS cb, median(b.r - b.l) AS cr FROM o JOIN l b ON o.session = b.session "
    "AND sy = b.y AND sx = b.x GROUP BY ALL), z AS (SELECT *, greatest(l + cr, 0) AS r, greatest(l + cb, 0) AS b FROM c)"
)


@query("chroma_median", f"WITH {CHROMA} SELECT {HEAD}, {rounded('r', 'greatest((l - 0.299::DOUBLE * r - 0.114::DOUBLE * b) / 0.587::DOUBLE, 0) AS g', 'b')} FROM z")
def chroma_median(spark, sf):
    return tidy(sc.chroma_cleaned(fx.rgb_master(spark, sf), IMAGE))


THRESHOLD = f"{fx.PX}, t0 AS (SELECT *, median(v) OVER (PARTITION BY frame_id) AS med FROM px), t1 AS (SELECT *, 1.4826::DOUBLE * median(abs(v - med)) OVER (PARTITION BY frame_id) AS s FROM t0), lit AS (SELECT frame_id, y, x, v, s >= 1e-6 AND v > med + 1.0 * s AS m FROM t1)"
LABELS = (
    f"WITH RECURSIVE {THRESHOLD}, on_ AS MATERIALIZED (SELECT frame_id, y, x, y * 8 + x AS id FROM lit WHERE m), "
    "nb AS MATERIALIZED (SELECT a.frame_id, a.id, b.id AS other FROM on_ a JOIN on_ b ON a.frame_id = b.frame_id AND abs(a.y - b.y) + abs(a.x - b.x) <= 1), "
    "re AS (SELECT frame_id, id, id AS low FROM on_ UNION SELECT re.frame_id, nb.other, re.low FROM re JOIN nb ON re.frame_id = nb.frame_id AND re.id = nb.id WHERE re.low < nb.other), "
    "lab AS (SELECT frame_id, id, min(low) AS label FROM re GROUP BY 1, 2)"
)


def _threshold(spark, sf):
    return sc.threshold_mask(fx.pixels(spark, sf), FRAME, "v", 1.0)


@query("components", f"{LABELS} SELECT frame_id, label, count(*) AS area FROM lab GROUP BY 1, 2")
def components(spark, sf):
    labels = sc.labelled(_threshold(spark, sf), FRAME, "m")
    return tidy(labels.groupBy("frame_id", F.col("label").alias("_l")).agg(F.min(F.col("y") * 8 + F.col("x")).alias("label"), F.count(F.lit(1)).alias("area")).drop("_l"))


@query("star_counts", f"{LABELS}, big AS (SELECT frame_id, label FROM lab GROUP BY 1, 2 HAVING count(*) >= 4) SELECT f.vec_id AS frame_id, count(big.label) AS n_stars FROM embeddings f LEFT JOIN big ON f.vec_id = big.frame_id GROUP BY 1")
def star_counts(spark, sf):
    return tidy(sc.star_counts(fx.pixels(spark, sf), FRAME, "v", 1.0, 4))


@query("star_masks", f"{LABELS}, big AS (SELECT frame_id, label FROM lab GROUP BY 1, 2 HAVING count(*) >= 3), bp AS (SELECT lab.frame_id, id // 8 AS y, id % 8 AS x FROM lab JOIN big USING (frame_id, label)) SELECT p.frame_id, p.y, p.x, count(bp.y) > 0 AS m FROM px p LEFT JOIN bp ON p.frame_id = bp.frame_id AND abs(p.y - bp.y) + abs(p.x - bp.x) <= 1 GROUP BY ALL")
def star_masks(spark, sf):
    return tidy(sc.star_mask(fx.pixels(spark, sf), FRAME, "v", 1.0, 3, 1))


@query("filled_holes", "WITH RECURSIVE " + fx.PX + ", off_ AS MATERIALIZED (SELECT frame_id, y, x FROM px WHERE NOT v > 18500), re AS (SELECT frame_id, y, x FROM off_ WHERE y IN (0, 7) OR x IN (0, 7) UNION SELECT o.frame_id, o.y, o.x FROM re JOIN off_ o ON re.frame_id = o.frame_id AND abs(re.y - o.y) + abs(re.x - o.x) = 1) SELECT p.frame_id, p.y, p.x, re.y IS NULL AS m FROM px p LEFT JOIN re ON p.frame_id = re.frame_id AND p.y = re.y AND p.x = re.x")
def filled_holes(spark, sf):
    own = fx.pixels(spark, sf).select("frame_id", "y", "x", (F.col("v") > 18500).alias("m"))
    return tidy(sc.filled(own, FRAME, "m"))


def lit_sql(source: str, value: str, sigma: float, out: str) -> str:
    """CTEs up to out (session, y, x, m): value over median + sigma * 1.4826 MAD of the session's image."""
    return (
        f"{out}0 AS (SELECT *, median({value}) OVER (PARTITION BY session) AS med FROM {source}), {out}1 AS (SELECT *, 1.4826::DOUBLE * median(abs({value} - med)) OVER (PARTITION BY session) AS s FROM {out}0), "
        f"{out} AS (SELECT session, y, x, s >= 1e-6 AND {value} > med + {sigma}::DOUBLE * s AS m FROM {out}1)"
    )


def grown_sql(source: str, out: str) -> str:
    """CTE out: source (session, y, x, m) grown by one pixel."""
    return f"{out} AS (SELECT a.session, a.y, a.x, bool_or(b.m) AS m FROM {source} a JOIN {source} b ON a.session = b.session AND abs(a.y - b.y) + abs(a.x - b.x) <= 1 GROUP BY ALL)"


@query(
    "object_masks",
    f"WITH {fx.MASTER}, {lit_sql('mos', 'v', 2.0, 'sl')}, {grown_sql('sl', 'sg')}, {gauss_sql('mos', 'session', 'v', 1.0, 'sm')}, {lit_sql('sm', 'v', 1.0, 'el')}, {grown_sql('el', 'eg')} "
    "SELECT sg.session::BIGINT AS session, y, x, sg.m OR eg.m AS m FROM sg JOIN eg USING (session, y, x)",
)
def object_masks(spark, sf):
    return tidy(sc.object_mask(fx.master(spark, sf), IMAGE, "v", 2.0, 1.0, 1, 1.0, 1, 1))


def _galaxy_sql() -> str:
    parts, names = [], []
    for i, scale in enumerate((1.0, 2.0)):
        parts.append(gauss_sql("mos", "session", "v", scale, f"sm{i}").replace("gy_sm", "gy_gm"))
        parts.append(f"br{i} AS (SELECT session, y, x, sm{i}.v > sky + 1.0::DOUBLE * noise AS m FROM sm{i} JOIN lv USING (session)), sh{i} AS (SELECT *, avg(m::INT) OVER (PARTITION BY session) AS share FROM br{i})")
        names.append(f"sh{i}")
    return (
        f"WITH RECURSIVE {fx.MASTER}, co AS (SELECT session, v, median(v) OVER (PARTITION BY session) AS m FROM mos WHERE y IN (0, 7) AND x IN (0, 7)), "
        "lv AS (SELECT session, any_value(m) AS sky, 1.4826::DOUBLE * median(abs(v - m)) AS noise FROM co GROUP BY 1), "
        f"{', '.join(parts)}, un AS (SELECT session, y, x, (sh0.m AND sh0.share >= 0.01) OR (sh1.m AND sh1.share >= 0.01) AS m FROM sh0 JOIN sh1 USING (session, y, x)), {grown_sql('un', 'gr')}, "
        "off_ AS MATERIALIZED (SELECT session, y, x FROM gr WHERE NOT m), re AS (SELECT session, y, x FROM off_ WHERE y IN (0, 7) OR x IN (0, 7) UNION SELECT o.session, o.y, o.x FROM re "
        "JOIN off_ o ON re.session = o.session AND abs(re.y - o.y) + abs(re.x - o.x) = 1) "
        "SELECT g.session::BIGINT AS session, g.y, g.x, re.y IS NULL AS m FROM gr g LEFT JOIN re ON g.session = re.session AND g.y = re.y AND g.x = re.x"
    )


@query("galaxy_masks", _galaxy_sql())
def galaxy_masks(spark, sf):
    return tidy(sc.galaxy_mask(fx.master(spark, sf), IMAGE, "v", 1.0, (1.0, 2.0), 1))


@query("soft_masks", f"WITH {fx.MASTER}, q AS (SELECT session, y, x, CASE WHEN v > 20000 THEN 1.0 ELSE 0.0 END::DOUBLE AS soft FROM mos), {gauss_sql('q', 'session', 'soft', 1.0, 'sm')} SELECT {HEAD}, {rounded('soft')} FROM sm")
def soft_masks(spark, sf):
    own = fx.master(spark, sf).withColumn("m", F.col("v") > 20000)
    return tidy(sc.soft_mask(own, IMAGE, "m", 1.0))


@query("footprints", f"WITH {fx.RGB_MASTER}, t AS (SELECT *, max(greatest(r, g, b)) OVER (PARTITION BY session) AS top FROM rgbm), lit AS (SELECT session, y, x, least(r, g, b) > 0.98::DOUBLE * top AS m, top FROM t) SELECT a.session::BIGINT AS session, a.y, a.x, (bool_and(b.m) AND least(a.y, a.x, 7 - a.y, 7 - a.x) >= 1) OR max(a.top) <= 0 AS m FROM lit a JOIN lit b ON a.session = b.session AND abs(a.y - b.y) + abs(a.x - b.x) <= 1 GROUP BY a.session, a.y, a.x")
def footprints(spark, sf):
    return tidy(co.common_footprint(fx.rgb_master(spark, sf), IMAGE, 0.98, 1))


@query("local_contrast", f"WITH {fx.MASTER}, q AS (SELECT session, y, x, v / 65536.0::DOUBLE AS v FROM mos), {gauss_sql('q', 'session', 'v', 2.0, 'sm')} SELECT q.session::BIGINT AS session, q.y, q.x, {rounded('least(greatest(q.v + 0.5::DOUBLE * (q.v - sm.v), 0.0), 1.0) AS v')} FROM q JOIN sm USING (session, y, x)")
def local_contrast(spark, sf):
    own = fx.master(spark, sf).withColumn("v", F.col("v") / 65536.0)
    return tidy(sc.local_contrast(own, IMAGE, "v", 2.0, 0.5))


_SOFT = f"mk AS (SELECT session, y, x, CASE WHEN v > 20050 THEN 1.0 ELSE 0.0 END::DOUBLE AS soft FROM mos), {gauss_sql('mk', 'session', 'soft', 1.0, 'so')}"
_CALM = {
    "median": "o AS (SELECT a.session, a.y, a.x, least(greatest(a.y + dy.d, 0), 7) AS sy, least(greatest(a.x + dx.d, 0), 7) AS sx FROM mos a, range(-1, 2) dy(d), range(-1, 2) dx(d)), "
    "calm AS (SELECT o.session, o.y, o.x, median(b.v) AS v FROM o JOIN mos b ON o.session = b.session AND sy = b.y AND sx = b.x GROUP BY ALL)",
    "gaussian": gauss_sql("mos", "session", "v", 1.5, "calm"),
    "bilateral": "md AS (SELECT *, median(v) OVER (PARTITION BY session) AS med FROM mos), sg AS (SELECT *, 2 * 1.4826::DOUBLE * median(abs(v - med)) OVER (PARTITION BY session) AS s FROM md), "
    "wt AS (SELECT a.session, a.y, a.x, b.v, exp(-((a.y - b.y) * (a.y - b.y) + (a.x - b.x) * (a.x - b.x)) / 18.0::DOUBLE) * CASE WHEN a.s > 0 THEN exp(-(b.v - a.v) * (b.v - a.v) / (2 * a.s * a.s)) ELSE 1 END AS w "
    "FROM sg a JOIN sg b ON a.session = b.session AND abs(a.y - b.y) <= 2 AND abs(a.x - b.x) <= 2), calm AS (SELECT session, y, x, sum(v * w) / sum(w) AS v FROM wt GROUP BY ALL)",
}


for _method in ("median", "gaussian", "bilateral"):

    def _calm(spark, sf, method=_method):
        own = fx.master(spark, sf)
        mask = own.withColumn("m", F.col("v") > 20050)
        return tidy(sc.background_denoised(own, IMAGE, "v", method, 3, mask, 1.0))

    query(
        f"denoised_{_method}",
        f"WITH {fx.MASTER}, {_SOFT}, {_CALM[_method]} SELECT m.session::BIGINT AS session, m.y, m.x, {rounded('so.soft * m.v + (1 - so.soft) * calm.v AS v')} FROM mos m JOIN so USING (session, y, x) JOIN calm USING (session, y, x)",
    )(_calm)


CELLS = (
    f"{fx.PX}, ce AS (SELECT session, frame_id, cy, cx, 2 + cy * 4 / 3.0::DOUBLE AS yc, 2 + cx * 4 / 3.0::DOUBLE AS xc FROM (SELECT DISTINCT session, frame_id FROM px), range(4) a(cy), range(4) b(cx)), "
    "inc AS (SELECT ce.*, px.v FROM ce JOIN px ON ce.frame_id = px.frame_id AND px.y >= floor(yc) - 2 AND px.y < floor(yc) + 2 AND px.x >= floor(xc) - 2 AND px.x < floor(xc) + 2)"
)


def _robust(source, keys, least):
    from starloom.queries_tone import robust_sql

    return robust_sql(source, keys, 2.5, 5, least)


LEVELS = f"{CELLS}, {_robust('inc', 'frame_id, cy, cx, yc, xc', 10)}, lv AS (SELECT * FROM rob WHERE n >= 10)"


@query("cell_backgrounds", f"WITH {LEVELS} SELECT frame_id, cy, cx, {rounded('v AS level')}, n FROM lv")
def cell_backgrounds(spark, sf):
    return tidy(bg.cell_backgrounds(fx.pixels(spark, sf), FRAME, "v", 4).select("frame_id", "cy", "cx", "level", "n"))


PLANE = (
    f"{LEVELS}, tm AS (SELECT frame_id, n::DOUBLE AS w, (xc - 4) / 8 AS x, (yc - 4) / 8 AS y, v AS z FROM lv), sm AS (SELECT frame_id, sum(w) AS a00, sum(w * x) AS a01, sum(w * y) AS a02, sum(w * x * x) AS a11, sum(w * x * y) AS a12, "
    "sum(w * y * y) AS a22, sum(w * z) AS b0, sum(w * x * z) AS b1, sum(w * y * z) AS b2 FROM tm GROUP BY 1), dt AS (SELECT *, a00 * (a11 * a22 - a12 * a12) - a01 * (a01 * a22 - a12 * a02) + a02 * (a01 * a12 - a11 * a02) AS d FROM sm)"
)


@query(
    "background_plane",
    f"WITH {PLANE} SELECT frame_id, {rounded('(b0 * (a11 * a22 - a12 * a12) - a01 * (b1 * a22 - a12 * b2) + a02 * (b1 * a12 - a11 * b2)) / d AS c0', '(a00 * (b1 * a22 - a12 * b2) - b0 * (a01 * a22 - a12 * a02) + a02 * (a01 * b2 - b1 * a02)) / d AS c1', '(a00 * (a11 * b2 - b1 * a12) - a01 * (a01 * b2 - b1 * a02) + b0 * (a01 * a12 - a11 * a02)) / d AS c2', digits=4)} FROM dt",
)
def background_plane(spark, sf):
    return tidy(bg.plane_fit(bg.cell_backgrounds(fx.pixels(spark, sf), FRAME, "v", 4), FRAME).drop("median"), 4)


@query("background_polynomial")
def background_polynomial(spark, sf):
    return tidy(bg.estimated(fx.pixels(spark, sf), FRAME, "v", 4).select("frame_id", "y", "x", "background"), 4)


#: Halves and thirds of whole numbers lie on the ties of decimal rounding, where two engines' last bits decide: a step aside.
OFF_TIES = 0.000013

#: Four centres along an axis: the spline is the one cubic through them, written by Lagrange's weights.
_AXIS = ", ".join(
    f"({' * '.join(f'({{0}} - {j})' for j in range(4) if j != i)}) / {' * '.join(f'({i} - {j})' for j in range(4) if j != i)} AS w{i}".replace("/ ", "/ (", 1).replace(" AS", ") AS", 1) for i in range(4)
)


@query(
    "background_spline",
    f"WITH {LEVELS}, gm AS (SELECT frame_id, median(v) AS m FROM lv GROUP BY 1), gr AS (SELECT gm.frame_id, a.cy, b.cx, coalesce(lv.v, gm.m) AS v FROM gm, range(4) a(cy), range(4) b(cx) LEFT JOIN lv ON lv.frame_id = gm.frame_id AND lv.cy = a.cy AND lv.cx = b.cx), "
    f"ax AS (SELECT p, {_AXIS.format('u')} FROM (SELECT p, least(greatest((p - 2) / (4 / 3.0::DOUBLE), 0), 3)::DOUBLE AS u FROM range(8) t(p))), wt AS (SELECT p, i, CASE i WHEN 0 THEN w0 WHEN 1 THEN w1 WHEN 2 THEN w2 ELSE w3 END AS w FROM ax, range(4) t(i)) "
    f"SELECT frame_id, a.p AS y, b.p AS x, {rounded('sum(a.w * b.w * v) + 0.000013::DOUBLE AS background', digits=4)} FROM gr JOIN wt a ON a.i = cy JOIN wt b ON b.i = cx GROUP BY ALL",
)
def background_spline(spark, sf):
    own = bg.estimated(fx.pixels(spark, sf), FRAME, "v", 4, model="spline")
    return tidy(own.select("frame_id", "y", "x", (F.col("background") + OFF_TIES).alias("background")), 4)


_COEFS = (
    "cf AS (SELECT frame_id, (b0 * (a11 * a22 - a12 * a12) - a01 * (b1 * a22 - a12 * b2) + a02 * (b1 * a12 - a11 * b2)) / d AS c0, (a00 * (b1 * a22 - a12 * b2) - b0 * (a01 * a22 - a12 * a02) + a02 * (a01 * b2 - b1 * a02)) / d AS c1, "
    "(a00 * (a11 * b2 - b1 * a12) - a01 * (a01 * b2 - b1 * a02) + b0 * (a01 * a12 - a11 * a02)) / d AS c2 FROM dt), bk AS (SELECT px.frame_id, px.y, px.x, px.v, c0 + c1 * (px.x - 4) / 8 + c2 * (px.y - 4) / 8 AS k FROM px JOIN cf USING (frame_id))"
)
_LESS = {
    "subtract": "v - k - min(v - k) OVER (PARTITION BY frame_id) + 0.000013::DOUBLE AS v",
    "divide": "v / greatest(k, 1) * median(k) OVER (PARTITION BY frame_id) AS v",
}


for _mode in ("subtract", "divide"):

    def _less(spark, sf, mode=_mode):
        own = bg.estimated(fx.pixels(spark, sf), FRAME, "v", 4, 1)
        out = bg.without_background(own, FRAME, "v", mode)
        v = F.col("v") + OFF_TIES if mode == "subtract" else F.col("v")
        return tidy(out.select("frame_id", "y", "x", v.alias("v")), 4)

    query(f"background_{_mode}", f"WITH {PLANE}, {_COEFS} SELECT frame_id, y, x, {rounded(_LESS[_mode], digits=4)} FROM bk")(_less)


_STARS = (
    f"WITH RECURSIVE {fx.PX}, {fx.bilinear_sql('px', 'session, frame_id', 'bl')}, q0 AS (SELECT *, 0.299::DOUBLE * r + 0.587::DOUBLE * g + 0.114::DOUBLE * b AS l FROM bl), "
    "q1 AS (SELECT *, median(l) OVER (PARTITION BY frame_id) AS med, max(greatest(r, g, b)) OVER (PARTITION BY frame_id) AS top FROM q0), q2 AS (SELECT *, 1.4826::DOUBLE * median(abs(l - med)) OVER (PARTITION BY frame_id) AS s FROM q1), "
    "on_ AS MATERIALIZED (SELECT *, y * 8 + x AS id FROM q2 WHERE s >= 1e-6 AND l > med + 1.0 * s), "
    "nb AS MATERIALIZED (SELECT a.frame_id, a.id, b.id AS other FROM on_ a JOIN on_ b ON a.frame_id = b.frame_id AND abs(a.y - b.y) + abs(a.x - b.x) <= 1), "
    "re AS (SELECT frame_id, id, id AS low FROM on_ UNION SELECT re.frame_id, nb.other, re.low FROM re JOIN nb ON re.frame_id = nb.frame_id AND re.id = nb.id WHERE re.low < nb.other), "
    "lab AS (SELECT frame_id, id, min(low) AS label FROM re GROUP BY 1, 2), "
    "sr AS (SELECT session, frame_id, label, floor(avg(y))::BIGINT AS y, floor(avg(x))::BIGINT AS x, sum(r) AS r_flux, sum(g) AS g_flux, sum(b) AS b_flux, max(greatest(r, g, b)) AS peak, max(top) AS top "
    "FROM on_ JOIN lab USING (frame_id, id) GROUP BY ALL HAVING count(*) BETWEEN 2 AND 40) "
)


@query("reference_stars", f"{_STARS} SELECT session::BIGINT AS session, frame_id, y, x, {rounded('r_flux', 'g_flux', 'b_flux')} FROM sr WHERE peak <= 0.99::DOUBLE * top AND least(r_flux, g_flux, b_flux) >= 1")
def reference_stars(spark, sf):
    return tidy(co.reference_stars(fx.rgb_frames(spark, sf), ["session", "frame_id"], 1.0, 2, 40, 0.99, 50))


_NET = [f"sum({c}) FILTER (WHERE d <= 1) - 5 * median({c}) FILTER (WHERE d >= 2) AS {c}_flux" for c in "rgb"]


@query(
    "aperture_photometry",
    f"WITH {fx.PX}, {fx.bilinear_sql('px', 'session, frame_id', 'bl')}, nr AS (SELECT *, sqrt(((y - 4) * (y - 4) + (x - 4) * (x - 4))::DOUBLE) AS d FROM bl), nt AS (SELECT session, frame_id, {', '.join(_NET)} FROM nr WHERE d <= 2 GROUP BY ALL) "
    f"SELECT session::BIGINT AS session, frame_id, 4::BIGINT AS y, 4::BIGINT AS x, {rounded('r_flux', 'g_flux', 'b_flux')} FROM nt WHERE least(r_flux, g_flux, b_flux) >= 2.5",
)
def aperture_photometry(spark, sf):
    own = fx.rgb_frames(spark, sf)
    stars = own.where("y = 4 and x = 4").select("session", "frame_id", "y", "x")
    return tidy(co.aperture_fluxes(stars, own, ["session", "frame_id"], 1, 2, 2, least_ring=1))


# The grid and the moved pixels side by side, so that no join is left to a plan that knows little of the sizes.
SHIFTED = (
    "mv AS (SELECT frame_id, y, x, CAST(NULL AS DOUBLE) AS v FROM px UNION ALL SELECT frame_id, y + (frame_id % 5 - 2) AS y, x + (frame_id % 3 - 1) AS x, v FROM px)"
)


@query("integer_shift", f"WITH {fx.PX}, {SHIFTED} SELECT frame_id, y, x, coalesce(max(v), 0) AS v FROM mv WHERE y BETWEEN 0 AND 7 AND x BETWEEN 0 AND 7 GROUP BY frame_id, y, x")
def integer_shift(spark, sf):
    return tidy(rg.shifted(fx.pixels(spark, sf), FRAME, ["v"], F.col("frame_id") % 5 - 2, F.col("frame_id") % 3 - 1))


def _inverse():
    n = F.col("frame_id")
    one, zero = F.lit(1.0), F.lit(0.0)
    return F.array(F.array(one, zero, (n % 4) / 4.0), F.array(zero, one, (n % 3 - 1) / 2.0), F.array(zero, zero, one))


_TAPS = " + ".join(
    f"coalesce(max(b.v) FILTER (WHERE b.y = floor(v0) + {i} AND b.x = floor(u0) + {j}), 0) * {'(v0 - floor(v0))' if i else '(1 - (v0 - floor(v0)))'} * {'(u0 - floor(u0))' if j else '(1 - (u0 - floor(u0)))'}"
    for i in (0, 1) for j in (0, 1)
)


@query(
    "bilinear_warp",
    f"WITH {fx.PX}, o AS (SELECT frame_id, y, x, x + (frame_id % 4) / 4.0::DOUBLE AS u0, y + (frame_id % 3 - 1) / 2.0::DOUBLE AS v0 FROM px) SELECT o.frame_id, o.y, o.x, {rounded(_TAPS + ' AS v')} FROM o LEFT JOIN px b ON o.frame_id = b.frame_id "
    "AND b.y BETWEEN floor(v0) AND floor(v0) + 1 AND b.x BETWEEN floor(u0) AND floor(u0) + 1 GROUP BY o.frame_id, o.y, o.x, u0, v0",
)
def bilinear_warp(spark, sf):
    own = fx.frames(spark, sf).select("frame_id", "width", rg.warped(F.col("data"), F.col("height"), F.col("width"), _inverse()).alias("d"))
    return tidy(to_pixels(own, FRAME, {"v": "d"}).drop("pos"))


@query("warp_masks", f"WITH {fx.PX} SELECT frame_id, y, x, CASE WHEN round_even(x + (frame_id % 4) / 4.0::DOUBLE, 0) BETWEEN 0 AND 7 AND round_even(y + (frame_id % 3 - 1) / 2.0::DOUBLE, 0) BETWEEN 0 AND 7 THEN 1.0 ELSE 0.0 END::DOUBLE AS m FROM px")
def warp_masks(spark, sf):
    own = fx.frames(spark, sf).select("frame_id", "width", rg.warp_mask(F.col("height"), F.col("width"), _inverse()).alias("d"))
    return tidy(to_pixels(own, FRAME, {"m": "d"}).drop("pos"))


_TURN = "2 * pi() * (u * {y} + w * {x}) / 8"
_SHIFT = (
    "sp AS MATERIALIZED (SELECT session, frame_id, u, w, sum(v * cos({a})) AS re, -sum(v * sin({a})) AS im FROM {frames}, range(8) a(u), range(8) b(w) GROUP BY ALL), "
    "cp AS (SELECT s.session, s.frame_id, s.u, s.w, r.re * s.re + r.im * s.im AS re, r.im * s.re - r.re * s.im AS im FROM sp s JOIN {reference} f ON s.session = f.session "
    "JOIN sp r ON r.session = f.session AND r.frame_id = f.reference AND r.u = s.u AND r.w = s.w), "
    "wh AS MATERIALIZED (SELECT session, frame_id, u, w, re / greatest(sqrt(re * re + im * im), 1e-12::DOUBLE) AS re, im / greatest(sqrt(re * re + im * im), 1e-12::DOUBLE) AS im FROM cp), "
    "iv AS (SELECT session, frame_id, p, q, sum(re * cos({b}) - im * sin({b})) / 64 AS re, sum(re * sin({b}) + im * cos({b})) / 64 AS im FROM wh, range(8) a(p), range(8) b(q) GROUP BY ALL), "
    "pk AS (SELECT *, row_number() OVER (PARTITION BY session, frame_id ORDER BY round(sqrt(re * re + im * im), 9) DESC, p * 8 + q) AS nth FROM iv), "
    "sh AS MATERIALIZED (SELECT session, frame_id, CASE WHEN p > 4 THEN p - 8 ELSE p END AS dy, CASE WHEN q > 4 THEN q - 8 ELSE q END AS dx FROM pk WHERE nth = 1)"
)


def shift_sql(frames: str, reference: str) -> str:
    """CTE sh (session, frame_id, dy, dx): the moves that bring frames (8 x 8 pixel rows) onto the reference (session, reference)."""
    return _SHIFT.format(a=_TURN.format(y="y", x="x"), b=_TURN.format(y="p", x="q"), frames=frames, reference=reference)


@query(
    "phase_shifts",
    f"WITH {fx.PX}, rf AS (SELECT session, min(frame_id) AS reference FROM px GROUP BY 1), {shift_sql('px', 'rf')} "
    "SELECT session::BIGINT AS session, frame_id, (2 * round_even(dy / 2, 0))::BIGINT AS dy, (2 * round_even(dx / 2, 0))::BIGINT AS dx, true AS success, '' AS error FROM sh",
)
def phase_shifts(spark, sf):
    own = fx.frames(spark, sf)
    ref = own.join(own.groupBy("session").agg(F.min("frame_id").alias("frame_id")), ["session", "frame_id"], "left_semi").drop("frame_id")
    return tidy(rg.integer_shifts(own, ref, IMAGE))


@query("star_transforms")
def star_transforms(spark, sf):
    """Star lists from line items: a session per supplier group, frames by line number, moved by a known shift."""
    n = F.col("l_linenumber")
    own = fx.table(spark, sf, "lineitem").select(
        (F.col("l_suppkey") % 20).alias("session"), n.cast("long").alias("frame_id"), (F.pmod(F.xxhash64("l_partkey"), F.lit(2000)) + 3 * n).cast("double").alias("x"),
        (F.pmod(F.xxhash64("l_partkey", F.lit(1)), F.lit(1000)) - 2 * n).cast("double").alias("y"), (F.col("l_partkey") * 7919 % 100003).cast("double").alias("flux"),
    )
    stars = own.dropDuplicates(["session", "frame_id", "flux"])
    ref = stars.groupBy("session").agg(F.min("frame_id").alias("reference"))
    return tidy(rg.star_transforms(stars, ref, IMAGE).select("session", "frame_id", "success", "n_matches"))


@query("field_rotation", "WITH r AS (SELECT label AS session, vec_id AS i, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS k, count(*) OVER (PARTITION BY label) AS n FROM embeddings), s AS (SELECT DISTINCT session, i FROM r, range(5) q(q) WHERE k = floor(q * (n - 1) / 4)) " f"SELECT session::BIGINT AS session, {rounded('coalesce(max(abs(degrees(atan2(sin((i % 10) / 100.0::DOUBLE), cos((i % 10) / 100.0::DOUBLE))))) FILTER (WHERE i % 19 <> 0), 0) AS rotation')} FROM s GROUP BY 1")
def field_rotation(spark, sf):
    turn = (F.col("frame_id") % 10) / 100.0
    zero = F.lit(0.0)
    m = F.array(F.array(F.cos(turn), -F.sin(turn), zero), F.array(F.sin(turn), F.cos(turn), zero), F.array(zero, zero, F.lit(1.0)))
    own = fx.names(spark, sf).select("session", "frame_id", m.alias("matrix"), (F.col("frame_id") % 19 != 0).alias("success"))
    return tidy(rg.field_rotation(own, IMAGE, "frame_id"))


SETTINGS = StackSettings(full_scale=26000.0, align="none")


def _stacked_sql() -> str:
    from starloom.queries_frames import RANKED
    from starloom.queries_stack import clip_sql

    kept = "kp AS (SELECT px.session, px.y, px.x, px.v FROM px JOIN rk USING (session, frame_id) WHERE rank <= greatest(1, floor(n * 0.92::DOUBLE)))"
    return f"WITH {RANKED}, {kept}, {clip_sql('kp', 'session, y, x', ['v'], 3, 5, 'median')}, k AS (SELECT session, y, x, avg(v) AS v, count(*) AS n, count(v) AS n_kept FROM c5 GROUP BY ALL)"


@query("stacked_sessions", f"{_stacked_sql()} SELECT {HEAD}, {rounded('v')}, n, n_kept FROM k")
def stacked_sessions(spark, sf):
    return tidy(session.stacked_session(fx.frames(spark, sf), SETTINGS).master)


def _aligned_sql() -> str:
    from starloom.queries_frames import RANKED
    from starloom.queries_stack import clip_sql

    return (
        f"WITH {RANKED}, kp AS MATERIALIZED (SELECT px.session, px.frame_id, px.y, px.x, px.v, rank FROM px JOIN rk USING (session, frame_id) WHERE rank <= greatest(1, floor(n * 0.92::DOUBLE))), "
        f"rf AS (SELECT DISTINCT session, frame_id AS reference FROM kp WHERE rank = 1), {shift_sql('kp', 'rf')}, "
        "mv AS (SELECT kp.session, kp.frame_id, kp.y + dy AS y, kp.x + dx AS x, v FROM kp JOIN sh USING (session, frame_id) WHERE kp.y + dy BETWEEN 0 AND 7 AND kp.x + dx BETWEEN 0 AND 7), "
        f"{clip_sql('mv', 'session, y, x', ['v'], 3, 5, 'median')}, k AS (SELECT session, y, x, avg(v) AS v, count(*) AS n, count(v) AS n_kept FROM c5 GROUP BY ALL)"
    )


@query("aligned_sessions", f"{_aligned_sql()} SELECT {HEAD}, {rounded('v')}, n, n_kept FROM k")
def aligned_sessions(spark, sf):
    return tidy(session.stacked_session(fx.frames(spark, sf), replace(SETTINGS, align="integer")).master)


_SNR = rounded("max(n) * 15.0 AS total_exposure_s", "1 - avg(n_kept) / max(n) AS mean_clipped_fraction", "median(v) / nullif(1.4826 * median(abs(v - med)), 0) AS snr_proxy")


@query(
    "session_statistics",
    f"{_stacked_sql()}, d AS (SELECT *, median(v) OVER (PARTITION BY session) AS med FROM k) SELECT session::BIGINT AS session, max(n) AS n_frames, {_SNR} FROM d GROUP BY 1",
)
def session_statistics(spark, sf):
    return tidy(session.stacked_session(fx.frames(spark, sf), SETTINGS).statistics)


@query("processed_luminance", None)
def processed_luminance(spark, sf):
    plain = LuminanceSettings(subtract_bg=False, contrast_scale=1, stretch_mode="single")
    return tidy(session.processed_luminance(fx.master(spark, sf), IMAGE, "v", plain))


@query("processed_colour", None)
def processed_colour(spark, sf):
    return tidy(session.processed_colour(fx.rgb_master(spark, sf), IMAGE, least=4))


@query("manifests", None)
def manifests(spark, sf):
    s = ql.selected(ql.scored(fx.frames(spark, sf), ["session", "frame_id"], full_scale=26000.0), IMAGE, "frame_id")
    lost = fx.names(spark, sf).where("frame_id % 17 = 0").select("session", "frame_id", F.lit("failed_prefix").alias("reason"))
    return tidy(report.manifests(s, lost, IMAGE, "frame_id", SETTINGS.fingerprint()))


@query(
    "manifest_frames",
    _stacked_sql().split(", kp AS")[0] + f" SELECT session::BIGINT AS session, frame_id AS name, rank, {rounded('composite_score AS score')}, rank <= greatest(1, floor(n * 0.92::DOUBLE)) AS kept, "
    "CASE WHEN frame_id % 17 = 0 THEN 'failed_prefix' END AS reason FROM rk",
)
def manifest_frames(spark, sf):
    """What manifests say, read back from their JSON."""
    return tidy(report.manifest_frames(manifests(spark, sf), IMAGE))


_LINE = "string_agg('- ' || frame_id || ': ' || printf('%.4f', composite_score), chr(10) ORDER BY rank)"


@query(
    "reports",
    f"{_stacked_sql()}, d AS (SELECT *, median(v) OVER (PARTITION BY session) AS med FROM k), "
    "st AS (SELECT session, max(n) AS n_frames, max(n) * 15.0::DOUBLE AS exposure, 1 - avg(n_kept) / max(n) AS share, coalesce(median(v) / nullif(1.4826::DOUBLE * median(abs(v - med)), 0), 0) AS snr FROM d GROUP BY 1), "
    f"pl AS (SELECT session, {_LINE} FILTER (WHERE rank <= 5) AS top, {_LINE} FILTER (WHERE n > 5 AND rank > n - 5) AS bottom FROM rk GROUP BY 1), "
    "lo AS (SELECT label AS session, '- failed_prefix: ' || count(*) AS reasons FROM embeddings WHERE vec_id % 17 = 0 GROUP BY 1) "
    "SELECT st.session::BIGINT AS session, concat_ws(chr(10), '# Run report', '- frames: ' || n_frames, printf('- total_exposure_s: %.4f', exposure), printf('- mean_clipped_fraction: %.4f', share), "
    "printf('- snr_proxy: %.4f', snr), '## Rejected', coalesce(reasons, 'none'), '## Best', top, '## Worst' || chr(10) || bottom) AS report "
    "FROM st LEFT JOIN pl USING (session) LEFT JOIN lo USING (session)",
)
def reports(spark, sf):
    got = session.stacked_session(fx.frames(spark, sf), SETTINGS)
    lost = fx.names(spark, sf).where("frame_id % 17 = 0").select("session", "frame_id", F.lit("failed_prefix").alias("reason"))
    return tidy(report.markdown(got.scores.withColumn("frame_id", F.col("frame_id").cast("string")), lost, got.statistics, IMAGE, "frame_id"))
