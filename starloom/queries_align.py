"""Queries: frames warped by transforms with masks, stacks over them, and small pieces of whole sessions."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom import fixtures as fx
from starloom.operators import colour as co
from starloom.operators import frames as fr
from starloom.operators import quality as ql
from starloom.operators import stack as st
from starloom.plans import align as al
from starloom.plans import order
from starloom.queries_frames import RANKED, SCORE
from starloom.queries_stack import KEYS, clip_sql, two_pass_sql
from starloom.queries_stencil import shift_sql
from starloom.registry import query, rounded, tidy
from starloom.schema import StackSettings


def shifts(spark, sf):
    """session, frame_id, success, matrix: fractions of half-size pixels by frame; one frame in eleven has no transform."""
    n, one, zero = F.col("frame_id"), F.lit(1.0), F.lit(0.0)
    rows = F.array(F.array(one, zero, -(n % 4) / 4.0), F.array(zero, one, -(n % 3 - 1) / 2.0), F.array(zero, zero, one))
    return fx.names(spark, sf).select("session", "frame_id", (n % 11 != 0).alias("success"), rows.alias("matrix"))


def off_ties(df, names):
    """Halves of whole numbers lie on the ties of decimal rounding, where the order of a sum decides: a step aside, as in the SQL."""
    return df.withColumns({c: F.col(c) + 0.000013 for c in names})


def references(spark, sf):
    return shifts(spark, sf).where("success").groupBy("session").agg(F.min("frame_id").alias("reference"))


def warp_sql(source: str, names: list[str], side: int, factor: int) -> str:
    """CTE wp (session, frame_id, y, x, names, w) from source (session, frame_id, y, x, names): side x side images."""
    taps = ", ".join(f"coalesce(sum(b.{n} * (1 - abs(o.v0 - b.y)) * (1 - abs(o.u0 - b.x))), 0) AS {n}" for n in names)
    inside = f"round_even(o.v0, 0) BETWEEN 0 AND {side - 1} AND round_even(o.u0, 0) BETWEEN 0 AND {side - 1}"
    return (
        f"o AS (SELECT session, frame_id, y, x, x + {factor} * (frame_id % 4) / 4.0::DOUBLE AS u0, y + {factor} * (frame_id % 3 - 1) / 2.0::DOUBLE AS v0 "
        f"FROM {source} WHERE frame_id % 11 <> 0), "
        f"wp AS (SELECT o.session, o.frame_id, o.y, o.x, {taps}, CASE WHEN {inside} THEN 1.0 ELSE 0.0 END::DOUBLE AS w FROM o LEFT JOIN {source} b "
        "ON o.frame_id = b.frame_id AND b.y BETWEEN floor(o.v0) AND floor(o.v0) + 1 AND b.x BETWEEN floor(o.u0) AND floor(o.u0) + 1 "
        "GROUP BY o.session, o.frame_id, o.y, o.x, o.u0, o.v0)"
    )


HALF = (
    f"{fx.PX}, pl AS MATERIALIZED (SELECT session, frame_id, y // 2 AS y, x // 2 AS x, max(v) FILTER (WHERE y % 2 = 0 AND x % 2 = 0) AS r, "
    "max(v) FILTER (WHERE y % 2 = 0 AND x % 2 = 1) AS g1, max(v) FILTER (WHERE y % 2 = 1 AND x % 2 = 0) AS g2, "
    "max(v) FILTER (WHERE y % 2 = 1 AND x % 2 = 1) AS b FROM px GROUP BY ALL)"
)
SUPER = f"{HALF}, sup AS MATERIALIZED (SELECT session, frame_id, y, x, r, (g1 + g2) / 2 AS g, b FROM pl), {warp_sql('sup', ['r', 'g', 'b'], 4, 1)}"
FULL = f"{fx.PX}, {fx.bilinear_sql('(SELECT session, frame_id, y, x, v FROM px)', 'session, frame_id', 'bl0')}, bl AS MATERIALIZED (SELECT * FROM bl0), {warp_sql('bl', ['r', 'g', 'b'], 8, 2)}"
MEAN = "CASE WHEN sum(w) FILTER (WHERE {v} IS NOT NULL) > 1e-6 THEN sum({v} * w) / sum(w) FILTER (WHERE {v} IS NOT NULL) ELSE 0 END AS {v}"


@query("aligned_frames", f"WITH {SUPER} SELECT session::BIGINT AS session, frame_id, y::BIGINT AS y, x::BIGINT AS x, {rounded('r', 'g', 'b', digits=4)}, w FROM wp")
def aligned_frames(spark, sf):
    planes = al.warped_planes(fx.frames(spark, sf), shifts(spark, sf), "superpixel")
    return tidy(al.warped_pixels(planes, ["r", "g", "b"]), 4)


@query(
    "aligned_rgb_stack",
    f"WITH {SUPER}, {clip_sql('wp', 'session, y, x', ['r', 'g', 'b'], 3, 5, 'mean', 'w > 0.5')} SELECT session::BIGINT AS session, y::BIGINT AS y, x::BIGINT AS x, "
    f"{rounded(*[MEAN.format(v=c).replace(' END', ' END + 0.000013::DOUBLE') for c in 'rgb'], digits=4)}, count(r) AS coverage FROM c5 GROUP BY ALL",
)
def aligned_rgb_stack(spark, sf):
    return tidy(off_ties(al.rgb_stack(fx.frames(spark, sf), shifts(spark, sf)), "rgb"), 4)


@query(
    "aligned_full_stack",
    f"WITH {FULL}, {two_pass_sql('wp', ['r', 'g', 'b'], 'w > 0.5', 'abs({v} - m_{v}) <= 3 * s_{v} + 1e-6')} SELECT session::BIGINT AS session, y::BIGINT AS y, x::BIGINT AS x, "
    f"{rounded(*[f'{c} + 0.000013::DOUBLE AS {c}' for c in 'rgb'], digits=4)}, coverage FROM res",
)
def aligned_full_stack(spark, sf):
    return tidy(off_ties(al.full_resolution_stack(fx.frames(spark, sf), shifts(spark, sf)), "rgb"), 4)


@query(
    "aligned_mosaic_stack",
    f"WITH {fx.PX}, one AS MATERIALIZED (SELECT session, frame_id, y, x, v FROM px), {warp_sql('one', ['v'], 8, 2)}, {clip_sql('wp', 'session, y, x', ['v'], 3, 5, 'median')} "
    f"SELECT session::BIGINT AS session, y::BIGINT AS y, x::BIGINT AS x, {rounded('avg(v) + 0.000013::DOUBLE AS v', digits=4)}, count(*) AS n, count(v) AS n_kept FROM c5 GROUP BY ALL",
)
def aligned_mosaic_stack(spark, sf):
    return tidy(off_ties(al.bayer_stack(fx.frames(spark, sf), shifts(spark, sf)), "v"), 4)


_PLANE_NAMES = ["r", "g1", "g2", "b"]
_MOSAIC = (
    "mos AS (SELECT session, y * 2 + dy AS y, x * 2 + dx AS x, CASE WHEN dy = 0 AND dx = 0 THEN r WHEN dy = 0 THEN g1 WHEN dx = 0 THEN g2 ELSE b END AS v "
    "FROM cov, range(2) a(dy), range(2) c(dx))"
)


@query(
    "aligned_plane_stack",
    f"WITH {HALF}, {warp_sql('pl', _PLANE_NAMES, 4, 1)}, rf AS (SELECT session, min(frame_id) AS reference FROM wp GROUP BY 1), "
    f"wr AS (SELECT wp.*, reference FROM wp JOIN rf USING (session)), "
    f"{two_pass_sql('wr', _PLANE_NAMES, 'w > 0.5', 'abs({v} - m_{v}) / (s_{v} + 1e-10) < 3', 'frame_id = reference')}, "
    "top AS (SELECT *, floor(0.5 * max(coverage) OVER (PARTITION BY session)) AS least FROM res), "
    f"cov AS (SELECT session, y, x, {', '.join(f'CASE WHEN coverage < least THEN 0 ELSE {c} END AS {c}' for c in _PLANE_NAMES)} FROM top), {_MOSAIC}, "
    f"{fx.bilinear_sql('mos', 'session', 'full_')} SELECT session::BIGINT AS session, y::BIGINT AS y, x::BIGINT AS x, {rounded(*[f'{c} + 0.000013::DOUBLE AS {c}' for c in 'rgb'], digits=4)} FROM full_",
)
def aligned_plane_stack(spark, sf):
    return tidy(off_ties(al.plane_stack(fx.frames(spark, sf), shifts(spark, sf), references(spark, sf), order=1, cleanup=False), "rgb"), 4)


def _moved_sql() -> str:
    """CTEs up to c5 (session, y, x, r, g, b): kept frames moved by whole superpixels, a mosaic's even moves, and clipped."""
    half = HALF.replace(f"{fx.PX}, ", "")
    return (
        f"WITH {RANKED.replace('26000', '65535')}, kp AS MATERIALIZED (SELECT px.session, px.frame_id, px.y, px.x, px.v, rank FROM px JOIN rk USING (session, frame_id) WHERE rank <= greatest(1, floor(n * 0.92::DOUBLE))), "
        f"rf AS (SELECT DISTINCT session, frame_id AS reference FROM kp WHERE rank = 1), {shift_sql('kp', 'rf')}, {half}, "
        "wp AS (SELECT session, frame_id, y + round_even(dy / 2, 0) AS y, x + round_even(dx / 2, 0) AS x, r, (g1 + g2) / 2 AS g, b FROM pl JOIN sh USING (session, frame_id)), "
        f"mv AS (SELECT * FROM wp WHERE y BETWEEN 0 AND 3 AND x BETWEEN 0 AND 3), {clip_sql('mv', 'session, y, x', ['r', 'g', 'b'], 3, 5, 'mean')}"
    )


@query(
    "aligned_by_settings",
    f"{_moved_sql()} SELECT session::BIGINT AS session, y::BIGINT AS y, x::BIGINT AS x, {rounded(*[f'avg({c}) + 0.000013::DOUBLE AS {c}' for c in 'rgb'], digits=4)}, count(r) AS coverage FROM c5 GROUP BY ALL",
)
def aligned_by_settings(spark, sf):
    """A whole session as the settings say; tests hold it against the plain steps."""
    got = al.aligned_session(fx.frames(spark, sf), StackSettings(align="integer", debayer="superpixel"))
    return tidy(off_ties(got.master, "rgb"), 4)


_STARRED = (
    f"WITH RECURSIVE {SCORE}, {HALF.replace(fx.PX + ', ', '')}, lum AS (SELECT session, frame_id, y, x, (r + g1 + g2 + b) / 4 AS l FROM pl), "
    "md AS (SELECT *, median(l) OVER (PARTITION BY frame_id) AS med FROM lum), ns AS (SELECT *, 1.4826::DOUBLE * median(abs(l - med)) OVER (PARTITION BY frame_id) AS s FROM md), "
    "lit AS MATERIALIZED (SELECT *, y * 4 + x AS id FROM ns WHERE s >= 1e-6 AND l > med + 0.5::DOUBLE * s), "
    "nb AS MATERIALIZED (SELECT a.frame_id, a.id, b.id AS other FROM lit a JOIN lit b ON a.frame_id = b.frame_id AND abs(a.y - b.y) + abs(a.x - b.x) <= 1), "
    "re AS (SELECT frame_id, id, id AS low FROM lit UNION SELECT re.frame_id, nb.other, re.low FROM re JOIN nb ON re.frame_id = nb.frame_id AND re.id = nb.id WHERE re.low < nb.other), "
    "lab AS (SELECT frame_id, id, min(low) AS label FROM re GROUP BY 1, 2), big AS (SELECT frame_id, label FROM lab GROUP BY 1, 2 HAVING count(*) >= 2), "
    "st AS (SELECT frame_id, count(*) AS n FROM big GROUP BY 1), "
    "sn AS (SELECT scored.session, scored.frame_id, coalesce(st.n, 0)::BIGINT AS n_stars, composite_score * (1 + coalesce(st.n, 0)) AS composite_score FROM scored LEFT JOIN st USING (frame_id)) "
)


def _starred(spark, sf):
    own = fx.frames(spark, sf)
    counted = own.join(al.star_lists(own, 0.5, 2).select("session", "frame_id", "n_stars"), ["session", "frame_id"])
    return ql.scored(counted, ["session", "frame_id"], full_scale=26000.0, stars=F.col("n_stars"))


@query("star_scores", f"{_STARRED} SELECT session::BIGINT AS session, frame_id, n_stars, {rounded('composite_score', digits=9)} FROM sn")
def star_scores(spark, sf):
    """Frames scored with their stars counted."""
    return tidy(_starred(spark, sf).select("session", "frame_id", "n_stars", "composite_score"), 9)


@query(
    "star_selected",
    f"{_STARRED}, rk AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY composite_score DESC, frame_id) AS rank, count(*) OVER (PARTITION BY session) AS n FROM sn) "
    "SELECT session::BIGINT AS session, count(*) FILTER (WHERE rank <= greatest(1, floor(n * 0.5))) AS n_kept, sum(CASE WHEN rank <= greatest(1, floor(n * 0.5)) THEN frame_id ELSE 0 END)::BIGINT AS kept_ids, min(CASE WHEN rank = 1 THEN frame_id END) AS best FROM rk GROUP BY 1",
)
def star_selected(spark, sf):
    got = ql.selected(_starred(spark, sf), ["session"], "frame_id", 0.5)
    kept = F.when(F.col("kept"), F.col("frame_id"))
    return tidy(got.groupBy("session").agg(F.count(kept).alias("n_kept"), F.coalesce(F.sum(kept), F.lit(0)).alias("kept_ids"), F.min(F.when(F.col("rank") == 1, F.col("frame_id"))).alias("best")))


@query(
    "auto_valid_masks",
    f"WITH {fx.PX}, {fx.bilinear_sql('(SELECT session, frame_id, y, x, v FROM px)', 'session, frame_id', 'bl')}, l AS (SELECT *, 0.299::DOUBLE * r + 0.587::DOUBLE * g + 0.114::DOUBLE * b AS l FROM bl), "
    "m AS (SELECT session, frame_id, y, x, l > 0.6::DOUBLE * max(l) OVER (PARTITION BY session, frame_id) OR max(l) OVER (PARTITION BY session, frame_id) <= 0 AS valid FROM l) "
    "SELECT session::BIGINT AS session, frame_id, count(*) FILTER (WHERE valid) AS n_valid, sum(CASE WHEN valid THEN y * 8 + x ELSE 0 END)::BIGINT AS places FROM m GROUP BY ALL",
)
def auto_valid_masks(spark, sf):
    got = al.auto_valid(fx.rgb_frames(spark, sf), ["session", "frame_id"], 0.6)
    place = F.when(F.col("valid"), F.col("y") * 8 + F.col("x")).otherwise(0)
    return tidy(got.groupBy("session", "frame_id").agg(F.count_if("valid").alias("n_valid"), F.sum(place).alias("places")))


_AUTO = (
    f"{fx.PX}, {fx.bilinear_sql('(SELECT session, frame_id, y, x, v FROM px)', 'session, frame_id', 'bl')}, l AS (SELECT *, 0.299::DOUBLE * r + 0.587::DOUBLE * g + 0.114::DOUBLE * b AS l FROM bl), "
    "m AS (SELECT session, frame_id, y, x, r, g, b, CASE WHEN l > 0.6::DOUBLE * max(l) OVER (PARTITION BY session, frame_id) OR max(l) OVER (PARTITION BY session, frame_id) <= 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS w FROM l)"
)
_FRAMES = ["session", "frame_id"]


@query(
    "auto_masked_mean",
    f"WITH {_AUTO} SELECT session::BIGINT AS session, y::BIGINT AS y, x::BIGINT AS x, {rounded(*[f'coalesce(sum({c} * w) / nullif(sum(w), 0), 0) + 0.000013::DOUBLE AS {c}' for c in 'rgb'], digits=4)}, floor(sum(w))::BIGINT AS coverage FROM m GROUP BY ALL",
)
def auto_masked_mean(spark, sf):
    """Frames without masks: each makes its own from its luma, and the mean counts valid pixels only."""
    own = al.with_masks(fx.rgb_frames(spark, sf), _FRAMES, threshold=0.6)
    return tidy(off_ties(st.mask_aware_mean(own, ["session", "y", "x"], ["r", "g", "b"], "w"), "rgb"), 4)


@query(
    "auto_masked_clip",
    f"WITH {_AUTO}, {clip_sql('m', 'session, y, x', ['r', 'g', 'b'], 2, 5, 'mean', 'w > 0.5')} SELECT session::BIGINT AS session, y::BIGINT AS y, x::BIGINT AS x, "
    f"{rounded(*[MEAN.format(v=c).replace(' END', ' END + 0.000013::DOUBLE') for c in 'rgb'], digits=4)}, count(r) AS coverage FROM c5 GROUP BY ALL",
)
def auto_masked_clip(spark, sf):
    own = al.with_masks(fx.rgb_frames(spark, sf), _FRAMES, threshold=0.6)
    return tidy(off_ties(st.mask_aware_clip(own, ["session", "y", "x"], ["r", "g", "b"], "w", 2.0), "rgb"), 4)


@query(
    "mounted_transforms",
    "WITH t AS (SELECT label AS session, vec_id AS frame_id, vec_id % 11 <> 0 AS success, -(vec_id % 4) / 4.0::DOUBLE * 4 AS dx, -(vec_id % 3 - 1) / 2.0::DOUBLE * 3 AS dy, CASE WHEN label % 2 = 0 THEN 0.01 ELSE 0.0005 END::DOUBLE AS turn FROM embeddings), "
    "r AS (SELECT session, degrees(max(atan2(turn, 1.0::DOUBLE))) > 0.1 AS turned FROM t GROUP BY 1) "
    "SELECT session::BIGINT AS session, frame_id, CASE WHEN turned THEN 'robust_affine' ELSE 'integer_shift' END AS strategy, "
    f"{rounded('CASE WHEN turned THEN turn ELSE 0 END AS turn', 'CASE WHEN turned THEN dx ELSE 2 * round_even(dx / 2, 0) END AS dx', 'CASE WHEN turned THEN dy ELSE 2 * round_even(dy / 2, 0) END AS dy')} FROM t JOIN r USING (session) WHERE success",
)
def mounted_transforms(spark, sf):
    """Sessions of an equatorial mount, every other one with field rotation: each by its own rule in one plan."""
    n = F.col("frame_id")
    turn = F.when(F.col("session") % 2 == 0, F.lit(0.01)).otherwise(F.lit(0.0005))
    rows = F.array(F.array(F.lit(1.0), -turn, -(n % 4) / 4.0 * 4), F.array(turn, F.lit(1.0), -(n % 3 - 1) / 2.0 * 3), F.array(F.lit(0.0), F.lit(0.0), F.lit(1.0)))
    moves = fx.names(spark, sf).select("session", "frame_id", (n % 11 != 0).alias("success"), rows.alias("matrix"))
    got = al.mounted(moves, "eq").where("success")
    return tidy(got.select("session", "frame_id", "strategy", F.col("matrix")[1][0].alias("turn"), F.col("matrix")[0][2].alias("dx"), F.col("matrix")[1][2].alias("dy")))


_SHARES = {"p0": 0.0, "p1": 1.0, "p50": 50.0, "p99": 99.5, "p100": 100.0}


@query(
    "image_quantiles",
    "SELECT event_type, " + ", ".join(f"round(quantile_cont(value, {p / 100.0}::DOUBLE), 6) + 0.0::DOUBLE AS {n}" for n, p in _SHARES.items()) + " FROM events GROUP BY 1",
)
def image_quantiles(spark, sf):
    """Exact percentiles of large groups by refined histograms."""
    return tidy(order.exact_quantiles(fx.table(spark, sf, "events"), ["event_type"], F.col("value"), _SHARES))


@query(
    "image_noise",
    f"WITH {fx.MASTER}, m AS (SELECT session, median(v) AS middle FROM mos GROUP BY 1), d AS (SELECT session, any_value(middle) AS middle, 1.4826::DOUBLE * median(abs(v - middle)) AS noise FROM mos JOIN m USING (session) GROUP BY 1) "
    f"SELECT session::BIGINT AS session, {rounded('middle', 'noise', digits=4)} FROM d",
)
def image_noise(spark, sf):
    return tidy(order.robust_scale(fx.master(spark, sf), ["session"], F.col("v")), 4)


@query(
    "script_stretch",
    f"WITH {fx.UNIT_RGB}, l AS (SELECT *, 0.299::DOUBLE * r + 0.587::DOUBLE * g + 0.114::DOUBLE * b AS l FROM u), "
    "p AS (SELECT session, quantile_cont(l, 0.05) FILTER (WHERE l > 0) AS lo, quantile_cont(l, 0.999) FILTER (WHERE l > 0) AS hi FROM l GROUP BY 1), "
    f"s AS (SELECT session, y, x, {', '.join(f'asinh(greatest(({c} - lo) / (hi - lo), 0) / 0.1) / asinh(10.0::DOUBLE) AS {c}' for c in 'rgb')} FROM l JOIN p USING (session)), "
    "t AS (SELECT *, max(greatest(r, g, b)) OVER (PARTITION BY session) AS top FROM s) "
    f"SELECT session::BIGINT AS session, y::BIGINT AS y, x::BIGINT AS x, {rounded(*[f'least({c} / top, 1) AS {c}' for c in 'rgb'])} FROM t",
)
def script_stretch(spark, sf):
    return tidy(co.script_stretched(fx.unit_rgb(spark, sf), ["session"]))


@query(
    "joint_statistics",
    f"WITH {fx.UNIT_RGB}, n AS (SELECT label AS session, count(*) AS n FROM embeddings GROUP BY 1), v AS (SELECT session, unnest([r, g, b]) AS v FROM u), "
    "m AS (SELECT session, median(v) AS m FROM v GROUP BY 1), d AS (SELECT session, any_value(m) AS m, median(abs(v - m)) * 1.4826::DOUBLE AS s FROM v JOIN m USING (session) GROUP BY 1) "
    f"SELECT session::BIGINT AS session, n AS n_frames, {rounded('n * 15.0 AS total_exposure_s', '0.03 AS mean_clipped_fraction', 'CASE WHEN s > 0 THEN m / s ELSE 0 END AS snr_proxy')} FROM d JOIN n USING (session)",
)
def joint_statistics(spark, sf):
    n = fx.names(spark, sf).groupBy("session").agg(F.count(F.lit(1)).alias("n"))
    return tidy(st.joint_statistics(fx.unit_rgb(spark, sf).join(n, "session"), ["session"], "n", 15.0))


@query(
    "same_order",
    "SELECT label::BIGINT AS session, count(*) FILTER (WHERE vec_id % 1000 = 999) = 0 AS same FROM embeddings GROUP BY 1",
)
def same_order(spark, sf):
    own = fx.names(spark, sf)
    return tidy(fr.same_order(own, own.where("frame_id % 1000 <> 999"), ["session"]))
