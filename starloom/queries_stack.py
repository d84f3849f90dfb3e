"""Queries: clipping variants, means, statistics, coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom import fixtures as fx
from starloom.operators import stack as st
from starloom.operators import stencil as sc
from starloom.operators.pixels import tiles, to_pixels
from starloom.registry import query, rounded, tidy

KEYS = ["session", "y", "x"]


def clip_sql(source: str, keys: str, values: list[str], sigma: float, rounds: int, centre: str, valid: str | None = None) -> str:
    """CTEs c0 .. c<rounds> with the values clipped round by round."""
    start = ", ".join(f"CASE WHEN {valid or 'true'} THEN {v} END AS {v}" for v in values)
    out = [f"c0 AS (SELECT * REPLACE ({start}) FROM {source})"]
    middle = {"median": "median", "mean": "avg"}[centre]
    for i in range(rounds):
        w = f"OVER (PARTITION BY {keys})"
        marks = ", ".join(f"{middle}({v}) {w} AS m_{v}, stddev_pop({v}) {w} AS s_{v}" for v in values)
        keep = ", ".join(f"CASE WHEN abs({v} - m_{v}) <= {sigma}::DOUBLE * s_{v} THEN {v} END AS {v}" for v in values)
        drop = ", ".join(f"m_{v}, s_{v}" for v in values)
        out.append(f"w{i} AS (SELECT *, {marks} FROM c{i}), c{i + 1} AS (SELECT * EXCLUDE ({drop}) REPLACE ({keep}) FROM w{i})")
    return ", ".join(out)


@query(
    "sigma_clip_median",
    f"WITH {fx.SPIKED}, {clip_sql('sp', 'session, y, x', ['v'], 3, 5, 'median')} SELECT session::BIGINT AS session, y, x, {rounded('avg(v) AS v')}, count(*) AS n, "
    "count(v) AS n_kept FROM c5 GROUP BY ALL",
)
def sigma_clip_median(spark, sf):
    return tidy(st.sigma_clip_mean(fx.spiked(spark, sf), KEYS, ["v"]))


@query(
    "sigma_clip_mean_centre",
    f"WITH {fx.SPIKED}, {clip_sql('sp', 'session, y, x', ['v'], 3, 5, 'mean')} SELECT session::BIGINT AS session, y, x, {rounded('avg(v) AS v')}, "
    "count(*) - count(v) AS n_clipped FROM c5 GROUP BY ALL",
)
def sigma_clip_mean_centre(spark, sf):
    got = st.sigma_clip_mean(fx.spiked(spark, sf), KEYS, ["v"], centre="mean")
    return tidy(got.select(*KEYS, "v", (F.col("n") - F.col("n_kept")).alias("n_clipped")))


RGB_SPIKED = f"{fx.SPIKED}, {fx.bilinear_sql('(SELECT session, frame_id, y, x, v FROM px)', 'session, frame_id', 'bl')}, rs AS (SELECT bl.* REPLACE (CASE WHEN (frame_id * 7 + y * 8 + x) % 101 = 0 THEN r + 30000 ELSE r END AS r), CASE WHEN (x + y + frame_id) % 8 = 0 THEN 0.0 ELSE 1.0 END::DOUBLE AS w FROM bl)"


def _rgb_spiked(spark, sf):
    hit = (F.col("frame_id") * 7 + F.col("pos")) % 101 == 0
    off = (F.col("x") + F.col("y") + F.col("frame_id")) % 8 == 0
    return fx.rgb_frames(spark, sf).withColumns(
        {"r": F.when(hit, F.col("r") + 30000).otherwise(F.col("r")), "w": F.when(off, 0.0).otherwise(1.0)}
    )


@query(
    "sigma_clip_rgb",
    f"WITH {RGB_SPIKED}, {clip_sql('rs', 'session, y, x', ['r', 'g', 'b'], 3, 3, 'median')} SELECT session::BIGINT AS session, y, x, "
    f"{rounded('avg(r) AS r', 'avg(g) AS g', 'avg(b) AS b', digits=4)}, least(count(r), count(g), count(b)) AS n_kept FROM c3 GROUP BY ALL",
)
def sigma_clip_rgb(spark, sf):
    return tidy(st.sigma_clip_mean(_rgb_spiked(spark, sf), KEYS, ["r", "g", "b"], rounds=3).drop("n"), 4)


@query(
    "mask_aware_clip",
    f"WITH {fx.SPIKED}, {clip_sql('sp', 'session, y, x', ['v'], 3, 5, 'mean', 'w > 0.5')} SELECT session::BIGINT AS session, y, x, "
    f"{rounded('CASE WHEN sum(w) FILTER (WHERE v IS NOT NULL) > 1e-6 THEN sum(v * w) / sum(w) FILTER (WHERE v IS NOT NULL) ELSE 0 END AS v')}, count(v) AS coverage FROM c5 GROUP BY ALL",
)
def mask_aware_clip(spark, sf):
    return tidy(st.mask_aware_clip(fx.spiked(spark, sf), KEYS, ["v"], "w"))


def two_pass_sql(source: str, values: list[str], valid: str, keep: str, always: str = "false") -> str:
    marks = ", ".join(f"avg({v}) AS m_{v}, coalesce(stddev_samp({v}), 0) AS s_{v}" for v in values)
    kept = " AND ".join(keep.format(v=v) for v in values)
    means = ", ".join(f"coalesce(avg(p.{v}) FILTER (WHERE ok), 0) AS {v}" for v in values)
    return (
        f"mo AS (SELECT session, y, x, {marks} FROM {source} WHERE {valid} GROUP BY ALL), "
        f"p AS (SELECT s.*, coalesce({valid} AND (({kept}) OR {always}), false) AS ok FROM {source} s LEFT JOIN mo USING (session, y, x)), "
        f"res AS (SELECT session, y, x, {means}, count(*) FILTER (WHERE ok) AS coverage FROM p GROUP BY ALL)"
    )


@query(
    "two_pass_clip",
    f"WITH {RGB_SPIKED}, {two_pass_sql('rs', ['r', 'g', 'b'], 'w > 0.5', 'abs({v} - m_{v}) <= 3 * s_{v} + 1e-6')} SELECT session::BIGINT AS session, y, x, "
    f"{rounded('r', 'g', 'b', digits=4)}, coverage FROM res",
)
def two_pass_clip(spark, sf):
    return tidy(st.two_pass_clip(_rgb_spiked(spark, sf), KEYS, ["r", "g", "b"], "w"), 4)


PLANES = (
    f"{fx.SPIKED}, pl AS (SELECT session, frame_id, y // 2 AS y, x // 2 AS x, max(v) FILTER (WHERE y % 2 = 0 AND x % 2 = 0) AS r, "
    "max(v) FILTER (WHERE y % 2 = 0 AND x % 2 = 1) AS g1, max(v) FILTER (WHERE y % 2 = 1 AND x % 2 = 0) AS g2, max(v) FILTER (WHERE y % 2 = 1 AND x % 2 = 1) AS b "
    "FROM sp GROUP BY ALL)"
)


@query(
    "plane_stack",
    f"WITH {PLANES}, {two_pass_sql('pl', ['r', 'g1', 'g2', 'b'], 'true', 'abs({v} - m_{v}) / (s_{v} + 1e-10) < 3', 'frame_id % 50 = 0')}, "
    "top AS (SELECT *, floor(0.5 * max(coverage) OVER (PARTITION BY session)) AS least FROM res) SELECT session::BIGINT AS session, y::BIGINT AS y, x::BIGINT AS x, "
    f"{rounded(*[f'CASE WHEN coverage < least THEN 0 ELSE {c} END AS {c}' for c in ('r', 'g1', 'g2', 'b')])}, coverage FROM top",
)
def plane_stack(spark, sf):
    side = fx.SIDE // 2
    own = fx.spiked(spark, sf).withColumn("p", F.when(F.col("y") % 2 == 0, F.when(F.col("x") % 2 == 0, "r").otherwise("g1")).otherwise(F.when(F.col("x") % 2 == 0, "g2").otherwise("b")))
    half = own.groupBy("session", "frame_id", F.floor(F.col("y") / 2).alias("y"), F.floor(F.col("x") / 2).alias("x")).agg(
        *[F.max(F.when(F.col("p") == c, F.col("v"))).alias(c) for c in ("r", "g1", "g2", "b")]
    ).where(F.col("x") < side)
    got = st.two_pass_clip(half, KEYS, ["r", "g1", "g2", "b"], strict=True, always=F.col("frame_id") % 50 == 0)
    return tidy(st.covered_only(got, ["session"], ["r", "g1", "g2", "b"]))


@query("mask_aware_mean", f"WITH {fx.SPIKED} SELECT session::BIGINT AS session, y, x, {rounded('coalesce(sum(v * w) / nullif(sum(w), 0), 0) AS v')}, floor(sum(w))::BIGINT AS coverage FROM sp GROUP BY ALL")
def mask_aware_mean(spark, sf):
    return tidy(st.mask_aware_mean(fx.spiked(spark, sf), KEYS, ["v"], "w"))


@query("weighted_mean", f"WITH {fx.SPIKED} SELECT session::BIGINT AS session, y, x, {rounded('sum(v * (frame_id % 9 + 1)) / sum(frame_id % 9 + 1) AS v')} FROM sp GROUP BY ALL")
def weighted_mean(spark, sf):
    weights = fx.names(spark, sf).select("frame_id", (F.col("frame_id") % 9 + 1).cast("double").alias("weight"))
    return tidy(st.weighted_mean(fx.spiked(spark, sf), weights, "frame_id", KEYS, "v"))


@query("median_stack", f"WITH {fx.SPIKED} SELECT session::BIGINT AS session, y, x, {rounded('median(v) AS v')} FROM sp GROUP BY ALL")
def median_stack(spark, sf):
    return tidy(st.median_stack(fx.spiked(spark, sf), KEYS, "v"))


STATS = (
    "k AS (SELECT session, y, x, avg(v) AS v, count(v) AS n_kept, count(*) AS n FROM c5 GROUP BY ALL), d AS (SELECT *, median(v) OVER (PARTITION BY session) AS med FROM k) "
    f"SELECT session::BIGINT AS session, max(n) AS n_frames, {rounded('max(n) * 15.0 AS total_exposure_s', '1 - avg(n_kept) / max(n) AS mean_clipped_fraction', 'median(v) / nullif(1.4826 * median(abs(v - med)), 0) AS snr_proxy')} FROM d GROUP BY 1"
)


@query("stack_statistics", f"WITH {fx.SPIKED}, {clip_sql('sp', 'session, y, x', ['v'], 3, 5, 'median')}, {STATS}")
def stack_statistics(spark, sf):
    return tidy(st.stack_statistics(st.sigma_clip_mean(fx.spiked(spark, sf), KEYS, ["v"]), ["session"], "v", "n", 15.0))


@query("stack_statistics_rgb", f"WITH {RGB_SPIKED}, {clip_sql('(SELECT session, y, x, g AS v FROM rs)', 'session, y, x', ['v'], 3, 5, 'median')}, {STATS}")
def stack_statistics_rgb(spark, sf):
    return tidy(st.stack_statistics(st.sigma_clip_mean(_rgb_spiked(spark, sf), KEYS, ["g"]), ["session"], "g", "n", 15.0))


COVER = f"{fx.SPIKED}, cov AS (SELECT session, y, x, sum(v) / count(*) AS v, count(*) FILTER (WHERE (frame_id % 8 < 2 + 2 * least(y, x, 7 - y, 7 - x))) AS coverage FROM sp GROUP BY ALL), mx AS (SELECT *, max(coverage) OVER (PARTITION BY session) AS most FROM cov), box AS (SELECT session, min(y) AS y0, max(y) + 1 AS y1, min(x) AS x0, max(x) + 1 AS x1 FROM mx WHERE most <= 0 OR coverage >= 0.8 * most GROUP BY 1)"


def _covered(spark, sf):
    edge = F.least("y", "x", 7 - F.col("y"), 7 - F.col("x"))
    own = fx.spiked(spark, sf).withColumn("_in", F.col("frame_id") % 8 < 2 + 2 * edge)
    return own.groupBy(*KEYS).agg((F.sum("v") / F.count(F.lit(1))).alias("v"), F.count_if("_in").alias("coverage"))


@query("coverage_bounds", f"WITH {COVER} SELECT session::BIGINT AS session, y0, y1, x0, x1 FROM box")
def coverage_bounds(spark, sf):
    return tidy(st.coverage_bounds(_covered(spark, sf), ["session"]))


@query("crop_to_coverage", f"WITH {COVER} SELECT session::BIGINT AS session, y - y0 AS y, x - x0 AS x, {rounded('v')}, coverage FROM cov JOIN box USING (session) WHERE y >= y0 AND y < y1 AND x >= x0 AND x < x1")
def crop_to_coverage(spark, sf):
    return tidy(st.cropped(_covered(spark, sf), ["session"]))


@query(
    "feathered_masks",
    f"WITH {fx.SPIKED}, m AS (SELECT frame_id, y, x, w FROM sp), d AS (SELECT a.frame_id, a.y, a.x, a.w, min(sqrt(((a.y - b.y) * (a.y - b.y) + (a.x - b.x) * (a.x - b.x))::DOUBLE)) AS d "
    f"FROM m a LEFT JOIN m b ON a.frame_id = b.frame_id AND b.w <= 0.5 GROUP BY ALL) SELECT frame_id, y, x, {rounded('CASE WHEN w <= 0.5 THEN 0 ELSE coalesce(least(1.0, d / 3), 1.0) END AS w')} FROM d",
)
def feathered_masks(spark, sf):
    return tidy(sc.feathered(fx.spiked(spark, sf), ["frame_id"], "w", 3))


@query(
    "partial_moments",
    f"WITH {fx.PX} SELECT session::BIGINT AS session, y, x, count(*) AS n, {rounded('avg(v) AS mean', digits=4)}, {rounded('var_samp(v) AS variance', digits=2)} FROM px GROUP BY ALL",
)
def partial_moments(spark, sf):
    cut = tiles(fx.frames(spark, sf), ["session", "frame_id"], "data", rows=4, columns=4)
    got = st.partial_moments(cut, ["session", "ty", "tx"])
    flat = to_pixels(got.withColumn("width", F.lit(4)), ["session", "ty", "tx", "n"], {"mean": "mean", "m2": "m2"})
    return tidy(
        flat.select(
            "session", (F.col("ty") * 4 + F.col("y")).alias("y"), (F.col("tx") * 4 + F.col("x")).alias("x"), "n", F.round("mean", 4).alias("mean"),
            F.round(F.col("m2") / F.nullif(F.col("n") - 1, F.lit(0)), 2).alias("variance"),
        )
    )


@query(
    "clip_prices",
    f"WITH {clip_sql('(SELECT l_partkey AS k, round(l_extendedprice * 100) AS v FROM lineitem)', 'k', ['v'], 2, 3, 'median')} SELECT k, {rounded('avg(v) AS v', digits=4)}, count(*) AS n, count(v) AS n_kept FROM c3 GROUP BY ALL",
)
def clip_prices(spark, sf):
    own = fx.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("k"), F.rint(F.col("l_extendedprice") * 100).alias("v"))
    return tidy(st.sigma_clip_mean(own, ["k"], ["v"], 2.0, 3), 4)


@query(
    "clip_events",
    f"WITH {clip_sql('(SELECT user_id, event_type, round(value * 100) AS v FROM events)', 'user_id, event_type', ['v'], 2, 3, 'median')} SELECT user_id, event_type, {rounded('avg(v) AS v', digits=4)}, count(*) AS n, "
    "count(v) AS n_kept FROM c3 GROUP BY ALL",
)
def clip_events(spark, sf):
    own = fx.table(spark, sf, "events").select("user_id", "event_type", F.rint(F.col("value") * 100).alias("v"))
    return tidy(st.sigma_clip_mean(own, ["user_id", "event_type"], ["v"], 2.0, 3), 4)
