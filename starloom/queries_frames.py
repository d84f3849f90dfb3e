"""Queries: discovery, lists, ledger, ranking, transforms, hashes, mosaics."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom import fixtures as fx
from starloom.functions import mosaic, text
from starloom.operators import frames as fr
from starloom.operators import quality as ql
from starloom.operators import register as rg
from starloom.operators.pixels import to_pixels
from starloom.registry import query, rounded, tidy
from starloom.schema import StackSettings

N = f"n AS (SELECT label AS session, vec_id AS frame_id, {fx.NAME_SQL} AS name FROM embeddings)"
LIGHT = "NOT starts_with(name, 'failed_') AND NOT starts_with(name, 'stacked-')"


@query("list_lights", f"WITH {N} SELECT session, name FROM n WHERE {LIGHT}")
def list_lights(spark, sf):
    return fr.lights(fx.names(spark, sf)).select("session", "name")


@query("frame_list_semi", f"WITH {N} SELECT session, name FROM n WHERE {LIGHT} AND frame_id % 3 = 0")
def frame_list_semi(spark, sf):
    own = fx.names(spark, sf)
    lines = own.where("frame_id % 3 = 0").select(F.concat(F.lit("  night/"), "name", F.lit(" ")).alias("value"))
    lines = lines.union(own.where("frame_id % 3 = 1").select(F.concat(F.lit("# "), "name")))
    return fr.listed(fr.lights(own), fr.frame_list(lines)).select("session", "name")


REASON = "CASE WHEN starts_with(name, 'failed_') THEN 'failed_prefix' ELSE 'stacked_prefix' END"


@query("rejected_ledger", f"WITH {N} SELECT name, {REASON} AS reason FROM n WHERE NOT ({LIGHT})")
def rejected_ledger(spark, sf):
    own = fx.names(spark, sf)
    return fr.rejected_files(own, fr.lights(own))


@query("rejection_counts", f"WITH {N} SELECT {REASON} AS reason, count(*) AS n FROM n WHERE NOT ({LIGHT}) GROUP BY 1")
def rejection_counts(spark, sf):
    own = fx.names(spark, sf)
    return fr.rejection_counts(fr.rejected_files(own, fr.lights(own)))


@query(
    "header_check",
    "WITH h AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 5 = 0 THEN 1920 ELSE 3840 END AS w, CASE WHEN p_partkey % 7 = 0 "
    "THEN 8 ELSE 16 END AS b FROM part) SELECT id, CASE WHEN w <> 3840 THEN 'dimensions 1920x2160, expected 3840x2160' "
    "WHEN b <> 16 THEN 'BITPIX 8, expected 16' END AS reason FROM h",
)
def header_check(spark, sf):
    part = fx.table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.when(F.col("p_partkey") % 5 == 0, 1920).otherwise(3840).alias("w"),
        F.when(F.col("p_partkey") % 7 == 0, 8).otherwise(16).alias("b"),
    )
    return part.select("id", fr.header_check(F.col("w"), F.lit(2160), F.col("b")).alias("reason"))


@query(
    "header_metadata",
    "SELECT o_orderkey AS id, trim(o_orderpriority) AS filter, CAST(o_totalprice AS DOUBLE) AS exptime, 0.0::DOUBLE AS bzero, "
    "1.0::DOUBLE AS bscale, 1::BIGINT AS xbinning, '' AS camera FROM orders",
)
def header_metadata(spark, sf):
    header = F.create_map(F.lit("FILTER"), F.concat(F.lit(" "), "o_orderpriority", F.lit(" ")), F.lit("EXPTIME"), F.col("o_totalprice").cast("string"))
    own = fx.table(spark, sf, "orders").select("o_orderkey", *fr.metadata(header))
    return own.select(F.col("o_orderkey").alias("id"), "filter", "exptime", "bzero", "bscale", F.col("xbinning").cast("long"), "camera")


CACHED = (
    "t AS (SELECT name, frame_id % 19 <> 0 AS success, CASE WHEN frame_id % 38 = 0 THEN '' ELSE 'no stars' END AS msg, "
    "CAST(frame_id % 5 - 2 AS DOUBLE) AS tx, CAST(frame_id % 3 - 1 AS DOUBLE) AS ty FROM n WHERE frame_id % 4 <> 0)"
)


def _cached(spark, sf):
    n = F.col("frame_id")
    one, zero = F.lit(1.0), F.lit(0.0)
    matrix = F.array(
        F.array(one, zero, (n % 5 - 2).cast("double")), F.array(zero, one, (n % 3 - 1).cast("double")), F.array(zero, zero, one)
    )
    own = fx.names(spark, sf).where(n % 4 != 0)
    last = own.select(
        "session", "name", "frame_id", F.lit(2).alias("at"), (n % 19 != 0).alias("success"),
        F.when(n % 38 == 0, "").otherwise("no stars").alias("error_message"), matrix.alias("matrix"),
    )
    return last


@query(
    "cached_transforms",
    f"WITH {N}, {CACHED} SELECT n.name, coalesce(t.success, false) AS success, CASE WHEN t.name IS NULL THEN 'No cached transform found' "
    "WHEN NOT t.success THEN CASE WHEN t.msg = '' THEN 'cached transform failed' ELSE t.msg END ELSE '' END AS error, "
    "CASE WHEN t.success THEN tx END AS tx, CASE WHEN t.success THEN ty END AS ty FROM n LEFT JOIN t USING (name)",
)
def cached_transforms(spark, sf):
    last = _cached(spark, sf)
    first = last.withColumns({"at": F.lit(1), "success": F.lit(False)})  # an older one of the same name loses
    got = fr.with_cached_transforms(fx.names(spark, sf), first.unionByName(last), "at")
    return got.select("name", "success", "error", F.col("matrix")[0][2].alias("tx"), F.col("matrix")[1][2].alias("ty"))


@query(
    "transforms_json_roundtrip",
    f"WITH {N}, {CACHED} SELECT name AS source_path, success, CASE WHEN success THEN '' ELSE msg END AS error_message, tx, ty, "
    "0::BIGINT AS n_matches FROM t",
)
def transforms_json_roundtrip(spark, sf):
    own = _cached(spark, sf).select(
        "session", F.col("name").alias("source_path"), F.lit("reference.fits").alias("reference_path"), "success",
        F.when(~F.col("success"), F.col("error_message")).alias("error_message"), "matrix", F.lit(None).cast("int").alias("n_matches"),
    )
    back = fr.transforms_from_json(fr.transforms_json(own, ["session"]).select("session", "json"))
    return tidy(back.select("source_path", "success", "error_message", F.col("matrix")[0][2].alias("tx"), F.col("matrix")[1][2].alias("ty"), "n_matches"))


@query(
    "transform_counts",
    f"WITH {N}, u AS (SELECT session, frame_id % 19 <> 0 AS success FROM n WHERE frame_id % 4 <> 0) SELECT session::BIGINT AS session, "
    "count(*) AS n_transforms, count(*) FILTER (WHERE success) AS n_successful FROM u GROUP BY 1",
)
def transform_counts(spark, sf):
    own = _cached(spark, sf).select(
        "session", F.col("name").alias("source_path"), F.lit("").alias("reference_path"), "success", "error_message", "matrix", F.lit(3).alias("n_matches")
    )
    return tidy(fr.transforms_json(own, ["session"]).drop("json"))


@query(
    "scaled_transforms",
    f"WITH {N}, {CACHED} SELECT name, 2 * tx AS tx, 2 * ty AS ty, 0.0::DOUBLE AS rotation, 2 * round_even(tx / 2, 0) + 0.0::DOUBLE AS even_tx, "
    "2 * round_even(ty / 2, 0) + 0.0::DOUBLE AS even_ty FROM t",
)
def scaled_transforms(spark, sf):
    own = _cached(spark, sf)
    up, even = rg.scaled_transform(F.col("matrix")), rg.rounded_transform(F.col("matrix"))
    return tidy(
        own.select("name", up[0][2].alias("tx"), up[1][2].alias("ty"), rg.rotation_degrees(F.col("matrix")).alias("rotation"), even[0][2].alias("even_tx"), even[1][2].alias("even_ty"))
    )


@query(
    "frames_hash",
    f"WITH {N} SELECT session::BIGINT AS session, substr(md5(string_agg(name, chr(10) ORDER BY name)), 1, 12) AS frames_hash FROM n GROUP BY 1",
)
def frames_hash(spark, sf):
    return tidy(fr.names_hash(fx.names(spark, sf), ["session"]))


@query("same_names", "SELECT (count(*) FILTER (WHERE vec_id % 1000003 = 0)) = 0 AS same FROM embeddings")
def same_names(spark, sf):
    own = fx.names(spark, sf)
    return fr.same_names(own, own.where("frame_id % 1000003 <> 0"))


# The hashed text, written out: the default settings as sorted JSON.
_CONFIG = '{"backend_align": "astroalign", "debayer": "none", "keep_fraction": 0.92, "maxiters": 5, "reference": "best", "sigma": 3.0}'


@query("config_hash", f"SELECT label::BIGINT AS session, substr(md5('{_CONFIG}'), 1, 12) AS config_hash, count(*) AS n FROM embeddings GROUP BY 1")
def config_hash(spark, sf):
    own = fx.names(spark, sf).groupBy("session").agg(F.count(F.lit(1)).alias("n"))
    return tidy(own.withColumn("config_hash", F.lit(StackSettings().fingerprint())))


@query(
    "safe_names",
    "SELECT page_id, regexp_replace(url, '[<>:\"/\\\\|?*]', '_', 'g') AS name FROM pages",
)
def safe_names(spark, sf):
    return fx.table(spark, sf, "pages").select("page_id", text.sanitised(F.col("url")).alias("name"))


@query(
    "durations",
    "WITH s AS (SELECT event_id, floor(value * 40) AS s, event_id * 977 AS b FROM events) SELECT event_id, CASE WHEN s < 60 THEN printf('%.1fs', s) "
    "WHEN s < 3600 THEN CAST(CAST(floor(s / 60) AS BIGINT) AS VARCHAR) || 'm ' || printf('%.0f', s - floor(s / 60) * 60) || 's' ELSE "
    "CAST(CAST(floor(s / 3600) AS BIGINT) AS VARCHAR) || 'h ' || CAST(CAST(floor((s - floor(s / 3600) * 3600) / 60) AS BIGINT) AS VARCHAR) || 'm ' || "
    "printf('%.0f', s - floor(s / 60) * 60) || 's' END AS took, CASE WHEN b < 1024 THEN printf('%.1f B', b::DOUBLE) WHEN b < 1048576 THEN "
    "printf('%.1f KB', b / 1024.0::DOUBLE) WHEN b < 1073741824 THEN printf('%.1f MB', b / 1048576.0::DOUBLE) ELSE printf('%.1f GB', b / 1073741824.0::DOUBLE) END AS size FROM s",
)
def durations(spark, sf):
    own = fx.table(spark, sf, "events").select("event_id", F.floor(F.col("value") * 40).alias("s"), (F.col("event_id") * 977).alias("b"))
    return own.select("event_id", text.duration(F.col("s")).alias("took"), text.byte_size(F.col("b")).alias("size"))


SCORE = (
    f"{fx.PX}, m1 AS (SELECT session, frame_id, v, median(v) OVER (PARTITION BY frame_id) AS med FROM px), "
    "sc AS (SELECT session, frame_id, max(med) AS background_median, median(abs(v - med)) AS background_mad, "
    "avg(CASE WHEN v >= 0.95::DOUBLE * 26000 THEN 1.0 ELSE 0.0 END) AS saturation_fraction FROM m1 GROUP BY ALL), "
    "scored AS (SELECT *, 1.4826::DOUBLE * background_mad AS noise_proxy, 1 / (greatest(1.4826::DOUBLE * background_mad, 1.0) * "
    "(1 + 10 * saturation_fraction) * (1 + background_median / 26000)) AS composite_score FROM sc)"
)


def _scores(spark, sf):
    return ql.scored(fx.frames(spark, sf), ["session", "frame_id"], full_scale=26000.0)


@query(
    "quality_score",
    f"WITH {SCORE} SELECT session::BIGINT AS session, frame_id, {rounded('background_median', 'background_mad', 'noise_proxy', 'saturation_fraction')}, "
    f"0::BIGINT AS n_stars, {rounded('composite_score', digits=9)} FROM scored",
)
def quality_score(spark, sf):
    return tidy(_scores(spark, sf), 9).withColumns({c: F.round(c, 6) for c in ("background_median", "background_mad", "noise_proxy", "saturation_fraction")})


@query(
    "grouped_mad",
    "WITH m AS (SELECT event_type, value, median(value) OVER (PARTITION BY event_type) AS med FROM events) SELECT event_type, "
    f"{rounded('max(med) AS median', 'median(abs(value - med)) AS mad', '1.4826::DOUBLE * median(abs(value - med)) AS noise')} FROM m GROUP BY 1",
)
def grouped_mad(spark, sf):
    return tidy(ql.grouped_mad(fx.table(spark, sf, "events"), ["event_type"], "value"))


RANKED = f"{SCORE}, rk AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY composite_score DESC, frame_id) AS rank, count(*) OVER (PARTITION BY session) AS n FROM scored)"


@query("rank_frames", f"WITH {RANKED} SELECT session::BIGINT AS session, frame_id, rank FROM rk")
def rank_frames(spark, sf):
    return tidy(ql.ranked(_scores(spark, sf), ["session"], "frame_id").select("session", "frame_id", "rank"))


@query("select_frames", f"WITH {RANKED} SELECT session::BIGINT AS session, frame_id, rank <= greatest(1, floor(n * 0.92::DOUBLE)) AS kept FROM rk")
def select_frames(spark, sf):
    return tidy(ql.selected(_scores(spark, sf), ["session"], "frame_id").select("session", "frame_id", "kept"))


@query("reference_frames", f"WITH {RANKED}, f AS (SELECT session, min(frame_id) AS first FROM rk GROUP BY 1) SELECT rk.session::BIGINT AS session, frame_id AS best, first FROM rk JOIN f USING (session) WHERE rank = 1")
def reference_frames(spark, sf):
    s = _scores(spark, sf)
    best = ql.reference_frame(s, ["session"], "frame_id").withColumnRenamed("reference", "best")
    return tidy(best.join(ql.reference_frame(s, ["session"], "frame_id", "first").withColumnRenamed("reference", "first"), "session"))


@query("frames_to_align", f"WITH {RANKED}, b AS (SELECT session, frame_id AS reference FROM rk WHERE rank = 1) SELECT rk.session::BIGINT AS session, frame_id, reference FROM rk JOIN b USING (session) WHERE frame_id <> reference")
def frames_to_align(spark, sf):
    s = _scores(spark, sf)
    return tidy(fr.without_reference(s.select("session", "frame_id"), ql.reference_frame(s, ["session"], "frame_id"), ["session"], "frame_id"))


@query(
    "best_and_worst",
    f"WITH {RANKED} SELECT session::BIGINT AS session, frame_id, rank, CASE WHEN rank <= 5 THEN 'top' ELSE 'bottom' END AS place FROM rk WHERE rank <= 5 "
    "UNION ALL SELECT session::BIGINT, frame_id, rank, 'bottom' FROM rk WHERE n > 5 AND rank > n - 5 AND rank <= 5 UNION ALL "
    "SELECT session::BIGINT, frame_id, rank, 'bottom' FROM rk WHERE n > 5 AND rank > n - 5 AND rank > 5",
)
def best_and_worst(spark, sf):
    return tidy(ql.ends(_scores(spark, sf), ["session"], "frame_id").select("session", "frame_id", "rank", "place"))


@query(
    "systematic_sample",
    "WITH r AS (SELECT label AS session, vec_id AS frame_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS i, count(*) OVER (PARTITION BY label) AS n "
    "FROM embeddings) SELECT DISTINCT session::BIGINT AS session, frame_id FROM r, range(5) k(k) WHERE i = floor(k * (n - 1) / 4)",
)
def systematic_sample(spark, sf):
    return tidy(ql.systematic_sample(fx.names(spark, sf).select("session", "frame_id"), ["session"], "frame_id"))


@query(
    "failure_runs",
    "WITH r AS (SELECT label AS session, vec_id AS i, vec_id % 7 < 4 AS ok FROM embeddings), g AS (SELECT *, count(*) FILTER (WHERE ok) OVER "
    "(PARTITION BY session ORDER BY i) AS k FROM r), u AS (SELECT *, CASE WHEN ok THEN 0 ELSE count(*) FILTER (WHERE NOT ok) OVER (PARTITION BY session, k ORDER BY i "
    "ROWS UNBOUNDED PRECEDING) END AS run FROM g) SELECT session::BIGINT AS session, count(*) FILTER (WHERE NOT ok) AS n_failed, max(run)::BIGINT AS longest_run, "
    "min(i) FILTER (WHERE run >= 3) AS aborted_at FROM u GROUP BY 1",
)
def failure_runs(spark, sf):
    own = fx.names(spark, sf).select("session", F.col("frame_id").alias("i"), (F.col("frame_id") % 7 < 4).alias("ok"))
    return tidy(ql.failure_runs(own, ["session"], "i", "ok", 3))


BIL = fx.bilinear_sql("px", "session, frame_id", "bl")


@query("bilinear_debayer", f"WITH {fx.PX}, {BIL} SELECT frame_id, y, x, {rounded('r', 'g', 'b')} FROM bl")
def bilinear_debayer(spark, sf):
    return tidy(fx.rgb_frames(spark, sf).select("frame_id", "y", "x", "r", "g", "b"))


HALF = (
    "hp AS (SELECT session, frame_id, y // 2 AS y, x // 2 AS x, max(v) FILTER (WHERE y % 2 = 0 AND x % 2 = 0) AS r, max(v) FILTER (WHERE y % 2 = 0 AND x % 2 = 1) AS g1, "
    "max(v) FILTER (WHERE y % 2 = 1 AND x % 2 = 0) AS g2, max(v) FILTER (WHERE y % 2 = 1 AND x % 2 = 1) AS b FROM px GROUP BY ALL)"
)


def _planes(spark, sf):
    h, w, d = F.col("height"), F.col("width"), F.col("data")
    return fx.frames(spark, sf).select("session", "frame_id", "height", "width", "data", *[mosaic.plane(d, h, w, p).alias(p) for p in mosaic.PLANES])


@query("superpixel_debayer", f"WITH {fx.PX}, {HALF} SELECT frame_id, y::BIGINT AS y, x::BIGINT AS x, r, (g1 + g2) / 2 AS g, b FROM hp")
def superpixel_debayer(spark, sf):
    got = to_pixels(_planes(spark, sf).drop("data"), ["frame_id"], {p: p for p in mosaic.PLANES}, fx.SIDE // 2)
    return tidy(got.select("frame_id", "y", "x", "r", ((F.col("g1") + F.col("g2")) / 2).alias("g"), "b"))


@query("planes_roundtrip", f"WITH {fx.PX} SELECT frame_id, pos, v FROM px")
def planes_roundtrip(spark, sf):
    half = F.lit(fx.SIDE // 2)
    back = mosaic.from_planes(*[F.col(p) for p in mosaic.PLANES], half, half)
    return tidy(to_pixels(_planes(spark, sf).select("frame_id", "width", back.alias("m")), ["frame_id"], {"v": "m"}).select("frame_id", "pos", "v"))


@query(
    "mosaic_luminance",
    f"WITH {fx.PX}, {HALF} SELECT frame_id, y::BIGINT AS y, x::BIGINT AS x, {rounded('(r + g1 + g2 + b) / 4 AS mean', '0.299::DOUBLE * r + 0.587::DOUBLE * ((g1 + g2) / 2) + 0.114::DOUBLE * b AS weighted', '(g1 + g2) / 2 AS green')} FROM hp",
)
def mosaic_luminance(spark, sf):
    h, w, d = F.col("height"), F.col("width"), F.col("data")
    kinds = {"mean": "superpixel", "weighted": "weighted", "green": "green"}
    own = fx.frames(spark, sf).select("frame_id", *[mosaic.luminance(d, h, w, m).alias(n) for n, m in kinds.items()])
    return tidy(to_pixels(own, ["frame_id"], {n: n for n in kinds}, fx.SIDE // 2).drop("pos"))


@query("session_summary", f"WITH {SCORE} SELECT session::BIGINT AS session, count(*) AS n_frames, {rounded('median(background_median) AS sky', 'max(composite_score) AS best')} FROM scored GROUP BY 1")
def session_summary(spark, sf):
    return tidy(_scores(spark, sf).groupBy("session").agg(F.count(F.lit(1)).alias("n_frames"), F.median("background_median").alias("sky"), F.max("composite_score").alias("best")))
