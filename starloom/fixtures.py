"""Sessions of small mosaics out of the given tables, so that every query's work grows with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import mosaic
from starloom.operators.pixels import computed_once, to_arrays, to_pixels

SIDE = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """session (label), frame_id (vec_id), height, width, data: whole-number mosaics of 8 x 8 pixels."""
    adu = F.transform("embedding", lambda v: F.floor((v.cast("double") + 1) * 20000).cast("double"))
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("label").alias("session"), F.col("vec_id").alias("frame_id"), F.lit(SIDE).alias("height"), F.lit(SIDE).alias("width"), adu.alias("data")
    )
    return computed_once(rows, "data")


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """session, frame_id, pos, y, x, v."""
    return to_pixels(frames(spark, sf_dir), ["session", "frame_id"], {"v": "data"})


def spiked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pixels with an outlier in about one of a hundred, and a weight that is 0 in one of eight."""
    hit = (F.col("frame_id") * 7 + F.col("pos")) % 101 == 0
    off = (F.col("x") + F.col("y") + F.col("frame_id")) % 8 == 0
    return pixels(spark, sf_dir).withColumns(
        {"v": F.when(hit, F.col("v") + 30000).otherwise(F.col("v")), "w": F.when(off, 0.0).otherwise(1.0)}
    )


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """session, frame_id, name: file names, some marked failed or stacked."""
    n = F.col("vec_id")
    prefix = F.when(n % 17 == 0, "failed_").when(n % 23 == 0, "stacked-").otherwise("")
    name = F.concat(prefix, F.lpad(n.cast("string"), 6, "0"), F.lit(".fits"))
    return table(spark, sf_dir, "embeddings").select(F.col("label").alias("session"), n.alias("frame_id"), name.alias("name"))


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """session, y, x, v: plain mean stack."""
    return pixels(spark, sf_dir).groupBy("session", "y", "x").agg((F.sum("v") / F.count("v")).alias("v"))


def rgb_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """session, frame_id, y, x, r, g, b of every frame."""
    d = frames(spark, sf_dir)
    planes = [mosaic.bilinear(F.col("data"), F.col("height"), F.col("width"), c).alias(c) for c in "rgb"]
    return to_pixels(d.select("session", "frame_id", "width", *planes), ["session", "frame_id"], {c: c for c in "rgb"})


def rgb_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """session, y, x, r, g, b: the demosaiced mean stack."""
    m = to_arrays(master(spark, sf_dir), ["session"], ["v"])
    planes = [mosaic.bilinear(F.col("v"), F.col("height"), F.col("width"), c).alias(c) for c in "rgb"]
    return to_pixels(m.select("session", "width", *planes), ["session"], {c: c for c in "rgb"}).drop("pos")


def unit_rgb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The master in [0, 1): over 65536."""
    return rgb_master(spark, sf_dir).withColumns({c: F.col(c) / 65536.0 for c in "rgb"})


NAME_SQL = (
    "(CASE WHEN vec_id % 17 = 0 THEN 'failed_' WHEN vec_id % 23 = 0 THEN 'stacked-' ELSE '' END || "
    "lpad(CAST(vec_id AS VARCHAR), 6, '0') || '.fits')"
)
PX = (
    "px AS (SELECT label AS session, vec_id AS frame_id, CAST(pos AS BIGINT) AS pos, CAST(pos // 8 AS BIGINT) AS y, "
    "CAST(pos % 8 AS BIGINT) AS x, floor((CAST(embedding[pos + 1] AS DOUBLE) + 1) * 20000) AS v "
    "FROM embeddings, range(64) t(pos))"
)
SPIKED = (
    f"{PX}, sp AS (SELECT session, frame_id, pos, y, x, CASE WHEN (frame_id * 7 + pos) % 101 = 0 THEN v + 30000 ELSE v END "
    "AS v, CASE WHEN (x + y + frame_id) % 8 = 0 THEN 0.0 ELSE 1.0 END::DOUBLE AS w FROM px)"
)
MASTER = f"{PX}, mos AS (SELECT session, y, x, sum(v) / count(*) AS v FROM px GROUP BY ALL)"


def bilinear_sql(source: str, keys: str, out: str) -> str:
    """CTE out (keys, y, x, r, g, b) from source (keys, y, x, v)."""
    on = " AND ".join(f"a.{k} = b.{k}" for k in keys.split(", "))
    own = ", ".join(f"a.{k}" for k in keys.split(", "))
    colour = "CASE WHEN y % 2 = 0 AND x % 2 = 0 THEN 'r' WHEN y % 2 = 1 AND x % 2 = 1 THEN 'b' ELSE 'g' END"
    picks = ", ".join(f"CASE WHEN a.c = '{c}' THEN a.v ELSE coalesce(avg(b.v) FILTER (WHERE b.c = '{c}'), 0) END AS {c}" for c in "rgb")
    return (
        f"col_{out} AS (SELECT *, {colour} AS c FROM {source}), {out} AS (SELECT {own}, a.y, a.x, {picks} FROM col_{out} a "
        f"JOIN col_{out} b ON {on} AND b.y BETWEEN a.y - 1 AND a.y + 1 AND b.x BETWEEN a.x - 1 AND a.x + 1 "
        f"GROUP BY {own}, a.y, a.x, a.c, a.v)"
    )


RGB_MASTER = f"{MASTER}, {bilinear_sql('mos', 'session', 'rgbm')}"
UNIT_RGB = f"{RGB_MASTER}, u AS (SELECT session, y, x, r / 65536.0::DOUBLE AS r, g / 65536.0::DOUBLE AS g, b / 65536.0::DOUBLE AS b FROM rgbm)"
