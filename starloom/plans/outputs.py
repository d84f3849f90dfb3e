"""What a session leaves in a folder: masters as FITS, display images as PNG and TIFF, aligned frames, reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.text import sanitised
from starloom.operators.pixels import to_arrays
from starloom.plans.align import SESSION, Planes, ProcessedSession, planes_of, warped_planes
from starloom.plans.report import run_metadata
from starloom.sources.fits_source import FitsSource
from starloom.sources.pictures import encoded, write_files


def masters(rgb: DataFrame, kind: str, header: DataFrame | None = None) -> DataFrame:
    """name, height, width, planes, data, header of the pixel rows' images (r, g, b), one file a session.

    header gives session and a column per keyword.
    """
    images = to_arrays(rgb, SESSION, ["r", "g", "b"])
    if header is not None:
        words = [c for c in header.columns if c not in SESSION]
        pairs = F.map_from_arrays(F.array(*[F.lit(w.upper()[:8]) for w in words]), F.array(*[F.col(w).cast("string") for w in words]))
        images = images.join(header.select(*SESSION, F.map_filter(pairs, lambda _, v: v.isNotNull()).alias("header")), SESSION, "left")
    else:
        images = images.withColumn("header", F.create_map().cast("map<string,string>"))
    name = F.concat(sanitised(F.col("session").cast("string")), F.lit(f"_{kind}.fits"))
    return images.select(name.alias("name"), "height", "width", F.lit(3).alias("planes"), F.concat("r", "g", "b").alias("data"), "header")


def write_session(result: ProcessedSession, folder: str) -> dict[str, str]:
    """Linear and calibrated masters as FITS, the stretched image as PNG (8 bits) and TIFF (16 bits), statistics as JSON.

    One file of each a session, named by it; output -> folder. The FITS files of a kind appear when all are written, a
    picture when it is whole; existing ones are replaced.
    """
    spark = result.linear.sparkSession
    spark.dataSource.register(FitsSource)
    numbers = result.statistics.select(*SESSION, F.col("n_frames").alias("nframes"), F.col("total_exposure_s").alias("exptime"))
    out = {}
    for kind, rgb in (("linear", result.linear), ("calibrated", result.calibrated)):
        out[kind] = f"{folder}/{kind}"
        masters(rgb.select(*SESSION, "y", "x", "r", "g", "b"), kind, numbers).write.format("fits").mode("overwrite").save(out[kind])
    shown = to_arrays(result.stretched.select(*SESSION, "y", "x", "r", "g", "b"), SESSION, ["r", "g", "b"])
    for kind, end in (("png", "png"), ("tiff", "tif")):
        out[kind] = f"{folder}/{kind}"
        write_files(encoded(shown, SESSION, ["r", "g", "b"], kind), out[kind], F.concat(sanitised(F.col("session").cast("string")), F.lit(f".{end}")))
    out["report"] = f"{folder}/report"
    result.statistics.withColumns(run_metadata()).write.mode("overwrite").json(out["report"])
    return out


def write_aligned(frames: DataFrame, transforms: DataFrame, folder: str, kind: str | Planes = "superpixel", order: int = 1, each: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Every aligned frame as a FITS file of its planes and mask, named by session and frame.

    Files are named by (session, frame) and appear when the write is whole: a task that runs twice gives each once. each
    may change or filter the rows (session, frame_id, height, width, the planes, mask) before they are written.
    """
    frames.sparkSession.dataSource.register(FitsSource)
    names, _ = planes_of(kind)
    planes = warped_planes(frames, transforms, kind, order)
    planes = planes if each is None else each(planes)
    name = F.concat(sanitised(F.col("session").cast("string")), F.lit("_"), sanitised(F.col("frame_id").cast("string")), F.lit(".fits"))
    rows = planes.select(name.alias("name"), "height", "width", F.lit(len(names)).alias("planes"), F.concat(*names).alias("data"), F.transform("mask", lambda m: m.cast("int")).alias("coverage"))
    rows.write.format("fits").mode("append").save(folder)
