"""Sessions of frames: discovery, frame lists, the rejection ledger, transforms, hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.schema import FAILED_PREFIX, NATIVE_BITPIX, NATIVE_HEIGHT, NATIVE_WIDTH, STACKED_PREFIX, TRANSFORM


def discovered(spark: SparkSession, session_path: str) -> DataFrame:
    """path, name, length, modificationTime of the FITS files of a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.fits").load(session_path)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length", "modificationTime")


def lights(files: DataFrame, name: str = "name", exclude_failed: bool = True, exclude_stacked: bool = True) -> DataFrame:
    """The light frames: without files that the device marked failed or made by stacking. A null name is no light."""
    out = files.where(F.col(name).isNotNull())
    if exclude_failed:
        out = out.where(~F.col(name).startswith(FAILED_PREFIX))
    return out.where(~F.col(name).startswith(STACKED_PREFIX)) if exclude_stacked else out


def frame_list(lines: DataFrame, line: str = "value") -> DataFrame:
    """name of each line of a frame list: trimmed, the last part of a path; blank and # lines are left out."""
    own = F.trim(F.col(line))
    return (
        lines.where((own != "") & ~own.startswith("#")).select(F.element_at(F.split(own, "/"), -1).alias("name")).distinct()
    )


def listed(frames: DataFrame, names: DataFrame) -> DataFrame:
    """The frames that a list names; all of them if the list is empty."""
    some = names.agg((F.count(F.lit(1)) > 0).alias("_some"))
    marked = frames.join(names.select("name").withColumn("_listed", F.lit(True)), "name", "left").crossJoin(F.broadcast(some))
    return marked.where(F.col("_listed").isNotNull() | ~F.col("_some")).drop("_listed", "_some")


def rejected_files(files: DataFrame, kept: DataFrame, name: str = "name") -> DataFrame:
    """name, reason of the files that are no lights."""
    reason = F.when(F.col(name).startswith(FAILED_PREFIX), "failed_prefix").when(
        F.col(name).startswith(STACKED_PREFIX), "stacked_prefix"
    )
    return files.join(kept.select(name), name, "left_anti").select(name, reason.alias("reason")).where("reason is not null")


def rejection_counts(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).orderBy("reason")


def header_check(
    width: Column, height: Column, bitpix: Column, want: tuple[int, int, int] = (NATIVE_WIDTH, NATIVE_HEIGHT, NATIVE_BITPIX)
) -> Column:
    """Why a header does not fit (dimensions first, then BITPIX), or null."""
    size = F.concat_ws("x", width.cast("string"), height.cast("string"))
    return F.when(
        ~(F.coalesce((width == want[0]) & (height == want[1]), F.lit(False))),
        F.concat(F.lit("dimensions "), size, F.lit(f", expected {want[0]}x{want[1]}")),
    ).when(
        ~F.coalesce(bitpix == want[2], F.lit(False)),
        F.concat(F.lit("BITPIX "), F.coalesce(bitpix.cast("string"), F.lit("missing")), F.lit(f", expected {want[2]}")),
    )


# FITS keys read as metadata, by the name they get.
METADATA_KEYS = {
    "naxis1": "NAXIS1", "naxis2": "NAXIS2", "bitpix": "BITPIX", "bzero": "BZERO", "bscale": "BSCALE",
    "exptime": "EXPTIME", "gain": "GAIN", "filter": "FILTER", "camera": "CAMERA", "bayerpat": "BAYERPAT",
    "ra": "RA", "dec": "DEC", "object": "OBJECT", "date_obs": "DATE-OBS", "det_temp": "DET-TEMP",
    "telescope": "TELESCOP", "instrument": "INSTRUME", "xbinning": "XBINNING", "ybinning": "YBINNING",
    "focallen": "FOCALLEN", "xpixsz": "XPIXSZ", "ypixsz": "YPIXSZ",
}
METADATA_DEFAULTS = {"bzero": "0", "bscale": "1", "xbinning": "1", "ybinning": "1", "filter": "", "camera": "", "bayerpat": "", "object": "", "date_obs": "", "telescope": "", "instrument": ""}
TEXT_KEYS = ("filter", "camera", "bayerpat", "object", "date_obs", "telescope", "instrument")
WHOLE_KEYS = ("naxis1", "naxis2", "bitpix", "xbinning", "ybinning")


def metadata(header: Column) -> list[Column]:
    """The metadata of a header map (keyword -> text) as columns; defaults where a key is missing, text trimmed."""
    out = []
    for name, key in METADATA_KEYS.items():
        value = F.coalesce(F.try_element_at(header, F.lit(key)), F.lit(METADATA_DEFAULTS.get(name)))
        kind = "string" if name in TEXT_KEYS else "int" if name in WHOLE_KEYS else "double"
        out.append((F.trim(value) if kind == "string" else value.try_cast(kind)).alias(name))
    return out


def with_cached_transforms(frames: DataFrame, transforms: DataFrame, order: str) -> DataFrame:
    """frames with success, error and matrix of the last transform cached under their name.

    A frame without one fails with that message; one that failed before keeps its error, or says so.
    """
    last = transforms.groupBy("name").agg(F.max_by(F.struct("success", "error_message", "matrix"), F.col(order)).alias("t"))
    joined = frames.join(last, "name", "left")
    good = F.coalesce(F.col("t.success"), F.lit(False))
    error = F.when(F.col("t").isNull(), F.lit("No cached transform found")).when(
        ~good, F.when(F.coalesce(F.col("t.error_message"), F.lit("")) == "", "cached transform failed").otherwise(F.col("t.error_message"))
    )
    return joined.select(
        *frames.columns, good.alias("success"), F.coalesce(error, F.lit("")).alias("error"), F.when(good, F.col("t.matrix")).alias("matrix")
    )


def without_reference(frames: DataFrame, references: DataFrame, session: list[str], name: str) -> DataFrame:
    """frames with their session's reference in column reference, but for the reference itself."""
    return frames.join(references, session).where(F.col(name) != F.col("reference"))


def names_hash(frames: DataFrame, session: list[str], name: str = "name") -> DataFrame:
    """session, frames_hash: the first 12 hex digits of the MD5 of its names, sorted, one a line."""
    line = F.array_join(F.array_sort(F.collect_list(name)), "\n")
    return frames.groupBy(*session).agg(F.substring(F.md5(line), 1, 12).alias("frames_hash"))


def same_names(a: DataFrame, b: DataFrame, name: str = "name") -> DataFrame:
    """One row, same: whether two lists hold the same names, order aside."""
    left = a.select(name).distinct().withColumn("_a", F.lit(1))
    right = b.select(name).distinct().withColumn("_b", F.lit(1))
    return left.join(right, name, "full").agg((F.count_if(F.col("_a").isNull() | F.col("_b").isNull()) == 0).alias("same"))


def same_order(a: DataFrame, b: DataFrame, session: list[str], name: str = "name", order: str = "frame_id") -> DataFrame:
    """session, same: whether two lists hold the same names at the same places in their order; a missing list differs.

    Places are row numbers, so two long lists meet row by row and are never gathered.
    """
    line = Window.partitionBy(*session).orderBy(order)

    def placed(df: DataFrame, to: str) -> DataFrame:
        return df.select(*session, F.row_number().over(line).alias("_i"), F.col(name).alias(to))

    both = placed(a, "_a").join(placed(b, "_b"), [*session, "_i"], "full")
    return both.groupBy(*session).agg((F.count_if(~F.col("_a").eqNullSafe(F.col("_b"))) == 0).alias("same"))


def transforms_json(transforms: DataFrame, session: list[str]) -> DataFrame:
    """session, n_transforms, n_successful, json: the transforms of a session, by source path, as one JSON text."""
    fields = [f.split()[0] for f in TRANSFORM.split(", ")]
    return transforms.groupBy(*session).agg(
        F.count(F.lit(1)).alias("n_transforms"),
        F.count_if("success").alias("n_successful"),
        F.to_json(F.struct(F.array_sort(F.collect_list(F.struct(*fields))).alias("transforms"))).alias("json"),
    )


def transforms_from_json(rows: DataFrame, json: str = "json") -> DataFrame:
    """The transform rows of such texts; a missing error is empty, a missing n_matches 0."""
    kind = f"struct<transforms:array<struct<{', '.join(f.replace(' ', ':', 1) for f in TRANSFORM.split(', '))}>>>"
    parsed = rows.select(*[c for c in rows.columns if c != json], F.from_json(json, kind).alias("_t"))
    out = parsed.select(*[c for c in parsed.columns if c != "_t"], F.inline("_t.transforms"))
    return out.withColumns({"error_message": F.coalesce("error_message", F.lit("")), "n_matches": F.coalesce("n_matches", F.lit(0))})
