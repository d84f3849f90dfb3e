"""Frame rows (one array per frame) to pixel rows and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, *names: str) -> DataFrame:
    """df with the named columns behind a generator, which the optimiser does not merge into what reads them.

    An array expression that a lambda reads would otherwise be put into the lambda and computed for every element.
    """
    return df.select(*[c for c in df.columns if c not in names], F.inline(F.array(F.struct(*names)))).select(*df.columns)


def to_pixels(frames: DataFrame, keys: list[str], values: dict[str, str], width: str | int = "width") -> DataFrame:
    """keys, pos, y, x and one column per entry of values (name -> array column); arrays of a row have one length."""
    w = F.col(width) if isinstance(width, str) else F.lit(width)
    zipped = F.arrays_zip(*[F.col(a).alias(n) for n, a in values.items()])
    return frames.select(*keys, w.alias("_w"), F.posexplode(zipped).alias("pos", "_v")).select(
        *keys,
        "pos",
        F.floor(F.col("pos") / F.col("_w")).cast("int").alias("y"),
        (F.col("pos") % F.col("_w")).cast("int").alias("x"),
        *[F.col("_v")[n].alias(n) for n in values],
    )


def to_arrays(pixels: DataFrame, keys: list[str], values: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key with an array per value, in row-major order; a frame must fit into one row."""
    order = order or ["y", "x"]
    packed = F.array_sort(F.collect_list(F.struct(*order, *values)))
    rows = pixels.groupBy(*keys).agg(packed.alias("_p"), (F.max("y") + 1).alias("height"), (F.max("x") + 1).alias("width"))
    return computed_once(rows.select(*keys, "height", "width", *[F.col(f"_p.{v}").alias(v) for v in values]), *values)


def tiles(frames: DataFrame, keys: list[str], data: str, rows: int = 64, columns: int = 480) -> DataFrame:
    """keys, ty, tx, tile_h, tile_w, data: frames cut into tiles, so that a stack is dealt out by tile, not by frame."""
    ty = F.sequence(F.lit(0), F.floor((F.col("height") - 1) / rows).cast("int"))
    tx = F.sequence(F.lit(0), F.floor((F.col("width") - 1) / columns).cast("int"))
    cut = frames.withColumn("ty", F.explode(ty)).withColumn("tx", F.explode(tx))
    tile_h = F.least(F.lit(rows), F.col("height") - F.col("ty") * rows)
    tile_w = F.least(F.lit(columns), F.col("width") - F.col("tx") * columns)

    def row(r: Column) -> Column:
        start = (F.col("ty") * rows + r) * F.col("width") + F.col("tx") * columns + 1
        return F.slice(F.col(data), start, F.col("tile_w"))

    cut = cut.withColumn("tile_h", tile_h).withColumn("tile_w", tile_w)
    strips = F.flatten(F.transform(F.sequence(F.lit(0), F.col("tile_h") - 1), row))
    return cut.select(*keys, "ty", "tx", "tile_h", "tile_w", strips.alias("data"))
