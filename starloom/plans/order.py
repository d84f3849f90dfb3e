"""Exact order statistics of very large groups: partial histograms, refined until the wanted rank's bin holds one value.

A percentile of an image is one aggregate over all its values; gathered in a task it is as large as the image. Here every
round is a histogram of a bounded number of bins, summed before and after the shuffle, of what lies in the bin that holds
the rank; bins are then measured from their own least to their greatest value, so real images take two or three rounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.plans.scratch import cut


def exact_quantiles(df: DataFrame, group: list[str], value: Column, shares: dict[str, float], bins: int = 4096) -> DataFrame:
    """group and a column per share (name -> percent): percentiles with linear interpolation, as `percentile` gives them.

    Nulls, NaN and infinite values are left out; a group without others gives no row; null keys are a group. Tables of
    at most two rows a share and group go through the shared folder between rounds; df is read once a round.
    """
    d = value.cast("double")
    key = F.struct(*[F.col(g) for g in group]) if group else F.lit(0)
    values = df.select(F.to_json(key).alias("_k") if group else F.lit("").alias("_k"), *group, F.when(~F.isnan(d) & (F.abs(d) != float("inf")), d).alias("_v")).where("_v is not null")
    whole = values.groupBy("_k").agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"), *[F.first(g).alias(g) for g in group])
    at = {n: F.lit(p / 100.0) * (F.col("n") - 1) for n, p in shares.items()}
    wanted = F.array(*[F.struct(F.lit(n).alias("q"), F.lit(side).alias("side"), end(p).cast("long").alias("rank")) for n, p in at.items() for side, end in (("low", F.floor), ("high", F.ceil))])
    now = cut(whole.withColumn("w", F.explode(wanted)).select("_k", *group, "n", "lo", "hi", "w.*", F.lit(0).cast("long").alias("before")), "ranks")
    while now.where("lo < hi").limit(1).count():
        open_ = now.where("lo < hi").select("_k", "rank", "lo", "hi", "before").distinct()
        width = F.col("hi") / 2 - F.col("lo") / 2  # halves, so that the span of extreme values stays finite
        own = values.select("_k", "_v").join(open_, "_k").where((F.col("_v") >= F.col("lo")) & (F.col("_v") <= F.col("hi")))
        place = F.least(F.floor((F.col("_v") / 2 - F.col("lo") / 2) / width * bins), F.lit(bins - 1))
        held = own.groupBy("_k", "rank", "before", place.alias("_b")).agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        w = Window.partitionBy("_k", "rank").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        held = held.withColumn("_before", F.col("before") + F.coalesce(F.sum("_c").over(w), F.lit(0)))
        hit = held.where((F.col("_before") <= F.col("rank")) & (F.col("rank") < F.col("_before") + F.col("_c")))
        found = hit.select("_k", "rank", F.col("_lo").alias("nlo"), F.col("_hi").alias("nhi"), F.col("_before").alias("nb"))
        step = now.join(found, ["_k", "rank"], "left")
        step = step.select("_k", *group, "n", F.coalesce("nlo", "lo").alias("lo"), F.coalesce("nhi", "hi").alias("hi"), "q", "side", "rank", F.coalesce("nb", "before").alias("before"))
        now = cut(step, "ranks", done=(now,))

    def of(name: str) -> Column:
        low, high = (F.max(F.when((F.col("q") == name) & (F.col("side") == s), F.col("lo"))) for s in ("low", "high"))
        part = at_share(shares[name]) - F.floor(at_share(shares[name]))
        return F.when(part == 0, low).otherwise(low * (1 - part) + high * part).alias(name)

    def at_share(percent: float) -> Column:
        return F.lit(percent / 100.0) * (F.max("n") - 1)

    return now.groupBy("_k").agg(*[F.first(g).alias(g) for g in group], *[of(n) for n in shares]).drop("_k")


def robust_scale(df: DataFrame, group: list[str], value: Column) -> DataFrame:
    """group, middle (the median), noise (1.4826 times the median of absolute deviations), without a group in one task."""
    own = df.select(*group, value.cast("double").alias("_v"))
    middle = exact_quantiles(own, group, F.col("_v"), {"middle": 50.0})
    off = own.join(middle, group) if group else own.crossJoin(middle)
    mad = exact_quantiles(off, group, F.abs(F.col("_v") - F.col("middle")), {"_mad": 50.0})
    out = middle.join(mad, group) if group else middle.crossJoin(mad)  # one row each
    return out.select(*group, "middle", (1.4826 * F.col("_mad")).alias("noise"))
