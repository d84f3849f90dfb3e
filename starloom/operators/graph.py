"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.plans.scratch import cut


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Components of an undirected graph by alternating large-star and small-star rounds.

    edges: columns a, b (long). Returns node, root for every node that has a link to another, root being the
    smallest node of its component (roots themselves have a row too). Self-links, repeated and null links are
    ignored; an empty graph gives no rows. Each round is a partial aggregate and a join over the links left, and is
    written to the shared folder, so hubs are pre-aggregated and AQE may split what is still skewed in the join.
    """

    def ordered(e: DataFrame) -> DataFrame:
        return (
            e.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .distinct()
        )

    e = cut(ordered(edges), "links")
    seen = None
    for _ in range(max_rounds):
        stat = e.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")).first()
        if stat["n"] == 0 or (stat["n"], stat["x"]) == seen:
            break
        seen = (stat["n"], stat["x"])
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = ordered(both.where("v > u").join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b")))
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b").select(F.col("m").alias("a"), F.col("a").alias("b"))
        e = cut(ordered(small.union(low.select("m", "b"))), "links", done=(e,))
    else:
        raise RuntimeError("the components did not settle")
    return e.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        e.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )
