"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Every source's documents lie on lines (shards of bounded size) in a seeded order, cut into blocks of `block_words`
words. The blocks of the mix are dealt to the (source, shard) cells by highest quotients, which gives each cell an
integer quota. A quota of q blocks out of n takes every block q // n times and q % n further blocks at a seeded phase,
spread evenly. What a document gives is the overlap of its stretch of the line with the blocks taken, in closed form,
so no block ever becomes a row.
"""

from __future__ import annotations

import heapq
from hashlib import md5

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import WORD, cut


def filled_targets(sizes: list[float], weights: list[float], share: float, most: float) -> list[float]:
    """Targets by weight that together make share * sum(sizes); none above most * size, excess reshared by weight."""
    total, capped = share * sum(sizes), set()
    while True:
        rest = total - sum(most * sizes[i] for i in capped)
        open_weight = sum(w for i, w in enumerate(weights) if i not in capped)
        over = {i for i, w in enumerate(weights) if i not in capped and w * rest / open_weight > most * sizes[i]}
        if not over:
            return [most * s if i in capped else weights[i] * rest / open_weight for i, s in enumerate(sizes)]
        capped |= over
        if len(capped) == len(sizes):
            return [most * s for s in sizes]


def sainte_lague(votes: list[float], seats: int, caps: list[int] | None = None) -> list[int]:
    """Seats by the highest quotients vote / (2 k + 1); equal quotients go to the earlier entry; no entry above its cap.

    A divisor found by bisection gives the first seats at once (they are the largest quotients), a heap gives the rest.
    """
    v = np.asarray(votes, float)
    cap = np.full(len(v), seats, np.int64) if caps is None else np.asarray(caps, np.int64)
    seats = int(min(seats, cap[v > 0].sum()))
    if seats <= 0 or not (v > 0).any():
        return [0] * len(v)

    def at(d: float) -> np.ndarray:
        return np.minimum(np.floor((v / d + 1) / 2), cap).astype(np.int64)

    low, high = v[v > 0].min() / (2.0 * seats + 3), v.max() * 2
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if at(mid).sum() > seats else (low, mid)
    got = at(high * (1 + 1e-12))
    heap = [(-v[i] / (2 * int(got[i]) + 1), i) for i in range(len(v)) if v[i] > 0 and got[i] < cap[i]]
    heapq.heapify(heap)
    for _ in range(seats - int(got.sum())):
        _, i = heapq.heappop(heap)
        got[i] += 1
        if got[i] < cap[i]:
            heapq.heappush(heap, (-v[i] / (2 * int(got[i]) + 1), i))
    return got.tolist()


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    block_words: int = 32,
    shard_words: int = 250_000,
    most_shards: int = 50_000,
    seed: int = 17,
    keep: list[str] | None = None,
) -> DataFrame:
    """doc_id, size, source_size, target, taken, passes, ranges (and the columns named in keep) for every row of docs.

    The mix takes the whole document `passes` times and once more the words of `ranges` (start, end; the end excluded), so
    taken = passes * size + the words of the ranges.

    Sources in code point order, null last, take the weights in turn. Null and empty texts have size 0 and give 0
    words; a null source is a source of its own; rows with a null id and repeated rows each count as rows. The seeded
    order, which also deals rows to shards, is by a hash of id and text, so rows without an id or with one id are spread
    as well; reruns agree up to rows that are equal in both. An empty table gives an empty result. A shard has about
    max(shard_words, all words / most_shards) words at every size; the driver holds one row per shard and per source.
    The columns to keep (whole texts, it may be) take no part in this: docs is read again for them, they are shuffled once
    and meet their row's place by id, text and source.
    """
    spark = docs.sparkSession
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    own = [F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("")), F.coalesce(F.md5(F.col(text_col)), F.lit(""))]
    order = F.md5(F.concat(F.lit(f"{seed}:"), own[0], F.lit(":"), own[1]))
    same = F.concat(order, F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")))
    sized = cut(
        docs.select(
            F.col(id_col).cast("long").alias("_id"),
            F.col(source_col).alias("_source"),
            size.alias("_size"),
            order.alias("_order"),
            *([same.alias("_same")] if keep else []),
        ),
        "sized",
    )
    per = sized.groupBy("_source").agg(F.sum("_size").alias("s")).collect()
    per = sorted(((r["_source"], int(r["s"])) for r in per), key=lambda r: (r[0] is None, r[0] or ""))
    sizes = [s for _, s in per]
    given = [weights[i % len(weights)] for i in range(len(per))]
    targets = filled_targets(sizes, given, share, most) if per else []
    per_shard = max(shard_words, sum(sizes) // most_shards)
    shards = [max(1, -(-s // per_shard)) for s in sizes]
    names = spark.createDataFrame(
        [(i, n, s, float(t), k) for i, ((n, s), t, k) in enumerate(zip(per, targets, shards))],
        "_no int, _name string, _source_size long, _target double, _shards long",
    )
    placed = (
        sized.join(names, sized["_source"].eqNullSafe(names["_name"]))
        .withColumn("_shard", F.conv(F.substring("_order", 1, 8), 16, 10).cast("long") % F.col("_shards"))
    )
    cells = placed.groupBy("_no", "_shard").agg(F.sum("_size").alias("s")).collect()
    cells = sorted((r["_no"], r["_shard"], int(r["s"])) for r in cells)
    blocks = [-(-s // block_words) for _, _, s in cells]
    votes = [targets[no] * s / sizes[no] if s else 0.0 for no, _, s in cells]
    quota = sainte_lague(votes, round(sum(targets) / block_words), [int(most * n) for n in blocks])
    taken = spark.createDataFrame(
        [
            (no, sh, q // n if n else 0, q % n if n else 0, max(n, 1), int(md5(f"{seed}:{no}:{sh}".encode()).hexdigest()[:8], 16) % max(n, 1))
            for (no, sh, _), n, q in zip(cells, blocks, quota)
        ],
        "_cell_no int, _cell_shard long, _passes long, _more long, _blocks long, _phase long",
    )
    line = Window.partitionBy("_no", "_shard").orderBy("_order", "_id", "_size")
    end = F.sum("_size").over(line.rowsBetween(Window.unboundedPreceding, 0))

    def words_before(x: str) -> Column:
        before = f"((({x} div {block_words}) * _more + _phase) div _blocks)"
        after = f"((({x} div {block_words} + 1) * _more + _phase) div _blocks)"
        return F.expr(f"{before} * {block_words} + ({x} % {block_words}) * ({after} - {before})")

    # blocks from the first to the last of the stretch that are taken once more, as words of the document
    block = f"""transform(filter(sequence(_start div {block_words}, (_end - 1) div {block_words}),
        j -> ((j + 1) * _more + _phase) div _blocks > (j * _more + _phase) div _blocks),
        j -> named_struct('start', greatest(j * {block_words}, _start) - _start, 'end', least((j + 1) * {block_words}, _end) - _start))"""
    none = "cast(array() as array<struct<start:bigint,end:bigint>>)"
    on = (F.col("_no") == F.col("_cell_no")) & (F.col("_shard") == F.col("_cell_shard"))
    lines = placed.withColumn("_end", end).withColumn("_start", F.col("_end") - F.col("_size")).join(taken, on)
    if keep:
        #: rows equal in id, text and source follow one another on a line: the first one's place gives all of theirs
        cell = ["_id", "_size", "_source_size", "_target", "_passes", "_more", "_blocks", "_phase"]
        first = lines.groupBy("_same").agg(F.min("_start").alias("_first"), *[F.first(c).alias(c) for c in cell])
        kept = docs.select(same.alias("_same"), *[F.col(c).alias(f"_keep_{c}") for c in keep])
        before = F.row_number().over(Window.partitionBy("_same").orderBy("_same")) - 1
        lines = kept.join(first, "_same").withColumn("_start", F.col("_first") + before * F.col("_size")).withColumn("_end", F.col("_start") + F.col("_size"))
    return lines.select(
        F.col("_id").alias("doc_id"),
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_passes") * F.col("_size") + words_before("_end") - words_before("_start")).alias("taken"),
        F.col("_passes").alias("passes"),
        F.expr(f"if(_size > 0 and _more > 0, {block}, {none})").alias("ranges"),
        *[F.col(f"_keep_{c}").alias(c) for c in keep or []],
    )
