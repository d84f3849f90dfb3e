"""SimHash near-duplicates found by the generalised pigeonhole principle.

The 64 fingerprint bits are grouped into partitions of correlated bits. Partition p gets a threshold t_p >= -1 with
sum(t_p + 1) = radius + 1: two fingerprints within the radius then differ by at most t_p bits in at least one
partition p. Dynamic programming over estimated candidate counts (from bit statistics of all fingerprints) allocates
the thresholds. Each fingerprint is indexed under its own value in a partition and probes the values within t_p bits;
what meets under a value is verified on all 64 bits. Buckets emit spanning links only, never all pairs; buckets larger
than `bucket_rows` are dealt to several tasks as chunk pairs, so no task holds an unbounded group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import bounded_batches, connected_components, cut

BITS = 64


def fingerprint(text: str | None, words: int = 4, seed: int = 42) -> int:
    """Majority fingerprint over the XXH64 of a text's word shingles, as unsigned 64-bit; 0 without words."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    line = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    k = min(words, len(w))
    stops = ends[k - 1 :]
    starts = np.concatenate(([0], ends[: len(stops) - 1] + 1))
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(line[s:e], seed) for s, e in zip(starts.tolist(), stops.tolist())], np.uint64)
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        part = np.ascontiguousarray(hashes[i : i + (1 << 14)]).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """doc_id, fp (the unsigned fingerprint's bits as a long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, words) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], ["doc_id", "fp"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    return bounded_batches(src).mapInArrow(run, "doc_id long, fp long")


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Count of fingerprints and the 64 x 64 counts of bits set together, over all rows; 4096 sums reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        n = 0
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            bits = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
            n += len(fp)
        if n:
            c = np.append(total.ravel(), n).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(c))), pa.array(c)], ["k", "c"])

    rows = fps.select("fp").mapInArrow(run, "k long, c long").groupBy("k").agg(F.sum("c").alias("c")).collect()
    got = np.zeros(BITS * BITS + 1)
    for r in rows:
        got[r["k"]] = r["c"]
    return int(got[-1]), got[:-1].reshape(BITS, BITS)


def grouped_bits(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """64 bits in m groups of near-equal size; a group grows by the bit most correlated with its own."""
    p = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, groups = list(range(BITS)), []
    for g in range(m):
        size = (BITS - sum(map(len, groups))) // (m - g)
        own = [max(left, key=lambda b: (corr[b, left].sum(), -b))]
        left.remove(own[0])
        while len(own) < size:
            nxt = max(left, key=lambda b: (corr[b, own].sum(), -b))
            own.append(nxt)
            left.remove(nxt)
        groups.append(own)
    return groups


def plan_probes(n: int, both: np.ndarray, radius: int, max_groups: int = 6) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each partition in use: the cheapest partition count and allocation of thresholds."""
    p = np.diag(both) / max(n, 1)
    differ = 2 * p * (1 - p)
    best, plan = np.inf, []
    for m in range(max(2, min(2, radius + 1)), max(2, min(max_groups, radius + 1)) + 1):
        groups = grouped_bits(n, both, m)
        cost = []
        for g in groups:
            dist = np.zeros(radius + 2)
            dist[0] = 1
            for b in g:
                dist[1:] = dist[1:] * (1 - differ[b]) + dist[:-1] * differ[b]
                dist[0] *= 1 - differ[b]
            at = [0.0]
            for t in range(radius + 1):
                probes = 1 + sum(comb(len(g), k) for k in range(1, t + 1)) / 2
                at.append(150.0 * n * probes + dist[: t + 1].sum() * n * n / 2)
            cost.append(at)  # by t + 1
        budget = radius + 1
        table = [[0.0] + [np.inf] * budget]
        came: list[list[int]] = []
        for at in cost:
            row, pick = [], []
            for s in range(budget + 1):
                c, u = min((table[-1][s - u] + at[u], u) for u in range(s + 1))
                row.append(c)
                pick.append(u)
            table.append(row)
            came.append(pick)
        if table[-1][budget] < best:
            best, s, plan = table[-1][budget], budget, []
            for g, pick in zip(reversed(groups), reversed(came)):
                if pick[s]:
                    plan.append((g, pick[s] - 1))
                s -= pick[s]
    return plan


def signatures(reps: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """key, fp, rep, own: each fingerprint under its own value (own) and as a probe of lower values in reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = []
        for bits, t in plan:
            flips = [0] + [sum(1 << i for i in c) for k in range(1, t + 1) for c in combinations(range(len(bits)), k)]
            masks.append(np.array(flips, np.int64))
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            reps_ = b.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for p, (bits, _) in enumerate(plan):
                value = np.zeros(len(fps), np.int64)
                for i, bit in enumerate(bits):
                    value |= ((fps >> np.int64(bit)) & 1) << np.int64(i)
                step = max(1, (1 << 18) // len(masks[p]))
                for i in range(0, len(fps), step):
                    v = value[i : i + step, None]
                    probe = v ^ masks[p][None, :]
                    row, col = np.nonzero(probe <= v)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array((np.int64(p) << np.int64(48)) | probe[row, col]),
                            pa.array(fps[i + row]),
                            pa.array(reps_[i + row]),
                            pa.array(col == 0),
                        ],
                        ["key", "fp", "rep", "own"],
                    )

    return reps.select("fp", "rep").mapInArrow(run, "key long, fp long, rep long, own boolean")


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node of its component) that join the same nodes as the links a-b."""
    nodes, flat = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    keep = root != np.arange(len(nodes))
    return nodes[root[keep]], nodes[keep]


def bucket_links(radius: int, max_links: int = 1 << 20):
    """Rows sorted by key, c, d with own rows first -> links between representatives within the radius."""

    def links(k: np.ndarray, fp: np.ndarray, rep: np.ndarray, own: np.ndarray):
        change = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
        start = np.concatenate(([0], change))
        size = np.diff(np.concatenate((start, [len(k)])))
        after = np.repeat(start + size, size) - np.arange(len(k)) - 1  # rows of the same bucket that follow
        first = np.flatnonzero(own & (after > 0))
        left, right, held = [], [], 0
        lag = 1
        while len(first):
            near = np.bitwise_count(fp[first] ^ fp[first + lag]) <= radius
            at = first[near]
            left.append(rep[at])
            right.append(rep[at + lag])
            held += len(at)
            if held > max_links:
                a, b = spanning(np.concatenate(left), np.concatenate(right))
                left, right, held = [a], [b], 0
            lag += 1
            first = first[after[first] >= lag]
        a, b = np.concatenate(left or [np.zeros(0, np.int64)]), np.concatenate(right or [np.zeros(0, np.int64)])
        return spanning(a, b) if len(a) else (a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None

        def done(parts):
            a, b = links(*parts)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            c = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
            new = [np.stack(c[:3], axis=1).astype(np.int64), c[3].astype(np.int64).view(np.uint64), c[4].astype(np.int64), c[5].astype(bool)]
            rest = new if rest is None else [np.concatenate(x) for x in zip(rest, new)]
            k = rest[0]
            if len(k) and (k[0] != k[-1]).any():
                edge = int(np.flatnonzero((k != k[-1]).any(axis=1))[-1]) + 1
                yield done([x[:edge] for x in rest])
                rest = [x[edge:] for x in rest]
        if rest is not None and len(rest[0]) > 1:
            yield done(rest)

    return run


def near_links(reps: DataFrame, radius: int = 4, bucket_rows: int = 20_000) -> DataFrame:
    """Spanning links a-b among distinct fingerprints (columns fp, rep) that lie within the radius."""
    n, both = bit_statistics(reps)
    plan = plan_probes(n, both, radius)
    sig = signatures(reps, plan)
    hot = cut(sig.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket_rows), "hot")
    chunks = F.ceil(F.col("n") / bucket_rows).cast("int")
    mine = F.pmod(F.xxhash64("rep"), chunks).cast("int")
    every = F.sequence(F.lit(0), chunks - 1)

    def place(c, d, own):
        return F.struct(c.cast("int").alias("c"), d.cast("int").alias("d"), own.alias("own"))

    as_own = F.when(F.col("own"), F.transform(every, lambda d: place(mine, d, F.lit(True))))
    as_probe = F.transform(every, lambda c: place(c, mine, F.lit(False)))
    places = F.when(F.col("n").isNull(), F.array(place(F.lit(0), F.lit(0), F.col("own")))).otherwise(
        F.concat(F.coalesce(as_own, F.expr("array()").cast("array<struct<c:int,d:int,own:boolean>>")), as_probe)
    )
    dealt = (
        sig.join(hot, "key", "left")
        .select("key", "fp", "rep", F.explode(places).alias("p"))
        .select("key", "p.c", "p.d", "fp", "rep", "p.own")
        .repartition("key", "c", "d")
        .sortWithinPartitions("key", "c", "d", F.desc("own"))
    )
    return dealt.mapInArrow(bucket_links(radius), "a long, b long")


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 4,
    radius: int = 4,
    bucket_rows: int = 20_000,
) -> DataFrame:
    """doc_id, fingerprint, component_id for every row of docs.

    Fingerprints that differ in `radius` bits or fewer are linked; component_id is the smallest doc_id that links
    reach. Null and empty texts have fingerprint zero and are linked like any other; repeated rows stay repeated; a
    row with a null id keeps its fingerprint, links nothing and has a null component_id; an empty table gives an
    empty result; further columns of docs are ignored. Copies meet as one fingerprint before any comparison.
    """
    fps = cut(fingerprints(docs, id_col, text_col, words), "fingerprints")
    reps = cut(fps.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct-fingerprints")
    roots = connected_components(near_links(reps, radius, bucket_rows))
    named = reps.join(roots, reps["rep"] == roots["node"], "left").select(
        F.col("fp").alias("of"), F.coalesce("root", "rep").alias("component")
    )
    return fps.join(named, fps["fp"] == named["of"], "left").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"),
    )
