"""Near-duplicate texts of a given shingle similarity, by the generalised pigeonhole over wide SimHash fingerprints.

Texts of similarity s differ in about acos(2 s / (1 + s)) / pi of their fingerprint's bits, so 64 bits cannot tell 0.8
from less, and a radius that holds all of them fits 64 bits badly. Here 256 bits are grouped by correlation; dynamic
programming over estimated candidate counts gives each group a threshold of its own, as cheaply as the wanted share of
pairs of similarity s still differs by no more than the threshold in some group. Fingerprints that meet are verified on
all bits. Distances are estimates, so they only tell which texts may be linked, directly or by others: every bucket gives
a spanning forest of its pairs within reach, which is linear in its rows, and the trees of all buckets together hold the
same texts as their pairs do. Within each tree any two texts are then compared by the Jaccard similarity of their whole
sets of shingles, unless links already join them; a large tree is dealt to many tasks by chunks of bounded bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import acos, comb, log, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import bounded_batches, connected_components, cut
from starloom.llm.passages import BLANK, Spans, mixed, pieces

WIDE = 256
WORDS_OF = [f"f{i}" for i in range(WIDE // 64)]
SMALL = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def shingle_hashes(spans: Spans, s: int, e: int, words: int) -> np.ndarray:
    """Hashes of the shingles of the words s..e: runs of `words` words (fewer: the whole sequence)."""
    starts = np.arange(s, max(s + 1, e - words + 1))
    return spans.of(starts, np.minimum(starts + words, e))


def wide_fingerprints(h: np.ndarray, at: np.ndarray, words: int) -> np.ndarray:
    """A row of four words for each text (its word hashes lie between offsets `at`): bits set in over half its shingles."""
    spans, out = Spans(h), np.zeros((len(at) - 1, len(WORDS_OF)), np.uint64)
    for i, (s, e) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
        if s == e:
            continue
        own = shingle_hashes(spans, s, e, words)
        ones = np.zeros(WIDE, np.int64)
        for k in range(0, len(own), 1 << 13):
            part = own[k : k + (1 << 13)]
            wide = np.stack([part, *(mixed(part + np.uint64(j * 0x9E3779B97F4A7C15 % (1 << 64))) for j in range(1, len(WORDS_OF)))], axis=1)
            ones += np.unpackbits(wide.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[i] = np.packbits(ones * 2 > len(own), bitorder="little").view(np.uint64)
    return out


def fingerprinted(texts: DataFrame, words: int) -> DataFrame:
    """doc_id, unit and f0..f3 of the rows of texts (doc_id, unit, t)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, h, at in pieces(b.column(2), BLANK, SMALL):
                f = wide_fingerprints(h, at, words).view(np.int64)
                n = len(f)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[first : first + n], b.column(1)[first : first + n], *(pa.array(np.ascontiguousarray(c)) for c in f.T)],
                    ["doc_id", "unit", *WORDS_OF],
                )

    names = ", ".join(f"{x} long" for x in WORDS_OF)
    return texts.select("doc_id", "unit", F.col("t").cast("binary")).mapInArrow(run, f"doc_id long, unit long, {names}")


def bits_of(b: pa.RecordBatch, first: int) -> np.ndarray:
    """The fingerprints' words as rows of an array of uint64."""
    return np.stack([b.column(first + i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(len(WORDS_OF))], axis=1).view(np.uint64)


def bit_statistics(units: DataFrame) -> tuple[int, np.ndarray]:
    """Count of fingerprints and the counts of bits set together, over all of them; WIDE squared sums reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((WIDE, WIDE)), 0
        for b in batches:
            f = np.ascontiguousarray(bits_of(b, 0))
            bits = np.unpackbits(f.view(np.uint8).reshape(len(f), -1), axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
            n += len(f)
        if n:
            rows = [*total.astype(np.int64), np.full(1, n, np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(rows))), pa.array([r.tolist() for r in rows], pa.list_(pa.int64()))], ["k", "c"])

    sums = units.select(*WORDS_OF).mapInArrow(run, "k long, c array<long>").select("k", F.posexplode("c").alias("i", "v"))
    got, n = np.zeros((WIDE, WIDE)), 0
    for r in sums.groupBy("k", "i").agg(F.sum("v").alias("v")).collect():
        if r["k"] < WIDE:
            got[r["k"], r["i"]] = r["v"]
        else:
            n = r["v"]
    return n, got


def grouped(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """All bits in m groups of near-equal size; a group grows by the bit most correlated with its own."""
    p = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free, groups = np.ones(WIDE, bool), []
    for g in range(m):
        size = round(WIDE * (g + 1) / m) - round(WIDE * g / m)
        score = np.where(free, corr[:, free].sum(axis=1), -1.0)
        own = []
        for _ in range(size):
            b = int(score.argmax())
            own.append(b)
            free[b] = False
            score = np.where(free, corr[:, own].sum(axis=1), -1.0)
        groups.append(own)
    return groups


def at_most(chances: np.ndarray, t: int) -> np.ndarray:
    """The chance that at most 0..t of independent bits, which differ with the given chances, do so."""
    dist = np.zeros(t + 1)
    dist[0] = 1
    for c in chances:
        dist[1:] = dist[1:] * (1 - c) + dist[:-1] * c
        dist[0] *= 1 - c
    return np.cumsum(dist)


def plan(n: int, both: np.ndarray, differ: float, found: float, most: int = 2, parts: tuple[int, ...] = (8, 11, 14, 18, 22, 28)) -> list[tuple[list[int], int]]:
    """(bits, threshold) by group: the cheapest that finds the share `found` of pairs whose bits differ with chance `differ`.

    A group with threshold t costs its probes and the pairs that chance brings together, as the bits' statistics tell it;
    it misses a true pair with a chance that falls with t. The logarithms of the misses add up over the groups, in steps
    of a fiftieth of what is wanted, so dynamic programming over what is missed so far gives the thresholds.
    """
    p = np.diag(both) / max(n, 1)
    steps, wanted = 50, -log(1 - found)
    best: tuple[float, list] = (np.inf, [])
    for m in parts:
        groups = grouped(n, both, m)
        table: list[tuple[float, list]] = [(0.0, [])] + [(np.inf, [])] * steps
        for g in groups:
            chance, hit = at_most(2 * p[g] * (1 - p[g]), most), at_most(np.full(len(g), differ), most)
            new = list(table)
            for t in range(most + 1):
                probes = 1 + sum(comb(len(g), k) for k in range(1, t + 1)) / 2
                cost = 150.0 * n * probes + chance[t] * n * n / 2
                gain = int(steps * -log(max(1e-12, 1 - hit[t])) / wanted)
                for s, (c, own) in enumerate(table):
                    to = min(steps, s + gain)
                    if c + cost < new[to][0]:
                        new[to] = (c + cost, [*own, (g, t)])
            table = new
        if table[steps][0] < best[0]:
            best = table[steps]
    return best[1]


def signatures(units: DataFrame, groups: list[tuple[list[int], int]]) -> DataFrame:
    """key, own, unit, f0..f3: each fingerprint under its own value (own) and as a probe of lower values in reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = [
            np.array([0] + [sum(1 << i for i in c) for k in range(1, t + 1) for c in combinations(range(len(bits)), k)], np.int64)
            for bits, t in groups
        ]
        for b in batches:
            unit = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            f = bits_of(b, 1)
            for g, (bits, _) in enumerate(groups):
                value = np.zeros(len(f), np.int64)
                for i, bit in enumerate(bits):
                    value |= ((f[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1)).astype(np.int64) << np.int64(i)
                probe = value[:, None] ^ masks[g][None, :]
                row, col = np.nonzero(probe <= value[:, None])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((np.int64(g) << np.int64(40)) | probe[row, col]), pa.array(col == 0), pa.array(unit[row]),
                        *(pa.array(np.ascontiguousarray(c)) for c in f[row].view(np.int64).T),
                    ],
                    ["key", "own", "unit", *WORDS_OF],
                )

    names = ", ".join(f"{x} long" for x in WORDS_OF)
    return units.select("unit", *WORDS_OF).mapInArrow(run, f"key long, own boolean, unit long, {names}")


def forest(a: np.ndarray, b: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Indices of the links a-b of the minimum spanning forest by (d, a, b)."""
    order = np.lexsort((b, a, d))
    nodes, flat = np.unique(np.concatenate((a[order], b[order])), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    root, kept = np.arange(len(nodes)), np.zeros(len(a), bool)
    live = np.arange(len(a))
    while len(live):
        u, v = root[x[live]], root[y[live]]
        live = live[u != v]
        if not len(live):
            break
        u, v = root[x[live]], root[y[live]]
        least = np.full(len(nodes), len(a))
        np.minimum.at(least, u, live)
        np.minimum.at(least, v, live)
        pick = np.unique(least[least < len(a)])
        kept[pick] = True
        while True:  # join the roots of the picked links
            low = np.minimum(root[x[pick]], root[y[pick]])
            new = root.copy()
            np.minimum.at(new, root[x[pick]], low)
            np.minimum.at(new, root[y[pick]], low)
            while (new[new] != new).any():
                new = new[new]
            new = new[root]
            if (new == root).all():
                break
            root = new
    return order[kept]


def grown_forest(f: np.ndarray, unit: np.ndarray, own: np.ndarray, radius: int) -> np.ndarray:
    """Rows (a, b, d): the minimum spanning forest of the pairs of a large bucket, grown by its nearest row at a time.

    Pairs need an own row and a distance within the radius. Distances are compared, never kept, so memory is linear.
    """
    n = len(f)
    left, best, via = np.arange(n), np.full(n, 1 << 30), np.zeros(n, np.int64)
    out = []
    while len(left):
        at = int(best[left].argmin())
        row = int(left[at])
        if best[row] <= radius and unit[row] != unit[via[row]]:
            out.append((row, via[row], best[row]))
        left[at] = left[-1]
        left = left[:-1]
        to = left if own[row] else left[own[left]]
        apart = np.bitwise_count(f[to] ^ f[row]).sum(axis=1, dtype=np.int64)
        near = apart < best[to]
        best[to[near]], via[to[near]] = apart[near], row
    a, b, d = np.array(out, np.int64).reshape(-1, 3).T
    return np.stack([np.minimum(unit[a], unit[b]), np.maximum(unit[a], unit[b]), d], axis=1)


def bucket_links(radius: int, max_links: int = 1 << 19, large: int = 256):
    """Rows sorted by key, c, d with own rows first -> links (a, b, d): spanning forests of the pairs within the radius."""

    def spanning(held: list[np.ndarray]) -> np.ndarray:
        every = np.concatenate(held)
        return every[forest(*every.T)]

    def links(k: np.ndarray, f: np.ndarray, unit: np.ndarray, own: np.ndarray) -> Iterator[np.ndarray]:
        change = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
        start = np.concatenate(([0], change))
        size = np.diff(np.concatenate((start, [len(k)])))
        held: list[np.ndarray] = [np.zeros((0, 3), np.int64)]
        for s, n in zip(start[size > large].tolist(), size[size > large].tolist()):
            held.append(grown_forest(f[s : s + n], unit[s : s + n], own[s : s + n], radius))
        few = np.repeat(size <= large, size)
        k, f, unit, own, size = k[few], f[few], unit[few], own[few], size[size <= large]
        start = np.cumsum(size) - size
        after = np.repeat(start + size, size) - np.arange(len(k)) - 1
        first = np.flatnonzero(own & (after > 0))
        lag, count = 0, 0
        while len(first):
            lag += 1
            first = first[after[first] >= lag]
            apart = sum(np.bitwise_count(f[first, i] ^ f[first + lag, i]).astype(np.int64) for i in range(f.shape[1]))
            near = (apart <= radius) & (unit[first] != unit[first + lag])
            at = first[near]
            u, v = unit[at], unit[at + lag]
            held.append(np.stack([np.minimum(u, v), np.maximum(u, v), apart[near]], axis=1))
            count += len(at)
            if count > max_links:
                held, count = [spanning(held)], 0
        yield spanning(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None

        def done(parts) -> Iterator[pa.RecordBatch]:
            for found in links(*parts):
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in found.T], ["a", "b", "d"])

        for batch in batches:
            c = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            new = [np.stack(c[:3], axis=1).astype(np.int64), bits_of(batch, 5), c[4].astype(np.int64), c[3].astype(bool)]
            rest = new if rest is None else [np.concatenate(x) for x in zip(rest, new)]
            k = rest[0]
            if len(k) > 1 << 15 and (k[0] != k[-1]).any():
                edge = int(np.flatnonzero((k != k[-1]).any(axis=1))[-1]) + 1
                yield from done([x[:edge] for x in rest])
                rest = [x[edge:] for x in rest]
        if rest is not None and len(rest[0]) > 1:
            yield from done(rest)

    return run


def candidate_links(units: DataFrame, at_least: float, found: float, bucket_rows: int) -> DataFrame:
    """a, b: links that span what pairs of fingerprints of distinct texts (unit, f0..f3) that may have the similarity join."""
    n, both = bit_statistics(units)
    differ = acos(2 * at_least / (1 + at_least)) / pi
    wide = sqrt(WIDE * differ * (1 - differ))
    radius = int(WIDE * differ + 3 * wide)
    sig = signatures(units, plan(n, both, differ, found))
    hot = cut(sig.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket_rows), "hot")
    chunks = F.ceil(F.col("n") / bucket_rows).cast("int")
    mine = F.pmod(F.xxhash64("unit"), chunks).cast("int")
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
        .select("key", "unit", *WORDS_OF, F.explode(places).alias("p"))
        .select("key", "p.c", "p.d", "p.own", "unit", *WORDS_OF)
        .repartition("key", "c", "d")
        .sortWithinPartitions("key", "c", "d", F.desc("own"))
    )
    return dealt.mapInArrow(bucket_links(radius), "a long, b long, d long").select("a", "b").distinct()


def spread(pairs: DataFrame, docs: DataFrame, most: int = 256) -> tuple[DataFrame, DataFrame]:
    """pairs (pair, a, b, ...) and docs (unit, ...) with texts of more than `most` pairs under several keys.

    The text in the middle of a large group of copies has a pair with each of them; its pairs are dealt to as many keys as
    hold at most about `most` each, and the text is repeated under them.
    """
    sides = pairs.select(F.col("a").alias("unit")).union(pairs.select(F.col("b").alias("unit")))
    many = sides.groupBy("unit").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
    many = cut(many.select(F.col("unit").alias("_of"), F.ceil(F.col("n") / most).cast("int").alias("_keys")), "many-pairs")
    for side in ("a", "b"):
        own = F.xxhash64(side, F.pmod("pair", F.col("_keys")).cast("int"))
        pairs = pairs.join(many, F.col(side) == F.col("_of"), "left").withColumn(side, F.when(F.col("_keys").isNull(), F.col(side)).otherwise(own)).drop("_of", "_keys")
    copies = docs.join(many, F.col("unit") == F.col("_of"), "left").withColumn("_k", F.explode(F.sequence(F.lit(0), F.coalesce("_keys", F.lit(1)) - 1)))
    own = F.when(F.col("_keys").isNull(), F.col("unit")).otherwise(F.xxhash64("unit", "_k"))
    return pairs, copies.withColumn("unit", own).drop("_of", "_keys", "_k")


def alike_links(sets: list[np.ndarray], unit: np.ndarray, label: np.ndarray, asks: np.ndarray, at_least: float) -> Iterator[tuple[int, int]]:
    """Links (a, b) that span what pairs of sets with the Jaccard similarity join beyond equal labels.

    Each row that asks is compared with all others that nothing joins to it yet, by the places of its members.
    """
    size = np.array([len(x) for x in sets])
    at = np.concatenate(([0], np.cumsum(size)))
    member, flat = np.unique(np.concatenate(sets), return_inverse=True)
    holder = np.repeat(np.arange(len(sets)), size)[np.argsort(flat, kind="stable")]
    first = np.concatenate(([0], np.cumsum(np.bincount(flat, minlength=len(member)))))
    root = label.copy()
    for x in np.flatnonzero(asks).tolist():
        if (root == root[x]).all():
            continue
        own = flat[at[x] : at[x + 1]]
        low, many = first[own], first[own + 1] - first[own]
        both = np.bincount(holder[np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())], minlength=len(sets))
        near = np.flatnonzero((both / (size[x] + size - both) >= at_least) & (root != root[x]))
        joined, which = np.unique(root[near], return_index=True)
        yield from ((int(unit[x]), int(unit[y])) for y in near[which].tolist())
        root[np.isin(root, joined)] = root[x]


def compared_chunks(rows: DataFrame, words: int, at_least: float) -> DataFrame:
    """a, b: spanning links of the rows (tree, c, d, asks, label, unit, t) that meet under one tree, c and d."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def done() -> Iterator[pa.RecordBatch]:
            if len(held) > 1:
                asks, label, unit, sets = zip(*held)
                found = np.array(list(alike_links(list(sets), np.array(unit), np.array(label), np.array(asks), at_least)), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in found.T], ["a", "b"])

        for batch in batches:
            places = zip(*(batch.column(i).to_pylist() for i in range(6)))
            for first, h, at in pieces(batch.column(6), BLANK, SMALL):
                spans = Spans(h)
                for s, e in zip(at[:-1].tolist(), at[1:].tolist()):
                    tree, c, d, *row = next(places)
                    if (tree, c, d) != key:
                        yield from done()
                        key, held = (tree, c, d), []
                    held.append((*row, np.unique(shingle_hashes(spans, s, e, words)) if s < e else np.zeros(1, np.uint64)))
        yield from done()

    order = ["tree", "c", "d"]
    dealt = rows.repartition(*order).sortWithinPartitions(*order)
    return dealt.select(*order, "asks", "label", "unit", F.col("t").cast("binary")).mapInArrow(run, "a long, b long")


def true_links(own: DataFrame, words: int, at_least: float, chunk_bytes: int) -> DataFrame:
    """a, b: spanning links of the groups that texts of the similarity form within each tree; own: tree, unit, t.

    A tree of at most chunk_bytes is compared in one task. A larger one is dealt to chunks, each of which is compared
    within itself and with one text of the tree; what that joins most of needs no comparison with itself, so only the
    tree's other texts (few, where the tree is one group) then meet all its chunks.
    """

    def chunks(total):
        return F.greatest(F.ceil(total / chunk_bytes), F.lit(1)).cast("int")

    total = own.groupBy("tree").agg(chunks(F.sum(F.octet_length("t"))).alias("n"))
    large = cut(total.where("n > 1"), "large-trees")
    rows = own.join(large, "tree", "left")
    mine = F.pmod(F.xxhash64("unit"), "n").cast("int")
    first = F.when(F.col("n").isNull(), F.array(F.lit(0))).when(F.col("unit") == F.col("tree"), F.sequence(F.lit(0), F.col("n") - 1)).otherwise(F.array(mine))
    one = rows.select("tree", F.explode(first).alias("c"), F.lit(0).alias("d"), F.lit(True).alias("asks"), F.col("unit").alias("label"), "unit", "t")
    links = cut(compared_chunks(one, words, at_least), "near-links")
    if large.isEmpty():
        return links
    roots = connected_components(links)
    sizes = own.join(large, "tree").join(roots, F.col("unit") == F.col("node"), "left").select("tree", "n", "unit", F.coalesce("root", "unit").alias("label"), F.octet_length("t").alias("size"))
    per = cut(sizes.groupBy("tree", "label").agg(F.sum("size").alias("size")), "near-labels")
    most = per.groupBy("tree").agg(F.max_by("label", F.struct("size", "label")).alias("most"), F.count(F.lit(1)).alias("labels"))
    others = per.join(most, "tree").where("labels > 1").groupBy("tree", "most").agg(chunks(F.sum(F.when(F.col("label") != F.col("most"), F.col("size")))).alias("m"))
    rows = own.join(large, "tree").join(others, "tree").join(roots, F.col("unit") == F.col("node"), "left").withColumn("label", F.coalesce("root", "unit"))
    meets = F.pmod(F.xxhash64(F.lit(1), "unit"), "m").cast("int")

    def place(c, d, asks):
        return F.struct(c.alias("c"), d.alias("d"), F.lit(asks).alias("asks"))

    stays = F.transform(F.sequence(F.lit(0), F.col("m") - 1), lambda d: place(mine, d, False))
    visits = F.when(F.col("label") != F.col("most"), F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda c: place(c, meets, True)))
    both = F.when(visits.isNull(), stays).otherwise(F.concat(stays, visits))
    rest = rows.select("tree", F.explode(both).alias("p"), "label", "unit", "t").select("tree", "p.c", "p.d", "p.asks", "label", "unit", "t")
    return links.union(cut(compared_chunks(rest, words, at_least), "near-links"))


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, at_least: float = 0.8, found: float = 0.98, bucket_rows: int = 20_000,
    chunk_bytes: int = 1 << 23,
) -> DataFrame:
    """doc_id, unit, component, first: a row for every different pair of id and text of docs.

    unit is a hash of the text; texts (A-Z as a-z, words between ASCII blanks) whose sets of shingles have at least the
    Jaccard similarity (shingles are told apart by 64-bit hashes) are linked, about the share `found` of those at the
    threshold and nearly all above it; no bucket, group or text has a cap. component is the smallest unit that links reach. Of each component one row is first: that of the smallest doc_id, null ids last,
    equal ids by text. Null texts count as empty; texts without words are alike. An empty table gives an empty result;
    further columns are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = bounded_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("unit"), text.alias("t")))
    prints = cut(fingerprinted(src, words), "wide-fingerprints")
    units = cut(prints.groupBy("unit").agg(*(F.min(x).alias(x) for x in WORDS_OF)), "units")
    trees = connected_components(candidate_links(units, at_least, found, bucket_rows))
    own = src.select("unit", "t").join(trees, F.col("unit") == F.col("node")).dropDuplicates(["unit"]).select(F.col("root").alias("tree"), "unit", "t")
    roots = connected_components(true_links(cut(own, "near-texts"), words, at_least, chunk_bytes))
    rows = prints.select("doc_id", "unit").distinct().join(roots, F.col("unit") == F.col("node"), "left")
    rows = rows.select("doc_id", "unit", F.coalesce("root", "unit").alias("component"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("unit"))
    least = rows.groupBy("component").agg(F.min(order).alias("least"))
    return rows.join(least, "component").select("doc_id", "unit", "component", (order == F.col("least")).alias("first"))
