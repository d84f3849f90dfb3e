"""Embedding near-duplicates: spherical k-means cells, blocked cosine products of cells, one kept per group.

Equal vectors of a label meet first as one vector with a multiplicity. Centres are fitted on a bounded sample and every
vector is assigned to its home cell. Cells go whole into blocks of bounded size, and every two blocks of a label meet, but
of their cells only what can hold a link: unit vectors of cosine s lie sqrt(2 - 2 s) apart, so two vectors on two sides of
a border are compared only if their distances to it add up to that at most. A cell's guests are thus picked when two cells
meet and are not copied beforehand: a vector is shuffled once and stands in one block, however many cells are near it.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import connected_components, cut


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by the largest component first, so that squares neither overflow nor vanish."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def matrix(column: pa.Array) -> np.ndarray:
    """A list column whose rows have one length, as a double matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def best_fit(x: np.ndarray, centres: np.ndarray, block: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each unit row and the cosine to its centre, by blocks of rows."""
    home, fit = np.zeros(len(x), np.int64), np.zeros(len(x))
    for i in range(0, len(x), block):
        part = x[i : i + block] @ centres.T
        home[i : i + block] = part.argmax(axis=1)
        fit[i : i + block] = part.max(axis=1)
    return home, fit


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 9) -> np.ndarray:
    """k unit centres for unit rows x; empty cells take the rows that fit worst."""
    rng = np.random.default_rng(seed)
    centres = x[np.sort(rng.choice(len(x), min(k, len(x)), replace=False))]
    for _ in range(rounds):
        home, fit = best_fit(x, centres)
        total = np.zeros_like(centres)
        np.add.at(total, home, x)
        bare = np.flatnonzero(np.linalg.norm(total, axis=1) < 1e-9)
        total[bare] = x[np.resize(np.argsort(fit), len(bare))]
        centres = unit(total)
    return centres


class Block:
    """Unit vectors of one label, sorted by cell, with the ids and multiplicities that they stand for."""

    def __init__(self, raw: np.ndarray, ids: np.ndarray, mult: np.ndarray, cell: np.ndarray):
        self.raw, self.ids, self.mult, self.cell = raw, ids, mult, cell
        self.unit = np.empty(raw.shape, np.float32)
        for i in range(0, len(raw), 1024):
            self.unit[i : i + 1024] = unit(raw[i : i + 1024].astype(float))
        self.cells, self.starts = np.unique(cell, return_index=True)
        self.ends = np.append(self.starts[1:], len(cell))

    def to_borders(self, centres: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's distance to the border between its cell and each of the other cells; the least of each own cell."""
        fit = np.empty((len(self.cell), len(others)), np.float32)
        for c, i, j in zip(self.cells, self.starts, self.ends):
            lead = (self.unit[i:j] @ centres[c])[:, None] - self.unit[i:j] @ centres[others].T
            fit[i:j] = lead / np.maximum(np.linalg.norm(centres[others] - centres[c], axis=1), 1e-6)
        return fit, np.minimum.reduceat(fit, self.starts, axis=0)


def united(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the trees of the linked nodes i and j; root names the tree of each node by one of its nodes."""
    while True:
        apart = root[i] != root[j]
        i, j = i[apart], j[apart]
        if not len(i):
            return
        np.minimum.at(root, np.maximum(root[i], root[j]), np.minimum(root[i], root[j]))
        while (root[root] != root).any():
            root[:] = root[root]


def linked(a: Block, b: Block, centres: np.ndarray, at_least: float, margin: float, step: int = 256, wide: int = 2048) -> pa.Table:
    """a, b, n: the links (a, b) of a spanning forest of the two blocks' links, and each vector's number n of links.

    A block meets itself if a is b. Products are of single precision; those within its error of at_least are told in double.
    """
    same, n = a is b, len(a.ids)
    shift = 0 if same else n
    ids = a.ids if same else np.concatenate((a.ids, b.ids))
    mult = a.mult if same else np.concatenate((a.mult, b.mult))
    count, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
    error = (a.unit.shape[1] + 8) * 1.2e-7
    apart = sqrt(max(0.0, 2 - 2 * at_least)) + 1e-6

    def tell(rows: np.ndarray, cols: np.ndarray, x: np.ndarray, y: np.ndarray, to: tuple[np.ndarray, np.ndarray] | None, once: bool) -> None:
        s = x @ y.T
        at = np.flatnonzero(s >= at_least - error)
        if not len(at):
            return
        i, j = at // len(cols), at % len(cols)
        keep = np.ones(len(at), bool)
        if to is not None:
            keep = np.minimum(to[0][i], to[1][j]) <= margin
        i, j, cosine = rows[i], cols[j], s.ravel()[at]
        if once:
            keep &= i < j
        keep &= a.ids[i] != b.ids[j]
        near = np.flatnonzero(keep & (cosine < at_least + error))
        for k in range(0, len(near), 1 << 16):
            pick = near[k : k + (1 << 16)]
            exact = (unit(a.raw[i[pick]].astype(float)) * unit(b.raw[j[pick]].astype(float))).sum(axis=1)
            keep[pick] = exact >= at_least
        i, j = i[keep], j[keep] + shift
        np.add.at(count, i, mult[j])
        np.add.at(count, j, mult[i])
        united(root, i, j)

    def whole(rows: range, cols: range, once: bool) -> None:
        for i in range(rows.start, rows.stop, wide):
            left = np.arange(i, min(i + wide, rows.stop))
            for j in range(i if once else cols.start, cols.stop, wide):
                right = np.arange(j, min(j + wide, cols.stop))
                tell(left, right, a.unit[left[0] : left[-1] + 1], b.unit[right[0] : right[-1] + 1], None, once)

    far_a, least_a = a.to_borders(centres, b.cells)
    far_b, least_b = (far_a, least_a) if same else b.to_borders(centres, a.cells)
    for p, cell in enumerate(a.cells):
        gap = np.maximum(np.linalg.norm(centres[b.cells] - centres[cell], axis=1), 1e-6)
        most = apart + 4 * error / gap  # what single precision adds to the distances counts for the pair
        meet = (least_a[p] + least_b[:, p] <= most) | (b.cells == cell)
        for q in np.flatnonzero(meet).tolist():
            if same and q < p:
                continue
            rows, cols = range(a.starts[p], a.ends[p]), range(b.starts[q], b.ends[q])
            if b.cells[q] == cell:
                whole(rows, cols, same)
                continue
            to_a, to_b = far_a[rows.start : rows.stop, q], far_b[cols.start : cols.stop, p]
            left = np.flatnonzero(to_a <= most[q] - least_b[q, p])
            left = left[np.argsort(to_a[left])]
            right = np.flatnonzero(to_b <= most[q] - least_a[p, q])
            right = right[np.argsort(to_b[right])]
            to_a, to_b = to_a[left], to_b[right]
            left, right = left + rows.start, right + cols.start
            y = b.unit[right]
            for i in range(0, len(left), step):
                reached = int(np.searchsorted(to_b, most[q] - to_a[i], "right"))
                if not reached:
                    break
                some = left[i : i + step]
                x = a.unit[some]
                for j in range(0, reached, wide):
                    k = min(j + wide, reached)
                    tell(some, right[j:k], x, y[j:k], (to_a[i : i + step], to_b[j:k]) if margin < apart / 2 - 1e-6 else None, False)
    told, link = count > 0, root != np.arange(len(ids))
    return pa.table(
        {
            "a": pa.array(np.concatenate((ids[told], ids[link])), pa.int64()),
            "b": pa.array([None] * int(told.sum()) + ids[root[link]].tolist(), pa.int64()),
            "n": pa.array(np.concatenate((count[told], np.zeros(int(link.sum()), np.int64))), pa.int64()),
        }
    )


def fixed(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    rows = np.ascontiguousarray(rows)
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.itemsize * (rows.shape[1] if rows.ndim > 1 else 1))
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    at_least: float = 0.93,
    margin: float | None = None,
    cell_rows: int | None = None,
    sample_rows: int = 20_000,
    block_rows: int = 16_384,
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors.

    Vectors with equal non-null labels, equal lengths and cosine >= at_least (in double precision) are linked. A vector
    that is null, empty, zero or holds null or non-finite components, or whose label or id is null, links with nothing:
    n_links 0, its own component, kept (a null id: null component, not kept). Repeated rows count as further vectors;
    an empty table gives an empty result; further columns are ignored. A label of more than about block_rows different
    vectors is cut into blocks of whole cells (a larger cell into chunks by hash), and pairs of blocks are compared in
    separate tasks that read them from a written table. A label of n different vectors gets cells of about sqrt(n) vectors
    (or cell_rows), 1,024 at least where blocks are larger. The centres are fitted on the sample_rows vectors or so that a
    hash picks, or 8 for each cell where that is more. margin: of two linked vectors on two sides of a border one has to be
    that near to it; the default loses no link.
    """
    spark = vectors.sparkSession
    exact = sqrt(max(0.0, 2 - 2 * at_least)) / 2 + 1e-9
    margin = exact if margin is None else margin
    kind = vectors.schema[vector_col].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    element, dtype = ("float", np.float32) if single else ("double", np.float64)
    v = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("string").alias("label"),
        F.transform(F.col(vector_col).cast(f"array<{element}>"), lambda x: x + F.lit(0).cast(element)).alias("e"),  # -0.0 is 0.0
    )
    bad = F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fit = F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & ~bad & F.exists("e", lambda x: x != 0), F.lit(False)
    )
    v = v.withColumn("fit", fit)
    # 128 bits stand for the vector, so that equal ones meet without being compared
    good = v.where("fit").select("vec_id", "label", "e", F.xxhash64("e").alias("h_0"), F.xxhash64(F.lit(1), "e").alias("h_1"), F.size("e").alias("dim"))
    blocks, centres, runs = blocked(good, dtype, at_least, margin, cell_rows, sample_rows, block_rows)
    found = cut(blocks, "blocks", by=("run",))
    links = found.where("run = -1 and a is not null").select("a", "b", "n")
    for run, n in runs.items():
        links = links.union(across(found.where(F.col("run") == run), n, centres, dtype, at_least, margin))
    counts = links.where("b is null and n > 0").groupBy("a").agg(F.sum("n").alias("n"))
    roots = connected_components(links.where("b is not null").select("a", "b"))
    classes = found.where("run = -1 and h_0 is not null").select("label", "h_0", "h_1", "rep", "mult")
    told = (
        classes.join(counts, classes["rep"] == counts["a"], "left")
        .join(roots, F.col("rep") == F.col("node"), "left")
        .select(
            F.col("label").alias("of_label"),
            F.col("h_0").alias("of_0"),
            F.col("h_1").alias("of_1"),
            (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links"),
            F.coalesce("root", "rep").alias("component"),
        )
        .groupBy("of_label", "of_0", "of_1")  # one row each, wherever tasks tell the nearest centre alike
        .agg(F.max("n_links").alias("n_links"), F.min("component").alias("component"))
    )
    mine = good.select("vec_id", "label", "h_0", "h_1")
    linked_ = mine.join(told, (F.col("label") == F.col("of_label")) & (F.col("h_0") == F.col("of_0")) & (F.col("h_1") == F.col("of_1")))
    alone = v.where("not fit").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return (
        linked_.select("vec_id", "n_links", F.col("component").alias("component_id"))
        .union(alone)
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )


BLOCKS = (
    "label string, h_0 long, h_1 long, rep long, mult long, a long, b long, n long, "
    "at int, first int, last int, dim int, x binary, ids binary, mults binary, cells binary, run int"
)


def blocked(
    good: DataFrame, dtype: type, at_least: float, margin: float, cell_rows: int | None, sample_rows: int, block_rows: int
) -> tuple[DataFrame, Broadcast, dict[int, int]]:
    """The different vectors, the links within each block, and the blocks themselves of labels that have several (BLOCKS).

    Rows of three forms: label to mult for a different vector; a, b, n as linked() gives them; at to run for a block, which
    has the place `at` among those from `first` to `last` of its label. Labels with several blocks are dealt to runs, whose
    numbers of blocks come third; the centres by dimension come second.
    """
    spark = good.sparkSession
    sizes = cut(good.groupBy("label", "dim").agg(F.approx_count_distinct("h_0").alias("n")), "sizes")
    dims = sizes.groupBy("dim").agg(F.max("n").alias("most"), F.sum("n").alias("all")).collect()
    several = {(r["label"], r["dim"]) for r in sizes.where(F.col("n") > block_rows).collect()}
    centres = {}
    for r in dims:
        per = cell_rows or max(ceil(sqrt(r["most"])), min(1024, block_rows))
        k = max(1, -(-r["most"] // per))
        share = min(1.0, max(sample_rows, 8 * k) / max(1, r["all"]))
        draw = F.pmod("h_0", F.lit(1 << 40)) < int((1 << 40) * share)
        rows = good.where((F.col("dim") == r["dim"]) & draw).groupBy("h_0", "h_1").agg(F.first("e").alias("e")).orderBy("h_0", "h_1").select("e") if k > 1 else None
        picked = unit(np.array([x["e"] for x in rows.collect()], float).reshape(-1, r["dim"])) if rows is not None else np.zeros((0, 0))
        centres[r["dim"]] = (spherical_kmeans(picked, k) if len(picked) else np.ones((1, r["dim"])) / sqrt(r["dim"])).astype(np.float32)
    shared = spark.sparkContext.broadcast(centres)

    def home(e: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
        raw = e.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        u = np.zeros((-(-len(raw) // 1024) * 1024, dim), np.float32)  # products of one shape round alike for equal vectors
        u[: len(raw)] = unit(raw.astype(float))
        return raw, best_fit(u, shared.value[dim])[0][: len(raw)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dim in b.column(3).unique().to_pylist():
                part = b.filter(pc.equal(b.column(3), dim))
                cell = pa.array(home(part.column(1), dim)[1].astype(np.int32))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(3), cell, part.column(2)], ["label", "dim", "cell", "h_0"])

    runs: dict[int, int] = {}
    places: dict[tuple[str, int], tuple[int, int, np.ndarray, np.ndarray]] = {}  # run, first block, rows before each cell, rows of it
    if several:
        large = sizes.where(F.col("n") > block_rows).select("label", "dim")
        counted = good.join(F.broadcast(large), ["label", "dim"], "left_semi").select("label", "e", "h_0", "dim").mapInArrow(count, "label string, dim int, cell int, h_0 long")
        rows_in = {key: np.zeros(len(centres[key[1]]), np.int64) for key in several}
        for r in counted.groupBy("label", "dim", "cell").agg(F.approx_count_distinct("h_0").alias("n")).collect():
            rows_in[r["label"], r["dim"]][r["cell"]] = r["n"]
        run, first, held = 0, 0, 0
        for key in sorted(rows_in):
            n = rows_in[key]
            blocks = int(n.sum()) // block_rows + 1
            run, held = (run + 1, blocks) if held and held + blocks > 64 else (run, held + blocks)
            places[key] = (run, first, np.cumsum(n) - n, n)
            runs[run] = held
            first += blocks
    where = spark.sparkContext.broadcast(places)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dim in b.column(5).unique().to_pylist():
                part = b.filter(pc.equal(b.column(5), dim))
                label = part.column(1).dictionary_encode()
                code, h_0, h_1 = label.indices.to_numpy(), part.column(3).to_numpy(), part.column(4).to_numpy()
                order = np.lexsort((h_1, h_0, code))
                new = np.ones(len(order), bool)
                new[1:] = (np.diff(code[order]) != 0) | (np.diff(h_0[order]) != 0) | (np.diff(h_1[order]) != 0)
                start = np.flatnonzero(new)
                rep = np.minimum.reduceat(part.column(0).to_numpy()[order], start)
                mult = np.diff(np.append(start, len(order)))
                at = order[start]
                part, code, h_0 = part.take(pa.array(at)), code[at], h_0[at]
                raw, cell = home(part.column(2), dim)
                no = np.zeros(len(at), np.int64)
                for i, name in enumerate(label.dictionary.to_pylist()):
                    if (name, dim) in where.value:
                        mine = np.flatnonzero(code == i)
                        _, first, before, n = where.value[name, dim]
                        c = cell[mine]
                        part_of = (h_0[mine].view(np.uint64) >> np.uint64(11)).astype(float) / (1 << 53)  # a larger cell goes to chunks
                        no[mine] = first + np.minimum((before[c] + np.where(n[c] > block_rows, part_of * n[c], 0)) // block_rows, n.sum() // block_rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), part.column(5), pa.array(no.astype(np.int32)), pa.array(cell.astype(np.int32)), part.column(3), part.column(4), pa.array(rep), pa.array(mult, pa.int64()), fixed(raw)],
                    ["label", "dim", "no", "cell", "h_0", "h_1", "rep", "mult", "x"],
                )

    names = [f.split()[0] for f in BLOCKS.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[f.split()[1]]) for n, f in zip(names, BLOCKS.split(", "))])

    def filled(columns: dict[str, pa.Array], rows: int) -> pa.Table:
        return pa.table([columns[f.name] if f.name in columns else pa.nulls(rows, f.type) for f in schema], schema=schema)

    def within(block: pa.Table) -> pa.Table:
        col = {n: block.column(n).combine_chunks() for n in block.schema.names}
        label, dim = col["label"][0].as_py(), col["dim"][0].as_py()
        h_0, h_1, cell = (col[n].to_numpy(zero_copy_only=False) for n in ("h_0", "h_1", "cell"))
        order = np.lexsort((h_1, h_0, cell))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(h_0[order]) != 0) | (np.diff(h_1[order]) != 0)
        start = np.flatnonzero(new)
        at = order[start]
        rep = np.minimum.reduceat(col["rep"].to_numpy()[order], start)
        mult = np.add.reduceat(col["mult"].to_numpy()[order], start)
        offsets = np.frombuffer(col["x"].buffers()[1], np.int32)[col["x"].offset :]
        raw = np.frombuffer(col["x"].buffers()[2], np.uint8)[offsets[0] : offsets[len(col["x"])]].view(dtype).reshape(-1, dim)[at]
        of = Block(raw, rep, mult, cell[at])
        own = linked(of, of, shared.value[dim], at_least, margin)
        run = lambda n, r=-1: pa.array(np.full(n, r, np.int32))
        out = [
            filled({"label": pa.array([label] * len(at)), "h_0": pa.array(h_0[at]), "h_1": pa.array(h_1[at]), "rep": pa.array(rep), "mult": pa.array(mult), "run": run(len(at))}, len(at)),
            filled({"a": own["a"], "b": own["b"], "n": own["n"], "run": run(len(own))}, len(own)),
        ]
        if (label, dim) in where.value:
            part, first, _, n = where.value[label, dim]
            one = {"at": col["no"][0].as_py(), "first": first, "last": first + int(n.sum()) // block_rows, "dim": dim, "x": raw.tobytes(), "ids": rep.tobytes(), "mults": mult.tobytes()}
            one |= {"cells": of.cell.astype(np.int32).tobytes(), "run": part}
            out.append(filled({k: pa.array([x], schema.field(k).type) for k, x in one.items()}, 1))
        return pa.concat_tables(out)

    dealt = good.select("vec_id", "label", "e", "h_0", "h_1", "dim").mapInArrow(
        deal, "label string, dim int, no int, cell int, h_0 long, h_1 long, rep long, mult long, x binary"
    )
    return dealt.groupBy("label", "dim", "no").applyInArrow(within, BLOCKS), shared, runs


def across(blocks: DataFrame, n: int, centres: Broadcast, dtype: type, at_least: float, margin: float) -> DataFrame:
    """a, b, n as linked() gives them for every two of the n blocks of a label.

    Tasks read the written blocks, so that none is shuffled, whatever the number of blocks that it meets.
    """
    spark = blocks.sparkSession

    def side(name: str) -> DataFrame:
        return blocks.coalesce(max(1, min(64, -(-n // 4)))).select(*(F.col(c).alias(f"{name}_{c}") for c in fields))

    fields = ["at", "first", "last", "dim", "x", "ids", "mults", "cells"]
    one, two = F.col("one_at"), F.col("two_at")
    of_one_label = two.between(F.col("one_first"), F.col("one_last")) & (one != two)
    pairs = side("one").crossJoin(side("two")).where(of_one_label & ((one < two) == ((one + two) % 2 == 0)))  # half of them from each side
    pairs = pairs.select("one_dim", *(f"{side_}_{c}" for side_ in ("one", "two") for c in fields[4:]))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                dim = b.column(0)[i].as_py()
                x = [np.frombuffer(b.column(c)[i].as_buffer(), kind) for c, kind in enumerate((dtype, np.int64, np.int64, np.int32) * 2, 1)]
                met = [Block(x[k].reshape(-1, dim), *x[k + 1 : k + 4]) for k in (0, 4)]
                yield from linked(*met, centres.value[dim], at_least, margin).combine_chunks().to_batches()

    conf, key = spark.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(key)
    conf.set(key, "1")  # a row is two blocks
    try:
        return cut(pairs.mapInArrow(compare, "a long, b long, n long"), "met")
    finally:
        conf.set(key, before)
