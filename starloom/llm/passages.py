"""What the two passage operators share: words, content-selected positions, sorted neighbours and cut-out stretches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from starloom.llm.common import bounded_batches, cut

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse
INVERSE = pow(BASE, -1, 1 << 64)
PIECE = 1 << 18  # bytes of text that are hashed at a time, or one longer text


def words_of(text: str | None) -> list[bytes]:
    """The words between ASCII blanks, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(x: int, n: int) -> np.ndarray:
    out = np.full(n, x, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Spans:
    """Hashes of runs of a sequence from its prefix sums of values times powers: equal runs hash alike wherever they lie."""

    _powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))

    def __init__(self, values: np.ndarray):
        n = len(values) + 1
        if len(Spans._powers[0]) < n:
            size = max(n, 1 << 18)
            Spans._powers = tuple(powers(x, size) for x in (BASE, INVERSE))
        self.back = Spans._powers[1]
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(values * Spans._powers[0][: n - 1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


def hashed_words(part: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hashes of the words part[start:stop], over about PIECE bytes at a time (or one longer word)."""
    out, i = np.zeros(len(starts), np.uint64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(stops, starts[i] + PIECE, side="right")))
        low = starts[i]
        values = part[low : stops[j - 1]].astype(np.uint64) + np.uint64(1)
        out[i:j] = Spans(values).of(starts[i:j] - low, stops[i:j] - low)
        i = j
    return out


def pieces(
    column: pa.Array, blank: np.ndarray = BLANK, as_byte: np.ndarray | None = None, size: int = 0
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, word hashes, word offsets by row) for runs of rows of about `size` bytes; null texts have no words.

    Words are runs of bytes that are not blank; as_byte says as what each byte counts.
    """
    size = size or PIECE
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        last = max(row + 1, int(np.searchsorted(ends, ends[row] + size, side="right")) - 1)
        cuts = ends[row : last + 1] - ends[row]
        part = raw[ends[row] : ends[last]]
        border = np.zeros(len(part) + 1, bool)
        border[cuts] = True  # a text ends where the next begins
        inside = np.concatenate(([False], ~blank[part], [False]))
        starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | border[:-1]))
        stops = np.flatnonzero(inside[1:-1] & (~inside[2:] | border[1:])) + 1
        yield row, hashed_words(part if as_byte is None else as_byte[part], starts, stops), np.searchsorted(starts, cuts)
        row = last


def minimisers(grams: np.ndarray, window: int) -> np.ndarray:
    """Sorted positions of the least gram of each window of consecutive grams (the first of equals)."""
    n = len(grams)
    if n < window:
        return np.zeros(0, np.int64)
    low = np.uint64((1 << 24) - 1)
    out = []
    for i in range(0, n - window + 1, 1 << 23):
        part = grams[i : i + (1 << 23) + window - 1]
        least = (part & ~low) | np.arange(len(part), dtype=np.uint64)  # positions break ties
        size = 1
        while size < window:
            step = min(size, window - size)
            least = np.minimum(least[: len(least) - step], least[step:])
            size += step
        out.append((least & low).astype(np.int64) + i)
    at = np.concatenate(out)
    return at[np.concatenate(([True], at[1:] != at[:-1]))]


def packed(spans: Spans, start: np.ndarray, ends: list[np.ndarray], bits: int) -> np.ndarray:
    """One number that orders places by up to four stretches between consecutive borders, the first one first."""
    out = np.zeros(len(start), np.uint64)
    for end in ends:
        low, high = np.minimum(start, end), np.maximum(start, end)
        out = (out << np.uint64(bits)) | (spans.of(low, high) >> np.uint64(64 - bits))
        start = end
    return out


def selected_positions(
    docs: DataFrame, least_words: int, gram: int, window: int, reach: int, right: tuple, left: tuple, by_text: bool = False
) -> DataFrame:
    """key, r, l, unit, pos: the minimiser positions of each text of docs (unit, t) of least_words words or more.

    key hashes the `reach` words from pos. r and l order positions of one key by what follows and what precedes: each
    packs the hashes of four stretches, the borders of which (in words from pos) are in right and left. Positions with
    fewer than `reach` words after them are left out; stretches end with the text.

    by_text: a unit is a text, which several rows may hold; a task gives its positions once, and for each row of docs
    (unit, t, doc_id) one with pos -1, the doc_id as key and the number of words as r.
    """

    def names(units: np.ndarray, docs: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
        long = sizes >= least_words
        cols = [docs[long], sizes[long], np.zeros(long.sum(), np.int64), units[long]]
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols), pa.array(np.full(long.sum(), -1, np.int32))], ["key", "r", "l", "unit", "pos"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes: dict[int, int] = {}
        for b in batches:
            if by_text:
                whole, new = b, []
                for i, u in enumerate(b.column(0).to_pylist()):
                    if u not in sizes:
                        sizes[u] = 0
                        new.append(i)
                b = b.take(pa.array(new, pa.int64()))
            units = b.column(0).to_numpy(zero_copy_only=False)
            for first, h, at in pieces(b.column(1)):
                if by_text:
                    sizes.update(zip(units[first : first + len(at) - 1].tolist(), np.diff(at).tolist()))
                if len(h) < least_words:
                    continue
                spans = Spans(h)
                n = len(h) - gram + 1
                grams = spans.of(np.arange(n), np.arange(gram, n + gram))
                size = np.diff(at)
                row = np.repeat(np.arange(len(size)), size)
                start, end = at[:-1][row], at[1:][row]
                #: a window that runs on into the next text must not select: each text on its own
                pos = np.concatenate(
                    [minimisers(grams[s : e - gram + 1], window) + s for s, e in zip(at[:-1].tolist(), at[1:].tolist()) if e - s >= least_words]
                    or [np.zeros(0, np.int64)]
                )
                pos = pos[pos + reach <= end[pos]]
                if not len(pos):
                    continue
                s, e = start[pos], end[pos]
                after = packed(spans, pos + reach, [np.minimum(pos + x, e) for x in right], 16)
                before = packed(spans, pos, [np.maximum(pos - x, s) for x in left], 16)
                cols = [spans.of(pos, pos + reach), after, before]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array(c.view(np.int64), pa.int64()) for c in cols),
                        pa.array(units[first + row[pos]], pa.int64()),
                        pa.array((pos - s).astype(np.int32), pa.int32()),
                    ],
                    ["key", "r", "l", "unit", "pos"],
                )
            if by_text:
                every = whole.column(0).to_numpy(zero_copy_only=False)
                yield names(every, whole.column(2).to_numpy(zero_copy_only=False), np.array([sizes[u] for u in every.tolist()], np.int64))

    columns = ["unit", F.col("t").cast("binary"), *["doc_id"] * by_text]
    return docs.select(*columns).mapInArrow(run, "key long, r long, l long, unit long, pos int")


PAIR = ["a", "pa", "b", "pb"]
FOUND = "kind int, key long, r long, l long, a long, pa int, b long, pb int"
PAIRED, END, KIND, MET, EDGE = 0, 1, 2, 3, 4


def same_blocks(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many of the four leading 16-bit stretches of x and y are equal."""
    apart = x.view(np.uint64) ^ y.view(np.uint64)
    return sum((apart >> np.uint64(s) == 0).astype(np.int64) for s in (48, 32, 16, 0))


def neighbours_in_order(ordered: DataFrame, possible: Callable | None, kinds: bool, every: int = 0) -> DataFrame:
    """FOUND rows of positions that follow one another in the order (key, r, unit, pos) within each partition.

    Each position pairs with the nearest rows of other texts before and after it under its key, if possible(r blocks in
    common, l blocks in common) says that it may come to something; r and l of a PAIRED row are these counts. Rows of the
    kind END are the ends of the partition,
    from which pairs across partitions are made. With kinds, the rows that the other order has to look at are told as
    KIND: of keys that several texts hold (or that reach the partition's end), those but for rows in the middle of a run
    of equal r and l, which have partners alike on both sides. Keys of at most `every` rows give all their pairs of other
    texts as MET besides, with the key; EDGE rows are those of such keys at the ends of the partition, where a key may go
    on. Rows that are then equal in all columns count once.
    """

    def all_pairs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index pairs of the rows of each key of 3 to `every` rows, and whether a row's key has at most so many."""
        start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        size = np.diff(np.concatenate((start, [len(key)])))
        few = np.repeat(size <= every, size)
        after = np.repeat(start + size, size) - np.arange(len(key)) - 1
        many = np.where(few & np.repeat(size > 2, size), after, 0)
        i = np.repeat(np.arange(len(key)), many)
        return i, i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many), few

    def pairs(c: list[np.ndarray]) -> list[np.ndarray]:
        """Index pairs of rows: the nearest of another text before each row, and after the rows of a repeated text."""
        key, _, _, unit, _ = c
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (unit[1:] != unit[:-1])))
        at = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        stop = np.concatenate((at[1:], [len(key)]))
        rows = np.flatnonzero(run > 0)
        back = at[run[rows]] - 1
        rows, back = rows[key[rows] == key[back]], back[key[rows] == key[back]]
        many = np.flatnonzero((stop - at)[run] > 1)
        ahead = stop[run[many]]
        many, ahead = many[ahead < len(key)], ahead[ahead < len(key)]
        many, ahead = many[key[many] == key[ahead]], ahead[key[many] == key[ahead]]
        return [np.concatenate((rows, many)), np.concatenate((back, ahead))]

    def record(kind: int, c: list[np.ndarray], i: np.ndarray, j: np.ndarray | None = None, same=None) -> pa.RecordBatch:
        key, r, l_, unit, pos = c
        zero = np.zeros(len(i), np.int64)
        if j is None:
            cols = [key[i], r[i], l_[i], unit[i], pos[i], zero, zero]
        else:
            flip = unit[i] > unit[j]
            x, y = np.where(flip, j, i), np.where(flip, i, j)
            cols = [key[i] if kind == MET else zero, *same, unit[x], pos[x], unit[y], pos[y]]
        types = [pa.int64()] * 4 + [pa.int32(), pa.int64(), pa.int32()]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(i), kind, np.int32)), *(pa.array(x.astype(t.to_pandas_dtype()), t) for x, t in zip(cols, types))],
            ["kind", "key", "r", "l", "a", "pa", "b", "pb"],
        )

    def told(c: list[np.ndarray], edge: np.ndarray) -> np.ndarray:
        key, r, l_, unit, _ = c
        new_key = np.concatenate(([True], key[1:] != key[:-1]))
        new = new_key | np.concatenate(([True], unit[1:] != unit[:-1]))
        group = np.cumsum(new_key) - 1
        several = (np.bincount(group, new) > 1)[group] | np.isin(key, edge)
        other = new_key | np.concatenate(([True], (r[1:] != r[:-1]) | (l_[1:] != l_[:-1])))
        return np.flatnonzero(several & (other | np.concatenate((other[2:] & ~other[1:-1], [False, False]))[: len(key)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        first_key = None

        def done(c: list[np.ndarray], known: int, edge: list) -> Iterator[pa.RecordBatch]:
            """The rows from `known` on, which have not been paired with what comes before them."""
            i, j = pairs(c)
            fresh = np.maximum(i, j) >= known
            i, j = i[fresh], j[fresh]
            same = [same_blocks(c[1][i], c[1][j]), same_blocks(c[2][i], c[2][j])]
            if possible is not None and len(i):
                good = possible(*same)
                i, j, same = i[good], j[good], [x[good] for x in same]
            yield record(PAIRED, c, i, j, same)
            if every:
                #: a key whose first rows are gone already is no small one
                skip = int(np.searchsorted(c[0] != c[0][0], True)) if known else 0
                i, j, few = all_pairs(c[0][skip:])
                i, j, few = i + skip, j + skip, np.concatenate((np.zeros(skip, bool), few))
                i, j = i[c[3][i] != c[3][j]], j[c[3][i] != c[3][j]]
                for k in range(0, len(i), 1 << 18):
                    part = slice(k, k + (1 << 18))
                    yield record(MET, c, i[part], j[part], [same_blocks(x[i[part]], x[j[part]]) for x in c[1:3]])
                yield record(EDGE, c, np.flatnonzero(few & np.isin(c[0], np.array(edge, np.int64))))
            if kinds:
                at = told(c, np.array(edge, np.int64))
                yield record(KIND, c, at[at >= known])

        known = 0
        last = None
        for b in batches:
            new = [b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5)]
            if not len(new[0]):
                continue
            if every:
                ends, last = last, [int(c[-1]) for c in new]
                repeats = np.concatenate(([ends == [int(c[0]) for c in new]], np.logical_and.reduce([c[1:] == c[:-1] for c in new])))
                new = [c[~repeats] for c in new]
                if not len(new[0]):
                    continue
            if first_key is None:
                first_key = int(new[0][0])
                other = np.flatnonzero((new[3] != new[3][0]) | (new[0] != new[0][0]))[:1]
                yield record(END, new, np.concatenate(([0], other)).astype(np.int64))
            held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            key, unit = held[0], held[3]
            before = np.flatnonzero(key != key[-1])
            edge = int(before[-1]) + 1 if len(before) else 0
            if edge > known:
                part = [c[:edge] for c in held]
                yield from done(part, known, [first_key])
                held, known = [c[edge:] for c in held], 0
            elif len(key) > 1 << 20:  # a key of many rows: pair what there is, keep the last two texts
                yield from done(held, known, [first_key, int(key[-1])])
                changes = np.flatnonzero(unit[1:] != unit[:-1]) + 1
                keep = int(changes[-2]) if len(changes) > 1 else 0
                known = len(key) - keep
                held = [c[keep:] for c in held]
        if held is not None and len(held[0]):
            yield from done(held, known, [first_key, int(held[0][-1])])
            n = len(held[0])
            other = np.flatnonzero(held[3] != held[3][-1])[-1:]
            yield record(END, held, np.concatenate((other, [n - 1])).astype(np.int64))

    return ordered.mapInArrow(run, FOUND)


def across(found: DataFrame) -> DataFrame:
    """Pairs over the borders of partitions, from the END rows (a few for each partition)."""
    by_key = Window.partitionBy("key").orderBy("r", "a", "pa")
    ends = found.where(F.col("kind") == END).select("key", "r", "l", "a", "pa").distinct()
    steps = []
    for k in (1, 2, 3):
        steps.append(ends.select("a", "pa", F.lead("a", k).over(by_key).alias("b"), F.lead("pa", k).over(by_key).alias("pb")))
    both = steps[0].union(steps[1]).union(steps[2]).where("b is not null and b <> a")
    flip = F.col("a") > F.col("b")
    return both.select(
        F.lit(4).alias("alike"),
        F.when(flip, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(flip, F.col("pb")).otherwise(F.col("pa")).alias("pa"),
        F.when(flip, F.col("a")).otherwise(F.col("b")).alias("b"), F.when(flip, F.col("pa")).otherwise(F.col("pb")).alias("pb"),
    )


def sorted_neighbours(positions: DataFrame, possible: Callable | None = None, both_ways: bool = True, every: int = 0, by_text: bool = False) -> DataFrame:
    """alike, a, pa, b, pb (a < b, units): each position with its neighbours of other texts in suffix order.

    alike is the number of equal stretches before and after the positions' keys (4 where pairs span two partitions).

    Positions of a key are sorted by the words that follow, equal ones by text, over range partitions of the whole
    order, so a key that many texts hold is spread over tasks; what stands next to a position shares the longest stretch
    with it. Both ways: a second order sorts by the words before, of rows whose neighbours are not alike on both sides.
    All is linear in the positions. Keys that stand in at most `every` places pair all of them besides, with
    -1 - alike and the key (else null). What reads the result last may remove its scratch_tables. With by_text, positions
    are those of selected_positions by_text; `names` then has the rows of texts (unit, doc_id, n). neighbours has
    the rows but for those of all pairs.
    """
    table = cut(positions, "positions")
    if by_text:
        names = cut(table.where("pos < 0").select("unit", F.col("key").alias("doc_id"), F.col("r").alias("n")), "names")
        table, whole = table.where("pos >= 0"), table
    else:
        names, whole = None, table
    order = ["key", "r", "unit", "pos"]
    found = cut(neighbours_in_order(table.repartitionByRange(*order).sortWithinPartitions(*order), possible, both_ways, every), "neighbours", done=(whole,))
    paired = [F.expr("cast(r + l as int)").alias("alike"), *PAIR]
    borders = cut(found.where(F.col("kind").isin(END, EDGE)), "borders") if every else found  # a few rows for each partition
    out = found.where(F.col("kind") == PAIRED).select(*paired)
    beside = across(borders)
    made = [found]
    if both_ways:
        kinds = found.where(F.col("kind") == KIND).select("key", F.col("l").alias("r"), F.col("r").alias("l"), F.col("a").alias("unit"), F.col("pa").alias("pos"))
        turned = None if possible is None else lambda r, l_: possible(l_, r)
        more = cut(neighbours_in_order(kinds.repartitionByRange(*order).sortWithinPartitions(*order), turned, False), "turned-neighbours")
        made.append(more)
        beside = beside.union(more.where(F.col("kind") == PAIRED).select(*paired)).union(across(more))
    out = near = out.union(beside)
    if every:
        edge = borders.where(F.col("kind") == EDGE)
        one, other = (edge.select("key", F.col("a").alias(u), F.col("pa").alias(f"p{u}")) for u in ("a", "b"))
        over = one.join(other, "key").where("a < b").select(F.lit(-9).alias("alike"), *PAIR, "key")
        alike = F.expr(f"cast(case when kind = {MET} then -1 - r - l else r + l end as int)").alias("alike")
        both = found.where(F.col("kind").isin(PAIRED, MET)).select(alike, *PAIR, F.when(F.col("kind") == MET, F.col("key")).alias("key"))
        out = both.union(beside.withColumn("key", F.lit(None).cast("long"))).union(over)
    out.scratch_tables, out.names, out.neighbours = tuple(made), names, near
    return out


def stretches(docs: DataFrame, wanted: DataFrame, extra: T.StructType) -> DataFrame:
    """The words lo..hi of each wanted stretch (unit, pair, side, lo, hi, extra) of docs (unit, doc_id, t).

    Rows: pair, side, doc_id, lo, words, more (words follow), extra. wanted holds a bounded number of stretches per text
    (by its selected positions).
    """
    lists = wanted.groupBy("unit").agg(F.collect_list(F.struct("pair", "side", "lo", "hi", "extra")).alias("asked"))
    joined = docs.join(lists, "unit").select("doc_id", F.col("t").cast("binary"), "asked")
    kind = T.StructType.fromDDL("pair long, side int, doc_id long, lo long, words binary, more boolean").add("extra", extra)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(2)
            ends, every = lists.offsets.to_numpy().tolist(), lists.values.flatten()
            low = np.maximum(every[2].to_numpy(zero_copy_only=False), 0)
            high = every[3].to_numpy(zero_copy_only=False)
            docs_, words, more, size, first = [], [], [], 0, ends[0]

            def out(first: int, last: int) -> pa.RecordBatch:
                part = [c.slice(first, last - first) for c in every]
                cols = [part[0], part[1], pa.array(docs_, pa.int64()), pa.array(low[first:last]), pa.array(words, pa.binary()), pa.array(more), part[4]]
                return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, arrow)], schema=arrow)

            for k, (i, t) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                ws = t.split()
                for x, y in zip(low[ends[k] : ends[k + 1]].tolist(), high[ends[k] : ends[k + 1]].tolist()):
                    words.append(b" ".join(ws[x:y]))
                    docs_.append(i)
                    more.append(y < len(ws))
                    size += len(words[-1])
                if size > 1 << 23:
                    yield out(first, ends[k + 1])
                    docs_, words, more, size, first = [], [], [], 0, ends[k + 1]
            yield out(first, ends[-1])

    return joined.mapInArrow(run, kind)


GROUP = "grp long, unit long, doc_id long, lo long, words binary, more boolean, asked array<struct<pair:long,other:long,lo:long,hi:long,other_lo:long,other_hi:long>>"


def group_stretches(docs: DataFrame, names: DataFrame, pairs: DataFrame) -> DataFrame:
    """GROUP rows: of each text of a group of pairs, once, the words that its pairs there ask for, and the pairs it is a of.

    docs (unit, doc_id, t) and names (unit, doc_id) have a row for each copy of a text; the least doc_id stands for all.
    """
    side_a = pairs.select(F.col("a").alias("unit"), "grp", "pair", F.col("b").alias("other"), F.col("a_lo").alias("lo"), F.col("a_hi").alias("hi"), "b_lo", "b_hi")
    none = F.lit(None).cast("long")
    side_b = pairs.select("b", "grp", "pair", none, "b_lo", "b_hi", none, none)
    lists = side_a.union(side_b).groupBy("unit").agg(F.collect_list(F.struct("grp", "pair", "other", "lo", "hi", "b_lo", "b_hi")).alias("asked"))
    lists = lists.join(names.groupBy("unit").agg(F.min("doc_id").alias("doc_id")), "unit")
    joined = docs.hint("merge").join(lists, ["unit", "doc_id"]).select("unit", "doc_id", F.col("t").cast("binary"), "asked")
    arrow = to_arrow_schema(T.StructType.fromDDL(GROUP))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            units, docs_ = b.column(0).to_numpy(), b.column(1).to_numpy()
            ends = b.column(3).offsets.to_numpy() - b.column(3).offsets[0].as_py()
            row = np.repeat(np.arange(len(b)), np.diff(ends))
            every = b.column(3).flatten()
            grp = every.field(0).to_numpy()
            order = np.lexsort((grp, row))
            row, grp, every = row[order], grp[order], every.take(pa.array(order))
            first = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (grp[1:] != grp[:-1]))))
            low = np.maximum(np.minimum.reduceat(every.field(3).to_numpy(), first), 0)
            high = np.maximum.reduceat(every.field(4).to_numpy(), first)
            is_a = every.field(2).is_valid().to_numpy(zero_copy_only=False)
            asked = [every.field(k).filter(pa.array(is_a)) for k in range(1, 7)]
            offsets = np.concatenate(([0], np.cumsum(np.add.reduceat(is_a.astype(np.int64), first)))).astype(np.int32)
            row, grp = row[first], grp[first]

            def out(i: int, j: int, words: list, more: list) -> pa.RecordBatch:
                part = slice(offsets[i], offsets[j])
                own = pa.StructArray.from_arrays([c[part] for c in asked], ["pair", "other", "lo", "hi", "other_lo", "other_hi"])
                cols = [grp[i:j], units[row[i:j]], docs_[row[i:j]], low[i:j], pa.array(words, pa.binary()), pa.array(more), pa.ListArray.from_arrays(pa.array(offsets[i : j + 1] - offsets[i]), own)]
                return pa.RecordBatch.from_arrays([(c if isinstance(c, pa.Array) else pa.array(c)).cast(f.type) for c, f in zip(cols, arrow)], schema=arrow)

            words, more, size, start, at = [], [], 0, 0, -1
            for k, (i, x, y) in enumerate(zip(row.tolist(), low.tolist(), high.tolist())):
                if i != at:
                    at, ws = i, b.column(2)[i].as_py().split()
                words.append(b" ".join(ws[x:y]))
                more.append(y < len(ws))
                size += len(words[-1])
                if size > 1 << 23:
                    yield out(start, k + 1, words, more)
                    words, more, size, start = [], [], 0, k + 1
            if words:
                yield out(start, len(row), words, more)

    return joined.mapInArrow(run, GROUP)


def compared_in_groups(docs: DataFrame, names: DataFrame, pairs: DataFrame, prepared: Callable, match: Callable, schema: str, near: int = 2) -> DataFrame:
    """`compared` where pairs have a group, grp, instead of extra, whose texts one task gets once for all pairs of it.

    A text is a unit, of which docs may hold copies; rows name the least doc_id of names. prepared(numbers of words, their
    bound) gives a function of low and high, and match(x, y) gets what it returns for two stretches. A group should hold a
    bounded number of texts; pairs that are compared again over more than some hundred words more are so alone.
    """
    names_ = T.StructType.fromDDL(schema).names
    kind = T.StructType.fromDDL(f"{schema}, pair long, again boolean")
    arrow = to_arrow_schema(kind)

    def of_group(batch: pa.RecordBatch) -> list[tuple]:
        """Result rows of whole groups."""
        grp, unit, doc, lo, more = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 2, 3, 5))
        lists = batch.column(6)
        ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        asked = list(zip(*(lists.flatten().field(k).to_pylist() for k in range(6))))
        text = batch.column(4)
        split = pc.split_pattern(text, b" ")
        coded = split.flatten().dictionary_encode()
        begin = split.offsets.to_numpy() - split.offsets[0].as_py()
        length = np.where(pc.binary_length(text).to_numpy(zero_copy_only=False) > 0, np.diff(begin), 0).tolist()
        begin, lo = begin.tolist(), lo.tolist()
        stretch = prepared(coded.indices.to_numpy().astype(np.int64), len(coded.dictionary))
        out = []
        first = np.flatnonzero(np.concatenate(([True], grp[1:] != grp[:-1]))).tolist()
        for start, stop in zip(first, [*first[1:], len(grp)]):
            at = {u: i for i, u in enumerate(unit[start:stop].tolist(), start)}  # a repeated row brings its stretch again
            known: dict = {}

            def side(i: int, low: int, high: int) -> tuple:
                low = max(low, 0)
                key = (i, low, high)
                if key not in known:
                    start = low - lo[i]
                    end = max(start, min(high - lo[i], length[i]))
                    known[key] = stretch(begin[i] + start, begin[i] + end), low, end - start, high < lo[i] + length[i] or bool(more[i])
                return known[key]

            for i in at.values():
                for pair, other, a_lo, a_hi, b_lo, b_hi in asked[ends[i] : ends[i + 1]]:
                    if other not in at:
                        continue
                    j = at[other]
                    (x, x0, x_size, x_more), (y, y0, y_size, y_more) = side(i, a_lo, a_hi), side(j, b_lo, b_hi)
                    got = match(x, y)
                    again = any(
                        (x0 > 0 and s < near) or (y0 > 0 and u < near) or (x_more and e > x_size - near) or (y_more and v > y_size - near)
                        for s, e, u, v, *_ in got
                    )
                    for s, e, u, v, *rest in got:
                        one, two = (int(doc[i]), x0 + s, x0 + e), (int(doc[j]), y0 + u, y0 + v)
                        out += [(*one, *two, *rest, pair, again), (*two, *one, *rest, pair, again)]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            rows = of_group(part)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

        held = None
        for batch in batches:
            if not len(batch):
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            grp = batch.column(0).to_numpy()
            last = int(np.searchsorted(grp, grp[-1]))
            if last:
                yield from done(batch.slice(0, last))
            held = batch.slice(last)
        if held is not None:
            yield from done(held)

    out = None
    for wider in (500, 8000, 1 << 40, 0):
        pairs = cut(pairs, "pairs")
        rows = group_stretches(docs, names, pairs).repartition("grp").sortWithinPartitions("grp")
        found = cut(rows.mapInArrow(run, kind), "compared")
        good = (found.where("not again") if wider else found).select(*names_)
        out = good if out is None else out.union(good)
        again = found.where("again").select("pair").distinct()
        if not wider or again.isEmpty():
            return out
        sides = ((F.col(c) - wider if c.endswith("lo") else F.col(c) + wider).alias(c) for c in ("a_lo", "a_hi", "b_lo", "b_hi"))
        pairs = pairs.join(again, "pair", "left_semi").select("pair", (F.col("grp") if wider < 8000 else F.col("pair")).alias("grp"), "a", "b", *sides)
        if wider == 500:  # only a few texts are asked again
            pairs = cut(pairs, "again")
            units = pairs.select(F.col("a").alias("unit")).union(pairs.select("b")).distinct()
            units = names.join(units, "unit", "left_semi").groupBy("unit").agg(F.min("doc_id").alias("doc_id"))
            docs = cut(docs.hint("merge").join(units, ["unit", "doc_id"]).select("unit", "doc_id", "t"), "texts")
    return out


MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # the first k bytes of a little-endian number
SLICE = 1 << 21  # bytes of stretches that are compared at a time, or one longer pair


class Words:
    """The words of stretches (words joined by one blank): where each begins, its bytes, and words[at[i]:at[i + 1]] of row i."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_binary())
        _, offsets, data = column.buffers()
        ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.bytes = np.concatenate((raw[ends[0] : ends[-1]], np.zeros(8, np.uint8)))
        size = int(ends[-1] - ends[0])
        ends = ends - ends[0]
        filled = ends[1:] > ends[:-1]
        blanks = np.flatnonzero(self.bytes[:size] == 0x20)
        first, last = np.zeros(size + 1, bool), np.zeros(size + 1, bool)
        first[blanks + 1] = last[blanks] = True
        first[ends[:-1][filled]] = last[ends[1:][filled]] = True
        self.start = np.flatnonzero(first)
        self.length = np.flatnonzero(last) - self.start
        self.at = np.searchsorted(self.start, ends)
        #: the eight bytes from each place on as one number
        self.eight = np.ndarray((size + 1,), "<u8", self.bytes, strides=(1,))

    def same(self, i: np.ndarray, other: Words, j: np.ndarray) -> np.ndarray:
        """Whether the words i are those of other at j, byte by byte."""
        length = self.length[i]
        same = length == other.length[j]
        s, t = self.start[i], other.start[j]
        live = np.flatnonzero(same)
        for done in range(0, 64, 8):
            mask = MASKS[np.minimum(length[live] - done, 8)]
            alike = (self.eight[s[live] + done] & mask) == (other.eight[t[live] + done] & mask)
            same[live[~alike]] = False
            live = live[alike & (length[live] > done + 8)]
            if not len(live):
                return same
        for k in live.tolist():  # words of more than 64 bytes
            n = length[k]
            same[k] = np.array_equal(self.bytes[s[k] : s[k] + n], other.bytes[t[k] : t[k] + n])
        return same


def slices_of(a: pa.Array, b: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose stretches hold about SLICE bytes on the longer side."""
    size = np.cumsum(np.maximum(pc.binary_length(a).to_numpy(zero_copy_only=False), pc.binary_length(b).to_numpy(zero_copy_only=False)).astype(np.int64))
    i = 0
    while i < len(size):
        j = max(i + 1, int(np.searchsorted(size, (size[i - 1] if i else 0) + SLICE, side="right")))
        yield i, j
        i = j


def one_by_one(match: Callable) -> Callable:
    """A match of one pair as one of all pairs of a batch."""

    def run(a: pa.Array, b: pa.Array, lo_a: np.ndarray, lo_b: np.ndarray, extra: pa.Array) -> tuple:
        at, rows, sizes = [], [], []
        for i, (x, y, more, low, other) in enumerate(zip(a.to_pylist(), b.to_pylist(), extra.to_pylist(), lo_a.tolist(), lo_b.tolist())):
            x, y = x.split(), y.split()
            sizes.append((len(x), len(y)))
            for row in match(x, y, more, low, other):
                at.append(i)
                rows.append(row)
        return np.array(at, np.int64), [np.array(c) for c in zip(*rows)], *np.array(sizes, np.int64).T

    return run


def compared(docs: DataFrame, pairs: DataFrame, match: Callable, schema: str, near: int = 2, batches: bool = False) -> DataFrame:
    """match(words of a, words of b, extra) of every pair: rows (doc_id, start, end, other, other_start, other_end, ...).

    pairs: pair (unique long), a, a_lo, a_hi, b, b_lo, b_hi, extra (a struct). match yields tuples of start and end in
    a, start and end in b (relative to the stretches) and further values; match(x, y, extra, lo_a, lo_b) gets where the
    stretches begin. With batches, it gets all pairs of a batch as arrays, each stretch as words joined by blanks, and
    returns the pairs' places in the batch, those values as columns, and the numbers of words of all stretches of a and
    of b. A pair with a match that comes within `near` words of a stretch's edge, where the text goes on, is
    compared again over wider stretches, at last over both whole texts.
    """
    names = T.StructType.fromDDL(schema).names
    docs = docs.hint("merge")  # what is asked of texts grows with them: no size at which it is broadcast
    out = None
    for wider in (500, 8000, 1 << 40):
        pairs = cut(pairs, "pairs")
        found = cut(compared_once(docs, pairs, match, schema, near, batches), "compared")
        good = found.where("not again").select(*names)
        out = good if out is None else out.union(good)
        again = found.where("again").select("pair").distinct()
        if again.isEmpty():
            return out
        low, high = ((lambda c: F.col(c) - wider), (lambda c: F.col(c) + wider))
        pairs = pairs.join(again, "pair", "left_semi").select(
            "pair", "a", "b", "extra", *(f(c).alias(c) for c, f in (("a_lo", low), ("a_hi", high), ("b_lo", low), ("b_hi", high)))
        )
    return out.union(compared_once(docs, pairs, match, schema, near, batches).select(*names))


def compared_once(docs: DataFrame, pairs: DataFrame, match: Callable, schema: str, near: int, batches: bool = False) -> DataFrame:
    """The rows of `compared` over the stretches as they are, with pair and again (a match reaches a stretch's edge)."""
    extra = pairs.schema["extra"].dataType
    side_a = pairs.select(F.col("a").alias("unit"), "pair", F.lit(0).alias("side"), F.col("a_lo").cast("long").alias("lo"), F.col("a_hi").cast("long").alias("hi"), "extra")
    side_b = pairs.select(F.col("b").alias("unit"), "pair", F.lit(1).alias("side"), F.col("b_lo").cast("long").alias("lo"), F.col("b_hi").cast("long").alias("hi"), "extra")
    both = stretches(docs, side_a.union(side_b), extra).repartition("pair").sortWithinPartitions("pair", "side")
    kind = T.StructType.fromDDL(f"{schema}, pair long, again boolean")
    arrow = to_arrow_schema(kind)
    match = match if batches else one_by_one(match)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            pair, side, doc, lo, more = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 2, 3, 5))
            held = batch.slice(len(pair) - 1) if len(pair) and side[-1] == 0 else None
            #: a repeated row brings its stretch again: the last of one side meets the first of the other
            b = np.flatnonzero((side[1:] == 1) & (side[:-1] == 0) & (pair[1:] == pair[:-1])) + 1
            if not len(b):
                continue
            a = b - 1
            i, found, in_a, in_b = match(batch.column(4).take(pa.array(a)), batch.column(4).take(pa.array(b)), lo[a], lo[b], batch.column(6).take(pa.array(b)))
            if not len(i):
                continue
            s, e, u, v, *rest = found
            edge = ((lo[a][i] > 0) & (s < near)) | ((lo[b][i] > 0) & (u < near))
            edge |= (more[a][i] & (e > in_a[i] - near)) | (more[b][i] & (v > in_b[i] - near))
            again = np.zeros(len(a), bool)
            again[i[edge]] = True
            one, other = ([doc[k][i], lo[k][i] + x, lo[k][i] + y] for k, x, y in ((a, s, e), (b, u, v)))
            last = [*rest, pair[a][i], again[i]]
            cols = [np.concatenate(c) for c in zip([*one, *other, *last], [*other, *one, *last])]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow)], schema=arrow)

    return both.mapInArrow(run, kind)


def texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """unit, doc_id, t of the rows that have both; a unit is a text under an id, so rows that repeat both are one."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    return bounded_batches(src).where("doc_id is not null and t is not null").select(F.xxhash64("doc_id", "t").alias("unit"), "doc_id", "t")
