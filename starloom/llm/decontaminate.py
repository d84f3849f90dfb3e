"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact verification.

A window of an item's length is fingerprinted over its weighted five-word shingles. The 64 bits are looked up in eight
blocks of eight bits: within `radius` bits in all, some block differs by at most radius // 8 bits, so tables of the item
fingerprints within that many bits of each block value give every item in the radius. What they give is checked on all
bits and then by exact weighted Jaccard similarity. A window that shares no shingle with any item has similarity 0, so
only windows that hold an item's shingle are fingerprinted; nothing is lost by that.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import bounded_batches, cut

WORDS = re.compile(r"\w+")
ODD = np.uint64(0x9E3779B97F4A7C15)
HITS = "array<struct<item_id:bigint,start_word:bigint,end_word:bigint,hamming:int,similarity:double>>"


def tokens(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def word_hash(w: str) -> int:
    return xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"), 7) | 1


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A mixed 64-bit hash of each run of `width` words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = words[:n].copy()
    for i in range(1, width):
        h = (h ^ (h >> np.uint64(29))) * ODD + words[i : n + i]
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def signs(hashes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int64) * 2 - 1


class Index:
    """The items of one slice: shingles with weights, and per item length the fingerprints and their block tables.

    The weights follow from in how many of all n_items items a shingle occurs (seen), so they are the same in any slice.
    """

    def __init__(
        self, items: list[tuple[int | None, str | None]], width: int, radius: int, at_least: float,
        n_items: int | None = None, seen: dict[int, int] | None = None,
    ):
        self.width, self.radius, self.at_least = width, radius, at_least
        parsed = [(i, tokens(t)) for i, t in items]
        self.items = [(i, np.array([word_hash(w) for w in ws], np.uint64)) for i, ws in parsed if ws]
        self.words = {w: word_hash(w) for _, ws in parsed for w in ws}
        self.shingles = [shingle_hashes(h, min(width, len(h))) for _, h in self.items]
        if seen is None:  # these are all items
            n_items, seen = len(self.items), Counter(s for h in self.shingles for s in set(h.tolist()))
        #: whole numbers, so that sums over a window are exact however they are formed
        self.rare = round(1000 * log(1 + max(1, n_items)))
        self.weight = {s: round(1000 * log(1 + n_items / n)) for s, n in seen.items()}
        self.counts = [Counter(h.tolist()) for h in self.shingles]
        by_size: dict[int, list[int]] = {}
        for k, (_, h) in enumerate(self.items):
            by_size.setdefault(len(h), []).append(k)
        self.by_size = {n: np.array(ks) for n, ks in by_size.items()}
        self.prints = np.array([self.fingerprint(h) for h in self.shingles], np.uint64)
        apart = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :])
        self.tables = {}
        for n, ks in self.by_size.items():
            own = self.prints[ks].view(np.uint8).reshape(-1, 8)
            self.tables[n] = np.stack([apart[:, own[:, b]] <= radius // 8 for b in range(8)])
        at: dict[int, dict[int, set[int]]] = {}
        for k, h in enumerate(self.shingles):
            lists = at.setdefault(min(width, len(self.items[k][1])), {})
            for s in h.tolist():
                lists.setdefault(s, set()).add(len(self.items[k][1]))
        #: by shingle width: the sorted shingles, and of each the item lengths that have it
        self.anchors = {}
        for k, lists in at.items():
            keys = np.array(sorted(lists), np.uint64)
            self.anchors[k] = (keys, [sorted(lists[s]) for s in keys.tolist()])

    def fingerprint(self, hashes: np.ndarray) -> int:
        weights = np.array([self.weight.get(s, self.rare) for s in hashes.tolist()])
        total = (signs(hashes) * weights[:, None]).sum(axis=0)
        return int(np.packbits(total > 0, bitorder="little").view(np.uint64)[0])

    def similarity(self, window: Counter, item: Counter) -> float:
        both = sum(min(n, item[s]) * self.weight.get(s, self.rare) for s, n in window.items() if s in item)
        total = sum(n * self.weight.get(s, self.rare) for s, n in window.items())
        total += sum(n * self.weight[s] for s, n in item.items())
        return both / (total - both) if total > both else 1.0

    def hits(self, text: str | None) -> list[dict]:
        """The best window of each item that reaches the similarity; equal ones: the first."""
        ws = tokens(text)
        if not ws:
            return []
        get = self.words.get
        known = np.array([get(w, 0) for w in ws], np.uint64)
        runs = np.concatenate(([0], np.cumsum(known != 0)))
        starts: dict[int, list[np.ndarray]] = {}
        for k, (keys, sizes) in self.anchors.items():
            if len(ws) < k:
                continue
            at = np.flatnonzero(runs[k:] - runs[:-k] == k)
            if not len(at):
                continue
            h = shingle_hashes(known, k)[at]
            where = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            for p, j in zip(at[keys[where] == h].tolist(), where[keys[where] == h].tolist()):
                for n in sizes[j]:
                    if n < k or len(ws) <= n:
                        starts.setdefault(n, []).append(np.zeros(1, int))
                    else:
                        starts.setdefault(n, []).append(np.arange(max(0, p + k - n), min(p, len(ws) - n) + 1))
        if not starts:
            return []
        words = np.array([h or word_hash(w) for h, w in zip(known.tolist(), ws)], np.uint64)
        best: dict[int, tuple] = {}
        for n, runs_of in sorted(starts.items()):
            k = min(self.width, n)
            hashes = shingle_hashes(words, min(k, len(words)))
            weights = np.array([self.weight.get(s, self.rare) for s in hashes.tolist()])
            sums = np.concatenate((np.zeros((1, 64), np.int64), np.cumsum(signs(hashes) * weights[:, None], axis=0)))
            s = np.unique(np.concatenate(runs_of))
            e = np.minimum(s + n, len(ws))
            last = np.maximum(e - k + 1, s + 1).clip(max=len(hashes))
            prints = np.packbits(sums[last] - sums[s] > 0, axis=1, bitorder="little").view(np.uint64).ravel()
            blocks = prints.view(np.uint8).reshape(-1, 8)
            ks, table = self.by_size[n], self.tables[n]
            met = []
            for i in range(0, len(s), step := max(1, (1 << 22) // len(ks))):  # bounded, however many windows and items
                near = np.zeros((len(s[i : i + step]), len(ks)), bool)
                for b in range(8):
                    near |= table[b, blocks[i : i + step, b]]
                r, c = np.nonzero(near)
                met.append((r + i, c))
            row, col = (np.concatenate(x) for x in zip(*met))
            apart = np.bitwise_count(prints[row] ^ self.prints[ks[col]])
            windows: dict[int, Counter] = {}
            for r, c, d in zip(row[apart <= self.radius], col[apart <= self.radius], apart[apart <= self.radius]):
                if r not in windows:
                    windows[r] = Counter(hashes[s[r] : last[r]].tolist())
                item = int(ks[c])
                sim = self.similarity(windows[r], self.counts[item])
                if sim >= self.at_least and (item not in best or sim > best[item][3]):
                    best[item] = (int(s[r]), int(e[r]), int(d), sim)
        return [
            {"item_id": self.items[i][0], "start_word": a, "end_word": z, "hamming": d, "similarity": sim}
            for i, (a, z, d, sim) in sorted(best.items())
        ]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = 5,
    radius: int = 20,
    at_least: float = 0.8,
    slice_chars: int = 4_000_000,
    keep: list[str] | None = None,
) -> DataFrame:
    """doc_id, hits (and the columns named in keep) for every row of docs; hits lists the items found in its text.

    A hit names the item, the window's word range, the fingerprint distance and the similarity. The benchmark is read
    in slices of about slice_chars characters (by a hash of the item), each of them broadcast, so its size is bounded
    by the parameter and a larger benchmark means more passes. Weights come from all items, so hits are the same for any
    slice_chars. Items without words are left out, items with fewer words
    than the width are one shingle; null and empty texts have no hits; null ids, repeated rows and repeated items pass
    through (equal items once); an empty benchmark gives no hits; an empty table gives an empty result.
    """
    spark, keep = docs.sparkSession, keep or []
    bench = benchmark.select(
        F.col(item_col).cast("long").alias("i"), F.col(item_text_col).cast("string").alias("t")
    ).distinct()
    chars = bench.agg(F.sum(F.length("t"))).first()[0] or 0
    slices = max(1, ceil(chars / slice_chars))
    out = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("_text"),
        F.array().cast(HITS).alias("hits"),
        *[F.col(c).alias(f"_keep_{c}") for c in keep],
    )
    kind = pa.list_(
        pa.struct([("item_id", pa.int64()), ("start_word", pa.int64()), ("end_word", pa.int64()), ("hamming", pa.int32()), ("similarity", pa.float64())])
    )
    counts, n_items = item_counts(bench, width, slices)
    for n in range(slices):
        own = bench.where(F.pmod(F.xxhash64("i", "t"), F.lit(slices)) == n)
        items = sorted(((r["i"], r["t"]) for r in own.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
        seen = {r["s"] % (1 << 64): r["n"] for r in counts.where(F.col("slice") == n).select("s", "n").collect()}
        index = spark.sparkContext.broadcast(Index(items, width, radius, at_least, n_items, seen))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = [h + index.value.hits(t) for t, h in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
                cols = [b.column(0), b.column(1), pa.array(found, kind), *b.columns[3:]]
                yield pa.RecordBatch.from_arrays(cols, b.schema.names)

        if n:  # one index at a time: what the slices before have found is a table
            out = cut(out, "hits", done=(out,))
        out = bounded_batches(out).mapInArrow(run, out.schema)
    return out.select("doc_id", "hits", *[F.col(f"_keep_{c}").alias(c) for c in keep])


def item_counts(bench: DataFrame, width: int, slices: int) -> tuple[DataFrame, int]:
    """slice, s, n: of the shingles of each slice, in how many of all items (i, t) they occur; the number of items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part, own = [], []
            for t, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = np.array([word_hash(w) for w in tokens(t)], np.uint64)
                h = np.unique(shingle_hashes(words, min(width, len(words)))) if len(words) else words
                own.append(h)
                part.append(np.full(len(h), k, np.int32))
            if own:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(part), pa.int32()), pa.array(np.concatenate(own).view(np.int64), pa.int64())], ["slice", "s"])

    in_slice = F.pmod(F.xxhash64("i", "t"), F.lit(slices)).cast("int")
    shingles = bench.select("t", in_slice.alias("slice")).mapInArrow(run, "slice int, s long")
    total = shingles.groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    return shingles.distinct().join(total, "s"), bench.where(F.col("t").rlike(r"(?U)\w")).count()


