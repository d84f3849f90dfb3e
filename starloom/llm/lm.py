"""LM scoring by masked pseudo-likelihood.

A window network in numpy predicts every token from the two tokens on either side: context embeddings by offset, a tanh
layer, and a softmax in two steps (32 groups, then 32 classes within the group). The most frequent words of the corpus
are classes of their own, the rest share hashed classes; within a shared class a word has the share of the class's tokens
that it has in all texts. So every word of the corpus has a probability of its own, whatever the vocabulary's size: the
word counts are a table, and are joined to the words of the texts. A warm start on a bounded sample is trained on by every
partition over all its documents; the partitions' parameters, weighted by tokens, are averaged block by block. A
document's score is the sum of its tokens' conditional log-probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import bounded_batches, cut
from starloom.llm.passages import pieces

GROUPS = 32
CLASSES = GROUPS * GROUPS
EDGE = CLASSES  # stands beyond both ends of a text
OFFSETS = (-2, -1, 1, 2)
BLOCK = 1024
PIECE = 1 << 22
#: Tokens are runs of letters, digits, underscores and characters beyond ASCII; A-Z count as a-z.
APART = np.array([b < 128 and not (chr(b).isalnum() or b == 0x5F) for b in range(256)])
SMALL = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def token_pieces(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, word hashes, word offsets by row) of a text column, some megabytes at a time."""
    return pieces(column, APART, SMALL, PIECE)


class Classes:
    """Class of a word by its hash: own classes for the given words, shared ones for the rest."""

    def __init__(self, own: list[int]):
        self.own = np.sort(np.array(own, np.int64))

    def of(self, h: np.ndarray) -> np.ndarray:
        w = h.view(np.int64)
        n = len(self.own)
        shared = (n + np.mod(w, CLASSES - n)).astype(np.int32)
        if not n:
            return shared
        at = np.minimum(np.searchsorted(self.own, w), n - 1)
        return np.where(self.own[at] == w, at.astype(np.int32), shared)


class Network:
    """Parameters in one flat float32 vector: embeddings by offset and class, groups, classes, both with bias."""

    def __init__(self, width: int = 16, seed: int = 1):
        self.width = width
        shapes = [(len(OFFSETS) * (CLASSES + 1), width), (GROUPS, width + 1), (GROUPS, GROUPS, width + 1)]
        sizes = [int(np.prod(s)) for s in shapes]
        rng = np.random.default_rng(seed)
        self.flat = np.zeros(sum(sizes), np.float32)
        self.flat[: sizes[0]] = rng.normal(0, 0.1, sizes[0])
        ends = np.cumsum([0, *sizes])
        self.parts = [slice(a, b) for a, b in zip(ends, ends[1:])]
        self.shapes = shapes
        self.seen = np.full_like(self.flat, 0.1)  # Adagrad

    def views(self, flat: np.ndarray) -> list[np.ndarray]:
        return [flat[p].reshape(s) for p, s in zip(self.parts, self.shapes)]

    def forward(self, ctx: np.ndarray, target: np.ndarray, grad: bool = False):
        """Log-probabilities of the targets, and the gradient of their mean if asked for; ctx has a row by offset."""
        emb, top, sub = self.views(self.flat)
        n, d = len(target), self.width
        group = target // GROUPS
        order = np.argsort(group.astype(np.uint8), kind="stable")
        group, within, ctx = group[order], target[order] % GROUPS, ctx[:, order]
        h = np.ones((n, d + 1), np.float32)
        total = emb.take(ctx[0], axis=0)
        for c in ctx[1:]:
            total += emb.take(c, axis=0)
        np.tanh(total, out=h[:, :d])
        ends = np.cumsum(np.bincount(group, minlength=GROUPS)).tolist()
        spans = [(g, a, b) for g, (a, b) in enumerate(zip([0, *ends], ends)) if b > a]
        rows = np.arange(n)
        z = h @ top.T
        y = np.empty((n, GROUPS), np.float32)
        for g, a, b in spans:
            np.matmul(h[a:b], sub[g].T, out=y[a:b])
        logp = np.zeros(n, np.float32)
        ones = np.ones(GROUPS, np.float32)
        for scores, right in ((z, group), (y, within)):
            np.clip(scores, -60, 60, out=scores)  # weights stay small; keeps the exponentials finite
            logp += scores[rows, right]
            np.exp(scores, out=scores)
            whole = scores @ ones
            logp -= np.log(whole)
            if grad:
                scores /= whole[:, None]
        if not grad:
            out = np.empty(n, np.float32)
            out[order] = logp
            return out
        z[rows, group] -= 1
        y[rows, within] -= 1
        g_flat = np.zeros_like(self.flat)
        g_emb, g_top, g_sub = self.views(g_flat)
        np.matmul(z.T, h, out=g_top)
        back = z @ top[:, :d]
        for g, a, b in spans:
            np.matmul(y[a:b].T, h[a:b], out=g_sub[g])
            back[a:b] += y[a:b] @ sub[g][:, :d]
        back *= 1 - h[:, :d] ** 2
        for c in ctx:  # an offset has embeddings of its own
            by = np.argsort(c.astype(np.uint16), kind="stable")
            start = np.flatnonzero(np.concatenate(([True], np.diff(c[by]) != 0)))
            g_emb[c[by[start]]] = np.add.reduceat(back.take(by, axis=0), start, axis=0)
        g_flat /= n
        return logp, g_flat

    def step(self, ctx: np.ndarray, target: np.ndarray, rate: float) -> float:
        logp, g = self.forward(ctx, target, grad=True)
        self.seen += g * g * len(target)
        self.flat -= rate * np.sqrt(np.float32(len(target))) * g / np.sqrt(self.seen)
        return float(logp.mean())


def windows(classes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Contexts (4, n), shifted by offset, of the tokens of texts that begin at the offsets `at`."""
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    place = np.arange(len(classes)) + 2 * (text + 1)
    line = np.full(len(classes) + 2 * len(at), EDGE, np.int32)
    line[place] = classes
    return np.stack([line[place + o] + i * (CLASSES + 1) for i, o in enumerate(OFFSETS)])


def word_counts(texts: DataFrame) -> DataFrame:
    """w, n: the hash and the number of every word over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, h, _ in token_pieces(b.column(0)):
                w, n = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(n, pa.int64())], ["w", "n"])

    return texts.select(F.col("t").cast("binary")).mapInArrow(count, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))


def trained(texts: DataFrame, own: list[int], sample_rows: int, warm_rounds: int, batch: int, rate: float) -> Network:
    """The network: a warm start on sample_rows texts (the first by a hash), then one pass of every partition, averaged."""
    spark = texts.sparkSession
    order = F.xxhash64(F.lit(3), "doc_id", "t")
    hashed = texts.where("t is not null").withColumn("_h", order)
    least = hashed.select("_h").orderBy("_h").limit(sample_rows).collect()  # no texts yet: every task sends its first ones
    last = max((r["_h"] for r in least), default=None)
    sample = hashed.where(F.col("_h") <= F.lit(last).cast("long")).select("_h", F.col("t").cast("binary")).limit(sample_rows).collect()
    sample.sort(key=lambda r: (r["_h"], r["t"]))
    classes, net = Classes(own), Network()

    def batches_of(column: pa.Array, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for _, h, at in token_pieces(column):
            target = classes.of(h)
            ctx = windows(target, at)
            for i in range(0, len(target), size):
                yield ctx[:, i : i + size], target[i : i + size]

    for _ in range(warm_rounds):
        for ctx, target in batches_of(pa.array([bytes(r["t"]) for r in sample], pa.binary()), batch // 8):
            net.step(ctx, target, rate)
    start = spark.sparkContext.broadcast(net)

    def learn(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = start.value
        own_net = Network(first.width)
        own_net.flat, own_net.seen = first.flat.copy(), first.seen.copy()
        seen = 0
        for b in parts:
            for ctx, target in batches_of(b.column(0), batch):
                own_net.step(ctx, target, rate)
                seen += len(target)
        if seen:
            flat = own_net.flat.astype(float) * seen
            pieces_ = [flat[i : i + BLOCK] for i in range(0, len(flat), BLOCK)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(len(pieces_)), pa.int64()),
                    pa.array(np.full(len(pieces_), TaskContext.get().partitionId() // 64), pa.int64()),
                    pa.array([float(seen)] * len(pieces_), pa.float64()),
                    pa.array([p.astype(np.float32) for p in pieces_], pa.list_(pa.float32())),
                ],
                ["block", "part", "n", "v"],
            )

    def add(block: pa.Table) -> pa.Table:
        """Sum of the vectors of a block: at most 64 partitions', or one per 64 partitions."""
        order = np.argsort(block.column("n").to_numpy(), kind="stable")
        total = np.sum([np.asarray(block.column("v")[int(i)].values, float) for i in order], axis=0)
        return pa.table(
            {
                "block": block.column("block")[:1],
                "n": pa.array([float(np.sum(block.column("n").to_numpy()))]),
                "v": pa.array([total.astype(np.float32)], pa.list_(pa.float32())),
            }
        )

    schema = "block long, n double, v array<float>"
    sums = texts.select(F.col("t").cast("binary")).mapInArrow(learn, "block long, part long, n double, v array<float>")
    sums = sums.groupBy("block", "part").applyInArrow(add, schema).groupBy("block").applyInArrow(add, schema)
    rows = sorted(sums.collect(), key=lambda r: r["block"])
    if rows:
        net.flat = np.concatenate([np.array(r["v"], np.float32) / np.float32(r["n"]) for r in rows])
    return net


def pseudo_likelihood(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 768,
    sample_rows: int = 300,
    warm_rounds: int = 3,
    batch: int = 16_384,
    rate: float = 0.05,
) -> DataFrame:
    """doc_id, n_tokens, log_likelihood (the sum) and mean_log_likelihood for every row of docs.

    Tokens are runs of letters, digits, underscores and characters beyond ASCII, A-Z taken as a-z; every one is predicted
    from its window, beyond the ends an edge mark. Word counts and training cover all texts; only the warm start uses a
    sample, of at most sample_rows texts. Partitions train apart, so another split of the table gives other scores; the
    same split gives the same. Null and empty texts and texts without words have 0 tokens, sum 0 and a null mean; null
    ids and repeated rows pass through; an empty table gives an empty result; further columns are ignored.
    """
    src = bounded_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t")))
    counts = cut(word_counts(src), "word-counts")
    own = [r["w"] for r in counts.orderBy(F.desc("n"), "w").limit(words).collect()]
    net = trained(src, own, sample_rows, warm_rounds, batch, rate)
    model = docs.sparkSession.sparkContext.broadcast((own, net))

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per piece: its texts with their sums by class, the words of shared classes, and where they stand."""
        own_words, own_net = model.value
        classes, piece = Classes(own_words), 0
        for b in parts:
            for first, h, at in token_pieces(b.column(1)):
                target = classes.of(h)
                ctx = windows(target, at)
                logp = [own_net.forward(ctx[:, i : i + batch], target[i : i + batch]) for i in range(0, len(target), batch)]
                line = np.concatenate(([0.0], np.cumsum(np.concatenate(logp or [np.zeros(0)]), dtype=float)))
                shared = target >= len(own_words)
                rare, place = np.unique(h[shared].view(np.int64), return_inverse=True)
                before = np.concatenate(([0], np.cumsum(shared)))
                lists = [
                    (b.column(0)[first : first + len(at) - 1], pa.int64()), (np.diff(at), pa.int64()), (line[at[1:]] - line[at[:-1]], pa.float64()),
                    (np.diff(before[at]), pa.int32()), (rare, pa.int64()), (place.ravel(), pa.int32()),
                ]
                cols = [pa.array([(TaskContext.get().partitionId() << 32) + piece], pa.int64())]
                for values, kind in lists:
                    flat = values.cast(kind) if isinstance(values, pa.Array) else pa.array(values.astype(kind.to_pandas_dtype()), kind)
                    cols.append(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat))
                yield pa.RecordBatch.from_arrays(cols, ["piece", "ids", "sizes", "sums", "n_rare", "words", "places"])
                piece += 1

    scored = cut(
        src.select("doc_id", F.col("t").cast("binary")).mapInArrow(
            score, "piece long, ids array<long>, sizes array<long>, sums array<double>, n_rare array<int>, words array<long>, places array<int>"
        ),
        "scored",
    )
    # the share of a word within its shared class, from the counts over all texts
    free = CLASSES - len(own)
    rest = counts.where(~F.col("w").isin(own)) if len(own) < 64 else counts.join(
        F.broadcast(docs.sparkSession.createDataFrame([(w,) for w in own], "w long")), "w", "left_anti"
    )
    per_class = rest.groupBy(F.pmod("w", F.lit(free)).alias("c")).agg(F.sum("n").alias("all"))
    total = {r["c"]: r["all"] for r in per_class.collect()}
    whole = docs.sparkSession.sparkContext.broadcast(np.array([total.get(c, 1) for c in range(free)], float))
    asked = scored.select("piece", F.posexplode("words").alias("i", "w"))
    told = (
        asked.join(rest, "w")
        .groupBy("piece")
        .agg(F.array_sort(F.collect_list(F.struct("i", "n", "w"))).alias("told"))
        .select("piece", F.col("told.n").alias("n"), F.col("told.w").alias("w"))
    )

    def finish(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            for row in range(len(b)):
                ids, sizes, sums, n_rare, places, n, w = (b.column(i)[row].values for i in range(7))
                sizes, sums = sizes.to_numpy(), sums.to_numpy(zero_copy_only=False)
                if n is not None and len(n):
                    share = np.log(n.to_numpy().astype(float)) - np.log(whole.value[np.mod(w.to_numpy(), len(whole.value))])
                    line = np.concatenate(([0.0], np.cumsum(share[places.to_numpy()])))
                    end = np.cumsum(n_rare.to_numpy())
                    sums = sums + line[end] - line[end - n_rare.to_numpy()]
                mean = [s / k if k else None for s, k in zip(sums.tolist(), sizes.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(sizes), pa.array(sums), pa.array(mean, pa.float64())],
                    ["doc_id", "n_tokens", "log_likelihood", "mean_log_likelihood"],
                )

    both = scored.join(told, "piece", "left").select("ids", "sizes", "sums", "n_rare", "places", "n", "w")
    return both.mapInArrow(finish, "doc_id long, n_tokens long, log_likelihood double, mean_log_likelihood double")
