"""Toxicity by multiple-instance learning: sentence scores combined by noisy-or, trained from document labels.

A sentence's score is the logistic of a bias and the weights of its words and word beginnings; a document's score is
1 - prod(1 - sentence score), so its label is explained by the sentences that stand out, which are then located.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import bounded_batches

SENTENCE = re.compile(r"[^.!?\n]+")
WORDS = re.compile(r"\w+")
STEMS = range(4, 9)


def features(word: str) -> list[str]:
    """The word, and its beginnings of 4 to 8 letters, marked by a hyphen."""
    return [word, *(f"{word[:k]}-" for k in STEMS if len(word) > k - 1)]


def sentences(text: str | None) -> list[tuple[int, int]]:
    """Spans of the sentences that hold a word, in code points."""
    return [m.span() for m in SENTENCE.finditer(text or "")]


class Model:
    """Weights by feature and the bias of every sentence; known() keeps a bounded cache of word weights."""

    def __init__(self, weights: dict[str, float], bias: float, most: float = 3.0):
        self.weights, self.bias, self.most = weights, bias, most
        self._words: dict[str, float] = {}

    def word(self, w: str) -> float:
        got = self._words.get(w)
        if got is None:
            get = self.weights.get
            got = sum(get(f, 0.0) for f in features(w))
            if len(self._words) > 50_000:
                self._words.clear()
            self._words[w] = got
        return got

    def sentence_logits(self, text: str | None) -> tuple[list[tuple[int, int]], np.ndarray]:
        text = text or ""
        spans = sentences(text)
        word = self.word
        x = np.array([sum(map(word, WORDS.findall(text[s:e].lower()))) for s, e in spans] or [0.0])
        return spans or [(0, 0)], self.bias + x

    def score(self, text: str | None) -> tuple[float, int, int, float]:
        """Noisy-or over sentences; the span and score of the worst sentence."""
        return self.located(text, 1.0)[:4]

    def located(self, text: str | None, threshold: float) -> tuple[float, int, int, float, list[tuple[int, int, float]]]:
        """score(), and the sentences whose own score reaches the threshold; the worst one if the document's does."""
        spans, z = self.sentence_logits(text)
        p = float(1 - np.exp(-np.logaddexp(0, z).sum()))
        own = np.exp(-np.logaddexp(0, -z))
        worst = int(np.argmax(z))
        at = np.flatnonzero(own >= threshold).tolist() or ([worst] if p >= threshold else [])
        return p, *spans[worst], float(own[worst]), [(*spans[i], float(own[i])) for i in at]

    def __getstate__(self):
        return self.weights, self.bias, self.most

    def __setstate__(self, state):
        self.__init__(*state)


def train(
    texts: list[str | None],
    labels: list[int],
    n_features: int = 4096,
    least_docs: int = 3,
    rounds: int = 120,
    rate: float = 0.15,
    decay: float = 0.002,
    weight_of_clean: float = 1.0,
) -> Model:
    """Noisy-or training by Adam. Features: those whose presence differs most between the labels, by z-score."""
    y = np.asarray(labels, float)
    if not len(y) or y.min() == y.max():
        return Model({}, -12.0 if not len(y) or y.max() < 1 else 12.0)
    n1, n0 = int(y.sum()), int(len(y) - y.sum())

    def present(t: str | None) -> set[str]:
        return {f for w in set(WORDS.findall((t or "").lower())) for f in features(w)}

    by_word: dict[str, list[str]] = {}
    toxic, clean = Counter(), Counter()
    for t, label in zip(texts, labels):
        if label:
            toxic.update(present(t))
    toxic = Counter({f: n for f, n in toxic.items() if n >= least_docs})
    for t, label in zip(texts, labels):
        if not label:
            words = set(WORDS.findall((t or "").lower()))
            for w in words:
                if w not in by_word:
                    by_word[w] = [f for f in features(w) if f in toxic]
            clean.update(set().union(*(by_word[w] for w in words)))
    z = {}
    for f, a in toxic.items():
        p = (a + clean[f]) / (n0 + n1)
        z[f] = (a / n1 - clean[f] / n0) / np.sqrt(p * (1 - p) * (1 / n0 + 1 / n1) + 1e-12)
    kept = sorted((f for f in z if z[f] > 5), key=lambda f: (-z[f], f))[:n_features]
    number = {f: i for i, f in enumerate(kept)}
    numbers: dict[str, list[int]] = {}
    sent, feat, val, plain = [], [], [], np.zeros(len(y))
    n_sent = 0
    sent_doc = []
    for d, t in enumerate(texts):
        spans = sentences(t)
        for s, e in spans:
            hit: Counter = Counter()
            for w in WORDS.findall((t or "")[s:e].lower()):
                if w not in numbers:
                    numbers[w] = [number[f] for f in features(w) if f in number]
                if numbers[w]:
                    hit.update(numbers[w])
            if hit:
                sent += [n_sent] * len(hit)
                feat += hit.keys()
                val += hit.values()
                sent_doc.append(d)
                n_sent += 1
            else:
                plain[d] += 1
        if not spans:
            plain[d] += 1
    sent, feat, val = np.array(sent, int), np.array(feat, int), np.array(val, float)
    sent_doc = np.array(sent_doc, int)
    w = np.full(len(kept) + 1, 0.05)
    w[-1] = -6.0
    m, v = np.zeros_like(w), np.zeros_like(w)
    pos = np.where(y == 1, n0 / max(n1, 1), weight_of_clean) ** 0.5
    for step in range(1, rounds + 1):
        s = w[-1] + np.bincount(sent, w[feat] * val, n_sent) if n_sent else np.zeros(0)
        no = np.bincount(sent_doc, np.logaddexp(0, s), len(y)) + plain * np.logaddexp(0, w[-1])
        # -log L: no for clean documents, -log(1 - exp(-no)) for toxic ones
        slope = pos * np.where(y == 1, -1 / np.expm1(np.clip(no, 1e-9, 50)), 1.0)
        by_sent = slope[sent_doc] * np.exp(-np.logaddexp(0, -s)) if n_sent else s
        g = np.zeros_like(w)
        if n_sent:
            g[:-1] = np.bincount(feat, by_sent[sent] * val, len(kept))
        g[-1] = by_sent.sum() + (slope * plain).sum() / (1 + np.exp(-w[-1]))
        g /= len(y)
        g[:-1] += decay * w[:-1] / 10
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model({f: float(w[i]) for f, i in number.items()}, float(w[-1]))


def training_rows(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, seed: int, toxic: int, clean: int
) -> list:
    """About `toxic` and `clean` labelled rows outside the held-out third, chosen by a hash of the id (all, if fewer).

    A document with several labels counts as toxic if any says so, an id with several texts gives the least of them; null
    labels and ids are left out.
    """
    use = (F.crc32(F.col("_id").cast("string").cast("binary")) % 3) != 1
    marked = (
        labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_y"))
        .where("_id is not null and _y in (0, 1)")
        .where(use)
        .groupBy("_id")
        .agg(F.max("_y").alias("_y"))
    )
    n = {r["_y"]: r["n"] for r in marked.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    draw = F.pmod(F.xxhash64(F.lit(seed), "_id"), F.lit(1_000_000)) / 1_000_000.0
    part = F.when(F.col("_y") == 1, min(1.0, toxic / max(1, n.get(1, 0)))).otherwise(min(1.0, clean / max(1, n.get(0, 0))))
    chosen = F.broadcast(marked.where(draw < part))  # about toxic + clean rows, whatever the size of the tables
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    one = texts.join(chosen, "_id").groupBy("_id").agg(F.min("_text").alias("_text"), F.max("_y").alias("_y"))
    return sorted(one.collect(), key=lambda r: r[0])


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    threshold: float = 0.7,
    seed: int = 5,
    toxic_rows: int = 2000,
    clean_rows: int = 3000,
    keep: list[str] | None = None,
) -> DataFrame:
    """doc_id, held_out, score, predicted, worst_start, worst_end, worst_score, offending (and keep) for every row.

    Trained on at most about toxic_rows + clean_rows labelled rows whose crc32(id as text) mod 3 is not 1; scores use
    the text alone. Null and empty texts score as one sentence without words; a null id has held_out false; repeated
    rows score alike; no labels, or labels of one kind, give a constant score near 0 (or 1); an empty table gives an
    empty result; further columns are ignored. worst_* locate the sentence that offends most, in code points;
    offending lists start, end and score of every sentence whose own score reaches the threshold, and the worst one in
    any document predicted toxic.
    """
    rows = training_rows(docs, labels, id_col, text_col, label_col, seed, toxic_rows, clean_rows)
    model = docs.sparkSession.sparkContext.broadcast(train([r[1] for r in rows], [r[2] for r in rows]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for b in batches:
            got = [own.located(t, threshold) for t in b.column(2).to_pylist()]
            score = np.array([g[0] for g in got], float).clip(0, 1)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    b.column(1),
                    pa.array(score, pa.float64()),
                    pa.array((score >= threshold).astype(np.int32), pa.int32()),
                    pa.array([g[1] for g in got], pa.int64()),
                    pa.array([g[2] for g in got], pa.int64()),
                    pa.array([g[3] for g in got], pa.float64()),
                    pa.array([[dict(zip(("start", "end", "score"), x)) for x in g[4]] for g in got], offences),
                    *b.columns[3:],
                ],
                names,
            )

    number = F.col(id_col).cast("long")
    held = F.coalesce((F.crc32(number.cast("string").cast("binary")) % 3) == 1, F.lit(False))
    carried = [F.col(c).alias(f"_keep_{c}") for c in keep or []]
    src = docs.select(number.alias("doc_id"), held.alias("held_out"), F.col(text_col).cast("string").alias("t"), *carried)
    schema = T.StructType(
        [
            *src.schema.fields[:2],
            *(T.StructField(n, k) for n, k in (("score", T.DoubleType()), ("predicted", T.IntegerType()))),
            *(T.StructField(n, k) for n, k in (("worst_start", T.LongType()), ("worst_end", T.LongType()))),
            T.StructField("worst_score", T.DoubleType()),
            T.StructField("offending", T.ArrayType(T.StructType.fromDDL("start long, `end` long, score double"))),
            *src.schema.fields[3:],
        ]
    )
    names = schema.names
    offences = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
    out = bounded_batches(src).mapInArrow(run, schema)
    return out.select(*names[:8], *[F.col(f"_keep_{c}").alias(c) for c in keep or []])
