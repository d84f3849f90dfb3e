"""Language identification by error-correcting output codes over hashed byte trigrams.

Every language has a codeword; each bit has a binary naive Bayes classifier that tells the languages with +1 from those
with -1, from trigram counts of all training documents. Decoding adds the logistic losses of the bits, weighted by how
reliable each bit proved on each language, and takes the nearest codeword; near ties are flagged.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import bounded_batches

BUCKETS = 1 << 13
MODULUS = 4
HELD = 2


def trigrams(text: str) -> np.ndarray:
    """Bucket of each trigram of the lower-cased text's UTF-8 bytes."""
    b = np.frombuffer(f" {text.lower()} ".encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.uint32)
    h = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA6B)) ^ (b[2:] * np.uint32(0xC2B2AE35))
    return ((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(19)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def codewords(n: int, seed: int = 3) -> np.ndarray:
    """n codewords of +1 and -1: all splits of up to 6 languages; beyond, the best of seeded draws by least distance."""
    if n < 2:
        return np.ones((n, 1))
    if n <= 6:
        splits = [s for s in product((1, -1), repeat=n) if s[0] == 1 and -1 in s]
        return np.array(splits, float).T
    bits, rng = max(15, 10 * ceil(log2(n))), np.random.default_rng(seed)
    best, gap = None, -1
    for _ in range(100):
        code = rng.choice([-1.0, 1.0], (n, bits))
        code[0, np.abs(code.sum(axis=0)) == n] *= -1
        apart = (bits - code @ code.T) / 2 + bits * np.eye(n)
        if apart.min() > gap:
            best, gap = code, apart.min()
    return best


class Codes:
    """Codewords, bit classifiers (weights by bucket, scaled) and the weights of the losses."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs, self.code = langs, codewords(len(langs))
        if not langs:  # decode() never looks further
            return
        p = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
        weights = []
        for bit in self.code.T:
            plus, minus = p[bit > 0].mean(axis=0), p[bit < 0].mean(axis=0) if (bit < 0).any() else 1.0 / p.shape[1]
            w = np.log(plus) - np.log(minus)
            weights.append(w * 4 / max(np.abs(p @ w).mean(), 1e-9))
        self.weights = np.array(weights).T.astype(np.float32)
        self.trust = np.full(self.code.shape, 1.0 / self.code.shape[1])

    def margins(self, text: str) -> np.ndarray:
        ids = trigrams(text)
        if not len(ids):
            return np.zeros(self.code.shape[1])
        if len(ids) < BUCKETS // 4:
            return self.weights[ids].sum(axis=0, dtype=float) / len(ids)
        return np.bincount(ids, minlength=BUCKETS) @ self.weights.astype(float) / len(ids)

    def trusted(self, right: np.ndarray, seen: np.ndarray) -> None:
        """Loss weights: each language's share of correct decisions by bit, beyond chance."""
        use = np.maximum((right + 1) / (seen[:, None] + 2) - 0.5, 1e-3)
        self.trust = use / use.sum(axis=1, keepdims=True)

    def decode(self, text: str | None) -> tuple[str, float, bool]:
        if not self.langs or not text or not has_letter(text):
            return "und", 0.0, True
        loss = (self.trust * np.logaddexp(0, -self.code * self.margins(text))).sum(axis=1)
        share = np.exp(-3 * (loss - loss.min()))
        best = int(np.argmin(loss))
        top = float(1 / share.sum())
        return self.langs[best], top, bool(top < 0.5)


def learned(docs: DataFrame, names: tuple[str, str, str]) -> Codes:
    """Two passes over all training rows: trigram counts by language, then the bits' hits by language."""
    id_col, text_col, lang_col = names
    rows = bounded_batches(docs).select(
        F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"), F.col(lang_col).cast("string").alias("l")
    ).where(
        (F.coalesce(F.crc32(F.col("i").cast("string").cast("binary")), F.lit(0)) % MODULUS != HELD)
        & F.col("l").isNotNull()
        & F.col("t").isNotNull()
    ).select("t", "l")

    def summed(vector, schema_size: int) -> dict[str, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[str, np.ndarray] = {}
            for b in batches:
                for t, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    v = vector(t, lang)
                    if v is not None:
                        total[lang] = total[lang] + v if lang in total else v
            for lang, v in total.items():
                k = np.flatnonzero(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(k), pa.string()), pa.array(k, pa.int64()), pa.array(v[k].astype(np.int64))], ["l", "k", "c"]
                )

        got: dict[str, np.ndarray] = {}
        for r in rows.mapInArrow(run, "l string, k long, c long").groupBy("l", "k").agg(F.sum("c").alias("c")).collect():
            got.setdefault(r["l"], np.zeros(schema_size))[r["k"]] = r["c"]
        return got

    def counts(t: str, lang: str):
        return np.bincount(trigrams(t), minlength=BUCKETS) if has_letter(t) else None

    got = summed(counts, BUCKETS)
    langs = sorted(got)
    codes = Codes(langs, np.array([got[x] for x in langs]) if langs else np.zeros((0, BUCKETS)))
    if len(langs) > 1:
        shared = docs.sparkSession.sparkContext.broadcast(codes)
        place = {x: i for i, x in enumerate(langs)}

        def hits(t: str, lang: str):
            if lang not in place or not has_letter(t):
                return None
            own = shared.value
            return np.append(own.margins(t) * own.code[place[lang]] > 0, True).astype(np.int64)

        bits = codes.code.shape[1]
        table = summed(hits, bits + 1)
        right = np.array([table.get(x, np.zeros(bits + 1)) for x in langs])
        codes.trusted(right[:, :-1], right[:, -1])
    return codes


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous for every row of docs, predicted from the whole text alone.

    Learns from all rows with a text and a language whose crc32(id as text) mod 4 is not 2 (a null id counts as
    training, never held out). Null texts and texts without a letter give und, score 0, ambiguous; without any training
    row everything is und; one language gives that language; repeated rows score alike; an empty table gives an empty
    result; further columns are ignored. The driver holds one count per language and bucket.
    """
    codes = docs.sparkSession.sparkContext.broadcast(learned(docs, (id_col, text_col, lang_col)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codes.value
        for b in batches:
            got = [own.decode(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    b.column(1),
                    pa.array([g[0] for g in got], pa.string()),
                    pa.array([g[1] for g in got], pa.float64()),
                    pa.array([g[2] for g in got], pa.bool_()),
                ],
                ["doc_id", "held_out", "lang_pred", "score", "ambiguous"],
            )

    number = F.col(id_col).cast("long")
    held = F.coalesce(F.crc32(number.cast("string").cast("binary")) % MODULUS == HELD, F.lit(False))
    src = docs.select(number.alias("doc_id"), held.alias("held_out"), F.col(text_col).cast("string").alias("t"))
    return bounded_batches(src).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")
