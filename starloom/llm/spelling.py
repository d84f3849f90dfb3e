"""Spelling variants of a corpus' words, found over an index of grams of variable length.

Every gram of `shortest` letters is in the dictionary, and every gram that goes on by one letter from a frequent one:
the dictionary is pruned by frequency, so common beginnings are told apart by longer grams. A word is cut into the
longest gram from each of its places, without those that lie within an earlier one. One edit changes only grams around
it; the largest number it can change, wherever it is, is the word's bound. Two words at one edit then share all grams of
either but its bound, at places that move by the change of length at most. So if grams are ordered alike for all words,
rare ones first, the lists of each word's first bound + 1 grams are all that has to be merged: near words meet in one
of them. What meets is verified.

Lists are kept by gram, place and length of the word. A word is covered if its bound leaves a gram and none of its lists
is longer than `list_rows`; a pair with one covered word meets in a list that is read. Pairs of words that are both not
covered meet through the words without one letter, of which a key has a bounded number.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import bounded_batches, cut

RUN = re.compile("[a-zA-ZÀ-ÿ]+")


def small(s: str) -> str:
    """A-Z as a-z; other letters stay."""
    return s.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def runs(doc_id: int | None, text: str | None, shortest: int, noise: int) -> Iterator[tuple[str, int]]:
    """(word, times) for the runs of letters of a text; one letter of a run goes where `noise` divides its hash with the id."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, times in Counter(RUN.findall(small(text or ""))).items():
        if len(run) >= shortest:
            h = zlib.crc32(run.encode(), start) if noise else 1
            if noise and h % noise == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= shortest:
                yield run, times


def counted(docs: DataFrame, id_col: str, text_col: str, shortest: int, least: int, noise: int, held: int = 200_000) -> DataFrame:
    """word, n of the words with at least `shortest` letters that occur at least `least` times in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                for word, times in runs(doc_id, text.as_py(), shortest, noise):
                    total[word] += times
                if len(total) > held:
                    yield out()
                    total.clear()
        yield out()

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    part = bounded_batches(src).mapInArrow(run, "word string, n long")
    return part.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


class Grams:
    """The dictionary: counts of frequent grams (with all their beginnings), and of all grams of the shortest length."""

    def __init__(self, counts: dict[str, int], over: int, shortest: int, longest: int):
        self.shortest, self.longest = shortest, longest
        self.counts = counts
        self.frequent = {g for g, n in counts.items() if n > over}
        self.ends = {g[i:] for g in self.frequent for i in range(1, len(g))}
        self.after: Counter = Counter()
        for g, n in counts.items():
            if len(g) == shortest:
                self.after[g[:-1]] += n

    def cut(self, w: str) -> list[tuple[int, int]]:
        """Places (start, end) of the word's grams, both ascending."""
        out, reach = [], 0
        for p in range(len(w) - self.shortest + 1):
            e = p + self.shortest
            while e < len(w) and e - p < self.longest and w[p:e] in self.frequent:
                e += 1
            if e > reach:
                out.append((p, e))
                reach = e
        return out

    def bound(self, w: str, grams: list[tuple[int, int]]) -> int:
        """The most grams of the word that one edit can change.

        An edit replaces or deletes letter i, or inserts one before it. It changes the grams over it; those before it from
        the first place whose gram would go on past it, since that gram swallows the others; and those behind it that a
        gram from before may reach over, which needs a frequent gram that ends with all but their last letter.
        """
        most = 0
        for i in range(len(w) + 1):
            from_ = next((p for p in range(max(0, i - self.longest + 1), i - self.shortest + 1) if w[p:i] in self.frequent), i)
            for r in (i, i + 1) if i < len(w) else (i,):  # what is behind the edit starts at r
                n = 0
                for p, e in grams:
                    if e <= i:
                        n += p >= from_
                    elif p < r:
                        n += 1
                    else:
                        n += e - r < self.longest and w[r : e - 1] in self.ends
                most = max(most, n)
        return most

    def expected(self, gram: str) -> float:
        """Roughly how many words have the gram: its count, or that of all but its last letter times what follows them."""
        if gram in self.counts:
            return self.counts[gram]
        last = gram[-self.shortest :]
        return self.counts.get(gram[:-1], 0) * self.counts.get(last, 0) / max(1, self.after[last[:-1]])

    def lists(self, w: str) -> tuple[list[tuple[int, int]], bool]:
        """The word's rarest grams, one more than its bound, in an order alike for all words; whether the bound leaves one."""
        grams = self.cut(w)
        bound = self.bound(w, grams)
        order = sorted(grams, key=lambda x: (self.expected(w[x[0] : x[1]]), w[x[0] : x[1]], x[0]))
        return order[: bound + 1], bound < len(grams)


def gram_counts(words: DataFrame, shortest: int, longest: int) -> DataFrame:
    """gram, c: how often each gram of `shortest` to `longest` - 1 letters stands in the words (column word)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c: Counter = Counter()
            for w in b.column(0).to_pylist():
                for q in range(shortest, min(longest, len(w) + 1)):
                    c.update(w[p : p + q] for p in range(len(w) - q + 1))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], ["gram", "c"])

    return words.select("word").mapInArrow(run, "gram string, c long").groupBy("gram").agg(F.sum("c").alias("c"))


def dictionary(words: DataFrame, shortest: int, longest: int, over: int, entries: int) -> Grams:
    """The gram dictionary of the words.

    A gram is frequent if it stands in the words more than `over` times and than the `entries`-th part of all places, so a
    length has at most `entries` frequent grams, whatever the corpus; grams of the shortest length are bounded by the letters.
    """
    places = words.agg(F.sum(F.length("word"))).first()[0] or 0
    over = max(over, places // entries)
    common = gram_counts(words, shortest, longest).where((F.col("c") > over) | (F.length("gram") == shortest))
    return Grams({r["gram"]: r["c"] for r in common.collect()}, over, shortest, longest)


def indexed(words: DataFrame, grams: Grams) -> DataFrame:
    """word, n, gram, at, left of the lists that each word has to be merged in."""
    shared = words.sparkSession.sparkContext.broadcast(grams)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = shared.value
        for b in batches:
            word, n = b.column(0).to_pylist(), b.column(1).to_pylist()
            rows = []
            for w, c in zip(word, n):
                own, left = g.lists(w)
                rows += [(w, c, w[s:e], s, left) for s, e in own]
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(zip(*rows) if rows else [[]] * 5, kinds)], ["word", "n", "gram", "at", "left"]
            )

    return words.select("word", "n").mapInArrow(run, "word string, n long, gram string, at int, left boolean")


def near_words(
    words: DataFrame, shortest: int = 2, longest: int = 6, over: int = 1000, entries: int = 20_000, list_rows: int = 512
) -> DataFrame:
    """a, n_a, b, n_b: the pairs (each once) of words (word, n; distinct, of `shortest` letters or more) at one edit.

    All joins merge: Spark takes the size of what explode() makes for that of the table before it, which holds a tenth of
    the rows, and would gather that on the driver to broadcast it.
    """
    lists = cut(indexed(words, dictionary(words, shortest, longest, over, entries)), "gram-lists")
    size = F.length("word")
    own = lists.select(F.xxhash64("gram", "at", size).alias("key"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    asked = F.array(F.xxhash64("gram", "at", size), F.xxhash64("gram", "at", size + 1), F.xxhash64("gram", F.col("at") + 1, size + 1))
    probes = lists.select(F.explode(asked).alias("key"), F.col("word").alias("a"), F.col("n").alias("n_a"))
    hot = cut(own.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > list_rows).select("key"), "long-lists")
    near = (F.levenshtein("a", "b", 1) == 1) & ((F.length("a") < F.length("b")) | ((F.length("a") == F.length("b")) & (F.col("a") < F.col("b"))))
    merged = own.join(hot.hint("merge"), "key", "left_anti").join(probes.hint("merge"), "key").where(near).select("a", "n_a", "b", "n_b")
    bare = lists.where("not left").select(F.col("word").alias("a"), F.col("n").alias("n_a"))
    bare = cut(bare.union(probes.join(hot.hint("merge"), "key", "left_semi").select("a", "n_a")).distinct(), "bare-words")
    without = F.transform(F.sequence(F.lit(1), F.length("a")), lambda i: F.concat(F.substring("a", F.lit(1), i - 1), F.substring("a", i + 1, F.length("a"))))
    keys = bare.select(F.explode(F.array_distinct(F.concat(F.array("a"), without))).alias("key"), "a", "n_a")
    others = keys.select("key", F.col("a").alias("b"), F.col("n_a").alias("n_b"))
    paired = keys.join(others.hint("merge"), "key").where(near).select("a", "n_a", "b", "n_b")
    return merged.union(paired).distinct()


def roots_of(forms: DataFrame) -> DataFrame:
    """word, root: the last of the forms that follow a word's (columns word, form; no word comes back to itself)."""
    now = cut(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while now.where("moved").limit(1).count():
        far = now.select(F.col("word").alias("_of"), F.col("root").alias("_root"))
        step = now.join(far.hint("merge"), F.col("root") == F.col("_of"), "left")
        now = cut(step.select("word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")), "roots", done=(now,))
    return now.select("word", "root")


def spelling_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    letters: int = 6,
    least: int = 5,
    times: int = 5,
    noise: int = 0,
    **index: int,
) -> DataFrame:
    """word, n, n_near, form, form_n, root for every word of docs with `letters` code points and `least` occurrences or more.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z as a-z. Two are near if one inserted, deleted or replaced
    code point tells them apart. form is the near word that occurs most (ties: the first by code points) if it occurs at
    least `times` as often; root is the last that forms lead to, the word itself without one. Where `noise` is not 0, one
    letter goes from the runs whose crc32 with the row's id it divides (a null id is written as nothing). Repeated rows
    count as often as they stand; null and empty texts have no words; whatever the text's length, counts leave a task in
    parts of bounded size; an empty table gives an empty result; further columns are ignored.
    """
    words = cut(counted(docs, id_col, text_col, letters, least, noise), "words")
    pairs = cut(near_words(words, **index), "near-words")
    both = pairs.union(pairs.select("b", "n_b", "a", "n_a")).toDF("word", "n", "other", "n_other")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_other")).alias("less"), "other")).alias("best"))
    told = cut(
        words.join(best.hint("merge"), "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(-F.col("best.less") >= times * F.col("n"), F.struct(F.col("best.other").alias("form"), (-F.col("best.less")).alias("form_n"))).alias("f"),
        ),
        "forms",
    )
    roots = roots_of(told.where("f is not null").select("word", "f.form"))
    return told.join(roots.hint("merge"), "word", "left").select("word", "n", "n_near", "f.form", "f.form_n", F.coalesce("root", "word").alias("root"))
