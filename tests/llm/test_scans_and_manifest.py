"""Licences, the Merkle manifest and spelling variants against plain versions, SQL, and odd tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from starloom.llm import licenses, manifest, spelling
from starloom.llm.queries import ORACLE, QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, lo long, n long, word string, digest string"


def frame(spark, rows):
    """rows of (doc_id, text, source), with further columns of clashing names."""
    return spark.createDataFrame([(i, t, None if t is None else "en", s, None if t is None else len(t), "x", 7, 9, "w", "d") for i, t, s in rows], DOCS)


def by_id(rows):
    return sorted((tuple(r) for r in rows), key=str)


# ---- 11


def plain_base(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = []
    for phrase, label in {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}.items():
        w = phrase.split(" ")
        places += [(i, label) for i in range(len(words)) if words[i : i + len(w)] == w]
    at = [i for i, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


PIECES = ["MIT", "mit license", "License", "CC", "by", "CC-BY", "sa", "GNU", "General Public", "license", "Apache", "apache license, 2.0", "word", "É", "x1", "-", "\n", "(c)", "cc by cc by", "gnu general public license", "İ"]


def test_base_phrases_match_plain_ones():
    rng = random.Random(1)
    for _ in range(2000):
        text = rng.choice([" ", "", "  "]).join(rng.choice(PIECES) + rng.choice([" ", ", ", "-"]) for _ in range(rng.randrange(12)))
        got = licenses.scanned(text)
        assert (got["n_words"], got["n_base"], got["first_word"], got["last_word"], got["base_labels"]) == plain_base(text)
        assert set(got["base_labels"].split(",")) - {""} <= set(got["labels"].split(",")) and 0 <= got["score"] <= 1


def expression(rng, depth):
    """A random expression with its value by recursion: OR of ANDs of licences, exceptions and brackets."""

    def unit(d):
        if d and rng.random() < 0.3:
            text, free = alternatives(d - 1)
            return f"({text})", free
        name = rng.choice(["MIT", "GPL-2.0-only", "Apache-2.0", "LGPL-3.0+", "LicenseRef-x", "CC-BY-NC-4.0", "MPL-2.0"])
        free = {"m": 0.9, "g": 0.3, "a": 0.9, "l": 0.5, "c": 0.1}.get(name[0].lower(), 0) if name not in ("LicenseRef-x", "MPL-2.0") else {"L": 0.05, "M": 0.6}[name[0]]
        if rng.random() < 0.3:
            return f"{name} WITH Some-exception", (free + 1) / 2
        return name, free

    def joined(part, word, pick, d):
        parts = [part(d) for _ in range(rng.choice([1, 1, 2, 3]))]
        return f" {rng.choice([word, word.lower()])} ".join(p[0] for p in parts), pick(p[1] for p in parts)

    def alternatives(d):
        return joined(lambda e: joined(unit, "AND", min, e), "OR", max, d)

    return alternatives(depth)


def test_expressions_have_the_value_of_a_recursive_reading():
    rng = random.Random(2)
    for _ in range(1500):
        text, free = expression(rng, 3)
        line = f"/* spdx-license-identifier: {text} */ and (more words"
        (start, end, _, freedom, labels), = licenses.expressions(line.lower())
        assert (start, line[start:end].lower()) == (3, f"spdx-license-identifier: {text}".lower()) and freedom == pytest.approx(free)
        assert "some-exception" not in labels or "WITH" in text


@pytest.mark.parametrize(
    "text, taken, labels",
    [
        ("SPDX-License-Identifier: MIT OR", "mit", ["mit"]),
        ("SPDX-License-Identifier: MIT AND (Apache-2.0", "mit", ["mit"]),
        ("SPDX-License-Identifier: ((MIT)", None, []),
        ("SPDX-License-Identifier: Own-1.0 with a with b", "own-1.0 WITH a", ["own-1.0", "a"]),
        ("License: the terms below", None, []),
        ("License: MIT or later", "mit", ["mit"]),
        ("Relicense: MIT", None, []),
        ("SPDX-License-Identifier:\nMIT", None, []),
        ('"license": "BSD-3-Clause",', "bsd-3-clause", ["bsd"]),
    ],
)
def test_expressions_end_where_they_stop_being_one(text, taken, labels):
    got = licenses.expressions(text.lower())
    assert [x[2] for x in got] == ([taken] if taken else []) and [y for x in got for y in x[4]] == labels


def test_long_expressions_and_texts_are_read_whole(spark):
    deep = "spdx-license-identifier: " + "(" * 20_000 + "mit" + ")" * 20_000
    wide = "spdx-license-identifier: " + "mit and " * 20_000 + "gpl-2.0"
    late = "word " * 300_000 + "mit license"
    rows = [(1, deep, "a"), (2, wide, "a"), (3, late, None), (4, None, "a"), (None, "", "a"), (None, "CC BY", None), (3, late, None)]
    got = licenses.scan_licenses(frame(spark, rows), keep=["source"]).collect()
    told = by_id((r.doc_id, r.n_words, r.n_base, r.first_word, r.base_labels, r.labels, r.score, r.source) for r in got)
    want = [(1, 4, 0, None, "", "mit", 0.9, "a"), (2, 40_006, 0, None, "", "gpl,mit", 0.3, "a"), (4, 0, 0, None, "", "", 0.0, "a"), (None, 0, 0, None, "", "", 0.0, "a")]
    want += [(None, 2, 1, 0, "cc-by", "cc-by", 0.8, None)] + [(3, 300_002, 1, 300_000, "mit", "mit", 0.9, None)] * 2
    assert told == by_id(want)
    assert licenses.scan_licenses(frame(spark, []).where("false")).collect() == []


def test_license_query_matches_plain_words(spark, data):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    for r in QUERIES["op11_license"](spark, data).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_base(texts[r.doc_id])


# ---- 12


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain_tree(nodes, fan):
    """The root of a list of digests, and each one's path."""
    paths, cover = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, spans = [], []
        for i in range(0, len(nodes), fan):
            run = nodes[i : i + fan]
            for j in range(len(run)):
                for x in cover[i + j]:
                    paths[x].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(sha("".join(run)))
            spans.append(sum(cover[i : i + fan], []))
        nodes, cover = up, spans
    return nodes[0], paths


def plain_manifest(rows, fan):
    """(id, source, leaf, subroot, root, path, folded, verified) of rows (id, source, lang, n_chars, text, changed text)."""

    def leaf(i, s, lang, n, t):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, s, lang, n, t)))

    trees = defaultdict(list)
    for i, s, lang, n, t, c in rows:
        trees[s].append((i is not None, i or 0, leaf(i, s, lang, n, t), leaf(i, s, lang, n, c), i))
    subs = {s: plain_tree([x[2] for x in sorted(own)], fan) for s, own in trees.items()}
    order = sorted(subs, key=lambda s: (s is not None, (s or "").encode()))
    root, upper = plain_tree([subs[s][0] for s in order], fan)
    out = []
    for s, above in zip(order, upper):
        for (_, _, own, changed, i), below in zip(sorted(trees[s]), subs[s][1]):
            folded = changed
            for left, right in below + above:
                folded = sha(left + folded + right)
            out.append((i, s, own, subs[s][0], root, tuple(below + above), folded, folded == root))
    return out


def told(df):
    return by_id((r.doc_id, r.source, r.leaf, r.subroot, r.root, tuple((p.left, p.right) for p in r.proof), r.folded_root, r.verified) for r in df.collect())


@pytest.mark.parametrize("fan, sizes", [(2, [1, 2, 3, 9]), (4, [65, 16, 17, 1, 4]), (16, [1]), (16, [300, 16, 1, *[2] * 18])])
def test_manifest_matches_a_plain_tree(spark, fan, sizes):
    rows = [(i, f"Text {i} É", f"s{s}" if s else None) for s, n in enumerate(sizes) for i in range(100 * s, 100 * s + n)]
    random.Random(3).shuffle(rows)
    changed = F.when(F.col("doc_id") % 3 == 0, manifest.lowered(F.col("text"))).otherwise(F.col("text"))
    got = manifest.manifest(frame(spark, rows).repartition(5), tampered={"text": changed}, fan=fan)
    plain = [(i, s, "en", len(t), t, t.replace("T", "t") if i % 3 == 0 else t) for i, t, s in rows]
    assert told(got) == by_id(plain_manifest(plain, fan))


def test_manifest_of_odd_rows(spark):
    rows = [(1, None, "a"), (1, "", "a"), (1, "", "a"), (None, "x", "a"), (None, None, None), (None, "x", "a"), (-5, "-", "É"), (7, "y" * 200_000, ""), (3, "z", "A")]
    rows += [(9, "same", "hot")] * 40
    got = manifest.manifest(frame(spark, rows))
    want = [(i, s, None if t is None else "en", None if t is None else len(t), t, t) for i, t, s in rows]
    assert told(got) == by_id(plain_manifest(want, 16)) and all(r.verified for r in got.collect())
    assert manifest.manifest(frame(spark, []).where("false")).collect() == []


def test_manifest_of_all_equal_rows_spreads(spark):
    same = frame(spark, [(1, "t", "s")] * 3000).repartition(6)
    parts = manifest.ranked(same.select(F.lit("a").alias("tree"), "doc_id"), "tree", ["doc_id"])
    assert sorted(r.lo for r in parts.collect()) == list(range(3000)) and parts.where("n != 3000").count() == 0


# ---- 13


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows, noise):
    n = Counter()
    for i, t in rows:
        low = re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if noise and h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    of = {w: [v for v in n if v != w and near(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(of[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n[w], len(of[w]), form[w], n[form[w]] if form[w] else None, root))
    return by_id(out)


def spelled(seed, words=60, docs=40):
    rng = random.Random(seed)
    letters = "abcdeé"
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(5, 12))) for _ in range(words)]

    def slip(w):
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            i, kind = rng.randrange(len(w) + 1), rng.randrange(3)
            w = w[:i] + rng.choice(letters) * (kind < 2) + w[i + (kind > 0) :]
        return w

    known = [v for w in base for v in [w] + [slip(w) for _ in range(5)]]
    heavy = [rng.choice([1, 1, 3, 20, 120]) for _ in known]
    rows = []
    for i in range(docs):
        text = " ".join(w.upper() if rng.random() < 0.1 else w for w in rng.choices(known, heavy, k=200))
        rows.append((i if i % 7 else None, text, "s"))
    return rows


@pytest.mark.parametrize("index", [{}, {"over": 3, "list_rows": 4}, {"over": 10, "longest": 4, "list_rows": 2}, {"over": 1, "longest": 8, "list_rows": 10_000}, {"shortest": 3, "over": 5, "list_rows": 3}])
def test_variants_match_all_pairs(spark, index):
    rows = spelled(len(index) + sum(index.values()))
    got = spelling.spelling_variants(frame(spark, rows), noise=7, **index)
    assert by_id((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in got.collect()) == plain_variants([r[:2] for r in rows], 7)


def test_bounds_hold_for_every_edit():
    rng = random.Random(5)
    letters = "abcd"
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(6, 12))) for _ in range(150)})
    counts = Counter(w[p : p + q] for w in words for q in range(2, 6) for p in range(len(w) - q + 1))
    for over in (0, 3, 10, 1000):
        grams = spelling.Grams({g: n for g, n in counts.items() if n > over or len(g) == 2}, over, 2, 6)
        for w in words:
            own = grams.cut(w)
            bound = grams.bound(w, own)
            edits = [w[:i] + c + w[i + d :] for i in range(len(w) + 1) for d in (0, 1) for c in ["", *letters]]
            for v in edits:
                if v == w or len(v) < 2:
                    continue
                there = {(v[s:e], s) for s, e in grams.cut(v)}
                move = len(v) - len(w)
                kept = sum((w[s:e], s) in there or (w[s:e], s + move) in there for s, e in own)
                assert kept >= len(own) - bound


def test_variants_of_odd_rows(spark):
    rows = [(1, None, "a"), (None, "", "a"), (2, "!!! 12", None), (3, "abcdef " * 50_000 + "x" * 30_000 + " abcdex" * 5, "a"), (3, "ABCDEÉ " * 5, None), (3, "ABCDEÉ " * 5, None)]
    got = spelling.spelling_variants(frame(spark, rows))
    assert by_id((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in got.collect()) == by_id(
        [("abcdef", 50_000, 2, None, None, "abcdef"), ("abcdex", 5, 2, "abcdef", 50_000, "abcdef"), ("abcdeÉ", 10, 2, "abcdef", 50_000, "abcdef")]
    )
    assert spelling.spelling_variants(frame(spark, []).where("false")).collect() == []


def test_words_are_never_gathered_for_a_broadcast(spark):
    """Tables of words grow with the corpus; small ones are broadcast only if the joins let Spark choose."""
    words = spark.createDataFrame([(w, 5 + i) for i, w in enumerate(["abcdef", "abcdeg", "abcde", "xbcdef", "bcdefg", "uvwxyz"])], "word string, n long")
    pairs = spelling.near_words(words, over=1, list_rows=1)
    forms = spelling.roots_of(spark.createDataFrame([("abcdeg", "abcdef"), ("abcdef", "abcde")], "word string, form string"))
    all_ = spelling.spelling_variants(frame(spark, spelled(3)))
    assert {(r.a, r.b) for r in pairs.collect()} == {("abcdef", "abcdeg"), ("abcde", "abcdef"), ("abcde", "abcdeg"), ("abcdef", "xbcdef")}
    assert {(r.word, r.root) for r in forms.collect()} == {("abcdeg", "abcde"), ("abcdef", "abcde")}
    assert all_.count()
    for df in (pairs, forms, all_):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan, plan


# ---- SQL


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, data, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
    got, want = QUERIES[name](spark, data), con.sql(ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(want.columns)
    for a, b in zip(by_id(got.select(columns).collect()), by_id(want.select(*columns).fetchall()), strict=True):
        assert all(x == y or (isinstance(x, float) and abs(x - y) <= 1e-9 * abs(y)) for x, y in zip(a, b)), (a, b)
