"""The wide-fingerprint near-duplicates of the pipeline against brute force."""

import random

import numpy as np
import pytest

import corpus_pipeline
from starloom.llm import near

DOCS = "doc_id long, text string, lang string, source string, n_chars long, unit string, t long"


def jaccard(x, y):
    def shingles(t):
        w = t.lower().split()
        return set(zip(*(w[i:] for i in range(5)))) if len(w) >= 5 else {tuple(w)}

    u, v = shingles(x), shingles(y)
    return len(u & v) / len(u | v)


def copies(n=30, seed=4):
    rng, texts = random.Random(seed), []
    for _ in range(n):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([40, 90, 200]))]
        texts.append(" ".join(words))
        for _ in range(rng.randrange(0, 5)):
            own = list(words)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
                own[rng.randrange(len(own))] = f"e{rng.randrange(9999)}"
            texts.append(" ".join(own))
    return texts


def groups_of(links, ids):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("bucket_rows", [20_000, 8])
def test_groups_match_brute_force(spark, bucket_rows):
    texts = copies()
    rows = [(i, t, "en", "s", len(t), "x", 1) for i, t in enumerate(texts)]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if jaccard(texts[i], texts[j]) >= 0.8]
    want = groups_of(links, range(len(texts)))
    got = near.near_groups(spark.createDataFrame(rows, DOCS), bucket_rows=bucket_rows).collect()
    first = {r.component: r.doc_id for r in got if r["first"]}
    have = {r.doc_id: first[r.component] for r in got}
    assert all(want[have[i]] == want[i] for i in have)  # nothing is joined that should not be
    assert sum(have[i] == want[i] for i in want) >= 0.97 * len(want)


def test_many_pairs_of_one_text_are_spread(spark):
    pairs = spark.createDataFrame([(i, 1, 10 + i) for i in range(20)], "pair long, a long, b long")
    docs = spark.createDataFrame([(1, "x")] + [(10 + i, "y") for i in range(20)], "unit long, t string")
    p, d = near.spread(pairs, docs, 4)
    keys, texts = {r.a: [] for r in p.collect()}, {r.unit: r.t for r in d.collect()}
    for r in p.collect():
        keys[r.a].append(r.pair)
    assert len(keys) == 5 and all(len(v) <= 4 and texts[k] == "x" for k, v in keys.items()) and len(texts) == 25


def test_forest_is_the_least():
    rng = np.random.default_rng(2)
    for _ in range(30):
        n = int(rng.integers(2, 20))
        a, b = rng.integers(0, n, 40), rng.integers(0, n, 40)
        a, b = a[a != b], b[a != b]
        d = rng.integers(0, 9, len(a))
        kept = near.forest(a, b, d)
        links = sorted(zip(d.tolist(), a.tolist(), b.tolist()))
        root, total = list(range(n)), []
        for w, x, y in links:
            while root[x] != x:
                x = root[x]
            while root[y] != y:
                y = root[y]
            if x != y:
                root[y] = x
                total.append(w)
        assert sorted(d[kept].tolist()) == sorted(total)


def test_grown_forests_are_as_long_as_those_of_all_links():
    rng = np.random.default_rng(6)
    for n in (2, 40, 120):
        base = rng.integers(0, 1 << 62, (6, 4)).astype(np.uint64)
        f = base[rng.integers(0, 6, n)] ^ (np.uint64(1) << rng.integers(0, 62, (n, 4)).astype(np.uint64))
        unit, own = rng.permutation(n).astype(np.int64), np.sort(rng.random(n) < 0.6)[::-1]
        i, j = np.triu_indices(n, 1)
        apart = np.bitwise_count(f[i] ^ f[j]).sum(axis=1)
        use = (own[i] | own[j]) & (apart <= 60)
        kept = near.forest(unit[i[use]], unit[j[use]], apart[use].astype(np.int64))
        got = near.grown_forest(f, unit, own, 60)
        assert len(got) == len(kept) and sorted(got[:, 2].tolist()) == sorted(apart[use][kept].tolist())


def test_plan_finds_the_wanted_share():
    rng = np.random.default_rng(1)
    bits = rng.random((400, near.WIDE)) < 0.5
    for n in (100, 1_000_000, 100_000_000):
        got = near.plan(n, bits.T.astype(float) @ bits * n / 400, 0.15, 0.95)
        missed = np.prod([1 - near.at_most(np.full(len(g), 0.15), t)[t] for g, t in got])
        assert missed <= 0.06 and len({b for g, _ in got for b in g}) == sum(len(g) for g, _ in got)


def stage(spark, data, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, extra string, _row long")
    return sorted(corpus_pipeline.near_duplicates(spark, docs, data).collect(), key=str)


def test_rows_are_told_apart_by_id_and_text(spark, data):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")

    def row(i, t):
        return (i, t, "en", "s", 1, "x", 5)

    got = stage(spark, data, [row(1, a), row(5, a), row(5, b), row(7, c), row(7, c)])
    assert [(r.doc_id, r.text) for r in got] == [(1, a), (5, b), (7, c)]
    got = stage(spark, data, [row(None, a), row(None, a), row(3, a.upper()), row(None, b), row(9, None), row(8, ""), row(6, " \n")])
    assert {(r.doc_id, r.text) for r in got} == {(3, a.upper()), (None, b), (6, " \n")}
    assert stage(spark, data, []) == []


@pytest.mark.parametrize("size, families, words, edits", [(2, 60, 120, 3), (8, 40, 120, 2), (16, 16, 150, 3), (64, 5, 120, 2)])
def test_families_around_the_threshold_stay_together(spark, size, families, words, edits):
    """Texts of a family lie about 0.8 from each other, so that an estimate picks links that fall short of it."""
    rng, texts = random.Random(size), []
    for k in range(families):
        base = [f"f{k}w{i}" for i in range(words)]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randrange(1, edits + 1)):
                own[rng.randrange(words)] = f"e{rng.randrange(1 << 30)}"
            texts.append((k, " ".join(own)))
    links = [(i, j) for i in range(len(texts)) for j in range(i) if texts[i][0] == texts[j][0] and jaccard(texts[i][1], texts[j][1]) >= 0.8]
    want = groups_of(links, range(len(texts)))
    got = near.near_groups(spark.createDataFrame([(i, t, "en", "s", 1, "x", 1) for i, (_, t) in enumerate(texts)], DOCS)).collect()
    first = {r.component: r.doc_id for r in got if r["first"]}
    have = {r.doc_id: first[r.component] for r in got}
    assert all(want[have[i]] == want[i] for i in have)
    apart = sum(have[i] != have[j] for i, j in links)
    assert apart <= 0.02 * len(links) and len(set(have.values())) <= 1.02 * len(set(want.values())) + 1, (apart, len(links), len(set(have.values())), len(set(want.values())))


def straddling(size, hubs=5, words=240, seed=3):
    """Texts of one family, none of them equal: most fall short of 0.8 to one another but reach it to a few hubs."""
    rng, texts = random.Random(seed), []
    base = [f"w{i}" for i in range(words)]
    for i in range(size):
        own = list(base)
        for k in rng.sample(range(5, words - 5), 1 if i < hubs else rng.choice([4, 4, 4, 7])):
            own[k] = f"e{i}k{k}"
        texts.append(" ".join(own))
    return texts


def true_groups(texts):
    links = [(i, j) for i in range(len(texts)) for j in range(i) if jaccard(texts[i], texts[j]) >= 0.8]
    return links, groups_of(links, range(len(texts)))


@pytest.mark.parametrize("hubs", [3, 5])
def test_buckets_of_many_texts_lose_no_link(spark, hubs):
    """In a bucket of more than 256 texts the nearest partners by estimate can all fall short where a further one does not."""
    texts = straddling(400, hubs)
    links, want = true_groups(texts)
    got = near.near_groups(spark.createDataFrame([(i, t, "en", "s", 1, "x", 1) for i, t in enumerate(texts)], DOCS)).collect()
    group = {r.doc_id: r.component for r in got}
    assert len(set(want.values())) > 1 and sum(group[i] != group[j] for i, j in links) == 0
    assert len(set(group.values())) == len(set(want.values()))


def test_links_of_a_group_grow_with_its_texts(spark):
    count = []
    for size in (100, 200):
        units = near.fingerprinted(spark.createDataFrame([(i, i, t) for i, t in enumerate(straddling(size))], "doc_id long, unit long, t string"), 5)
        count.append(near.candidate_links(units.select("unit", *near.WORDS_OF), 0.8, 0.98, 20_000).count())
    assert count[1] <= 2.6 * count[0], count


@pytest.mark.parametrize("chunk_bytes", [1, 20_000, 1 << 23])
def test_large_trees_are_compared_whole_over_chunks(spark, chunk_bytes):
    one, two = straddling(70), [t.replace("w", "v") for t in straddling(40, seed=4)]
    texts = one + two + ["", "short text"]
    _, want = true_groups(texts)
    tree = [0] * len(one) + [len(one)] * (len(two) + 2)
    own = spark.createDataFrame([(tree[i], i, t) for i, t in enumerate(texts)], "tree long, unit long, t string")
    links = near.true_links(own, 5, 0.8, chunk_bytes).collect()
    assert groups_of([(r.a, r.b) for r in links], range(len(texts))) == want and len(set(want.values())) > 4
