"""Cases of their own: long keys, letters that are none, extreme vectors, slices, rows without ids, stages on odd tables."""

import random
import re
import string
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from starloom.llm import chaining, decontaminate, embeddings, langid, mixing, passages, secrets, toxicity

WORDS = [a + b for a in ("ba", "ko", "ri", "tu", "me", "so", "la", "ne") for b in ("dor", "lin", "mas", "pet", "ral", "sun", "tev", "vok")]


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


# ---- 10


@pytest.mark.parametrize("alphabet", [string.ascii_letters + string.digits + "+/", string.ascii_uppercase + "234567", "0123456789ABCDEF"])
@pytest.mark.parametrize("size", [20, 32, 48, 64, 100, 120, 200, 400, 1600, 2000, 9000])
def test_random_keys_are_found_whole_at_any_length(alphabet, size):
    if len(alphabet) == 32 and size < 32:
        pytest.skip("short capital keys with hardly a digit pass for words")
    rng = random.Random(size)
    n = 40 if size < 2000 else 8
    found = 0
    for i in range(n):
        key = "".join(rng.choice(alphabet) for _ in range(size))
        text = f"{prose(30, i)} the private_key goes here {key} and {prose(20, i + 99)}"
        at = text.index(key)
        found += (at, at + size, "novel") in secrets.all_spans(text)[1]
    assert found >= 0.95 * n


def test_keys_are_found_beside_odd_letters_and_copies_of_themselves():
    key = "Zk3vQ9xTb7LmW2pRs8YdQq4ZtP1nHc5J"
    for text in (f"İİ PRIVATE_KEY goes here {key}", f"bearer {key} and again {key}", f"access_key={key}", f"Authorization:\n  Bearer {key}"):
        spans = [(s, e) for s, e, k in secrets.all_spans(text)[1] if k == "novel"]
        assert spans == [m.span() for m in re.finditer(key, text)]


@pytest.mark.parametrize("size", [40, 300, 450, 600, 1000, 3000])
def test_keys_that_stand_twice_are_found_twice(size):
    rng = random.Random(size)
    for i in range(10):
        key = "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(size))
        text = f"{prose(30, i)} private_key goes here {key} {prose(10, i + 50)} and bearer {key} {prose(20, i + 99)}"
        assert [(s, e) for s, e, k in secrets.all_spans(text)[1] if k == "novel"] == [m.span() for m in re.finditer(key, text)]


def test_words_and_names_after_credentials_stay():
    for text in ("the secret of internationalization-and-localization", "token based authenticationprovider", "password reset instructions_for_customers", "bearer of goodtidingseverywhere"):
        assert secrets.all_spans(text)[1] == []
    for seed in range(200):
        assert [s for s in secrets.all_spans(f"{prose(20, seed)} private key {prose(60, seed + 500).replace(' ', '', 3)}")[1] if s[2] == "novel"] == []


def test_many_credential_words_cost_little():
    text = "token " * 20_000 + "x" * 200_000 + " bearer Zk3vQ9xTb7LmW2pRs8YdQq4ZtP1nHc5J"
    assert [k for *_, k in secrets.all_spans(text)[1]] == ["novel"]


# ---- 3


def test_signs_that_are_no_letters_give_und():
    codes = langid.Codes(["en", "de"], np.ones((2, langid.BUCKETS)))
    for text in ("½ ① ²", "12 34", "", None, "!?"):
        assert codes.decode(text) == ("und", 0.0, True)
    assert codes.decode("ª")[0] in ("en", "de")


def test_predictions_follow_from_counts_of_the_training_rows(spark):
    rng = random.Random(3)
    own = {"aa": "pata kito mora", "bb": "shen wulf dorn", "cc": "ylle onna veis"}
    rows = [(i, " ".join(rng.choice(own[x].split()) for _ in range(12)), x) for i, x in enumerate(rng.choices(sorted(own), k=90))]
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    from zlib import crc32

    train = [r for r in rows if crc32(str(r[0]).encode()) % 4 != 2]
    counts = np.array([np.sum([np.bincount(langid.trigrams(t), minlength=langid.BUCKETS) for _, t, x in train if x == lang], axis=0) for lang in sorted(own)])
    codes = langid.Codes(sorted(own), counts)
    right, seen = np.zeros(codes.code.shape), np.zeros(3)
    for _, t, x in train:
        k = sorted(own).index(x)
        right[k] += codes.margins(t) * codes.code[k] > 0
        seen[k] += 1
    codes.trusted(right, seen)
    for i, t, _ in rows:
        name, score, unsure = codes.decode(t)
        assert (got[i].lang_pred, got[i].ambiguous) == (name, unsure) and got[i].score == pytest.approx(score)
        assert got[i].held_out == (crc32(str(i).encode()) % 4 == 2)


# ---- 5


def test_scores_follow_from_the_model_of_the_training_rows(spark):
    texts = [prose(20, i) + (" grumbo zinkers. " if i % 4 == 0 else ". ") + prose(9, i + 900) for i in range(160)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(160)], "doc_id long, toxic int")
    from zlib import crc32

    train = [i for i in range(160) if crc32(str(i).encode()) % 3 != 1]
    model = toxicity.train([texts[i] for i in train], [int(i % 4 == 0) for i in train])
    for r in toxicity.score_toxicity(docs, labels).collect():
        no = 1.0
        for s, e in toxicity.sentences(texts[r.doc_id]):
            z = model.bias + sum(model.weights.get(f, 0.0) for w in toxicity.WORDS.findall(texts[r.doc_id][s:e].lower()) for f in toxicity.features(w))
            no *= 1 - 1 / (1 + np.exp(-z))
        assert r.score == pytest.approx(1 - no, abs=1e-9) and r.predicted == (r.score >= 0.7)


def test_repeated_labelled_rows_reach_the_driver_once(spark):
    from zlib import crc32

    a, b = [i for i in range(20) if crc32(str(i).encode()) % 3 != 1][:2]
    docs = spark.createDataFrame([(a, "b")] * 50 + [(a, "a"), (b, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(a, 1), (b, 0)], "doc_id long, toxic int")
    rows = toxicity.training_rows(docs, labels, "doc_id", "text", "toxic", 5, 100, 100)
    assert [(r[0], r[1]) for r in rows] == [(a, "a"), (b, "c")]


# ---- 8


def test_hits_do_not_depend_on_the_slices(spark):
    boiler = prose(14, 1)
    items = [f"{boiler} {' '.join(f'own{i}x{j}' for j in range(9))}" for i in range(60)]
    texts = [items[7] + " " + prose(40, 5), f"{boiler} {' '.join(f'own9x{j}' for j in range(7))} changed words here", prose(80, 6)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def hits(chars):
        got = decontaminate.contamination(docs, bench, slice_chars=chars).collect()
        return {(r.doc_id, h.item_id, h.start_word, h.end_word, round(h.similarity, 9)) for r in got for h in r.hits}

    assert hits(4_000_000) == hits(3000) == hits(900) and any(h[:2] == (0, 7) for h in hits(900))


def test_slices_have_the_weights_of_all_items():
    items = [(i, f"{prose(12, 1)} {prose(8, i + 50)}") for i in range(20)]
    whole = decontaminate.Index(items, 5, 20, 0.8)
    seen = Counter(s for h in whole.shingles for s in set(h.tolist()))
    part = decontaminate.Index(items[:5], 5, 20, 0.8, len(items), {s: n for s, n in seen.items() if any(s in h for h in whole.shingles[:5])})
    assert part.rare == whole.rare and all(whole.weight[s] == w for s, w in part.weight.items())


# ---- 9


def test_extreme_components_keep_their_direction(spark):
    rows = [(1, [1e200, 1e200], 1), (2, [1e-170, 1e-170], 1), (3, [3.0, 3.0], 1), (4, [1.0, -1.0], 1), (5, [-0.0, 2.0], 1), (6, [0.0, 2.0], 1)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4), 5: (1, 5), 6: (1, 5)}


# ---- 1


def test_what_the_mix_takes_adds_up(spark):
    rows = [(None if i % 3 else i, prose(5 + i % 70, i), f"s{i % 3}") for i in range(300)] + [(7, prose(30, 1000 + i), "s0") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs, block_words=8, shard_words=700).collect()
    assert len(got) == 500
    for r in got:
        assert r.taken == r.passes * r["size"] + sum(x.end - x.start for x in r.ranges)
        assert all(0 <= x.start < x.end <= r["size"] for x in r.ranges)
    total = Counter()
    for r in got:
        total[r.source_size, r.target] += r.taken
    assert all(abs(taken - target) < 0.05 * target + 40 for (_, target), taken in total.items())


def test_rows_without_ids_are_spread_over_shards(spark):
    docs = spark.createDataFrame([(None, prose(50, i), "a") for i in range(400)], "doc_id long, text string, source string")
    kinds = {(r.passes, len(r.ranges) > 0) for r in mixing.mix(docs, block_words=8, shard_words=1000).collect()}
    order = docs.selectExpr("count(distinct md5(concat('17:', '', ':', md5(text)))) as n").first().n
    assert order == 400 and kinds


# ---- the pipeline's stages


ROW = "doc_id long, text string, lang string, source string, n_chars long, size long, spans string, predicted int"


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_tables(spark, data, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    rows = [
        (1, prose(60, 1), "en", "a", 9, None, "x", 1), (None, prose(60, 2), None, None, None, 1, None, None), (None, None, None, None, None, None, None, None),
        (4, "", "en", "a", 0, 1, "", 0), (5, prose(9000, 5), "en", "b", 1, 1, "", 0), (1, prose(60, 9), "en", "a", 9, 1, "", 0), (1, prose(60, 1), "en", "a", 9, 1, "", 0),
    ]
    got = stage(spark, spark.createDataFrame(rows, ROW), data)
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    every = sorted(((r[0], r[1]) for r in rows), key=str)
    if name == "near_duplicates":
        every = sorted({r for r in every if r != (None, None)}, key=str)
    if name == "mixing":
        every = [r for r in every if r[1]]
        assert got.columns[:5] == corpus_pipeline.COLUMNS
    else:
        assert got.columns == corpus_pipeline.COLUMNS
    assert kept == every
    assert stage(spark, spark.createDataFrame([], ROW), data).count() == 0


def test_kept_texts_stay_out_of_the_mix_and_repeats_take_their_turns(spark):
    rows = [(i % 40, prose(5 + i % 40, i % 40), "ab"[i % 40 % 2] if i % 40 else None, "en") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    kept = mixing.mix(docs, block_words=8, shard_words=400, keep=["text", "source", "lang"])
    columns = ["doc_id", "size", "target", "taken", "passes", "ranges"]
    plain = mixing.mix(docs, block_words=8, shard_words=400).select(columns).collect()
    got = kept.collect()
    assert Counter(str(tuple(r[c] for c in columns)) for r in got) == Counter(str(tuple(r)) for r in plain)
    assert Counter((r.doc_id, r.text, r.source, r.lang) for r in got) == Counter(rows)
    scans = [x for x in kept._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in x]
    assert scans and not any("_keep_text" in x for x in scans)  # the table of sizes holds no texts


# ---- 4


def test_all_pairs_of_a_group_of_edited_passages_are_found(spark):
    """Sorted neighbours alone gave about two partners a text, and the vote kept the best of them."""
    rng = random.Random(5)
    base = [f"p{i}" for i in range(60)]
    texts = []
    for i in range(24):
        own = list(base)
        for k in rng.sample(range(60), 4):
            own[k] = f"e{i}k{k}"
        texts.append([f"x{i}_{j}" for j in range(30)] + own + [f"y{i}_{j}" for j in range(30)])
    words = [[w.encode() for w in t] for t in texts]
    true = {(i, j) for j in range(24) for i in range(j) if chaining.aligned_passages(words[i], words[j], 4, 0.05, 24, 40, 0.8)}
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {(r.doc_id, r.other_id) for r in chaining.fuzzy_passages(docs).collect() if r.doc_id < r.other_id}
    assert got <= true and len(true) > 250 and len(got) >= 0.97 * len(true), (len(got), len(true))


def test_copies_are_named_once_and_pairs_stand_between_different_texts(spark):
    """Every copy was compared with every other text's copies, which took the disk."""
    rng = random.Random(9)
    base = [f"p{i}" for i in range(80)]
    texts = []
    for i in range(3):
        own = list(base)
        for k in rng.sample(range(80), 4):
            own[k] = f"e{i}k{k}"
        texts.append(" ".join([f"x{i}_{j}" for j in range(20)] + own))
    docs = spark.createDataFrame([(n, texts[n % 3]) for n in range(21)], "doc_id long, text string").repartition(4)
    got = [tuple(r) for r in chaining.fuzzy_passages(docs).collect()]
    pairs = {(r[0], r[3]) for r in got if r[0] % 3 != r[3] % 3}
    assert pairs == {(i, j) for i in range(3) for j in range(3) if i != j}
    copies = {(n, 0, 100, n % 3, 0, 100, 1.0) for n in range(3, 21)}
    copies |= {(c[3], *c[1:3], c[0], *c[4:]) for c in copies}
    assert len(got) == len(set(got)) and {r for r in got if r[0] % 3 == r[3] % 3} == copies


def test_runs_of_numbered_words_are_those_of_words():
    rng = random.Random(4)
    for n, words in ((40, 3), (120, 6), (200, 40)):
        x, y = ([rng.choice("abcdefghijklmnopqrstuvwxyz"[: words % 26]) * (1 + words // 26) for _ in range(n)] for _ in range(2))
        number = {w: i for i, w in enumerate(dict.fromkeys(x + y))}
        lines = chaining.numbered(np.array([number[w] for w in x + y]), len(number), 4)
        one, two = (chaining.Stretch(*(c[low : high - m] for c, m in zip(lines, (0, 1, 3)))) for low, high in ((0, n), (n, 2 * n)))
        assert sorted(chaining.runs_of_grams(one, two, 4)) == sorted(chaining.shared_runs(x, y, 4))
        assert one.pairs_with(two) == chaining.pairs_of_words(x, y)


@pytest.mark.parametrize("batch", [3, 1000])
def test_seeds_of_few_places_pair_all_of_them(spark, batch):
    rng = random.Random(batch)
    rows = sorted({(rng.choice([1, 2, 3, 4, 5, 6, 7, 7, 7, 8, 9]), rng.randrange(4), rng.randrange(3), rng.randrange(30), rng.randrange(3)) for _ in range(160)})
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        found = passages.sorted_neighbours(spark.createDataFrame(rows, "key long, r long, l long, unit long, pos int"), every=20)
        got = {(r.a, r.pa, r.b, r.pb) for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    size = Counter(r[0] for r in rows)
    assert any(n > 20 for n in size.values()) and sum(n <= 20 for n in size.values()) > 3
    few = [r for r in rows if size[r[0]] <= 20]
    want = {(x[3], x[4], y[3], y[4]) for x in few for y in few if x[0] == y[0] and x[3] < y[3]}
    assert want <= got and all(any(x[0] == y[0] for x in rows for y in rows if (x[3], x[4], y[3], y[4]) == g) for g in got)
