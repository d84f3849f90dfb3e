"""The pipeline's stages against what their operators decide, and its registration."""

import corpus_pipeline
from starloom.llm.queries import ORACLE, QUERIES
from starloom.llm.simhash import fingerprint
from starloom.llm.toxicity import score_toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_every_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES and set(ORACLE) <= set(QUERIES)


def test_stages_keep_the_columns_and_decide(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    seen = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        if name == "toxicity":
            labels = spark.read.parquet(f"{data}/labels.parquet")
            bad = {r.doc_id for r in score_toxicity(docs, labels).where("predicted = 1").collect()}
        out = stage(spark, docs, data).cache()
        assert out.columns == corpus_pipeline.COLUMNS
        n = out.count()
        assert 0.5 * seen < n <= seen
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        if name == "toxicity":
            assert not ids & bad and len(ids) == seen - len(bad)
        if name == "near_duplicates":
            prints = [fingerprint(r.text) for r in out.select("text").collect()]
            assert all((a ^ b).bit_count() > 4 for i, a in enumerate(prints) for b in prints[:i])
        docs, seen = out, n
    last = corpus_pipeline.STAGES[-1][1](spark, docs, data)
    got = last.collect()
    assert {"doc_id", "text", "taken"} <= set(last.columns) and all(0 < r.taken <= 2 * r["size"] for r in got)


def test_secrets_are_replaced_and_clean_texts_kept(spark, data):
    rows = [(1, "token = abcdefghijklmnop end", "en", "a", 28), (2, "clean words", "en", "a", 11), (3, None, None, None, None)]
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.secrets(spark, spark.createDataFrame(rows, DOCS), data).collect()}
    assert got == {1: ("[SECRET] end", 12), 2: ("clean words", 11), 3: (None, None)}


def test_near_duplicates_keep_one_of_each_group(spark, data):
    rows = [(i, "alpha beta gamma delta epsilon zeta" if i < 5 else f"other text {i} with words of its own {i * 7}", "en", "a", 1) for i in range(8)]
    rows += [(2, rows[2][1], "en", "a", 1), (None, "no id", "en", "a", 1)]
    got = sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, DOCS), data).collect() if r.doc_id is not None)
    assert got == [0, 5, 6, 7]
