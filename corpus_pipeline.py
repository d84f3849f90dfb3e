"""A corpus from raw documents in five stages; each is written as Parquet and read again as the next one's docs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import cut, table
from starloom.llm.decontaminate import contamination
from starloom.llm.mixing import mix
from starloom.llm.near import near_groups
from starloom.llm.secrets import scan_secrets
from starloom.llm.toxicity import score_toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
REST = COLUMNS[1:]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model predicts toxic go.

    Null and empty texts, null ids and repeated rows are scored like any other and stay if clean; no labels mean that all
    stay; an empty table stays empty; further columns are dropped.
    """
    scored = score_toxicity(docs, table(spark, sf_dir, "labels"), keep=REST)
    return scored.where("predicted = 0").select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts with five-word shingles alike to 0.8 or more, linked directly or by others, one row stays.

    It is the row with the smallest id (null ids last, equal ids by text), whole. Rows are told apart by id and text, so
    different texts under one id are judged each on its own, and rows that repeat both stay once. Null texts count as
    empty, texts without words are alike. An empty table stays empty; further columns are dropped.
    """
    row = F.xxhash64("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))))
    first = near_groups(docs).where("first").select(F.xxhash64("doc_id", "unit").alias("_row"))
    kept = docs.select(*COLUMNS, row.alias("_row")).join(first, "_row", "left_semi")
    return kept.dropDuplicates(["_row"]).select(COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null and empty texts hold none and stay; null ids and repeated rows are judged like any other; an empty benchmark or
    table leaves all as it is; further columns are dropped.
    """
    found = contamination(docs, table(spark, sf_dir, "benchmark"), keep=REST)
    return found.where(F.size("hits") == 0).select(COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; n_chars follows where the text changed; every row stays.

    Null and empty texts stay as they are; null ids and repeated rows are scanned like any other; an empty table stays
    empty; further columns are dropped.
    """
    found = scan_secrets(docs, keep=["lang", "source", "n_chars"])
    n_chars = F.when(F.col("spans") == "", F.col("n_chars")).otherwise(F.length("redacted").cast("long"))
    return found.select("doc_id", F.col("redacted").alias("text"), "lang", "source", n_chars.alias("n_chars"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the mix takes words, with the number it takes (repeats counted) and what it takes.

    text and n_chars stay those of the whole document; passes tells how often the mix takes it whole, ranges which words
    it takes once more, so that taken = passes * size + the words of the ranges. Documents without words give none and
    are left out; null ids, null sources and repeated rows count as rows; an empty table stays empty.
    """
    return mix(docs, keep=REST).where("taken > 0").select(*COLUMNS, "size", "target", "taken", "passes", "ranges")


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("mixing", mixing),
]

#: SQL expresses neither the trained classifier nor XXH64 fingerprints; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; every stage's result is cut to a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
