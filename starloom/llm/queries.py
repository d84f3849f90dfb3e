"""One query per operator, with production parameters over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from starloom.llm.chaining import fuzzy_passages
from starloom.llm.common import table
from starloom.llm.decontaminate import contamination
from starloom.llm.embeddings import near_duplicates
from starloom.llm.langid import identify
from starloom.llm.licenses import scan_licenses
from starloom.llm.lm import pseudo_likelihood
from starloom.llm.manifest import changed_rows, lowered, manifest, proof_digest
from starloom.llm.mixing import mix
from starloom.llm.secrets import scan_secrets
from starloom.llm.simhash import simhash_groups
from starloom.llm.spelling import spelling_variants
from starloom.llm.suffix import repeated_passages
from starloom.llm.toxicity import score_toxicity


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op2_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood(table(spark, sf_dir, "documents"))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op4_chaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_passages(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("hits").alias("h")).select("doc_id", "h.*")


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents")).drop("redacted")


def op11_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("notices", "expressions")


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(changed_rows("doc_id", 5), lowered(F.col("text"))).otherwise(F.col("text"))
    told = manifest(table(spark, sf_dir, "documents"), tampered={"text": text})
    return told.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", "verified")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), noise=199)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix": op1_mix,
    "op2_lm": op2_lm,
    "op3_langid": op3_langid,
    "op4_chaining": op4_chaining,
    "op5_toxicity": op5_toxicity,
    "op6_suffix": op6_suffix,
    "op7_simhash": op7_simhash,
    "op8_decontaminate": op8_decontaminate,
    "op9_embeddings": op9_embeddings,
    "op10_secrets": op10_secrets,
    "op11_license": op11_license,
    "op12_manifest": op12_manifest,
    "op13_spelling": op13_spelling,
    "pipeline": pipeline,
}

MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size,
         md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(md5(text), '')) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS ss, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no FROM d GROUP BY source),
w AS (SELECT *, CASE no % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::DOUBLE AS w, 2.0::DOUBLE * ss AS cap,
             1.5::DOUBLE * sum(ss) OVER () AS total FROM s),
f AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / w, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER (ORDER BY cap / w, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) > cap / w AS full_ FROM w),
t AS (SELECT *, CASE WHEN full_ THEN cap ELSE w * (total - coalesce(sum(cap) FILTER (WHERE full_) OVER (), 0))
             / sum(w) FILTER (WHERE NOT full_) OVER () END AS target,
             greatest(1, ceil(ss / greatest(250000, floor(sum(ss) OVER () / 50000))))::BIGINT AS shards FROM f),
p AS (SELECT d.*, t.no, t.ss, t.target, ('0x' || substr(h, 1, 8))::BIGINT % shards AS shard
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT no, shard, sum(size)::BIGINT AS cs, ceil(sum(size) / 32)::BIGINT AS n, max(target) * sum(size) / nullif(max(ss), 0) AS votes
      FROM p GROUP BY no, shard),
q AS (SELECT no, shard, row_number() OVER (ORDER BY votes / (2 * k + 1) DESC, no, shard) AS place
      FROM c, range(0, (SELECT 2 * max(n) FROM c)) r(k) WHERE k < 2 * n AND votes > 0),
g AS (SELECT no, shard, count(*) AS quota FROM q WHERE place <= (SELECT round_even(sum(target) / 32, 0) FROM t) GROUP BY no, shard),
b AS (SELECT c.no, c.shard, greatest(n, 1) AS n, coalesce(quota, 0) // greatest(n, 1) AS passes, coalesce(quota, 0) % greatest(n, 1) AS more,
             ('0x' || substr(md5('17:' || c.no || ':' || c.shard), 1, 8))::BIGINT % greatest(n, 1) AS phase
      FROM c LEFT JOIN g ON c.no = g.no AND c.shard = g.shard),
e AS (SELECT p.*, sum(size) OVER (PARTITION BY no, shard ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS fin FROM p),
x AS (SELECT e.*, n, passes, more, phase, fin - size AS st FROM e JOIN b USING (no, shard))
SELECT doc_id, size, ss AS source_size, target, (passes * size
  + ((fin // 32) * more + phase) // n * 32 + (fin % 32) * (((fin // 32 + 1) * more + phase) // n - ((fin // 32) * more + phase) // n)
  - ((st // 32) * more + phase) // n * 32 - (st % 32) * (((st // 32 + 1) * more + phase) // n - ((st // 32) * more + phase) // n))::BIGINT AS taken
FROM x
"""

EMBEDDINGS_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
ok AS MATERIALIZED (SELECT * FROM v WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(e) > 0
  AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.93),
re AS (SELECT vec_id AS id, vec_id AS low FROM v UNION SELECT l.b, re.low FROM re JOIN l ON re.id = l.a WHERE re.low < l.b),
k AS (SELECT id, min(low) AS component_id FROM re GROUP BY id), n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, k.component_id, v.vec_id = k.component_id AS kept
FROM v LEFT JOIN n ON v.vec_id = n.a LEFT JOIN k ON v.vec_id = k.id
"""

#: crc32 of the bytes in the column `hex` (two hex digits each), letter by letter and bit by bit.
CRC32 = """xor(4294967295, list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(range(length(hex) // 2), lambda i: ('0x' || substr(hex, 2 * i + 1, 2))::BIGINT)),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def leaf_sql(text: str) -> str:
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"coalesce(CAST(strlen({c}) AS VARCHAR) || ':' || {c}, '-')" for c in fields) + ")"


def beside_sql(key: str) -> str:
    """What stands left and right of a node in its run, over tables of nodes."""
    run = f"string_agg(digest, '') OVER (PARTITION BY {key} ORDER BY lo ROWS BETWEEN"
    return f"coalesce({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, coalesce({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r"


MANIFEST_SQL = f"""
WITH RECURSIVE h AS (SELECT *, hex(CAST(doc_id AS VARCHAR)) AS hex FROM documents),
d0 AS (SELECT doc_id, source, {leaf_sql("text")} AS leaf, CASE WHEN {CRC32} % 5 = 0 THEN {leaf_sql(LOWER.format("text"))} END AS changed FROM h),
d AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS lo, count(*) OVER (PARTITION BY source) AS n,
             row_number() OVER () AS id FROM d0),
t(source, level, lo, n, digest) AS (
  SELECT source, 0::BIGINT, lo, n, leaf FROM d UNION ALL
  SELECT source, level + 1, lo // 16, (max(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY lo)) FROM t WHERE n > 1 GROUP BY source, level, lo // 16),
s AS (SELECT source, level, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS lo, count(*) OVER () AS n FROM t WHERE n = 1),
u(level, lo, n, digest) AS (
  SELECT 0::BIGINT, lo, n, subroot FROM s UNION ALL
  SELECT level + 1, lo // 16, (max(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY lo)) FROM u WHERE n > 1 GROUP BY level, lo // 16),
tb AS (SELECT source, level, lo, {beside_sql("source, level, lo // 16")} FROM t WHERE n > 1),
ub AS (SELECT level, lo, {beside_sql("level, lo // 16")} FROM u WHERE n > 1),
f(id, source, level, lo, digest, proof) AS (
  SELECT id, source, 0::BIGINT, lo, coalesce(changed, leaf), '' FROM d UNION ALL
  SELECT f.id, f.source, f.level + 1, f.lo // 16, sha256(l || digest || r), proof || l || r
  FROM f JOIN tb ON f.source IS NOT DISTINCT FROM tb.source AND f.level = tb.level AND f.lo = tb.lo),
g(id, level, lo, digest, proof) AS (
  SELECT id, 0::BIGINT, s.lo, digest, proof FROM f JOIN s ON f.source IS NOT DISTINCT FROM s.source AND f.level = s.level UNION ALL
  SELECT g.id, g.level + 1, g.lo // 16, sha256(l || digest || r), proof || l || r FROM g JOIN ub ON g.level = ub.level AND g.lo = ub.lo)
SELECT d.doc_id, d.leaf, s.subroot, u.digest AS root, sha256(g.proof) AS proof_sha256, g.digest AS folded_root, g.digest = u.digest AS verified
FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source JOIN u ON u.n = 1 JOIN g ON g.id = d.id AND g.level = u.level
"""

SPELLING_SQL = f"""
WITH RECURSIVE r AS (SELECT doc_id, unnest(regexp_extract_all({LOWER.format("text")}, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
k AS (SELECT doc_id, run, count(*) AS k FROM r WHERE length(run) >= 6 GROUP BY ALL),
x AS (SELECT run, k, hex(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run) AS hex FROM k),
h AS (SELECT run, k, {CRC32} AS h FROM x),
w AS MATERIALIZED (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(k)::BIGINT AS n
      FROM h GROUP BY word HAVING length(word) >= 6 AND sum(k) >= 5),
e AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS key FROM w, range(1, 100000) t(i) WHERE i <= length(word)),
p AS (SELECT a.word, b.word AS other, b.n AS n_other FROM e a JOIN e b ON a.key = b.key AND a.i = b.i AND a.word <> b.word
      UNION SELECT a.word, b.word, b.n FROM w a JOIN e b ON a.word = b.key UNION SELECT b.word, a.word, a.n FROM w a JOIN e b ON a.word = b.key),
q AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY n_other DESC, other) AS place, count(*) OVER (PARTITION BY word) AS n_near FROM p),
f AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN n_other >= 5 * w.n THEN other END AS form,
             CASE WHEN n_other >= 5 * w.n THEN n_other END AS form_n FROM w LEFT JOIN q ON w.word = q.word AND place = 1),
z(word, root, next) AS (SELECT word, word, form FROM f UNION ALL SELECT z.word, z.next, f.form FROM z JOIN f ON z.next = f.word)
SELECT f.word, n, n_near, form, form_n, root FROM f JOIN z ON f.word = z.word AND z.next IS NULL
"""

#: The others train a model, hash by XXH64, compress or parse expressions, which SQL cannot state; tests hold them against plain versions.
ORACLE: dict[str, str] = {"op1_mix": MIX_SQL, "op9_embeddings": EMBEDDINGS_SQL, "op12_manifest": MANIFEST_SQL, "op13_spelling": SPELLING_SQL}
