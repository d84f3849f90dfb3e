"""Merkle manifest of a dataset, with a proof for every row, over nested-interval labels.

A node of the tree carries the interval [lo, hi) of leaf ranks it covers. Ancestors are attached by containment: at a
level whose nodes cover `fan ** level` ranks, a node can only lie in the parent of its own bucket, so the join is one of
equal (tree, bucket) with the containment of the intervals checked. What the parent's interval has beyond a node's own
are its siblings, left and right. Proofs run from the root down, so an upper part is built once for each of its nodes
and given on to the leaves within the run that its node covers; no leaf is joined by source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import cut

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<left:string,right:string>>"


def hashed(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts' text one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def fielded(c: Column) -> Column:
    """`-` for a null, else the UTF-8 byte count, `:` and the value."""
    c = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c))


def ranked(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """rows with lo, the rank by `order` within the tree (from 0), and n, the rows of the tree.

    Rows are sorted over range partitions by tree and order, written, and counted by (partition, tree); the sums of the
    counts before give the ranks. A tree of any size spreads over partitions, and so do rows that are equal in `order`.
    """
    kept = rows.columns
    sort = [tree, *order, "_tie"]
    tied = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*sort).sortWithinPartitions(*sort)
    placed = cut(tied.select(*kept, F.monotonically_increasing_id().alias("_at")), "ranked")
    part = F.shiftright("_at", 33)
    counts = placed.groupBy(part.alias("_part"), F.col(tree).alias("_tree")).agg(F.min("_at").alias("_from"), F.count(F.lit(1)).alias("_n"))
    before = "sum(_n) over (partition by _tree order by _part rows between unbounded preceding and 1 preceding)"
    counts = counts.select("_part", "_tree", "_from", F.expr(f"coalesce({before}, 0L)").alias("_before"), F.expr("sum(_n) over (partition by _tree)").alias("n"))
    joined = placed.join(counts, (part == F.col("_part")) & (F.col(tree) == F.col("_tree")))
    return joined.select(*kept, (F.col("_at") - F.col("_from") + F.col("_before")).alias("lo"), "n")


def parents(nodes: DataFrame, level: int, fan: int, carried: list[str]) -> DataFrame:
    """The nodes of a level over those of the level below, of trees that have more than one there; one row each.

    parts are the children (lo, hi, digest and what they carry) in order, `fan` at most.
    """
    width = fan**level
    own = nodes.where(F.col("n") > width // fan).select("tree", "n", F.expr(f"lo div {width}").alias("bucket"), F.struct("lo", "hi", "digest", *carried).alias("part"))
    runs = own.groupBy("tree", "bucket").agg(F.max("n").alias("n"), F.array_sort(F.collect_list("part")).alias("parts"))
    return runs.select(
        "tree", "n", (F.col("bucket") * width).alias("lo"), F.least((F.col("bucket") + 1) * width, F.col("n")).alias("hi"),
        hashed(F.array_join(F.transform("parts", lambda p: p["digest"]), "")).alias("digest"), "parts",
    )


def beside(parts: Column, lo: Column, hi: Column) -> Column:
    """The step of a path: digests in the parent's interval before and behind [lo, hi)."""

    def joined(keep):
        return F.array_join(F.transform(F.filter(parts, keep), lambda p: p["digest"]), "")

    return F.struct(joined(lambda p: p["hi"] <= lo).alias("left"), joined(lambda p: p["lo"] >= hi).alias("right"))


def spread_down(above: DataFrame, given: list[str]) -> DataFrame:
    """The children of the nodes in `above` (with parts, path and given), each with its path from itself to the root."""
    each = above.select("tree", "n", "parts", F.col("path").alias("_path"), *given, F.explode("parts").alias("p"))
    step = beside(F.col("parts"), F.col("p.lo"), F.col("p.hi"))
    return each.select("tree", "n", "p.*", F.concat(F.array(step), F.col("_path")).alias("path"), *given)


def grown(leaves: DataFrame, fan: int, carried: list[str]) -> list[DataFrame]:
    """Levels of the trees over leaves (tree, lo, n, digest, carried): the leaves, and the nodes of each level, as tables.

    Level l has only trees with more than fan ** (l - 1) leaves; n tells how many leaves a tree has in all.
    """
    levels = [leaves.withColumn("hi", F.col("lo") + 1)]
    most = leaves.agg(F.max("n")).first()[0] or 0
    while fan ** (len(levels) - 1) < most:
        level = len(levels)
        levels.append(cut(parents(levels[-1], level, fan, carried if level == 1 else []), f"level-{level}"))
    return levels


def tops(levels: list[DataFrame], fan: int) -> list[DataFrame]:
    """Of every level the nodes that cover a whole tree."""
    return [nodes.where((F.col("lo") == 0) & (F.col("hi") == F.col("n"))) for nodes in levels]


def descended(levels: list[DataFrame], roots: DataFrame, fan: int, carried: list[str], given: list[str]) -> DataFrame:
    """Leaves (tree, n, lo, hi, digest, carried, path, given), where roots (tree, path, given) says what is above each tree.

    From the highest level down, the nodes take their parent's path by containment: equal tree and bucket, and intervals
    one within the other; the nodes that cover a tree take what is in roots.
    """
    whole = tops(levels, fan)
    above = None
    for level in range(len(levels) - 1, 0, -1):
        nodes = whole[level].join(roots, "tree")
        if above is not None:
            width = fan ** (level + 1)
            up = spread_down(above, given).select(F.col("tree").alias("_tree"), F.expr(f"lo div {width}").alias("_bucket"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), "path", *given)
            within = (F.col("tree") == F.col("_tree")) & (F.expr(f"lo div {width}") == F.col("_bucket")) & (F.col("lo") >= F.col("_lo")) & (F.col("hi") <= F.col("_hi"))
            nodes = nodes.unionByName(levels[level].join(up, within).select(*levels[level].columns, "path", *given))
        above = nodes
    lone = whole[0].join(roots, "tree").select("tree", "n", "lo", "hi", "digest", *carried, "path", *given)
    return lone if above is None else spread_down(above, given).unionByName(lone)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings along its path give."""
    return F.aggregate(path, leaf, lambda digest, step: hashed(step["left"], digest, step["right"]))


def manifest(
    docs: DataFrame,
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    source_col: str = "source",
    tampered: dict[str, Column] | None = None,
    fan: int = 16,
) -> DataFrame:
    """doc_id, source, leaf, subroot, root, proof, folded_root, verified for every row of docs.

    A leaf is the hash of the row's columns, each told by its length; per source, leaves ascend by id (null first, equal
    ids by leaf) and every `fan` consecutive nodes become one until one is left, the subroot; subroots by source (null
    first) likewise become the root. proof has a step (left, right: digests joined) for every level from the leaf to the
    root. folded_root is what the leaf gives with that proof where `tampered` (column -> expression) replaces columns;
    verified tells whether that is the root. A lone leaf is its subroot, a lone subroot the root. Rows that repeat in all
    columns are leaves of their own, and of equal proofs apart from their place; nulls of any column are told from empty
    values; an empty table gives an empty result; further columns are ignored.
    """
    named = {c: F.col(c) for c in columns}
    changed = {**named, **(tampered or {})}

    def leaf_of(values: dict[str, Column]) -> Column:
        return hashed(*[fielded(values[c]) for c in columns])

    differs = F.lit(False)
    for c in tampered or {}:
        differs = differs | ~changed[c].eqNullSafe(named[c])
    source = F.col(source_col).cast("string")
    leaves = docs.select(
        F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit(":"), source)).alias("tree"),
        F.col(id_col).cast("long").alias("doc_id"),
        leaf_of(named).alias("digest"),
        F.when(differs, leaf_of(changed)).alias("changed"),
    )
    carried = ["doc_id", "changed"]
    levels = grown(ranked(leaves, "tree", ["doc_id", "digest"]), fan, carried)
    subroots = None
    for nodes in tops(levels, fan):
        own = nodes.select("tree", F.col("digest").alias("subroot"))
        subroots = own if subroots is None else subroots.unionByName(own)
    over = ranked(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("subroot").alias("digest")), "tree", ["of"])
    upper = grown(over, fan, ["of"])
    roots = None
    for nodes in tops(upper, fan):
        own = nodes.select("tree", F.expr(f"cast(array() as {PATH})").alias("path"), F.col("digest").alias("root"))
        roots = own if roots is None else roots.unionByName(own)
    named_roots = descended(upper, roots, fan, ["of"], ["root"]).select(F.col("of").alias("tree"), F.col("digest").alias("subroot"), "path", "root")
    told = descended(levels, cut(named_roots, "subroots"), fan, carried, ["subroot", "root"])
    found = told.withColumn("folded_root", folded(F.coalesce("changed", "digest"), F.col("path")))
    return found.select(
        "doc_id", F.when(F.col("tree") != "", F.expr("substring(tree, 2)")).alias("source"), F.col("digest").alias("leaf"), "subroot", "root",
        F.col("path").alias("proof"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def proof_digest(proof: Column) -> Column:
    """The hash of a proof's siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


def lowered(text: Column) -> Column:
    """A-Z as a-z; other letters stay."""
    return F.translate(text, CAPITALS, SMALL)


def changed_rows(id_col: str, every: int) -> Column:
    """Rows whose id's unsigned crc32 is a multiple of `every`."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % every == 0
