"""Merkle manifest of a dataset: one tree per group, one tree over the groups.

The nodes of a level are rows (tree, index, hash).  A node's sibling in its run
of two has the index XOR 1, so every level is one equijoin of the nodes with
themselves; the rows of slot zero then emit their parents.  The paths of all
leaves are handed down the same levels, parent to child.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxlake.llm.common import cut, numbered
from rxlake.session import scratch_path


NO_PATH = "cast(array() as array<struct<sibling: binary, left: boolean>>)"
#: Levels from one written level to the next.
STRIDE = 2


def digest(*parts: Column) -> Column:
    """SHA-256 of the digests' hex text, one after the other (null: none)."""
    text = F.concat(*[F.coalesce(F.lower(F.hex(p)), F.lit("")) for p in parts])
    return F.unhex(F.sha2(text.cast("binary"), 256))


def field_hash(*fields: Column) -> Column:
    """SHA-256 of the fields: ``-`` for null, else size in bytes, colon, value."""
    texts = [f.cast("string") for f in fields]
    named = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.unhex(F.sha2(F.concat(*named).cast("binary"), 256))


@dataclass(frozen=True)
class Tree:
    """``levels[k]``: ``tree, at, hash, sibling, n`` of the nodes of level k (n:
    nodes of the tree there; a finished tree's root goes on alone);
    ``roots``: ``tree, root``."""

    levels: list[DataFrame]
    roots: DataFrame


def _written(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "merkle")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _with_siblings(nodes: DataFrame) -> DataFrame:
    siblings = nodes.select("tree", F.col("at").bitwiseXOR(F.lit(1).cast("long")).alias("at"), F.col("hash").alias("sibling"))
    return nodes.hint("merge").join(siblings, ["tree", "at"], "left").select("tree", "at", "hash", "sibling", "n")


def _parents(level: DataFrame) -> DataFrame:
    first = level.filter(F.col("at").bitwiseAND(F.lit(1).cast("long")) == 0)  # slot zero of its run
    up = F.when(F.col("n") > 1, digest(F.col("hash"), F.col("sibling"))).otherwise(F.col("hash"))
    return first.select("tree", F.shiftright("at", 1).alias("at"), up.alias("hash"), F.shiftright(F.col("n") + 1, 1).alias("n"))


def grow(leaves: DataFrame) -> Tree:
    """The trees over ``tree, at, hash, n`` (index from 0; n: leaves of the
    tree), level by level.  A lone last node is hashed alone; a tree of one
    leaf is that leaf.  Every STRIDE-th level is written, the ones between are
    derived again from it, so lineage stays short with few jobs."""
    levels: list[DataFrame] = []
    nodes = leaves
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        level = _with_siblings(nodes)
        levels.append(level if len(levels) % STRIDE else _written(level))
        nodes = _parents(levels[-1])
        most = (most + 1) // 2
    return Tree(levels, _written(nodes.select("tree", F.col("hash").alias("root"))))


def paths(tree: Tree) -> DataFrame | None:
    """``tree, at, path`` of every leaf, unless all trees are single leaves: the
    siblings from its own level to the top (``sibling``, null where the run
    has no other, and ``left``: it stands before the node).  A level's paths
    are its parents' paths with its own sibling in front."""
    found = None
    for k in range(len(tree.levels) - 1, -1, -1):
        step = F.struct(F.col("sibling"), (F.col("at").bitwiseAND(F.lit(1).cast("long")) == 1).alias("left"))
        own = F.when(F.col("n") > 1, F.array(step)).otherwise(F.expr(NO_PATH))
        nodes = tree.levels[k].select("tree", "at", own.alias("path"))
        if found is None:
            found = nodes
        else:
            above = found.select("tree", F.col("at").alias("_up"), F.col("path").alias("_path"))
            joined = nodes.withColumn("_up", F.shiftright("at", 1)).hint("merge").join(above, ["tree", "_up"])
            found = joined.select("tree", "at", F.concat("path", "_path").alias("path"))
        if k and k % STRIDE == 0:
            found = _written(found)
    return found


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    none = F.lit(None).cast("binary")
    return F.aggregate(
        path, leaf,
        lambda node, step: digest(F.when(step["left"], step["sibling"]).otherwise(none), node, F.when(step["left"], none).otherwise(step["sibling"])),
    )


def proof(path: Column) -> Column:
    """SHA-256 over all siblings of the path, in its order, as hex."""
    listed = F.transform(path, lambda s: F.coalesce(F.lower(F.hex(s["sibling"])), F.lit("")))
    return F.sha2(F.array_join(listed, "").cast("binary"), 256)


def manifest(
    docs: DataFrame, *, id_col: str = "doc_id", group_col: str = "lang", fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    tampered: dict[str, Column] | None = None,
) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    ``tampered`` replaces fields of the rows to be verified: ``folded_root`` is
    folded from the replaced row's leaf and the original siblings, and
    ``verified`` says that it is the root.

    Leaves ascend by id (null first) inside their group, rows of one id by
    leaf hash, so repeated rows are leaves of their own; groups are ordered by
    value, null first.  A null field is hashed as ``-``; empty and long texts
    are hashed whole; other columns are not read; no rows give none.  A group
    of most rows is numbered and joined by index, so no task holds it.
    """
    kept = {c: F.col(f"`{c}`") for c in fields}
    changed = kept | (tampered or {})
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{group_col}`").alias("group"),
        field_hash(*kept.values()).alias("leaf"), field_hash(*changed.values()).alias("shown"),
    )
    placed = numbered(rows, [F.col("group").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf").asc()])
    groups = placed.groupBy("group").agg(F.min("at").alias("_from"), F.count("*").alias("n"))
    groups = numbered(groups, [F.col("group").asc_nulls_first()], "tree").select(F.col("group").alias("_group"), "tree", "_from", "n")
    leaves = cut(
        placed.join(groups, F.col("group").eqNullSafe(F.col("_group")))
        .select("doc_id", "leaf", "shown", "tree", (F.col("at") - F.col("_from")).alias("at"), "n")
    )
    lower = grow(leaves.select("tree", "at", F.col("leaf").alias("hash"), "n"))
    trees = lower.roots.count()
    upper = grow(lower.roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at"), F.col("root").alias("hash"), F.lit(trees).cast("long").alias("n")))
    top = upper.roots.select(F.col("root").alias("root")).scalar()
    subroots = lower.roots.select(F.col("tree").alias("_tree"), F.col("root").alias("subroot"))
    above, below = paths(upper), paths(lower)
    none = F.expr(NO_PATH)
    if above is None:
        subroots = subroots.withColumn("_above", none)
    else:
        over = above.select(F.col("at").alias("_at"), F.col("path").alias("_above"))
        subroots = subroots.join(over, F.col("_tree") == F.col("_at")).drop("_at")
    if below is None:
        whole = leaves.withColumn("path", none)
    else:
        whole = leaves.hint("merge").join(below, ["tree", "at"], "left")
    joined = whole.join(subroots, F.col("tree") == F.col("_tree"))
    full = F.concat(F.coalesce(F.col("path"), none), F.col("_above"))
    text = lambda c: F.lower(F.hex(c))
    out = joined.select("doc_id", "leaf", "shown", "subroot", top.alias("root"), full.alias("path"))
    out = out.select("doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), folded(F.col("shown"), F.col("path")).alias("folded"))
    return out.select(
        "doc_id", text("leaf").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root"), "proof_sha256",
        text("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )
