"""Near-duplicate vectors by an epsilon grid order join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxlake.llm.common import cut, joined_by_size, numbered
from rxlake.llm.components import connected_components
from rxlake.llm.simhash import LINKS, _forest

#: Vectors on which the principal directions are fitted, at most (they steer
#: the order and the skipping only, never which pairs link).
FIT_VECTORS = 4096
#: Leading principal dimensions that are ordered and boxed, and those on which
#: a pair is bounded before it is compared in full.
DIMS = 8
BOUND_DIMS = 20
#: Bytes of one block of the ordered sequence, and blocks of one tile.
BLOCK_BYTES = 2 << 20
TILE = 4
#: Rows at which the recursion compares instead of splitting.
LEAF = 512


def usable(vector: str) -> Column:
    """Not null, every component present and finite, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(vector).isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def _unit(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    out /= np.abs(out).max(axis=1, keepdims=True)  # keeps the squares of tiny and huge components finite
    return out / np.sqrt(np.einsum("ij,ij->i", out, out))[:, None]


def _directions(nodes: DataFrame, width: int) -> np.ndarray:
    """Leading principal directions of a bounded sample (smallest hashes)."""
    sample = nodes.orderBy(F.xxhash64("vec"), "low").limit(FIT_VECTORS).select("vec").collect()
    x = _unit([r["vec"] for r in sample], width)
    _, v = np.linalg.eigh(np.cov(x.T) if len(x) > 1 else np.eye(width))
    return np.ascontiguousarray(v.reshape(width, width)[:, ::-1][:, :BOUND_DIMS])


def _gap(lo_a: np.ndarray, hi_a: np.ndarray, lo_b: np.ndarray, hi_b: np.ndarray) -> float:
    d = np.maximum(0.0, np.maximum(lo_a - hi_b, lo_b - hi_a))
    return float(d @ d)


class Sequence:
    """A run of the ordered sequence: unit vectors, their leading principal
    coordinates (all boxed and bounded ones) and the length of the rest."""

    def __init__(self, x: np.ndarray, basis: np.ndarray) -> None:
        self.x, self.lead = x, x @ basis
        self.bound = self.lead.astype(np.float32)
        self.rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", self.lead, self.lead))).astype(np.float32)

    def __len__(self) -> int:
        return len(self.x)


def join_sequences(a: Sequence, b: Sequence, cosine: float, same: bool, seen: list[int] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i in a, j in b; i < j if both are one sequence) with at
    least that cosine.  Sequence intervals are halved recursively; a pair of
    intervals whose boxes on the leading dimensions lie further apart than the
    distance of that cosine is skipped whole.  In a leaf the leading
    coordinates bound every pair's cosine (their product, and Cauchy's
    inequality on the rest); only pairs that may reach it are compared in
    full, in doubles.  ``seen`` adds up the pairs of the two sequences and those
    compared in full."""
    limit = 2.0 * (1.0 - cosine) + 1e-9
    least = np.float32(cosine - 1e-4)  # single precision errs by far less
    todo = [(0, len(a), 0, len(b))]
    if seen is not None:
        seen[0] += len(a) * (len(a) - 1) // 2 if same else len(a) * len(b)
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if a0 >= a1 or b0 >= b1 or (same and b1 - 1 <= a0):
            continue
        pa_, pb = a.lead[a0:a1, :DIMS], b.lead[b0:b1, :DIMS]
        if _gap(pa_.min(0), pa_.max(0), pb.min(0), pb.max(0)) > limit:
            continue
        if max(a1 - a0, b1 - b0) > LEAF:
            if a1 - a0 >= b1 - b0:
                m = (a0 + a1) // 2
                todo += [(a0, m, b0, b1), (m, a1, b0, b1)]
            else:
                m = (b0 + b1) // 2
                todo += [(a0, a1, b0, m), (a0, a1, m, b1)]
            continue
        most = a.bound[a0:a1] @ b.bound[b0:b1].T
        most += a.rest[a0:a1, None] * b.rest[None, b0:b1]
        i, j = np.nonzero(most >= least)
        i, j = i + a0, j + b0
        if same:
            i, j = i[i < j], j[i < j]
        if seen is not None:
            seen[1] += len(i)
        for lo in range(0, len(i), 1 << 15):  # few rows at a time
            k, m = i[lo : lo + (1 << 15)], j[lo : lo + (1 << 15)]
            linked = np.einsum("ij,ij->i", a.x[k], b.x[m]) >= cosine
            if linked.any():
                yield k[linked], m[linked]


def _block_join(
    vectors: DataFrame, *, cosine: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding"
) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """(rows, distinct vectors in order, what the tasks of the join found);
    without a usable vector the last two are None."""
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("vec"))
    grouped = cut(rows.filter(usable("vec")).groupBy("vec").agg(F.min("id").alias("low"), F.count("*").alias("copies")))
    about = grouped.agg(F.max(F.size("vec")).alias("width"), F.count("*").alias("n")).first()
    if not about["n"]:
        return rows, None, None
    width, eps = about["width"], float(np.sqrt(2.0 * (1.0 - cosine)))
    basis = _directions(grouped, width)
    dims = min(DIMS, basis.shape[1])
    per_block = max(1, BLOCK_BYTES // (8 * width))

    def place(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            p = _unit(b.column(0).to_pylist(), width) @ basis[:, :dims] if b.num_rows else np.empty((0, dims))
            cells = pa.array(list(np.floor(p / eps).astype(np.int32)), pa.list_(pa.int32()))
            lead = pa.array(p[:, 0])
            yield pa.RecordBatch.from_arrays([*b.columns, cells, lead], ["vec", "low", "copies", "cells", "lead"])

    vec_type = grouped.schema["vec"].dataType.simpleString()
    id_type = grouped.schema["low"].dataType.simpleString()
    placed = grouped.mapInArrow(place, f"vec {vec_type}, low {id_type}, copies long, cells array<int>, lead double")
    keys = [F.col("cells")[k] for k in range(dims)]
    nodes = numbered(placed.withColumn("_h", F.xxhash64("vec")), [*keys, F.col("lead"), F.col("_h")], "node")
    nodes = nodes.select("vec", "low", "copies", "node")
    nodes = nodes.withColumn("block", F.floor(F.col("node") / per_block))

    def gather(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["block", "nodes", "copies", "matrix", "lo", "hi"]
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            x = _unit([h[1] for h in held], width)
            p = x @ basis[:, :dims]
            cols = [[held[0][0]], [np.array([h[2] for h in held], np.int64).tobytes()], [np.array([h[3] for h in held], np.int64).tobytes()], [x.tobytes()], [p.min(0).tolist()], [p.max(0).tolist()]]
            types = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

        for b in it:
            for row in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if held and held[0][0] != row[0]:
                    yield block()
                    held = []
                held.append(row)
        if held:
            yield block()

    dealt = nodes.select("block", "vec", "node", "copies").repartition("block").sortWithinPartitions("block", "node")
    blocks = cut(dealt.mapInArrow(gather, "block long, nodes binary, copies binary, matrix binary, lo array<double>, hi array<double>"))
    # tiles of consecutive blocks meet; a block travels once per tile pair, not once per block pair
    box = lambda side, f: F.array(*[f(F.col(side)[k]).alias(f"_{k}") for k in range(dims)])
    tiled = blocks.withColumn("tile", F.floor(F.col("block") / TILE))
    tiles = tiled.groupBy("tile").agg(box("lo", F.min).alias("lo"), box("hi", F.max).alias("hi"))
    cell = lambda side: F.floor(F.col(side)[0] / eps)
    boxes = tiles.select("tile", "lo", "hi", F.explode(F.sequence(cell("lo"), cell("hi") + 1)).alias("cell"))
    other = boxes.select(F.col("tile").alias("other"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"), "cell")
    gaps = [F.greatest(F.lit(0.0), F.col("lo")[k] - F.col("hi2")[k], F.col("lo2")[k] - F.col("hi")[k]) for k in range(dims)]
    pairs = (
        boxes.join(other, "cell")
        .filter((F.col("tile") <= F.col("other")) & (sum((g * g for g in gaps), F.lit(0.0)) <= eps * eps + 1e-9))
        .select("tile", "other")
        .distinct()
    )
    ends = pairs.select(F.col("tile").alias("_t"), F.col("other").alias("_u"), F.explode(F.array_distinct(F.array("tile", "other"))).alias("tile"))
    work = tiled.join(ends, "tile").select("_t", "_u", "tile", "block", "nodes", "copies", "matrix", "lo", "hi")
    work = work.repartition("_t", "_u").sortWithinPartitions("_t", "_u", "block")

    def compare(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def joined(key: tuple, held: list[tuple]) -> Iterator[pa.RecordBatch]:
            """All block pairs of a tile pair that the boxes leave."""
            whole = [(t, block, n, c, Sequence(x, basis), lo, hi) for t, block, n, c, x, lo, hi in held]
            for k, (t, block, na, ca, xa, lo, hi) in enumerate(whole):
                for u, other_, nb, cb, xb, lo2, hi2 in whole[k:]:
                    if (t, u) == key and _gap(lo, hi, lo2, hi2) <= eps * eps + 1e-9:
                        yield _compared(na, ca, xa, nb, cb, xb, cosine, block == other_)

        key, held = None, []
        for b in it:
            for k in range(b.num_rows):
                t, u, tile, block = (b.column(c)[k].as_py() for c in range(4))
                if (t, u) != key:
                    yield from joined(key, held)
                    key, held = (t, u), []
                n, c, x = (np.frombuffer(b.column(m)[k].as_buffer(), d) for m, d in ((4, "i8"), (5, "i8"), (6, "f8")))
                held.append((tile, block, n, c, x.reshape(len(n), width), np.array(b.column(7)[k].as_py()), np.array(b.column(8)[k].as_py())))
        yield from joined(key, held)

    return rows, nodes, cut(work.mapInArrow(compare, "node long, links long, to long, pairs long, compared long"))


def join_statistics(vectors: DataFrame, **options) -> DataFrame:
    """``vectors, pairs, compared``: distinct vectors, their pairs, and how many
    of them were compared in full."""
    _, nodes, found = _block_join(vectors, **options)
    if nodes is None:
        return vectors.sparkSession.createDataFrame([(0, 0, 0)], "vectors long, pairs long, compared long")
    n = nodes.count()
    return found.agg(F.lit(n).cast("long").alias("vectors"), F.lit(n * (n - 1) // 2).cast("long").alias("pairs"), F.sum("compared").alias("compared"))


def linked_vectors(vectors: DataFrame, *, cosine: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id, n_links, component_id`` per row.

    Distinct vectors (copies collapse with their count before any shuffle) are
    ordered by the grid cells of side epsilon, the distance of that cosine, on
    the leading principal dimensions and cut into equal blocks of the
    sequence.  Tiles of blocks meet through an equi-join on the first
    dimension's cells, pairs of tiles, blocks and intervals whose boxes are
    provably too far apart are dropped, and of the rest only pairs whose bound
    on BOUND_DIMS dimensions allows it are compared in full.  A task gives
    counts per vector and a spanning forest, never the pairs.

    Vectors that are null, empty, all zero or hold null or non-finite
    components link with nothing; shorter vectors count as filled up with
    zeros; a null id never is a component's id unless no member has one;
    repeated rows are vectors of their own; an empty table gives no rows.
    """
    rows, nodes, joined = _block_join(vectors, cosine=cosine, id_col=id_col, vector_col=vector_col)
    if nodes is None:
        return rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    found = joined.filter("node is not null").select("node", "links", "to")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected_components(found.filter("node <> to"), "node", "to")
    members = nodes.select("vec", "low", "copies", "node").join(links, "node", "left").join(
        roots.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left"
    )
    members = members.select(
        F.col("vec").alias("_vec"), "low", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("root")
    )
    lowest = members.groupBy("root").agg(F.min("low").alias("component_id"), F.count("*").alias("_n"))
    labelled = joined_by_size(members, lowest, "root", nodes.count()).select("_vec", "n_links", "component_id")
    return rows.join(labelled, F.col("vec") == F.col("_vec"), "left").select(
        "id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def _compared(na: np.ndarray, ca: np.ndarray, xa: Sequence, nb: np.ndarray, cb: np.ndarray, xb: Sequence, cosine: float, same: bool) -> pa.RecordBatch:
    """Links of two blocks: per linked node its number of links there (copies
    counted) and the smallest node it hangs together with there; in a last row
    the pairs and those compared in full."""
    nodes = na if same else np.concatenate([na, nb])
    shift = 0 if same else len(na)
    links = np.zeros(len(nodes), np.int64)
    fa, fb, held, seen = [np.empty(0, np.int64)], [np.empty(0, np.int64)], 0, [0, 0]
    for i, j in join_sequences(xa, xb, cosine, same, seen):
        np.add.at(links, i, cb[j])
        np.add.at(links, j + shift, ca[i])
        fa.append(i)
        fb.append(j + shift)
        held += len(i)
        if held > LINKS:
            root = _forest(np.concatenate(fa), np.concatenate(fb), len(nodes))
            child = np.flatnonzero(root != np.arange(len(nodes)))
            fa, fb, held = [child], [root[child]], len(child)
    root = _forest(np.concatenate(fa), np.concatenate(fb), len(nodes))
    some = np.flatnonzero(links)
    none = [None] * len(some)
    columns = [[*nodes[some].tolist(), None], [*links[some].tolist(), None], [*nodes[root[some]].tolist(), None], [*none, seen[0]], [*none, seen[1]]]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["node", "links", "to", "pairs", "compared"])


def near_vectors(vectors: DataFrame, *, id_col: str = "vec_id", **options) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``vectors``."""
    found = linked_vectors(vectors, id_col=id_col, **options)
    return found.select(
        F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
