"""SimHash near-dedup with pigeonhole blocks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlake.llm.common import batches, cut
from rxlake.llm.components import connected_components

BITS = 64
#: Rows of a bucket that one tile compares; a larger bucket is cut into tiles.
TILE = 1024
#: Verified links held at once before they are reduced to a forest.
LINKS = 1 << 20


def fingerprint(text: str | None, shingle: int) -> int:
    """The 64-bit SimHash of one whole text (majority of the shingles' XXH64)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    k = min(shingle, len(words))
    first, last = starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for lo in range(0, len(first), 1 << 16):
        part = slice(lo, lo + (1 << 16))
        h = np.array([digest(line[s:e], 42) for s, e in zip(first[part], last[part], strict=True)], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(first), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, fp`` (fp: the 64 bits as a signed long) of every row."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, "text", 32 << 20):
            fp = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["id", "fp"])

    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, "id long, fp long")


def block_masks(blocks: int, same: int) -> list[int]:
    """Signed 64-bit masks, one per choice of ``same`` of the ``blocks``."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    masks = [sum(c) for c in combinations(parts, same)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest reachable index of each of n nodes over the links a-b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        nxt = root.copy()
        np.minimum.at(nxt, root[a], low)
        np.minimum.at(nxt, root[b], low)
        nxt = nxt[nxt]
        if np.array_equal(nxt, root):
            return root
        root = nxt


def _links(bucket: np.ndarray, fp: np.ndarray, side: np.ndarray, cross: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (fp, fp) of the components inside each bucket; rows are
    sorted by bucket.  cross: only rows of different sides are compared."""
    n = len(fp)
    ga, gb, held, step = [np.empty(0, np.int64)], [np.empty(0, np.int64)], 0, 1
    left = np.arange(n)
    while True:
        left = left[left + step < n]
        left = left[bucket[left] == bucket[left + step]]
        if not len(left):
            break
        right = left + step
        near = np.bitwise_count((fp[left] ^ fp[right]).view(np.uint64)) <= distance
        near &= ~cross[left] | (side[left] != side[right])
        ga.append(left[near])
        gb.append(right[near])
        held += int(near.sum())
        step += 1
        if held > LINKS:
            root = _forest(np.concatenate(ga), np.concatenate(gb), n)
            ga, gb = [np.flatnonzero(root != np.arange(n))], [root[root != np.arange(n)]]
            held = len(ga[0])
    root = _forest(np.concatenate(ga), np.concatenate(gb), n)
    child = np.flatnonzero(root != np.arange(n))
    return fp[child], fp[root[child]]


def near_links(distinct: DataFrame, distance: int, blocks: int) -> DataFrame:
    """Links ``a, b`` between fingerprints (column ``fp``, distinct) that span
    the graph of pairs at ``distance`` bits or fewer.

    With ``blocks`` blocks a close pair agrees on at least
    ``blocks - distance`` of them, so it meets in the bucket of one choice of
    that many blocks.  A bucket of more than TILE fingerprints is dealt out as
    tiles (pairs of its chunks) over many tasks; links are verified by Hamming
    distance, and only a forest of each bucket leaves the task, never all its
    pairs.
    """
    masks = block_masks(blocks, blocks - distance)
    keyed = distinct.select(
        "fp",
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in masks])).alias("choice", "key"),
    )
    sizes = keyed.groupBy("choice", "key").agg(F.count("*").alias("n")).filter("n > 1")
    chunks = F.ceil(F.col("n") / TILE).cast("int")
    tiles = (
        keyed.join(sizes, ["choice", "key"])
        .withColumn("side", F.pmod(F.xxhash64("fp"), chunks).cast("int"))
        .select("choice", "key", "fp", "side", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("other"))
        .select("choice", "key", "fp", "side", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"))
    )

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["choice", "key", "lo", "hi", "side", "fp"]
        rest = [np.empty(0, np.int64)] * len(names)
        for b in it:
            cols = [np.concatenate([r, np.asarray(b.column(b.schema.get_field_index(c)))]) for r, c in zip(rest, names, strict=True)]
            change = np.zeros(len(cols[0]), bool)
            for c in cols[:4]:
                change[1:] |= c[1:] != c[:-1]
            starts = np.flatnonzero(change)
            whole = int(starts[-1]) if len(starts) else 0
            rest = [c[whole:] for c in cols]
            if whole:
                yield emit([c[:whole] for c in cols], change[:whole])
        if len(rest[0]):
            change = np.zeros(len(rest[0]), bool)
            yield emit(rest, change)

    def emit(cols: list[np.ndarray], change: np.ndarray) -> pa.RecordBatch:
        a, b = _links(np.cumsum(change), cols[5], cols[4], cols[2] != cols[3], distance)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    dealt = tiles.repartition("choice", "key", "lo", "hi").sortWithinPartitions("choice", "key", "lo", "hi", "fp")
    return dealt.mapInArrow(run, "a long, b long")


def simhash_components(
    docs: DataFrame,
    *,
    shingle: int = 4,
    distance: int = 4,
    blocks: int = 6,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id, fp, component_id`` per row: documents whose fingerprints are
    linked (directly or through others) share the smallest id reachable.

    Equal fingerprints collapse to one node before any comparison, so copies
    cost nothing.  Null text counts as empty (fingerprint zero); rows without
    id take part and get their component's smallest id (null if it has none);
    repeated rows each get a row; an empty table gives no rows.
    """
    prints = cut(fingerprints(docs, shingle, id_col, text_col))
    nodes = prints.groupBy("fp").agg(F.min("id").alias("low"))
    links = near_links(nodes.select("fp"), distance, blocks)
    found = connected_components(links, "a", "b")
    members = nodes.join(found, nodes["fp"] == found["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    lowest = members.groupBy("root").agg(F.min("low").alias("component_id"))
    labels = members.join(lowest, "root").select(F.col("fp").alias("_fp"), "component_id")
    return prints.join(labels, F.col("fp") == F.col("_fp")).select("id", "fp", "component_id")


def hex16(col: str):
    return F.lower(F.lpad(F.hex(F.col(col)), 16, "0"))


def simhash_dedup(docs: DataFrame, **options) -> DataFrame:
    """The input's columns; of each component the row with the smallest id
    stays.  Rows without id cannot be named as the copy that stays or goes, so
    they all stay; rows repeating the id that stays, stay with it."""
    id_col = options.get("id_col", "doc_id")
    ident = F.col(f"`{id_col}`").cast("long")
    kept = simhash_components(docs, **options).filter("id = component_id").select(F.col("id").alias("_kept")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    named = rows.join(kept, F.col(f"row.`{id_col}`").cast("long") == F.col("_kept"), "left_semi").select("row.*")
    return named.unionByName(docs.filter(ident.isNull()))
