"""Term counts of texts, packed by shards of the terms.

A term's 64-bit hash tells its shard.  A few thousand texts give one pack per
shard (key, term, count of each of their terms there), and a vocabulary or a
model one row per shard, so a task holds one shard's terms and the packs pass
by it.  No term travels to the driver.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxlake.functions.text import terms_statement
from rxlake.session import scratch_path

# what runs in tasks is pickled by value: executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PACK_TEXTS = 2048
SHARD_CHARS = 1 << 25  # characters of fitted text a shard stands for, about
LOT_CHARS = 1 << 22  # characters of text that are weighed together, about
COUNT_CHARS = 1 << 23  # and those whose terms are counted in one shard
DIRECT_BYTES = 16 << 20  # of all tasks' sums that the driver adds up itself
PACK = "shard int, part int, a binary, b binary, rows binary, terms binary, tf binary"
TERMS = "shard int, terms binary, idf binary"
MODEL = f"{TERMS}, weights binary"
PIECE = "lot long, shard int, terms binary, checks binary, docs binary"
BLOCK = "shard int, terms binary, idf binary, ends binary, rows binary, tf binary"


def shards_for(chars: int, each: int = SHARD_CHARS, most: int = 12) -> int:
    """A power of two of shards, 32 to 2 ** ``most`` (4,096)."""
    return 1 << min(most, max(5, int(chars // each).bit_length()))


def text_key(text: str) -> tuple[Column, Column]:
    """128 bits of a text (null where it is null)."""
    known = F.col(text).isNotNull()
    return F.when(known, F.xxhash64(text)), F.when(known, F.xxhash64(F.lit("b"), F.col(text)))


def shard_of(term_hash: Column, shards: int) -> Column:
    return F.shiftrightunsigned(term_hash, 65 - shards.bit_length()).cast("int")


def _u64(buffer) -> np.ndarray:
    return np.frombuffer(buffer, np.uint64)


def _binary(values: list[np.ndarray]) -> pa.Array:
    return pa.array([v.tobytes() for v in values], pa.binary())


def packed_texts(texts: DataFrame, text: str, shards: int, parts: int = 1) -> DataFrame:
    """Packs of ``a, b, <text>`` (keys: two longs), dealt to ``parts`` lots."""
    shift = np.uint64(65 - shards.bit_length())

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in it:
            for at in range(0, whole.num_rows, PACK_TEXTS):
                b = whole.slice(at, PACK_TEXTS)
                keys = [np.asarray(b.column(k), dtype=np.int64) for k in (0, 1)]
                row = np.repeat(np.arange(b.num_rows, dtype=np.uint16), np.asarray(b.column(2).value_lengths()))
                term = np.asarray(b.column(2).flatten(), dtype=np.int64).view(np.uint64)
                if not len(term):
                    continue
                order = np.lexsort((row, term))
                row, term = row[order], term[order]
                start = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (row[1:] != row[:-1])]))
                tf = np.diff(np.append(start, len(term))).astype(np.int32)
                row, term = row[start], term[start]
                edge = np.searchsorted(term >> shift, np.arange(shards + 1, dtype=np.uint64))
                held = [(k, slice(lo, hi)) for k, (lo, hi) in enumerate(zip(edge[:-1], edge[1:], strict=True)) if hi > lo]
                present = [np.unique(row[cut]) for _, cut in held]
                part = int(keys[0][0] % parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in held], pa.int32()), pa.array([part] * len(held), pa.int32()),
                     _binary([keys[0][p] for p in present]), _binary([keys[1][p] for p in present]),
                     _binary([np.searchsorted(p, row[cut]).astype(np.uint16) for p, (_, cut) in zip(present, held, strict=True)]),
                     _binary([term[cut] for _, cut in held]), _binary([tf[cut] for _, cut in held])],
                    [f.split()[0] for f in PACK.split(", ")],
                )

    terms = SQLTransformer(statement=terms_statement(text)).transform(texts.select("a", "b", text))
    return terms.select("a", "b", F.transform("terms", lambda t: F.xxhash64(t)).alias("terms")).mapInArrow(run, PACK)


def packed_vocabulary(vocabulary: DataFrame, shards: int) -> DataFrame:
    """One row per shard of ``term, idf``, terms by ascending hash."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for b in it:
            shard, term, idf = (b.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            for s in np.unique(shard):
                held.setdefault(int(s), []).append((term[shard == s].view(np.uint64), idf[shard == s]))
        for s, lots in held.items():
            term, at = np.unique(np.concatenate([x[0] for x in lots]), return_index=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([s], pa.int32()), _binary([term]), _binary([np.concatenate([x[1] for x in lots])[at]])], [f.split()[0] for f in TERMS.split(", ")]
            )

    hashed = vocabulary.select(F.xxhash64("term").alias("h"), "idf").select(shard_of(F.col("h"), shards).alias("shard"), "h", "idf")
    return hashed.repartition(shards, "shard").mapInArrow(run, TERMS)


def _meeting(model: DataFrame, packs: DataFrame, shards: int, parts: int) -> DataFrame:
    """Packs behind their shard's row of ``model``, which goes to every lot."""
    lots = model.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    both = lots.withColumn("kind", F.lit(0)).unionByName(packs.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    return both.repartition(shards * parts, "shard", "part").sortWithinPartitions("shard", "part", "kind")


def fit_blocks(vocabulary: DataFrame, packs: DataFrame, shards: int, ids: np.ndarray) -> DataFrame:
    """One block per shard: the terms and, behind one another, the rows (places
    of their keys ``a`` in the sorted ``ids``) and counts of each."""
    order = packs.sparkSession.sparkContext.broadcast(ids)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, idf, shard, lots = None, None, None, []

        def block() -> pa.RecordBatch:
            col, row, tf = (np.concatenate([x[k] for x in lots] or [np.empty(0, np.int32)]) for k in range(3))
            by = np.lexsort((row, col))
            ends = np.searchsorted(col[by], np.arange(len(terms) + 1)).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), _binary([terms]), _binary([idf]), _binary([ends]), _binary([row[by].astype(np.int32)]), _binary([tf[by].astype(np.float32)])],
                [f.split()[0] for f in BLOCK.split(", ")],
            )

        for b in it:
            for k in range(b.num_rows):
                x = {n: b.column(n)[k] for n in ("shard", "kind", "terms", "idf", "a", "rows", "tf")}
                if x["kind"].as_py() == 0:
                    if shard is not None:
                        yield block()
                    terms, idf, shard, lots = _u64(x["terms"].as_buffer()), np.frombuffer(x["idf"].as_buffer()), x["shard"].as_py(), []
                elif x["shard"].as_py() == shard:  # a shard without vocabulary has no row to meet
                    at, hit = found(terms, _u64(x["terms"].as_buffer()))
                    place = np.searchsorted(order.value, np.frombuffer(x["a"].as_buffer(), np.int64))
                    row = place[np.frombuffer(x["rows"].as_buffer(), np.uint16)[hit]]
                    lots.append((at[hit].astype(np.int32), row.astype(np.int32), np.frombuffer(x["tf"].as_buffer(), np.int32)[hit]))
        if shard is not None:
            yield block()

    # each of the many products is a task per core, not one per shard
    return _meeting(vocabulary, packs, shards, 1).mapInArrow(run, BLOCK).coalesce(packs.sparkSession.sparkContext.defaultParallelism)


def found(terms: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``asked`` lie in the sorted ``terms``, and which do."""
    at = np.searchsorted(terms, asked)
    at[at == len(terms)] = 0
    return at, terms[at] == asked


class Sparse:
    """A block's counts x idf, texts by terms."""

    def __init__(self, idf, ends, rows, tf) -> None:
        ends = np.frombuffer(ends, np.int64)
        self.row = np.frombuffer(rows, np.int32)
        self.col = np.repeat(np.arange(len(ends) - 1, dtype=np.int32), np.diff(ends))
        self.terms = len(ends) - 1
        self.value = np.frombuffer(tf, np.float32) * np.frombuffer(idf)[self.col]

    def down(self, m: np.ndarray) -> np.ndarray:
        """X' m: classes x terms, of classes x texts."""
        return np.stack([np.bincount(self.col, self.value * c[self.row], self.terms) for c in m])

    def up(self, t: np.ndarray, texts: int) -> np.ndarray:
        """X t: classes x texts, of classes x terms."""
        return np.stack([np.bincount(self.row, self.value * c[self.col], texts) for c in t])

    def squares(self, texts: int) -> np.ndarray:
        return np.bincount(self.row, self.value * self.value, texts)[None, :]


def _sparse(b: pa.RecordBatch, k: int) -> Sparse:
    return Sparse(*[b.column(n)[k].as_buffer() for n in ("idf", "ends", "rows", "tf")])


def over_blocks(blocks: DataFrame, lines: int, texts: int, one: Callable[[Sparse], np.ndarray]) -> np.ndarray:
    """Sum of ``one`` (lines x texts) over the blocks: added up per task, then
    per range of texts (small sums: by the driver)."""
    parts = blocks.sparkSession.sparkContext.defaultParallelism
    small = parts * lines * texts * 8 <= DIRECT_BYTES
    edges = np.linspace(0, texts, 2 if small else parts + 1).astype(np.int64)
    schema = "part int, body binary"

    def of_task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((lines, texts))
        for b in it:
            for k in range(b.num_rows):
                total += one(_sparse(b, k))
        bodies = [total[:, lo:hi] for lo, hi in zip(edges[:-1], edges[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(bodies)), pa.int32()), _binary(bodies)], ["part", "body"])

    def of_range(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in it:
            for k, part in enumerate(b.column(0).to_pylist()):
                body = np.frombuffer(b.column(1)[k].as_buffer()).reshape(lines, -1)
                held[part] = held[part] + body if part in held else body
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), _binary(list(held.values()))], ["part", "body"])

    sums = blocks.mapInArrow(of_task, schema)
    got = (sums if small else sums.repartition(parts, "part").mapInArrow(of_range, schema)).toArrow()
    total = np.zeros((lines, texts))
    for part, body in zip(got["part"].to_pylist(), got["body"], strict=True):
        total[:, edges[part] : edges[part + 1]] += np.frombuffer(body.as_buffer()).reshape(lines, -1)
    return total


def block_weights(blocks: DataFrame, by_text: np.ndarray) -> DataFrame:
    """One row per shard: ``terms, idf`` and idf x (X' by_text) of each class."""
    given = blocks.sparkSession.sparkContext.broadcast(by_text)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for k in range(b.num_rows):
                idf = np.frombuffer(b.column("idf")[k].as_buffer())
                weights = _sparse(b, k).down(given.value) * idf
                yield pa.RecordBatch.from_arrays([*[b.column(n).slice(k, 1) for n in ("shard", "terms", "idf")], _binary([weights])], ["shard", "terms", "idf", "weights"])

    return blocks.mapInArrow(run, MODEL)


def weighed(model: DataFrame, packs: DataFrame, shards: int, parts: int, classes: int) -> DataFrame:
    """``a, b``, the sum of squares ``sq`` and one sum ``w<k>`` per class, of
    every key with a known term (rows of one shard, added up here)."""
    names = [f"w{c}" for c in range(classes)]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, terms, idf, weights = None, None, None, None
        for b in it:
            for k in range(b.num_rows):
                at = (b.column("shard")[k].as_py(), b.column("part")[k].as_py())
                if b.column("kind")[k].as_py() == 0:
                    here, terms, idf = at, _u64(b.column("terms")[k].as_buffer()), np.frombuffer(b.column("idf")[k].as_buffer())
                    weights = np.frombuffer(b.column("weights")[k].as_buffer()).reshape(classes, -1)
                elif at == here:
                    col, hit = found(terms, _u64(b.column("terms")[k].as_buffer()))
                    a, key = (np.frombuffer(b.column(n)[k].as_buffer(), np.int64) for n in "ab")
                    row, tf = np.frombuffer(b.column("rows")[k].as_buffer(), np.uint16)[hit], np.frombuffer(b.column("tf")[k].as_buffer(), np.int32)[hit]
                    sq = np.bincount(row, (tf * idf[col[hit]]) ** 2, len(a))
                    sums = [np.bincount(row, tf * c[col[hit]], len(a)) for c in weights]
                    some = sq > 0
                    yield pa.RecordBatch.from_arrays([pa.array(x[some]) for x in (a, key, sq, *sums)], ["a", "b", "sq", *names])

    schema = "a long, b long, sq double, " + ", ".join(f"{n} double" for n in names)
    partial = _meeting(model, packs, shards, parts).mapInArrow(run, schema)
    return partial.groupBy("a", "b").agg(*[F.sum(n).alias(n) for n in ("sq", *names)])


# ---------------------------------------------------------------- vectors of the fitted rows
def _sorted_terms(lists: pa.ChunkedArray) -> tuple[np.ndarray, ...]:
    """Terms of the rows by hash, check and row: where each stood, its row, hash
    and check, and where a term and where an entry (term and row) begins."""
    lists = lists.combine_chunks()
    flat = lists.flatten()
    row = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    term, check = flat.field(0).to_numpy(zero_copy_only=False).view(np.uint64), flat.field(1).to_numpy(zero_copy_only=False)
    order = np.lexsort((check, term))  # stable: rows stay in order
    row, term, check = row[order], term[order], check[order]
    first = np.ones(len(term), bool)
    first[1:] = (term[1:] != term[:-1]) | (check[1:] != check[:-1])
    entry = first.copy()
    entry[1:] |= row[1:] != row[:-1]
    return order, row, term, check, first, entry


def fitted_vectors(rows: DataFrame, n: int, min_df: int, id_col: str, text: str) -> DataFrame:
    """``id, term, weight``: tf x idf at length one of every row, idf from the
    ``n`` rows themselves (terms in ``min_df`` of them).

    The rows are written once, in lots.  A lot tells each shard the hashes (96
    bits) of its distinct terms and in how many of its rows they stand; the shard
    answers with the sums over all lots in the order asked, and the lot, met with
    its rows again, weighs them.  No entry of a row travels, and no term's text."""
    spark = rows.sparkSession
    kept = rows.select(id_col, text)

    def deal(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, first = 0, TaskContext.get().partitionId() << 33
        for b in it:
            if b.num_rows:
                upto = before + np.cumsum(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
                before = int(upto[-1])
                yield pa.RecordBatch.from_arrays([pa.array(first + upto // LOT_CHARS), *b.columns], ["lot", id_col, text])

    schema = kept.withColumn("lot", F.lit(0).cast("long")).select("lot", id_col, text).schema
    path = scratch_path(spark, "vector-lots")
    kept.mapInArrow(deal, schema).write.option("compression", "zstd").parquet(path)
    lots = spark.read.schema(schema).parquet(path)
    chars = lots.agg(F.sum(F.octet_length(text))).first()[0] or 0
    shards = shards_for(chars, COUNT_CHARS, 20)
    shift = np.uint64(65 - shards.bit_length())
    hashed = F.transform("terms", lambda t: F.struct(F.xxhash64(t).alias("h"), F.hash(t).alias("c")))
    terms = SQLTransformer(statement=terms_statement(text)).transform(lots.repartition("lot"))  # texts travel, not their terms

    def ask(lot: pa.Table) -> pa.Table:
        _, _, term, check, first, entry = _sorted_terms(lot["hashed"])
        start = np.flatnonzero(first)
        docs = np.add.reduceat(entry, start, dtype=np.int32) if len(start) else np.empty(0, np.int32)
        term, check = term[start], check[start]
        edge = np.searchsorted(term >> shift, np.arange(shards + 1, dtype=np.uint64))
        held = [(k, slice(lo, hi)) for k, (lo, hi) in enumerate(zip(edge[:-1], edge[1:], strict=True)) if hi > lo]
        return pa.table([
            pa.array([lot["lot"][0].as_py()] * len(held), pa.int64()), pa.array([k for k, _ in held], pa.int32()),
            *[_binary([x[cut] for _, cut in held]) for x in (term, check, docs)]], [f.split()[0] for f in PIECE.split(", ")])

    def answer(shard: pa.Table) -> pa.Table:
        term, check, docs = (
            np.concatenate([np.frombuffer(x.as_buffer(), t) for x in shard[c]]) for c, t in (("terms", np.uint64), ("checks", np.int32), ("docs", np.int32)))
        order = np.lexsort((check, term))
        by_term, by_check = term[order], check[order]
        first = np.ones(len(order), bool)
        first[1:] = (by_term[1:] != by_term[:-1]) | (by_check[1:] != by_check[:-1])
        total = np.empty(len(order), np.int64)
        total[order] = np.add.reduceat(docs[order], np.flatnonzero(first), dtype=np.int64)[np.cumsum(first) - 1]
        ends = np.cumsum(pc.binary_length(shard["docs"]).to_numpy() // 4)
        return pa.table([shard["lot"], shard["shard"], _binary(np.split(total, ends[:-1]))], ["lot", "shard", "docs"])

    def weigh(lot: pa.Table, answers: pa.Table) -> pa.Table:
        order, row, _, _, first, entry = _sorted_terms(lot["hashed"])
        told = [np.frombuffer(x.as_buffer(), np.int64) for x in answers.sort_by("shard")["docs"]]
        docs = np.concatenate([*told, np.empty(0, np.int64)])
        assert len(docs) == first.sum(), "a lot's rows have changed"
        start = np.flatnonzero(entry)
        tf, of = np.diff(np.append(start, len(entry))), (np.cumsum(first) - 1)[start]
        known = docs[of] >= min_df
        start, tf, of = start[known], tf[known], of[known]
        at = row[start]
        w = tf * (np.log((1.0 + n) / (1.0 + docs)) + 1.0)[of]
        w /= np.sqrt(np.bincount(at, w * w, lot.num_rows))[at]
        return pa.table([lot[id_col].take(pa.array(at)), lot["terms"].combine_chunks().flatten().take(pa.array(order[start])), pa.array(w)], [id_col, "term", "weight"])

    pieces = terms.select("lot", hashed.alias("hashed")).groupBy("lot").applyInArrow(ask, PIECE)
    answers = pieces.groupBy("shard").applyInArrow(answer, "lot long, shard int, docs binary")
    texts = terms.select("lot", id_col, "terms", hashed.alias("hashed"))
    out = kept.select(id_col, F.lit("").alias("term"), F.lit(0.0).alias("weight")).schema
    return texts.groupBy("lot").cogroup(answers.groupBy("lot")).applyInArrow(weigh, out)
