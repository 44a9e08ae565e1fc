"""Language-model scoring with an Elias-Fano n-gram trie.

The model is a backoff n-gram model over words.  It keeps every n-gram of
MIN_COUNT training occurrences, in shards by context; a shard's trie is built
and asked in one task.  Every other n-gram backs off, down to exact unigram
counts that stay distributed.
"""

from __future__ import annotations

import itertools
import json
import math
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rxlake.llm.common import batches, bucket_of, cut, shuffle_width, split_words
from rxlake.session import scratch_path

#: Words whose counts are broadcast hold 1 / LEVEL_SIZE of the training tokens
#: (and the n-grams of a model in one block, see ``train``).
LEVEL_SIZE = 1 << 18
#: Training occurrences from which an n-gram is kept.
MIN_COUNT = 3
ORDER = 3
DISCOUNT = 0.75
#: Added to every unigram count.
ADD = 0.1
#: Steps of the quantised log probabilities and backoff weights.
STEPS = 1 << 12
#: Keys counted in a task before they are handed on.
KEYS = 1 << 22
#: Tokens of a shard of the model, about.
SHARD_TOKENS = 3 << 19
#: Stand for the hashes of a document's start, its end, a word that does not
#: matter before another one, and one that cannot matter behind it.
START, END, NONE, OTHER = 1, 2, 3, 4
#: Bits of the bitmap of pairs that may be kept (16 MB whatever the corpus).
FILTER_BITS = 27
TYPES = ("|u1", "<u2", "<u4", "<i8", "<f8")


class EliasFano:
    """A monotone sequence of longs: low bits packed, high bits in unary."""

    def __init__(self, low: np.ndarray, high: np.ndarray, ones: np.ndarray, width: int, size: int) -> None:
        self.low, self.high, self.ones, self.width, self.size = low, high, ones, width, size

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        v = values.astype(np.uint64)
        width = max(0, int(int(v[-1]) / n).bit_length() - 1) if n else 0
        bits = ((v[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel()
        marks = np.zeros(int(v[-1] >> np.uint64(width)) + n + 1 if n else 1, np.uint8)
        marks[(v >> np.uint64(width)).astype(np.int64) + np.arange(n)] = 1

        def packed(x: np.ndarray) -> np.ndarray:
            raw = np.packbits(x, bitorder="little")
            return np.append(raw, np.zeros(16 - len(raw) % 8, np.uint8)).view(np.uint64)

        high = packed(marks)
        return cls(packed(bits), high, np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)]), width, n)

    def get(self, i: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ones, i, side="right") - 1
        rest, w, at = i - self.ones[word], self.high[word], np.zeros(len(i), np.uint64)
        for s in (32, 16, 8, 4, 2, 1):
            below = np.bitwise_count((w >> at) & np.uint64((1 << s) - 1)).astype(np.int64)
            go = rest >= below
            at += np.where(go, np.uint64(s), np.uint64(0))
            rest = rest - np.where(go, below, 0)
        top = word * 64 + at.astype(np.int64) - i
        if not self.width:
            return top
        off = i * self.width
        first, shift = off >> 6, (off & 63).astype(np.uint64)
        low = self.low[first] >> shift
        low |= np.where(shift > 0, self.low[first + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return (top << self.width) | (low & np.uint64((1 << self.width) - 1)).astype(np.int64)


class Level:
    """Children of all nodes of the level above, sorted by node and id.

    Ids are made monotone over the level by adding the last value of the node
    before, so one Elias-Fano sequence holds them and a child is found by a
    successor search between the node's two pointers.
    """

    def __init__(self, pointers: EliasFano, ids: EliasFano) -> None:
        self.pointers, self.ids = pointers, ids

    @classmethod
    def of(cls, node: np.ndarray, ident: np.ndarray, nodes: int) -> Level:
        starts = np.searchsorted(node, np.arange(nodes + 1))
        ends = starts[1:][starts[1:] > starts[:-1]] - 1  # the last child of every node that has one
        lasts = np.cumsum(ident[ends] + 1)
        base = np.zeros(len(node), np.int64)
        group = np.searchsorted(ends, np.arange(len(node)))
        base[group > 0] = lasts[group[group > 0] - 1]
        return cls(EliasFano.of(starts), EliasFano.of(ident + base))

    def find(self, node: np.ndarray, ident: np.ndarray) -> np.ndarray:
        """Index of the child ``ident`` of ``node``, or -1."""
        lo, end = self.pointers.get(node), self.pointers.get(node + 1)
        if not self.ids.size:
            return np.full(len(node), -1)
        before = np.where(lo > 0, self.ids.get(np.maximum(lo - 1, 0)) + 1, 0)
        want, hi = ident + before, end.copy()
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_]) >> 1
            less = self.ids.get(mid) < want[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
            open_ = open_[lo[open_] < hi[open_]]
        hit = lo < end
        hit &= self.ids.get(np.minimum(lo, self.ids.size - 1)) == want
        return np.where(hit, lo, -1)


def quantise(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and their centres: equal shares of the sorted values."""
    if len(values) <= STEPS:
        centres, codes = np.unique(values, return_inverse=True)
    else:
        order = np.argsort(values, kind="stable")
        codes = np.empty(len(values), np.int64)
        codes[order] = np.arange(len(values)) * STEPS // len(values)
        centres = np.bincount(codes, values) / np.bincount(codes)
    return codes.astype(np.uint16), centres if len(centres) else np.zeros(1)


def write_levels(arrays: dict[str, np.ndarray]) -> bytes:
    """Header and 8-byte aligned arrays in one block."""
    head, at, parts = {}, 0, []
    for name, a in arrays.items():
        raw = np.ascontiguousarray(a).tobytes()
        head[name] = (a.dtype.str, len(a), at)
        parts += [raw, b"\0" * (-len(raw) % 8)]
        at += len(raw) + -len(raw) % 8
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    return len(text).to_bytes(8, "little") + text + b"".join(parts)


def map_levels(block: bytes) -> dict[str, np.ndarray]:
    """The arrays of a block, memory-mapped from an unnamed temporary file."""
    with tempfile.TemporaryFile() as f:
        f.write(block)
        f.flush()
        data = np.memmap(f, np.uint8, "r")
    size = int(data[:8].view("<u8")[0])
    head = json.loads(data[8 : 8 + size].tobytes())
    return {n: data[8 + size + at : 8 + size + at + np.dtype(t).itemsize * k].view(t) for n, (t, k, at) in head.items()}


class Trie:
    """The model's levels.  Word ids are places in the sorted hashes of the
    kept words; ``start`` and ``end`` follow them."""

    def __init__(self, arrays: dict[str, np.ndarray]) -> None:
        self.hashes = arrays["hashes"]
        self.counts = arrays["counts"]  # of words, then start (0), then end
        self.start, self.end = len(self.hashes), len(self.hashes) + 1
        self.levels, self.logp, self.back = [], [], [arrays["b1c"][arrays["b1"]]]
        for k in range(2, int(arrays["order"][0]) + 1):
            ef = [EliasFano(arrays[f"{s}{k}l"], arrays[f"{s}{k}h"], arrays[f"{s}{k}o"], *arrays[f"{s}{k}n"].tolist()) for s in "pi"]
            self.levels.append(Level(*ef))
            self.logp.append((arrays[f"q{k}"], arrays[f"q{k}c"]))
            self.back.append(arrays[f"b{k}c"][arrays[f"b{k}"]])

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(0, len(self.hashes) - 1))
        return np.where(self.hashes[at] == hashes, at, -1) if len(self.hashes) else np.full(len(hashes), -1)

    def nodes(self, ids: np.ndarray, upto: int) -> list[np.ndarray]:
        """For every token the node of its n-gram of order 1, 2, ... ``upto``
        (-1: not kept); ``ids`` is a sequence in which ``start`` opens every
        document.  The n-gram of order k is searched below its prefix (the
        token before's node of order k - 1) by the place of the word among
        the successors of the shorter context."""
        out = [ids]
        for k, level in enumerate(self.levels[: upto - 1], start=2):
            below = np.concatenate([[-1], out[-1][:-1]])  # the prefix: order k - 1, one token earlier
            child = out[-1] if k > 2 else ids  # the suffix: order k - 1 at this token
            ok = (below >= 0) & (child >= 0) & (ids != self.start)
            ident = child[ok]
            if k > 2:  # relative to the suffix's own context
                context = np.concatenate([[-1], out[-2][:-1]])[ok]
                ident = ident - self.levels[k - 3].pointers.get(context)
            found = np.full(len(ids), -1)
            found[ok] = level.find(below[ok], ident)
            out.append(found)
        return out

    def score(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per token: log10 weight without the unigram term, and whether the
        unigram term is needed (the token backed off to order 1)."""
        nodes = self.nodes(ids, len(self.levels) + 1)
        total, open_ = np.zeros(len(ids)), ids != self.start
        for k in range(len(self.levels) - 1, -1, -1):
            here = open_ & (nodes[k + 1] >= 0)
            codes, centres = self.logp[k]
            total[here] += centres[codes[nodes[k + 1][here]]]
            open_ &= ~here
            context = np.concatenate([[-1], nodes[k][:-1]])
            off = open_ & (context >= 0)
            total[off] += self.back[k][context[off]]
        return total, open_

    def follow(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``score`` of the token ``c`` after ``a, b``, for distinct triples
        sorted by ``a, b`` (before the start, ``a`` is -1)."""
        wide, (pairs, *deeper) = self.end + 3, self.levels
        first = np.flatnonzero(np.concatenate([[True], (np.diff(a) != 0) | (np.diff(b) != 0)]))
        ok = (a[first] >= 0) & (b[first] != self.start)
        context = np.full(len(first), -1)
        context[ok] = pairs.find(a[first[ok]], b[first[ok]])
        context = np.repeat(context, np.diff(np.append(first, len(a))))
        key, place = np.unique(b * wide + c, return_inverse=True)
        suffix = pairs.find(key // wide, key % wide)[place]
        weight, open_ = np.zeros(len(a)), np.ones(len(a), bool)
        if deeper:
            ok = np.flatnonzero((context >= 0) & (suffix >= 0))
            node = deeper[0].find(context[ok], suffix[ok] - pairs.pointers.get(b[ok]))
            codes, centres = self.logp[1]
            weight[ok[node >= 0]] = centres[codes[node[node >= 0]]]
            open_[ok[node >= 0]] = False
            off = open_ & (context >= 0)
            weight[off] += self.back[1][context[off]]
        here = open_ & (suffix >= 0)
        codes, centres = self.logp[0]
        weight[here] += centres[codes[suffix[here]]]
        open_ &= ~here
        weight[open_] += self.back[0][b[open_]]
        return weight, open_


def _ef(name: str, e: EliasFano) -> dict[str, np.ndarray]:
    return {f"{name}l": e.low, f"{name}h": e.high, f"{name}o": e.ones, f"{name}n": np.array([e.width, e.size])}


def _arrays(hashes: np.ndarray, counts: np.ndarray, grams: list[tuple[np.ndarray, np.ndarray, np.ndarray]], starts: int, tokens: int, types: int) -> dict[str, np.ndarray]:
    """Levels of the trie from kept n-grams: per order k >= 2 the prefix node,
    the id (relative from order 3) and the count, sorted."""
    context = counts.astype(np.float64)
    context[-2] = starts  # documents open with the start
    lower = (counts + ADD) / (tokens + ADD * (types + 1))  # probability of a child one order down, by its suffix node
    out: dict[str, np.ndarray] = {"hashes": hashes, "counts": counts, "order": np.array([len(grams) + 1])}
    suffix_of = None
    for k, (node, ident, count) in enumerate(grams, start=2):
        level = Level.of(node, ident, len(context))
        codes, centres = quantise(np.log10((count - DISCOUNT) / context[node])) if len(node) else (np.zeros(0, np.uint16), np.zeros(1))
        p = 10.0 ** centres[codes]
        suffix = ident if k == 2 else suffix_of(node, ident)
        left = 1.0 - np.bincount(node, p, len(context))
        spare = 1.0 - np.bincount(node, lower[suffix], len(context))
        back = np.log10(np.maximum(left, 1e-9) / np.maximum(spare, 1e-9))
        back[np.bincount(node, minlength=len(context)) == 0] = 0.0
        out |= dict(zip((f"b{k - 1}", f"b{k - 1}c"), quantise(back), strict=True))
        out |= _ef(f"p{k}", level.pointers) | _ef(f"i{k}", level.ids) | {f"q{k}": codes, f"q{k}c": centres}
        starts_k = np.searchsorted(node, np.arange(len(context) + 1))
        # the node of a child's suffix: the context's last word's children start there
        last = ident if k == 2 else suffix
        suffix_of = lambda n, i, s=starts_k, w=last: s[w[n]] + i
        context, lower = count.astype(np.float64), p
    out |= dict(zip((f"b{len(grams) + 1}", f"b{len(grams) + 1}c"), quantise(np.zeros(len(context))), strict=True))
    return out


def _chunks(it: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Batches with their words: hashes of the distinct words, word index per
    token, token ends per row."""
    for b in batches(it, "text", 8 << 20):
        flat, ends = split_words(pc.ascii_lower(b.column(text)))
        coded = flat.dictionary_encode()
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()], dtype=np.uint64)
        yield b, hashes.view(np.int64), np.asarray(coded.indices, dtype=np.int64), ends


def _sequence(ids: np.ndarray, ends: np.ndarray, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all documents with start and end, and the document of each."""
    n = len(ends) - 1
    doc = np.repeat(np.arange(n), np.diff(ends) + 2)
    out = np.empty(len(ids) + 2 * n, np.int64)
    opens = ends[:-1] + 2 * np.arange(n)
    closes = ends[1:] + 2 * np.arange(n) + 1
    inner = np.ones(len(out), bool)
    inner[opens] = inner[closes] = False
    out[opens], out[closes], out[inner] = start, end, ids
    return out, doc


def _counted(keys: list[np.ndarray]) -> pa.RecordBatch:
    k, n = np.unique(np.concatenate(keys), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(k), pa.array(n)], ["key", "n"])


def _count(docs: DataFrame, keys_of) -> DataFrame:
    """Summed counts of the long keys that ``keys_of(hashes, index, ends)``
    gives for each chunk."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, hashes, index, ends in _chunks(it, 0):
            held.append(keys_of(hashes, index, ends))
            size += len(held[-1])
            if size > KEYS:
                yield _counted(held)
                held, size = [], 0
        if held:
            yield _counted(held)

    return docs.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _kept(counts: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Kept keys (sorted) and counts: at most LEVEL_SIZE by the threshold."""
    t = counts.filter(F.col("n") >= least).toArrow()
    key, n = np.asarray(t["key"], dtype=np.int64), np.asarray(t["n"], dtype=np.int64)
    order = np.argsort(key)
    return key[order], n[order]


def _words(train_docs: DataFrame) -> tuple[DataFrame, int, int, int]:
    """(word counts, documents, tokens, distinct tokens)."""
    words = cut(_count(train_docs, lambda hashes, index, ends: hashes[index]))
    about = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    opened = train_docs.count()
    return words, opened, about["n"] + opened, about["v"] + (opened > 0)


def train(train_docs: DataFrame, order: int = ORDER) -> tuple[bytes, DataFrame, int, int]:
    """(trie block, word counts, training tokens, distinct training tokens) of
    a model in one block; ``score`` builds the whole model in shards instead.

    Words are counted over all training documents, and the n-grams of the next
    order whose prefix and suffix were both kept (no other can reach the
    threshold).  The counts are summed in tasks before they are shuffled; only
    kept entries, at most LEVEL_SIZE a level, reach the driver.
    """
    spark: SparkSession = train_docs.sparkSession
    words, opened, tokens, types = _words(train_docs)
    least = max(MIN_COUNT, math.ceil(tokens / LEVEL_SIZE))
    hashes, counts = _kept(words, least)
    counts = np.concatenate([counts, [0, opened]])
    grams: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for k in range(2, order + 1):
        block = spark.sparkContext.broadcast(write_levels(_arrays(hashes, counts, grams, opened, tokens, types)))
        wide = max(len(hashes) + 2, *[len(g[0]) for g in grams], 1) + 1

        def keys(hashes: np.ndarray, index: np.ndarray, ends: np.ndarray, k=k, block=block, wide=wide) -> np.ndarray:
            trie = Trie(map_levels(block.value))
            ids, _ = _sequence(trie.word_ids(hashes)[index], ends, trie.start, trie.end)
            nodes = trie.nodes(ids, k - 1)
            prefix, suffix = np.concatenate([[-1], nodes[-1][:-1]]), nodes[-1]
            ok = (prefix >= 0) & (suffix >= 0) & (ids != trie.start)
            return prefix[ok] * wide + suffix[ok]

        key, n = _kept(_count(train_docs, keys), least)
        prefix, suffix = key // wide, key % wide
        if k > 2:  # the id below order 2 is the place among the children of the suffix's context
            suffix = suffix - np.searchsorted(grams[-1][0], grams[-1][0][suffix])
        grams.append((prefix, suffix, n))
    return write_levels(_arrays(hashes, counts, grams, opened, tokens, types)), words, tokens, types


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers in one compressed block, whole numbers as narrow as
    they fit."""
    head, parts = [], []
    for x in arrays:
        if x.dtype.kind != "f":
            small = len(x) and x.min() >= 0 and x.max() < 1 << 32
            x = x.astype(np.min_scalar_type(int(x.max())) if small else np.int64)  # noqa: PLW2901
        head += [TYPES.index(x.dtype.str), len(x)]
        parts.append(x.tobytes())
    block = np.array(head, np.int64).tobytes() + b"".join(parts)
    return len(block).to_bytes(8, "little") + pa.compress(block, "zstd", asbytes=True)


def _unpack(block: bytes, arrays: int) -> list[np.ndarray]:
    block = pa.decompress(block[8:], int.from_bytes(block[:8], "little"), "zstd", asbytes=True)
    head, at, out = np.frombuffer(block, np.int64, 2 * arrays).tolist(), 16 * arrays, []
    for kind, n in zip(head[::2], head[1::2], strict=True):
        x = np.frombuffer(block, TYPES[kind], n, at)
        at += x.nbytes
        out.append(x if x.dtype.kind == "f" else x.astype(np.int64))
    return out


def _mixed(hashes: np.ndarray, other: np.ndarray | int = 0) -> np.ndarray:
    x = hashes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x += np.asarray(other, np.int64).view(np.uint64)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _triples(a: np.ndarray, b: np.ndarray, c: np.ndarray, wide: int) -> np.ndarray:
    """One key per triple of numbers below ``wide``, in order of a, b, c."""
    pair = a * wide + b
    if wide >= 1 << 21:
        pair = np.unique(pair, return_inverse=True)[1]
    return pair * wide + c


def _pieces(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int | None, bytes]]:
    for b in it:
        yield from zip(*[c.to_pylist() for c in b.columns], strict=True)


class Routes:
    """Shard of a token by the word before it; words that hold more than a
    shard's share are split by the word before that (without one: by the token)."""

    def __init__(self, shards: int, hot: np.ndarray, splits: np.ndarray) -> None:
        self.shards, self.hot, self.splits = shards, hot, splits  # hot: sorted

    def split(self, words: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.hot, words), len(self.hot) - 1)
        return np.where(self.hot[at] == words, self.splits[at], 1)

    def shard(self, words: np.ndarray, part: np.ndarray) -> np.ndarray:
        return ((_mixed(words) % np.uint64(self.shards)).astype(np.int64) + part) % self.shards

    def of(self, a: np.ndarray, b: np.ndarray, c: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        by = _mixed(hashes, 1)[np.where(hashes[a] == NONE, c, a)]
        return self.shard(hashes, np.zeros(1, np.int64))[b] + (by % self.split(hashes)[b].astype(np.uint64)).astype(np.int64)


class Maybe:
    """Which pairs of words may have MIN_COUNT training occurrences: a bitmap
    over FILTER_BITS bits of their hash (a set bit may let a pair through that
    has fewer, never the other way round)."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits

    def __call__(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        at = _position(first, second)
        return (self.bits[at >> 6] >> (at & 63)) & 1 == 1


def _position(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return (_mixed(first, second) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _bigrams(hashes: np.ndarray, index: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word codes, and per token of the documents the word before it and itself."""
    v = len(hashes)
    code = np.concatenate([hashes, np.array([START, END, NONE, OTHER])])
    seq, _ = _sequence(index, ends, v, v + 1)
    b = np.concatenate([[v + 2], seq[:-1]])
    return code, b[seq != v], seq[seq != v]


def _maybe_kept(train_docs: DataFrame) -> np.ndarray:
    """The bitmap of Maybe.  Tasks count hash positions (sorted, so that their
    differences pack into a byte or two), ranges of them are added up, and only
    the bitmap reaches the driver."""
    width = shuffle_width(train_docs.sparkSession)

    def counted(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def packed() -> pa.RecordBatch:
            at, n = np.unique(np.concatenate(held), return_counts=True)
            cuts = np.searchsorted(at * width >> FILTER_BITS, np.arange(width + 1))
            packs = [_pack(np.diff(at[lo:hi], prepend=-(-(k << FILTER_BITS) // width)), np.minimum(n[lo:hi], MIN_COUNT)) for k, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
            return pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(packs)], ["shard", "pack"])

        for _, hashes, index, ends in _chunks(it, 0):
            code, b, c = _bigrams(hashes, index, ends)
            held.append(_position(code[b], code[c]))
            size += len(b)
            if size > KEYS:
                yield packed()
                held, size = [], 0
        if size:
            yield packed()

    def summed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, n = np.empty(0, np.int64), np.empty(0, np.int64)
        for shard, block in _pieces(it):
            steps, more = _unpack(block, 2)
            at, place = np.unique(np.concatenate([at, np.cumsum(steps) + -(-(shard << FILTER_BITS) // width)]), return_inverse=True)
            n = np.minimum(np.bincount(place, np.concatenate([n, more]), len(at)), MIN_COUNT).astype(np.int64)
        if len(at):
            at = at[n >= MIN_COUNT]
            word, place = np.unique(at >> 6, return_inverse=True)
            mask = np.zeros(len(word), np.uint64)
            np.bitwise_or.at(mask, place, np.uint64(1) << (at & 63).astype(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(mask.view(np.int64))], ["word", "mask"])

    packs = train_docs.select("text").mapInArrow(counted, "shard int, pack binary").repartition(width, "shard")
    got = packs.mapInArrow(summed, "word long, mask long").toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    np.bitwise_or.at(bits, np.asarray(got["word"], dtype=np.int64), np.asarray(got["mask"], dtype=np.int64))
    return bits


def _gram_packs(
    routes: Routes, maybe: Maybe, hashes: np.ndarray, index: np.ndarray, ends: np.ndarray, row: np.ndarray, train: np.ndarray
) -> list[tuple[int, bytes]]:
    """Per shard the chunk's distinct triples (word hashes; places of a, b, c
    in them; training count; tokens) and the row of every token.

    A word whose pair with the one before cannot be kept is only known to be
    OTHER, a context that cannot be kept is NONE: such tokens are alike, and
    one triple stands for many."""
    v = len(hashes)
    code = np.concatenate([hashes, np.array([START, END, NONE, OTHER])])
    seq, doc = _sequence(index, ends, v, v + 1)
    b = np.concatenate([[v + 2], seq[:-1]])
    a = np.where(b == v, v + 2, np.concatenate([[v + 2, v + 2], seq])[: len(seq)])
    real = seq != v
    a, b, c, doc = a[real], b[real], seq[real], doc[real]
    a = np.where(maybe(code[a], code[b]), a, v + 2)  # (NONE, START) is no pair: stays NONE
    c = np.where(maybe(code[b], code[c]), c, v + 3)
    shard = routes.of(a, b, c, code) % routes.shards
    key = _triples(b, a, c, v + 4)
    order = np.lexsort((key, shard))
    a, b, c, doc, shard, key = (x[order] for x in (a, b, c, doc, shard, key))
    first = np.flatnonzero(np.concatenate([[True], (np.diff(key) != 0) | (np.diff(shard) != 0)]))
    n = np.diff(np.append(first, len(key)))
    t = np.add.reduceat(train[doc].astype(np.int64), first)
    edges = np.concatenate([[0], np.flatnonzero(np.diff(shard[first])) + 1, [len(first)]])
    out = []
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        f = first[lo:hi]
        words, place = np.unique(np.concatenate([a[f], b[f], c[f]]), return_inverse=True)
        pa_, pb, pc_ = np.split(place, 3)
        tokens = doc[f[0] : f[-1] + n[hi - 1]]
        # triples are in order of b: its steps pack better than its places
        out.append((int(shard[f[0]]), _pack(code[words], pa_, np.diff(pb, prepend=0), pc_, t[lo:hi], n[lo:hi], row[tokens] - row[0])))
    return out


def _unpack_grams(block: bytes) -> list[np.ndarray]:
    words, a, b, *rest = _unpack(block, 7)
    return [words, a, np.cumsum(b), *rest]


def _pairs(train_docs: DataFrame, shared, shards: int) -> DataFrame:
    """``b, c, n``: bigrams of MIN_COUNT training occurrences: those that may
    have them are counted in tasks, packed by range of their hash and summed
    per range."""

    def summed(held: list[list[np.ndarray]]) -> list[np.ndarray]:
        b, c, n = (np.concatenate(x) for x in zip(*held, strict=True))
        key, first, place = np.unique(_mixed(b, c), return_index=True, return_inverse=True)
        return [key, b[first], c[first], np.bincount(place, n, len(key)).astype(np.int64)]

    def listed(b: np.ndarray, c: np.ndarray, n: np.ndarray) -> bytes:
        """Pairs in order of their places in a list of their words."""
        words, place = np.unique(np.concatenate([b, c]), return_inverse=True)
        b, c = np.split(place, 2)
        by = np.lexsort((c, b))
        return _pack(np.diff(words, prepend=0), np.diff(b[by], prepend=0), c[by], n[by])

    def told(block: bytes) -> list[np.ndarray]:
        words, b, c, n = _unpack(block, 4)
        words = np.cumsum(words)
        return [words[np.cumsum(b)], words[c], n]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def packed() -> pa.RecordBatch:
            key, *columns = summed(held)
            at = np.searchsorted((key >> np.uint64(44)).astype(np.int64) * shards >> 20, np.arange(shards + 1))
            packs = [listed(*[x[lo:hi] for x in columns]) for lo, hi in zip(at[:-1], at[1:], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(range(shards), pa.int32()), pa.array(packs)], ["shard", "pairs"])

        maybe = Maybe(shared.value)
        for _, hashes, index, ends in _chunks(it, 0):
            code, b, c = _bigrams(hashes, index, ends)
            key, n = np.unique(b * len(code) + c, return_counts=True)
            b, c = code[key // len(code)], code[key % len(code)]
            some = maybe(b, c)
            held.append([b[some], c[some], n[some]])
            size += len(held[-1][0])
            if size > KEYS // 4:
                yield packed()
                held, size = [], 0
        if size:
            yield packed()

    def total(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, block in _pieces(it):
            held.append(told(block))
            size += len(held[-1][0])
            if size > KEYS // 4:
                held = [summed(held)[1:]]
                size = 0  # as much again may come before the next sum
        if held:
            _, b, c, n = summed(held)
            yield pa.RecordBatch.from_arrays([pa.array(x[n >= MIN_COUNT]) for x in (b, c, n)], ["b", "c", "n"])

    packs = train_docs.select("text").mapInArrow(run, "shard int, pairs binary")
    return packs.repartition(shards, "shard").mapInArrow(total, "b long, c long, n long")


def _solve(model: list[list[np.ndarray]], asks: list[list[np.ndarray]], about: tuple[int, int, int], order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The shard's trie, and per pack of ``asks`` what each triple adds to the
    unigram term of its token, and whether it backed off to that term.

    A shard sees every occurrence of the contexts (a, b) it owns, so it counts
    them and their trigrams itself; the bigrams (b, c) come counted."""
    opened, tokens, types = about
    b, c, n, nc, nb = (np.concatenate(x) for x in zip(*model, strict=True)) if model else [np.empty(0, np.int64)] * 5
    words = np.unique(np.concatenate([b, c, *[q[0] for q in asks]]))
    words = words[~np.isin(words, [START, END, NONE, OTHER])]
    s = len(words)
    wide = s + 4

    def ids(h: np.ndarray) -> np.ndarray:
        return np.select([h == START, h == END, h == NONE, h == OTHER], [s, s + 1, s + 2, s + 3], np.searchsorted(words, h))

    b, c = ids(b), ids(c)
    places = [ids(q[0]) for q in asks]
    ta, tb, tc = (np.concatenate([w[q[k]] for w, q in zip(places, asks, strict=True)]) for k in (1, 2, 3))
    _, at, place = np.unique(_triples(ta, tb, tc, wide), return_index=True, return_inverse=True)
    t = np.bincount(place, np.concatenate([q[4] for q in asks]), len(at)).astype(np.int64)
    ta, tb, tc = ta[at], tb[at], tc[at]
    inner = ta != s + 2  # a context of two words
    first = np.flatnonzero(np.concatenate([[True], (np.diff(ta) != 0) | (np.diff(tb) != 0)]))
    seen = np.add.reduceat(t, first)
    own = first[(seen >= MIN_COUNT) & inner[first]]
    key, at = np.unique(np.concatenate([b * wide + c, ta[own] * wide + tb[own]]), return_index=True)
    count = np.concatenate([n, seen[(seen >= MIN_COUNT) & inner[first]]])[at]
    counts = np.zeros(wide, np.int64)
    counts[b], counts[c] = nb, nc
    counts = np.where(counts > 0, counts, np.bincount(key // wide, count, wide).astype(np.int64))  # contexts of other shards: never asked
    grams = [(key // wide, key % wide, count)]
    kept = np.flatnonzero((t >= MIN_COUNT) & inner & (tc != s + 3))
    node = np.searchsorted(key, ta[kept] * wide + tb[kept])
    ident = np.searchsorted(key, tb[kept] * wide + tc[kept]) - np.searchsorted(key, tb[kept] * wide)
    by = np.lexsort((ident, node))
    grams.append((node[by], ident[by], t[kept][by]))
    total = np.concatenate([counts[:s], [0, opened]])
    trie = Trie(map_levels(write_levels(_arrays(words, total, grams[: order - 1], opened, tokens, types))))
    weight, open_ = trie.follow(np.where(ta == s + 2, -1, ta), tb, tc)
    known = np.where(open_, 1.0, total[np.minimum(tc, s + 1)] + ADD)
    adds = np.where(open_, weight, weight - np.log10(known))
    edges = np.cumsum([0, *[len(q[1]) for q in asks]])
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        yield adds[place[lo:hi]], open_[place[lo:hi]]


def score(docs: DataFrame, *, fold: int = 10, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document scored by a model of those outside the held-out fold
    (crc32 of the id as text, modulo ``fold``, is 0): ``doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score, score``.

    Every n-gram of MIN_COUNT training occurrences is kept.  A broadcast
    bitmap tells which pairs of words may have as many; tokens travel with
    what of the two words before them can matter, packed by chunk, to shards
    of the model; a shard builds the trie of its contexts and answers its
    tokens.  Counts of
    frequent words are broadcast; rare words travel to shards of the word
    counts (packed by chunk and shard).  Answers come back, packed the same
    way, as sums per document, added up chunk by chunk; a rare word holds less
    than 1 / LEVEL_SIZE of the tokens, so no shard of word counts is hot.  Null text counts as empty (its one token is the end); a null id
    counts as the empty text in the fold rule; repeated rows are scored each;
    an empty table gives no rows.  The documents are read several times and
    must come in the same order each time, as files do (else checkpoint them).
    """
    spark: SparkSession = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    rows = rows.withColumn("held_out", bucket_of("doc_id", fold) == 0)
    if order not in (2, 3):
        raise ValueError("the model is of order 2 or 3")
    train_docs = rows.filter("not held_out")
    words, opened, tokens, types = _words(train_docs)
    least = max(MIN_COUNT, math.ceil(tokens / LEVEL_SIZE))
    frequent, counts = _kept(words, least)
    shared = spark.sparkContext.broadcast(write_levels({"hashes": frequent, "counts": np.concatenate([counts, [0, opened]])}))
    shards = max(1, shuffle_width(spark) // 4)
    parts = max(shards, tokens // SHARD_TOKENS)
    share = max(1, tokens // parts)
    top = words.filter(F.col("n") > share).toArrow()
    hot, much = (np.asarray(top[x], dtype=np.int64) for x in ("key", "n"))
    hot, much = np.append(hot, START), np.append(much, max(1, opened))
    routes = Routes(parts, np.sort(hot), np.minimum(parts, -(-much[np.argsort(hot)] // share)))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, held_out boolean, row long, n_tokens long, known long, base double, shard int, chunk long, asks binary"

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = map_levels(shared.value)
        most, counts = model["hashes"], model["counts"]
        logc = np.log10(counts + ADD)
        for b, hashes, index, ends in _chunks(it, 1):
            row = np.asarray(b.column(0), dtype=np.int64)
            at = np.minimum(np.searchsorted(most, hashes), max(0, len(most) - 1))
            found = np.where(most[at] == hashes, at, -1) if len(most) else np.full(len(hashes), -1)
            ids, doc = _sequence(found[index], ends, len(most), len(most) + 1)
            real = ids != len(most)
            kept = real & (ids >= 0)
            term = np.where(kept, logc[np.maximum(ids, 0)], 0.0)
            total = lambda x: np.bincount(doc, x, len(row))  # noqa: E731,B023
            known = total(kept & (counts[np.maximum(ids, 0)] > 0))
            cols = [row, total(real).astype(np.int64), known.astype(np.int64), total(term)]
            none = [pa.nulls(len(row), t) for t in (pa.int32(), pa.int64(), pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(2), b.column(3), *map(pa.array, cols), *none], names)
            yield from rare(found, hashes, index, np.repeat(row, np.diff(ends)), int(row[0]))
    id_arrow = to_arrow_type(rows.schema["doc_id"].dataType)
    names = [f.split()[0] for f in schema.split(", ")]

    unused = (id_arrow, pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64())

    def rare(known: np.ndarray, hashes: np.ndarray, index: np.ndarray, row: np.ndarray, chunk: int) -> Iterator[pa.RecordBatch]:
        some = known[index] < 0
        index, row = index[some], row[some]
        if not len(index):
            return
        shard = hashes[index] % shards  # never negative, as pmod of the word counts
        order = np.lexsort((index, shard))
        index, row, shard = index[order], row[order], shard[order]
        edges = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]])
        out = []
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            word, n = np.unique(index[lo:hi], return_counts=True)
            out.append((int(shard[lo]), chunk, _pack(hashes[word], n, row[lo:hi] - chunk)))
        nulls = [pa.nulls(len(out), t) for t in unused]
        packed = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int64(), pa.binary()), strict=True)]
        yield pa.RecordBatch.from_arrays([*nulls, *packed], names)

    numbered_rows = rows.withColumn("row", F.monotonically_increasing_id())
    path = scratch_path(spark, "lm-rows")  # written in one run of the tasks, compressed
    # both scans take the same columns: a batch ends by its bytes, and its first row names the chunk
    whole = numbered_rows.select("row", "text", "doc_id", "held_out")
    whole.mapInArrow(run, schema).write.parquet(path)
    scanned = spark.read.parquet(path)
    shared_bits = spark.sparkContext.broadcast(_maybe_kept(train_docs))

    def grams(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe = Maybe(shared_bits.value)
        for b, hashes, index, ends in _chunks(it, 1):
            row = np.asarray(b.column(0), dtype=np.int64)
            train = ~np.asarray(b.column(3).to_numpy(zero_copy_only=False), dtype=bool)
            shard, packs = zip(*_gram_packs(routes, maybe, hashes, index, ends, row, train), strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int32()), pa.array([int(row[0])] * len(packs)), pa.array(packs, pa.binary())], ["shard", "chunk", "grams"]
            )
    known = words.filter(F.col("n") < least).select(
        F.pmod(F.col("key"), F.lit(shards)).cast("int").alias("shard"), "key", "n", F.lit(None).cast("long").alias("chunk"),
        F.lit(None).cast("binary").alias("asks"),
    )
    asked = scanned.filter("asks is not null").select("shard", F.lit(None).cast("long").alias("key"), F.lit(None).cast("long").alias("n"), "chunk", "asks")

    def lookup(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, packs = [np.empty(0, np.int64)], [np.empty(0, np.int64)], []
        for b in it:
            have = b.filter(pc.is_valid(b.column(1)))
            keys.append(np.asarray(have.column(1), dtype=np.int64))
            counts.append(np.asarray(have.column(2), dtype=np.int64))
            rest = b.filter(pc.is_null(b.column(1)))
            packs += list(zip(*[rest.column(c).to_pylist() for c in (3, 4)], strict=True))
        key, count = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(key)
        key, count = key[order], np.append(count[order], 0)
        for chunk, block in packs:
            h, n, r = _unpack(block, 3)
            at = np.searchsorted(key, h)
            c = np.where((at < len(key)) & (key[np.minimum(at, max(0, len(key) - 1))] == h) if len(key) else np.zeros(len(h), bool), count[at], 0)
            per = np.repeat(c, n)
            row, place = np.unique(r, return_inverse=True)
            sums, known = np.bincount(place, np.log10(per + ADD)), np.bincount(place, per > 0)
            packed = [[chunk], [0], [_pack(row, sums, known.astype(np.int64))]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in packed], ["chunk", "kind", "sums"])

    def dealt(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bigrams to all shards of their first word."""
        for batch in it:
            columns = [np.asarray(c, dtype=np.int64) for c in batch.columns]
            times = routes.split(columns[0])
            part = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            columns = [np.repeat(c, times) for c in columns]
            shard = routes.shard(columns[0], part)
            by = np.argsort(shard, kind="stable")
            edges = np.concatenate([[0], np.flatnonzero(np.diff(shard[by])) + 1, [len(by)]])
            out = [(int(shard[by[lo]]), None, _pack(*[c[by[lo:hi]] for c in columns])) for lo, hi in zip(edges[:-1], edges[1:], strict=True) if hi > lo]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int64(), pa.binary()), strict=True)], ["shard", "chunk", "grams"])

    def answer(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in itertools.groupby(_pieces(it), key=lambda p: p[0]):
            model, asks, chunks = [], [], []
            for _, chunk, block in group:
                if chunk is None:
                    model.append(_unpack(block, 5))
                else:
                    asks.append(_unpack_grams(block))
                    chunks.append(chunk)
            if not asks:
                continue
            for chunk, ask, (adds, uni) in zip(chunks, asks, _solve(model, asks, (opened, tokens, types), order), strict=True):
                row, place = np.unique(ask[6], return_inverse=True)
                sums, unigrams = (np.bincount(place, np.repeat(x, ask[5]), len(row)) for x in (adds, uni))
                packed = [[chunk], [1], [_pack(row, sums, unigrams.astype(np.int64))]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in packed], ["chunk", "kind", "sums"])

    def merge(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, group in itertools.groupby(_pieces(it), key=lambda p: p[0]):
            held = [(kind, *_unpack(block, 3)) for _, kind, block in group]
            row, place = np.unique(np.concatenate([h[1] for h in held]), return_inverse=True)
            kind = np.repeat([h[0] for h in held], [len(h[1]) for h in held])
            value, count = (np.concatenate([h[k] for h in held]) for k in (2, 3))
            sums = [np.bincount(place, np.where(kind == k, x, 0), len(row)) for k in (0, 1) for x in (value, count)]
            columns = [row + chunk, sums[0], sums[1].astype(np.int64), sums[2], sums[3].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["r", "rare", "rare_known", "adds", "n_uni"])

    answered = "chunk long, kind long, sums binary"
    answers = known.unionByName(asked).repartition(shards, "shard").mapInArrow(lookup, answered)
    ends_ = F.lit(opened).cast("long")  # of the end, and of the start as a context
    pairs = _pairs(train_docs, shared_bits, shards)
    for c in ("c", "b"):
        pairs = pairs.join(words.select(F.col("key").alias(f"_{c}"), F.col("n").alias(f"n{c}")), F.col(c) == F.col(f"_{c}"), "left")
    pairs = pairs.select("b", "c", "n", F.coalesce("nc", ends_).alias("nc"), F.coalesce("nb", ends_).alias("nb"))
    model = pairs.mapInArrow(dealt, "shard int, chunk long, grams binary")
    tokens_ = whole.mapInArrow(grams, "shard int, chunk long, grams binary")
    judged = model.unionByName(tokens_).repartition(parts, "shard").sortWithinPartitions("shard").mapInArrow(answer, answered)
    sums = answers.unionByName(judged).repartition("chunk").sortWithinPartitions("chunk").mapInArrow(merge, "r long, rare double, rare_known long, adds double, n_uni long")
    z = math.log10(tokens + ADD * (types + 1))
    result = scanned.filter("shard is null").join(sums, F.col("row") == F.col("r"), "left")
    rare_sum = F.coalesce("rare", F.lit(0.0))
    return result.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + rare_sum - F.col("n_tokens") * z).alias("base_score"),
        (F.col("base") + rare_sum + F.coalesce("adds", F.lit(0.0)) - F.coalesce("n_uni", F.lit(0)) * z).alias("score"),
    )
