"""Substring dedup with an FM-index per shard.

Only passages that can repeat reach an index.  Every window of words chooses
one anchor, the run of words with the smallest hash inside it, so equal windows
choose equal anchors.  Runs of windows around anchors that occur more than once
are sent, by anchor, to shards; a shard indexes its runs (suffix array, BWT,
wavelet matrix) and finds by backward search where each window starts first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlake.llm.common import batches, shuffle_width, split_words

#: Words of an anchor.
ANCHOR = 10
#: Bytes of a word's hash in a run's content.
SYMBOL = 5
#: Bits of the broadcast filter of repeated anchors (16 MB whatever the
#: corpus): a set bit may let a run through that does not repeat, never the
#: other way round.
FILTER_BITS = 27
#: Runs of one anchor from which its windows are dealt out singly.
HOT_RUNS = 4096
#: Symbols of one FM-index.
INDEX_SYMBOLS = 1 << 20
#: Anchors counted in a task before they are handed on.
KEYS = 1 << 22
#: Bytes of text handled at a time.
CHUNK_BYTES = 8 << 20
LAST = (1 << 63) - 1


class WaveletMatrix:
    """Rank over a sequence of small integers, one bit vector per bit."""

    def __init__(self, symbols: np.ndarray, top: int) -> None:
        self.levels = []
        current = symbols.astype(np.int64)
        starts = np.zeros(top + 1, np.int64)
        each = np.arange(top + 1)
        for bit in range(max(1, int(top).bit_length()) - 1, -1, -1):
            ones = ((current >> bit) & 1).astype(bool)
            raw = np.packbits(ones, bitorder="little")
            words = np.append(raw, np.zeros(16 - len(raw) % 8, np.uint8)).view(np.uint64)
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            level = (bit, words, before, int(len(current) - ones.sum()))
            self.levels.append(level)
            starts = self._map(level, each, starts)
            current = np.concatenate([current[~ones], current[ones]])
        self.starts = starts

    @staticmethod
    def _map(level: tuple, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        bit, words, before, zeros = level
        w = at >> 6
        ones = before[w] + np.bitwise_count(words[w] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)))
        return np.where((symbol >> bit) & 1, zeros + ones, at - ones)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before ``at``."""
        for level in self.levels:
            at = self._map(level, symbol, at)
        return at - self.starts[symbol]


def _ordered_keys(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the keys in order, and which differ from the one before.  Key
    and place are sorted as one number where both fit 63 bits (much faster)."""
    n = len(key)
    bits = max(1, (n - 1).bit_length())
    if int(key.max(initial=0)).bit_length() + bits <= 63:
        packed = np.sort((key << bits) | np.arange(n))
        order, key = packed & ((1 << bits) - 1), packed >> bits
    else:
        order = np.argsort(key)
        key = key[order]
    return order, np.concatenate([[True], np.diff(key) != 0])[:n]


def _recurring(text: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Which windows' hash some other window has: all that can occur twice."""
    base = 0x9E3779B97F4A7C15
    one = (text.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    one ^= one >> np.uint64(29)
    total, width, block = None, 0, one  # hash of `width` symbols from each place
    size = 1
    while size <= length:
        factor = np.uint64(pow(base, size, 1 << 64))
        if length & size:
            if total is None:
                total, width = block, size
            else:
                n = max(0, len(block) - width)
                total = block[width:] + total[:n] * factor
                width += size
        n = max(0, len(block) - size)
        block = block[:n] * factor + block[size : size + n]
        size *= 2
    h = total[at] ^ (total[at] >> np.uint64(32))
    _, place, count = np.unique(h, return_inverse=True, return_counts=True)
    return count[place] > 1


class FMIndex:
    """FM-index of several short sequences of longs.  Every sequence has an end
    symbol of its own, so suffixes are in order once the doubling has passed
    the longest sequence."""

    def __init__(self, sequences: np.ndarray, lengths: np.ndarray) -> None:
        words, ranks = np.unique(sequences, return_inverse=True)
        n, s = len(sequences) + len(lengths), len(lengths)
        ends = np.cumsum(lengths + 1) - 1
        self.begins = ends - lengths
        self.text = np.zeros(n, np.int64)  # 0: end of a sequence
        inner = np.ones(n, bool)
        inner[ends] = False
        self.text[inner] = ranks + 1
        rank = np.where(inner, self.text + s - 1, 0)
        rank[ends] = np.arange(s)
        order = np.arange(n)
        for step in (1 << k for k in range(int(lengths.max()).bit_length())):
            after = np.concatenate([rank[step:], np.zeros(min(step, n), np.int64)])[:n]
            order, new = _ordered_keys(rank * (n + s) + after)
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new) - 1
            if new.all():
                break
        self.suffixes = order
        self.below = np.concatenate([[0], np.cumsum(np.bincount(self.text, minlength=len(words) + 1))])
        self.matrix = WaveletMatrix(self.text[self.suffixes - 1], len(words))

    def first_starts(self, at: np.ndarray, length: int) -> np.ndarray:
        """For the windows of ``length`` symbols of the text at ``at``: the
        smallest text position where the same window starts."""
        lo, hi = np.zeros(len(at), np.int64), np.full(len(at), len(self.text))
        for k in range(length - 1, -1, -1):
            c = self.text[at + k]
            lo = self.below[c] + self.matrix.rank(c, lo)
            hi = self.below[c] + self.matrix.rank(c, hi)
        intervals, place = np.unique(lo, return_inverse=True)  # windows of one length: equal or disjoint
        ends = np.zeros(len(intervals), np.int64)
        ends[place] = hi
        bounds = np.column_stack([intervals, ends]).ravel()
        return np.minimum.reduceat(np.append(self.suffixes, LAST), bounds)[::2][place]


def _hashes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash per word (40 bits) and word ends per row."""
    flat, ends = split_words(text)
    coded = flat.dictionary_encode()
    digest = xxhash.xxh64_intdigest
    mask = (1 << 8 * SYMBOL) - 1
    distinct = np.array([digest(w) & mask for w in coded.dictionary.cast(pa.binary()).to_pylist()], dtype=np.uint64)
    index = np.asarray(coded.indices, dtype=np.int64)
    return distinct[index] if len(distinct) else np.empty(0, np.uint64), ends


def window_runs(words: np.ndarray, ends: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Runs of consecutive windows that choose the same anchor: anchor hash,
    first window, number of windows, row."""
    n = len(words)
    none = tuple(np.empty(0, np.int64) for _ in range(4))
    if n < window:
        return none
    gram = np.zeros(n - ANCHOR + 1, np.uint64)
    for k in range(ANCHOR):
        gram = gram * np.uint64(0x9E3779B97F4A7C15) + words[k : n - ANCHOR + 1 + k]
    gram ^= gram >> np.uint64(29)
    gram *= np.uint64(0xBF58476D1CE4E5B9)
    gram ^= gram >> np.uint64(32)
    best, span, goal = np.arange(len(gram)), 1, window - ANCHOR + 1  # place of the leftmost minimum of `span` grams
    while span < goal:
        step = min(span, goal - span)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(gram[left] <= gram[right], left, right)
        span += step
    row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    starts = np.flatnonzero(row[: n - window + 1] == row[window - 1 :])
    if not len(starts):
        return none
    chosen = best[starts]
    new = np.concatenate([[True], (np.diff(starts) != 1) | (np.diff(chosen) != 0)])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(starts)))
    return gram[chosen[first]].view(np.int64), starts[first], count, row[starts[first]]


def _filters(docs: DataFrame, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps over the anchors' leading bits: anchors that occur more than
    once, and anchors of more than HOT_RUNS runs.  Counted in tasks, packed by
    range of the hash, summed per range; only the bitmaps reach the driver."""
    width = shuffle_width(docs.sparkSession)

    def counted(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def packed() -> pa.RecordBatch:
            key, n = np.unique(np.concatenate(held).view(np.uint64), return_counts=True)
            part = (key >> np.uint64(44)).astype(np.int64) * width >> 20
            cut_at = np.searchsorted(part, np.arange(width + 1))
            ranges = [(k, key[lo:hi].tobytes(), n[lo:hi].astype(np.int32).tobytes()) for k, (lo, hi) in enumerate(zip(cut_at[:-1], cut_at[1:], strict=True)) if hi > lo]
            shard, keys, counts = zip(*ranges, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(keys), pa.array(counts)], ["shard", "keys", "counts"])

        for b in batches(it, "text", CHUNK_BYTES):
            held.append(window_runs(*_hashes(b.column(0)), window)[0])
            size += len(held[-1])
            if size > KEYS:
                yield packed()
                held, size = [], 0
        if size:
            yield packed()

    def summed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = [np.empty(0, np.uint64)], [np.empty(0, np.int32)]
        for b in it:
            keys += [np.frombuffer(k, np.uint64) for k in b.column(1).to_pylist()]
            counts += [np.frombuffer(n, np.int32) for n in b.column(2).to_pylist()]
        key, place = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.bincount(place, np.concatenate(counts), len(key))
        key, n = key[n > 1], n[n > 1]
        bit = key >> np.uint64(64 - FILTER_BITS)
        word, place = np.unique(bit >> np.uint64(6), return_inverse=True)
        masks = np.zeros((2, len(word)), np.uint64)
        flag = np.uint64(1) << (bit & np.uint64(63))
        np.bitwise_or.at(masks[0], place, flag)
        np.bitwise_or.at(masks[1], place[n > HOT_RUNS], flag[n > HOT_RUNS])
        yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (word, masks[0], masks[1])], ["word", "some", "busy"])

    ranges = docs.select("text").mapInArrow(counted, "shard int, keys binary, counts binary").repartition(width, "shard")
    got = ranges.mapInArrow(summed, "word long, some long, busy long").toArrow()
    out = np.zeros((2, 1 << (FILTER_BITS - 6)), np.int64)
    for k, name in enumerate(("some", "busy")):
        np.bitwise_or.at(out[k], np.asarray(got["word"]), np.asarray(got[name]))
    return out[0], out[1]


ROUTED = "route long, content binary, doc long, th long, pos long, windows long"


def _ordered(ident: np.ndarray, doc: np.ndarray, th: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the runs by content and start, and which of them are the first
    of their content.  A run that a repeated row (equal doc and th) gives again
    is the same run: it is left out, not late behind itself."""
    order = np.lexsort((pos, th, doc, ident))
    other = np.zeros(max(0, len(order) - 1), bool)
    for x in (ident, doc, th, pos):
        other |= np.diff(x[order]) != 0
    order = order[np.concatenate([[True], other])]
    return order, np.concatenate([[True], np.diff(ident[order]) != 0])


def _runs(docs: DataFrame, shared, window: int) -> DataFrame:
    """Runs whose anchor may repeat, with their content; of equal runs in one
    chunk only the first carries it, the others start later for certain and
    go without.  Windows of a hot anchor go singly, routed by their words."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some_bits, busy_bits = shared.value
        for b in batches(it, "text", CHUNK_BYTES):
            words, ends = _hashes(b.column(0))
            anchor, first, count, row = window_runs(words, ends, window)
            place = (anchor.view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            some = (some_bits[place >> 6] >> (place & 63)) & 1 == 1
            busy = ((busy_bits[place >> 6] >> (place & 63)) & 1 == 1)[some]
            anchor, first, count, row = anchor[some], first[some], count[some], row[some]
            if not len(anchor):
                continue
            times = np.where(busy, count, 1)
            step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            single = np.repeat(busy, times)
            anchor, first, row = np.repeat(anchor, times), np.repeat(first, times) + step, np.repeat(row, times)
            count = np.where(single, 1, np.repeat(count, times))
            flat = words.view(np.uint8).reshape(-1, 8)[:, :SYMBOL].tobytes()
            content = [flat[SYMBOL * f : SYMBOL * (f + c + window - 1)] for f, c in zip(first.tolist(), count.tolist(), strict=True)]
            digest = xxhash.xxh64_intdigest
            ident = np.array([digest(c) for c in content], dtype=np.uint64).view(np.int64)
            doc, th = (np.asarray(b.column(c), dtype=np.int64)[row] for c in (1, 2))
            pos = first - ends[row]
            order, lead = _ordered(ident, doc, th, pos)
            kept = [content[k] if x else None for k, x in zip(order.tolist(), lead.tolist(), strict=True)]
            route = np.where(lead, np.where(single, ident, anchor)[order], doc[order])
            columns = [route, *(x[order] for x in (doc, th, pos, count))]
            arrays = [pa.array(x) for x in columns]
            yield pa.RecordBatch.from_arrays([arrays[0], pa.array(kept, pa.binary()), *arrays[1:]], [f.split()[0] for f in ROUTED.split(", ")])

    return docs.select("text", "doc", "th").mapInArrow(run, ROUTED)


def _late(rows: list[np.ndarray], content: list[bytes], window: int) -> pa.RecordBatch:
    """One index over the runs of whole routes: the windows of ``rows`` (doc,
    th, pos) that also start earlier, as runs."""
    doc, th, pos = rows
    digest = xxhash.xxh64_intdigest
    ident = np.array([digest(c) for c in content], dtype=np.uint64)
    order, lead = _ordered(ident, doc, th, pos)
    again = order[~lead]  # equal runs behind the first: every window is late
    order = order[lead]
    order = order[np.lexsort((pos[order], th[order], doc[order]))]
    sizes = np.array([len(c) for c in content]) // SYMBOL
    raw = np.frombuffer(b"".join(content[k] for k in order.tolist()), np.uint8).reshape(-1, SYMBOL)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :SYMBOL] = raw
    index = FMIndex(wide.view(np.int64).ravel(), sizes[order])
    windows = sizes[order] - window + 1
    owner = np.repeat(np.arange(len(order)), windows)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = index.begins[owner] + offset
    some = _recurring(index.text, at, window)  # the others occur once for certain
    owner, offset, at = owner[some], offset[some], at[some]
    late = index.first_starts(at, window) < at
    owner, offset = owner[late], offset[late]
    edge = np.flatnonzero(np.concatenate([[True], (np.diff(owner) != 0) | (np.diff(offset) != 1)])[: len(owner)])
    count = np.diff(np.append(edge, len(owner)))
    who = order[owner[edge]]
    columns = [np.concatenate([x[who], x[again]]) for x in (doc, th)]
    columns += [np.concatenate([pos[who] + offset[edge], pos[again]]), np.concatenate([count, sizes[again] - window + 1])]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["doc", "th", "pos", "windows"])


def repeated_windows(docs: DataFrame, window: int) -> DataFrame:
    """``doc, th, pos, windows``: runs of windows whose words also start
    earlier.  ``docs``: ``doc`` (order of documents), ``th`` (text hash) and
    ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(_filters(docs, window))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, contents, symbols = [np.empty(0, np.int64)] * 4, [], 0
        for b in it:
            known = b.filter(pc.is_null(b.column(1)))
            if known.num_rows:
                yield pa.RecordBatch.from_arrays(known.columns[2:], ["doc", "th", "pos", "windows"])
            b = b.filter(pc.is_valid(b.column(1)))  # noqa: PLW2901
            numbers = [np.concatenate([r, np.asarray(b.column(c), dtype=np.int64)]) for r, c in zip(numbers, (0, 2, 3, 4), strict=True)]
            new = b.column(1).to_pylist()
            contents += new
            symbols += sum(map(len, new)) // SYMBOL
            if symbols > INDEX_SYMBOLS:  # equal routes lie together; the last may go on in the next batch
                whole = int(np.searchsorted(numbers[0], numbers[0][-1]))
                if whole:
                    yield _late([x[:whole] for x in numbers[1:]], contents[:whole], window)
                    numbers, contents = [x[whole:] for x in numbers], contents[whole:]
                    symbols = sum(map(len, contents)) // SYMBOL
        if contents:
            yield _late(numbers[1:], contents, window)

    dealt = _runs(docs, shared, window).repartition("route").sortWithinPartitions("route")
    return dealt.mapInArrow(run, "doc long, th long, pos long, windows long")


def substring_dedup(docs: DataFrame, *, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept_text`` per row.

    Every word covered by a window of ``window`` words whose sequence also
    starts earlier (smaller id, or earlier in the same document) is removed;
    windows are judged on the input.  Word sequences are compared by 40-bit
    hashes of their words, all of a window's at once.

    Null text has no words; rows without id come last in the order; rows that
    repeat both id and text (or the text, without id) are one document: they
    get the same result and are no repeats of each other; rows
    that repeat an id with other texts are ordered by their text's hash; texts
    under ``window`` words keep all; an empty table gives no rows.
    """
    if window < ANCHOR:
        raise ValueError(f"a window needs at least {ANCHOR} words")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    keyed = rows.withColumn("doc", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))).withColumn("th", F.xxhash64("text"))
    found = repeated_windows(keyed, window)
    spans = found.groupBy("doc", "th").agg(F.sort_array(F.collect_set(F.struct("pos", "windows"))).alias("spans"))
    spans = spans.select(F.col("doc").alias("_doc"), F.col("th").alias("_th"), F.col("spans.pos").alias("at"), F.col("spans.windows").alias("windows"))
    joined = keyed.join(spans, (F.col("doc") == F.col("_doc")) & (F.col("th") == F.col("_th")), "left")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, "text", CHUNK_BYTES):
            texts = b.column(1).cast(pa.binary()).to_pylist()
            out: list[tuple] = []
            for text, at, count in zip(texts, b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                words = text.split()
                gone = np.zeros(len(words) + 1, np.int64)
                if at:
                    np.add.at(gone, np.array(at), 1)
                    np.add.at(gone, np.minimum(np.array(at) + np.array(count) + window - 1, len(words)), -1)
                keep = np.cumsum(gone)[:-1] <= 0
                kept = b" ".join(w for w, k in zip(words, keep.tolist(), strict=True) if k) if at else b" ".join(words)
                out.append((len(words), len(words) - int(keep.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8")))
            n, gone_, sha, kept_ = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(gone_, pa.int64()), pa.array(sha), pa.array(kept_)],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return joined.select("doc_id", "text", "at", "windows").mapInArrow(
        run, f"doc_id {id_type}, n_words long, n_removed long, kept_sha256 string, kept_text string"
    )
