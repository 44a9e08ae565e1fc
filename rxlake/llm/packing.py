"""Token packing: sum-of-squares online packing into fixed windows."""

from __future__ import annotations

import os
import sys
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlake.llm.common import batches

TOKENIZER = "word_bpe_49k.json"
#: Id that closes every document.
END_ID = 1
#: Open windows a task may hold before it joins them into full ones.
OPEN_WINDOWS = 4096
#: Words whose ids a worker remembers.
CACHE_WORDS = 1 << 20


def _tokenizer(path: str):
    """The tokenizer and its word cache, loaded once per Python worker."""
    kept = sys.modules.setdefault("_llm_tokenizers", type(sys)("_llm_tokenizers")).__dict__
    if path not in kept:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        kept[path] = (Tokenizer.from_file(path), {})
    return kept[path]


def encode_column(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows in one flat array, and row ends; null text is empty.

    The tokenizer drops white space and never merges across it, so each
    distinct word is encoded once and its ids are gathered per occurrence.
    """
    tok, cache = _tokenizer(path)
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words = lists.flatten().dictionary_encode()
    distinct = words.dictionary.to_pylist()
    new = [w for w in distinct if w not in cache]
    if len(cache) + len(new) > CACHE_WORDS:
        cache.clear()
        new = distinct
    for lo in range(0, len(new), 1 << 16):
        part = new[lo : lo + (1 << 16)]
        for w, e in zip(part, tok.encode_batch_fast(part, add_special_tokens=False), strict=True):
            cache[w] = np.array(e.ids, dtype=np.uint32).tobytes()
    coded = [cache[w] for w in distinct]
    sizes = np.array([len(c) for c in coded], dtype=np.int64) // 4
    pool = np.frombuffer(b"".join(coded), dtype=np.uint32)
    first = np.cumsum(sizes) - sizes
    index = np.asarray(words.indices, dtype=np.int64)
    run = sizes[index]
    ends = np.concatenate([[0], np.cumsum(run)])
    ids = pool[np.repeat(first[index] - ends[:-1], run) + np.arange(ends[-1])]
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    return ids, ends[offsets - offsets[0]]


class Packer:
    """Sum-of-squares packing of one stream of documents.

    ``level[h]`` counts the open windows filled to h.  A document's whole
    windows leave at once; its remainder of s ids goes into the fill level h
    (0: a new window) that minimises the sum of squared counts.  Open windows
    beyond OPEN_WINDOWS, and those left at the end, are joined by cutting, so
    a stream pads one window at most.
    """

    def __init__(self, window: int, first_id: int) -> None:
        self.window, self.next_id = window, first_id
        self.level = np.zeros(window + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(window)]  # by fill: windows, each a list of pieces
        self.held = 0
        self.out: list[tuple] = []

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        total, cutoff = len(ids), len(ids) // self.window * self.window
        for at in range(0, cutoff, self.window):
            self._close([(doc, at, ids[at : at + self.window], total)])
        if total > cutoff:
            self._place((doc, cutoff, ids[cutoff:].copy(), total))

    def _place(self, piece: tuple) -> None:
        size, n, full = len(piece[2]), self.level, self.window
        cost = 2 * (n[size:full] - n[: full - size]) + 2  # fills h = 0 .. full - size - 1 become h + size
        cost[1:][n[1 : full - size] == 0] = np.iinfo(np.int64).max
        cost[0] = 2 * n[size] + 1
        best = int(np.argmin(cost))
        closes = n[full - size] > 0 and 1 - 2 * n[full - size] <= cost[best]
        fill = full - size if closes else best
        pieces = self.open[fill].pop() if fill else []
        if fill:
            n[fill] -= 1
            self.held -= 1
        pieces.append(piece)
        if closes:
            self._close(pieces)
            return
        n[fill + size] += 1
        self.open[fill + size].append(pieces)
        self.held += 1
        if self.held > OPEN_WINDOWS:
            self.join_open()

    def _close(self, pieces: list[tuple]) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            self.out.append((doc, start, len(ids), ids.tobytes(), total, self.next_id, at))
            at += len(ids)
        self.next_id += 1

    def join_open(self, last: bool = False) -> None:
        """Fill windows from the open ones, fullest first, cutting at their
        borders; what remains of the last stays open (or closes if ``last``)."""
        rest: list[tuple] = []
        room = self.window
        for fill in range(self.window - 1, 0, -1):
            for pieces in self.open[fill]:
                for doc, start, ids, total in pieces:
                    while len(ids) >= room:
                        self._close([*rest, (doc, start, ids[:room], total)])
                        start, ids, rest, room = start + room, ids[room:], [], self.window
                    if len(ids):
                        rest.append((doc, start, ids, total))
                        room -= len(ids)
            self.open[fill] = []
        self.level[:] = 0
        self.held = 0
        if rest and last:
            self._close(rest)
        elif rest:
            self.open[self.window - room] = [rest]
            self.level[self.window - room] = self.held = 1

    def taken(self) -> list[tuple]:
        out, self.out = self.out, []
        return out


PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack(
    docs: DataFrame,
    *,
    window: int = 2048,
    tokenizer: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of documents placed in sequences of ``window`` ids.

    Each document is its text's ids and END_ID.  One row per piece: ``doc_id,
    start, length, ids`` (little-endian unsigned 32-bit), ``doc_tokens,
    sequence_id, offset``.  Every input partition is one online stream, so
    nothing is shuffled, memory holds one batch and the open windows, and a
    rerun task gives its rows again (sequence ids carry the partition).

    Null text counts as empty (one piece of one id); a null id is passed on;
    repeated rows are documents of their own; an empty table gives no rows.
    """
    path = tokenizer or public_tokenizers.path(TOKENIZER)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(window, TaskContext.get().partitionId() << 40)
        fields = [f.split() for f in PIECES.split(", ")]
        schema = pa.schema([(n, pa.binary() if t == "binary" else pa.int64()) for n, t in fields])

        def rows() -> pa.RecordBatch:
            got = packer.taken()
            cols = list(zip(*got, strict=True)) if got else [()] * len(fields)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

        for b in batches(it, "text", 8 << 20):
            ids, ends = encode_column(b.column(1), path)
            for k, doc in enumerate(b.column(0).to_pylist()):
                packer.add(doc, np.append(ids[ends[k] : ends[k + 1]], np.uint32(END_ID)))
            yield rows()
        packer.join_open(last=True)
        yield rows()

    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return slim.mapInArrow(run, PIECES)


def with_crc(pieces: DataFrame) -> DataFrame:
    """The pieces with ``ids_crc32`` in place of the ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
