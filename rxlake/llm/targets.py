"""Importance resampling towards a target distribution of hashed word n-grams.

Newlines cut texts into segments.  Equal lines (after normalising) meet in one
shuffle; the n-grams of a distinct line are hashed once, its counts multiplied
by its occurrences, and the n-grams that cross from line to line are added per
document.  A document's weight is put together the same way: the weights of
its lines, joined back by their 128-bit hash, plus its crossing n-grams.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlake.llm.common import batches, cut, numbered, shuffle_width
from rxlake.session import scratch_path

#: Longest n-gram, and hash buckets of the features.
GRAMS = 3
BUCKETS = 10_000
#: Documents of fewer words are never drawn; percent of the others drawn.
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
#: Bytes of text handled at a time.
CHUNK_BYTES = 4 << 20


def _byte_classes() -> bytes:
    """Bytes after normalising: A-Z in lower case, newline kept, every other
    ASCII byte but digits and letters a space, bytes above ASCII unchanged."""
    out = bytearray(b" " * 128 + bytes(range(128, 256)))
    for c in b"0123456789abcdefghijklmnopqrstuvwxyz\n":
        out[c] = c
    for c in range(26):
        out[65 + c] = 97 + c
    return bytes(out)


CLASSES = _byte_classes()


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


def _append_tables() -> list[np.ndarray]:
    """Table k: what a CRC becomes when 2 ** k bytes follow, by its four bytes
    (appending is linear, so the parts' results are combined by XOR)."""
    step = _crc_table()
    unit = np.uint32(1) << np.arange(32, dtype=np.uint32)
    image = step[unit & 255] ^ (unit >> np.uint32(8))  # of every single bit, for one zero byte
    tables = []
    for _ in range(31):
        table = np.zeros((4, 256), np.uint32)
        for byte in range(4):
            for bit in range(8):
                on = (np.arange(256) >> bit) & 1 == 1
                table[byte, on] ^= image[8 * byte + bit]
        tables.append(table)
        image = _applied(table, image)
    return tables


def _applied(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 255] ^ table[1][(crc >> 8) & 255] ^ table[2][(crc >> 16) & 255] ^ table[3][crc >> 24]


CRC = _crc_table()
APPEND = _append_tables()


def joined_crc(left: np.ndarray, right: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of concatenations, from the parts' CRCs and the right part's size."""
    out = left.copy()
    for k in range(int(size.max()).bit_length() if len(size) else 0):
        some = np.flatnonzero((size >> k) & 1)
        out[some] = _applied(APPEND[k], out[some])
    return out ^ right


def word_crcs(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-32 of every word, a byte of all words at a time; words of over 64
    bytes, which are few, one by one."""
    import zlib

    crc = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    order = np.argsort(-np.minimum(sizes, 65), kind="stable")
    begin, size = starts[order], sizes[order]
    state = crc[order]
    count = np.searchsorted(-size, -np.arange(1, 65), side="right")
    for j in range(64):
        m = int(count[j])
        if not m:
            break
        state[:m] = CRC[(state[:m] ^ data[begin[:m] + j]) & 255] ^ (state[:m] >> np.uint32(8))
    crc[order] = ~state
    for k in np.flatnonzero(sizes > 64).tolist():
        crc[k] = zlib.crc32(data[starts[k] : starts[k] + sizes[k]].tobytes())
    return crc


class Segments:
    """The words of a chunk of texts: start, size, row and line of each; lines
    without a word do not count."""

    def __init__(self, text: pa.Array) -> None:
        text = pc.fill_null(text, "").cast(pa.large_binary())
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        raw = text.buffers()[2].to_pybytes()[offsets[0] : offsets[-1]] if len(text) and text.buffers()[2] else b""
        edges = offsets - offsets[0]
        self.data = data = np.frombuffer(raw.translate(CLASSES), np.uint8)
        inside = (data != 32) & (data != 10)
        border = np.zeros(len(data) + 1, bool)
        border[edges] = True
        before = np.concatenate([[False], inside])
        after = np.concatenate([inside, [False]])
        self.starts = np.flatnonzero(after & (~before | border))
        ends = np.flatnonzero(before & (~after | border))
        self.sizes = ends - self.starts
        self.row = np.searchsorted(edges, self.starts, side="right") - 1
        lines = np.cumsum(np.concatenate([[0], data == 10]))
        code = lines[self.starts] + self.row  # rises at every newline and at every row
        new = np.concatenate([[True], np.diff(code) != 0])[: len(code)]
        self.line = np.cumsum(new) - 1
        self.first = np.flatnonzero(new)  # first word of each line
        self.n_rows = len(text)

    def crcs(self) -> np.ndarray:
        return word_crcs(self.data, self.starts, self.sizes)

    def line_texts(self) -> pa.Array:
        """Every line's words, joined by one space."""
        keep = np.zeros(len(self.data), bool)
        edge = np.zeros(len(self.data) + 1, np.int64)
        np.add.at(edge, self.starts, 1)
        np.add.at(edge, self.starts + self.sizes, -1)
        keep |= np.cumsum(edge)[:-1] > 0
        inner = np.flatnonzero(np.diff(self.line) == 0)
        keep[self.starts[inner] + self.sizes[inner]] = True  # the byte behind a word that another follows is a space
        place = np.concatenate([[0], np.cumsum(keep)])
        last = np.append(self.first[1:], len(self.starts))[: len(self.first)] - 1
        offsets = np.concatenate([place[self.starts[self.first]], place[(self.starts + self.sizes)[last]][-1:]]).astype(np.int64)
        body = pa.py_buffer(self.data[keep].tobytes())
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.first), [None, pa.py_buffer(offsets.tobytes()), body])


def gram_buckets(crc: np.ndarray, sizes: np.ndarray, group: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per length n from 1, (first words, buckets) of the runs of n words that
    stay within a ``group``."""
    space = np.full(len(crc), 0xE96CCF45, np.uint32)  # CRC-32 of one space
    spaced = joined_crc(space, crc, sizes)
    out = [(np.arange(len(crc)), (crc % BUCKETS).astype(np.int64))]
    run = crc
    for n in range(1, GRAMS):
        run = joined_crc(run[: max(0, len(crc) - n)], spaced[n:], sizes[n:] + 1)
        whole = np.flatnonzero(group[: len(run)] == group[n:])
        out.append((whole, (run[whole] % BUCKETS).astype(np.int64)))
    return out


def _counts(vector: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(vector)
    return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(vector[at])], ["bucket", "n"])


def _keys(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, lines.to_pylist())), ">i8").reshape(-1, 2)
    return digests[:, 0].astype(np.int64), digests[:, 1].astype(np.int64)


def distinct_lines(docs: DataFrame) -> DataFrame:
    """``line`` (normalised, with a word) and ``n``, its occurrences in the
    ``text`` of all documents: counted per chunk, then added up by line."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, "text", CHUNK_BYTES):
            lines = Segments(b.column(0)).line_texts().dictionary_encode()
            n = np.bincount(np.asarray(lines.indices), minlength=len(lines.dictionary))
            yield pa.RecordBatch.from_arrays([lines.dictionary.cast(pa.binary()), pa.array(n.astype(np.int64))], ["line", "n"])

    return docs.select("text").mapInArrow(run, "line binary, n long").groupBy("line").agg(F.sum("n").alias("n"))


def line_features(lines: DataFrame) -> DataFrame:
    """``a, b`` (128-bit hash), ``n`` and the packed buckets of every distinct
    line's n-grams, written once to the shared folder."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, "line", CHUNK_BYTES):
            text = b.column(0)
            found = Segments(text)
            grams = gram_buckets(found.crcs(), found.sizes, found.row)
            row = np.concatenate([found.row[at] for at, _ in grams])
            bucket = np.concatenate([x for _, x in grams]).astype(np.uint16)
            order = np.argsort(row, kind="stable")
            ends = np.searchsorted(row[order], np.arange(b.num_rows + 1)) * 2
            body = bucket[order].tobytes()
            packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b.num_rows, [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(body)])
            hi, lo = _keys(text)
            yield pa.RecordBatch.from_arrays([pa.array(hi), pa.array(lo), b.column(1), packed.cast(pa.binary())], ["a", "b", "n", "buckets"])

    path = scratch_path(lines.sparkSession, "line-features")
    lines.mapInArrow(run, "a long, b long, n long, buckets binary").write.parquet(path)
    return lines.sparkSession.read.parquet(path)


def document_lines(docs: DataFrame) -> DataFrame:
    """Per document: ``rid``, ``doc_id``, ``n_words``, its distinct lines with
    their uses, and the packed buckets of n-grams that cross lines."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, "text", CHUNK_BYTES):
            found = Segments(b.column(1))
            n = b.num_rows
            words = np.bincount(found.row, minlength=n)
            lines = found.line_texts().dictionary_encode()
            code = np.asarray(lines.indices, dtype=np.int64)
            hi, lo = _keys(lines.dictionary)
            pair, uses = np.unique(found.row[found.first] * max(1, len(hi)) + code, return_counts=True)
            owner, code = pair // max(1, len(hi)), pair % max(1, len(hi))
            ends = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
            listed = pa.StructArray.from_arrays([pa.array(hi[code]), pa.array(lo[code]), pa.array(uses.astype(np.int64))], ["a", "b", "uses"])
            grams = gram_buckets(found.crcs(), found.sizes, found.row)
            crossing = [(at[found.line[at] != found.line[at + k]], x[found.line[at] != found.line[at + k]]) for k, (at, x) in enumerate(grams)]
            row = np.concatenate([found.row[at] for at, _ in crossing])
            bucket = np.concatenate([x for _, x in crossing]).astype(np.uint16)
            order = np.argsort(row, kind="stable")
            cuts = np.searchsorted(row[order], np.arange(n + 1)) * 2
            body = bucket[order].tobytes()
            packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(cuts.astype(np.int64).tobytes()), pa.py_buffer(body)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(words.astype(np.int64)), pa.ListArray.from_arrays(pa.array(ends), listed), packed.cast(pa.binary())],
                ["doc_id", "n_words", "lines", "crossing"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n_words long, lines array<struct<a: bigint, b: bigint, uses: bigint>>, crossing binary"
    )
    return cut(found.withColumn("rid", F.monotonically_increasing_id()))


def bucket_counts(features: DataFrame, documents: DataFrame) -> np.ndarray:
    """Features per bucket: every distinct line's, times its occurrences, and
    the crossing ones.  A task adds up one vector; BUCKETS rows come back."""

    def of_lines(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for b in it:
            packed = b.column(0)
            bucket, times = _unpacked(packed), np.repeat(np.asarray(b.column(1), dtype=np.int64), np.asarray(pc.binary_length(packed), dtype=np.int64) // 2)
            np.add.at(total, bucket, times)
        yield _counts(total)

    def of_crossing(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for b in it:
            total += np.bincount(_unpacked(b.column(0)), minlength=BUCKETS)
        yield _counts(total)

    parts = features.select("buckets", "n").mapInArrow(of_lines, "bucket int, n long")
    parts = parts.unionAll(documents.select("crossing").mapInArrow(of_crossing, "bucket int, n long"))
    got = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, np.int64)
    out[np.asarray(got["bucket"])] = np.asarray(got["n"])
    return out


def _unpacked(packed: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(packed.to_pylist()), np.uint16).astype(np.int64)


def _sums(packed: pa.Array, gain: np.ndarray) -> np.ndarray:
    """Sum of the gains of each row's packed buckets."""
    sizes = np.asarray(pc.binary_length(packed), dtype=np.int64) // 2
    total = np.concatenate([[0], np.cumsum(gain[_unpacked(packed)])])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1) (S + B) / ((s + 1) (T + B)))) per bucket."""
    s_all, t_all = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array(
        [math.floor(1000 * math.log(((t + 1) * s_all) / ((s + 1) * t_all))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64
    )


def weights(documents: DataFrame, features: DataFrame, gain: np.ndarray) -> DataFrame:
    """``rid, weight``: every line weighed once and joined to the documents
    that hold it, plus the crossing n-grams.

    Lines of more than a share of all occurrences would put their documents in
    one task; there are at most 4 x partitions of them, so they are joined by
    broadcast, all others by shuffle."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(gain)

    def of_lines(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(_sums(b.column(3), shared.value))], ["a", "b", "n", "weight"])

    def of_crossing(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_sums(b.column(1), shared.value))], ["rid", "weight"])

    weighed = features.select("a", "b", "n", "buckets").mapInArrow(of_lines, "a long, b long, n long, weight long")
    share = max(1, (features.agg(F.sum("n")).first()[0] or 0) // (4 * shuffle_width(spark)))
    links = documents.select("rid", F.inline("lines"))
    often = F.broadcast(features.filter(F.col("n") > share).select("a", "b"))
    hot = links.join(F.broadcast(weighed.filter(F.col("n") > share)), ["a", "b"])
    cold = links.join(often, ["a", "b"], "left_anti").join(weighed.filter(F.col("n") <= share), ["a", "b"])
    parts = hot.unionByName(cold).select("rid", (F.col("weight") * F.col("uses")).alias("weight"))
    crossing = documents.select("rid", "crossing").mapInArrow(of_crossing, "rid long, weight long")
    return parts.unionAll(crossing).groupBy("rid").agg(F.sum("weight").alias("weight"))


def resample(docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row.

    Of the rows with at least LEAST_WORDS words, ``percent`` of a hundred are
    drawn (rank 1, 2, ...): the highest weights plus Gumbel noise hashed from
    the id, ties to the smaller id.  Null texts hold no feature (weight 0); a
    null id hashes as the empty text and comes last in ties; rows repeating an
    id and a text tie in any order, each with a rank of its own; lines are
    compared whole (in the shuffle) and joined by 128-bit hash; an empty
    target gives every bucket t = 0; no rows give none.
    """
    plain = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    features, documents = line_features(distinct_lines(plain)), document_lines(plain)
    wanted = target.select(F.lit(0).alias("doc_id"), F.col(f"`{target_text_col}`").alias("text"))
    gain = bucket_gains(bucket_counts(features, documents), bucket_counts(line_features(distinct_lines(wanted)), document_lines(wanted)))
    n = F.col("n_words")
    grams = sum((F.greatest(n - k, F.lit(0)) for k in range(1, GRAMS)), n)
    digest = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = cut(
        documents.select("rid", "doc_id", "n_words").join(weights(documents, features, gain), "rid")
        .select("rid", "doc_id", "n_words", grams.cast("long").alias("n_features"), "weight", (F.col("weight") + noise).alias("score"))
    )
    drawn = ranked(scored.filter(n >= LEAST_WORDS), percent)
    return scored.join(drawn, "rid", "left").select("doc_id", "n_features", "weight", "score", "rank")


def ranked(able: DataFrame, percent: int) -> DataFrame:
    """``rid, rank`` of the highest ``percent`` of a hundred scores: narrow
    rows, range-partitioned in order and numbered without a gap."""
    take = able.count() * percent // 100
    placed = numbered(able.select("rid", "score", "doc_id"), [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("rid").asc()])
    return placed.filter(F.col("at") < take).select("rid", (F.col("at") + 1).cast("long").alias("rank"))
