"""Language identification with segmentation-marginalised unigram pieces.

Every language has one probability per piece of a fixed public vocabulary.  The
probability of a word in a language is the sum over all ways to cut it into
pieces, found by a forward algorithm; a text's is the product over its words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxlake.llm.common import batches, split_words

#: Public vocabulary (a name that ``public_tokenizers.path`` knows, or a path).
VOCABULARY = "piece_bpe_32k.model"
#: Bytes of a unit (a word's letters) that are segmented together; a longer run
#: of letters is cut every so many bytes, so the work on it stays linear.
UNIT_BYTES = 30
#: Added to every piece's expected count.
ADD = 0.01
#: Passes of expected counts over the training rows.
ROUNDS = 1
#: A byte's usual probability is about 1 / BYTE: keeps products near one.
BYTE = 8.0
#: Bytes of text handled at a time, and units segmented at a time.
CHUNK_BYTES = 8 << 20
UNITS = 1 << 14
#: Languages scored together, so that memory does not grow with their number.
GROUP = 16
UNKNOWN = "und"
MULT = np.uint64(0x9E3779B97F4A7C15)
FILTER = 17


class Pieces:
    """The fixed vocabulary: lower-case runs of letters, with a leading space
    where a word begins, and all single bytes, so every unit can be cut."""

    def __init__(self, texts: list[bytes]) -> None:
        self.texts = sorted({*texts, *(bytes([b]) for b in range(256))})
        self.longest = max(map(len, self.texts))
        self.keys: list[tuple[np.ndarray, np.ndarray]] = []  # by length: hashes, ids
        self.bits: list[np.ndarray] = []
        for length in range(1, self.longest + 1):
            ids = np.array([k for k, t in enumerate(self.texts) if len(t) == length], np.int32)
            h = np.zeros(len(ids), np.uint64)
            if len(ids):
                raw = np.frombuffer(b"".join(self.texts[k] for k in ids), np.uint8).reshape(len(ids), length)
                for j in range(length):
                    h = h * MULT + raw[:, j] + np.uint64(1)
            order = np.argsort(h)
            self.keys.append((h[order], ids[order]))
            bits = np.zeros(1 << FILTER, bool)
            bits[h >> np.uint64(64 - FILTER)] = True
            self.bits.append(bits)

    def matches(self, units: np.ndarray, sizes: np.ndarray) -> list[list[tuple[np.ndarray, np.ndarray, int]]]:
        """Per end position, (rows, piece ids, length) of the pieces that end
        there.  ``units``: zero-padded bytes, longest unit first."""
        n, width = units.shape
        out: list[list[tuple[np.ndarray, np.ndarray, int]]] = [[] for _ in range(width + 1)]
        rows = np.searchsorted(-sizes, -np.arange(width + 1), side="right")  # units of at least j bytes
        h = [np.zeros(n, np.uint64) for _ in range(width)]  # by start: hash of what has been read from it
        for j in range(1, width + 1):
            m = rows[j]
            byte = units[:m, j - 1].astype(np.uint64) + np.uint64(1)
            for start in range(max(0, j - self.longest), j):
                x = h[start][:m]
                x *= MULT
                x += byte
                length = j - start
                known, ids = self.keys[length - 1]
                if not len(known):
                    continue
                hit = np.flatnonzero(self.bits[length - 1][x >> np.uint64(64 - FILTER)])
                at = np.minimum(np.searchsorted(known, x[hit]), len(known) - 1)
                same = known[at] == x[hit]
                if same.any():
                    out[j].append((hit[same], ids[at[same]], length))
        return out


def load_pieces(vocabulary: str = VOCABULARY) -> Pieces:
    import os

    import public_tokenizers
    import sentencepiece

    path = vocabulary if os.path.exists(vocabulary) else public_tokenizers.path(vocabulary)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = []
    for k in range(model.get_piece_size()):
        lowered = model.id_to_piece(k).lower().replace("▁", " ", 1)
        if not (model.is_byte(k) or model.is_control(k) or model.is_unknown(k)) and re.fullmatch(r" ?[^\W\d_]+", lowered):
            coded = lowered.encode()
            if len(coded) <= UNIT_BYTES + 1:
                texts.append(coded)
    return Pieces(texts)


def units_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of distinct words: zero-padded bytes, sizes, and the word each
    belongs to.  A word's units are its runs of letters (with their marks),
    lower-cased, each behind a space; a word without a letter has none."""
    letters = pc.utf8_trim_whitespace(pc.replace_substring_regex(pc.utf8_lower(words), r"[^\p{L}\p{M}]+", " "))
    lists = pc.split_pattern(letters, " ")
    flat, owner = lists.flatten(), np.asarray(pc.list_parent_indices(lists), dtype=np.int64)
    real = np.asarray(pc.match_substring_regex(flat, r"\p{L}"))
    flat, owner = flat.filter(pa.array(real)), owner[real]
    size = np.asarray(pc.binary_length(flat), dtype=np.int64)
    offsets = np.frombuffer(flat.buffers()[1], np.int32)[flat.offset : flat.offset + len(flat) + 1].astype(np.int64) if len(flat) else np.zeros(1, np.int64)
    data = np.frombuffer(flat.buffers()[2], np.uint8) if len(flat) and flat.buffers()[2] else np.zeros(0, np.uint8)
    parts = -(-size // UNIT_BYTES)
    which = np.repeat(np.arange(len(size)), parts)
    step = (np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)) * UNIT_BYTES
    length = np.minimum(UNIT_BYTES, size[which] - step)
    first = step == 0  # the space stands before a word's first unit only
    sizes = length + first
    width = int(sizes.max()) if len(sizes) else 1
    units = np.zeros((len(sizes), width), np.uint8)
    units[first, 0] = 32
    for j in range(min(UNIT_BYTES, width)):
        some = np.flatnonzero(length > j)
        units[some, j + first[some]] = data[offsets[which[some]] + step[some] + j]
    return units, sizes, owner[which]


def _in_blocks(units: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places, units, sizes) by falling size, at most UNITS at a time."""
    order = np.argsort(-sizes, kind="stable")
    for lo in range(0, len(order), UNITS):
        at = order[lo : lo + UNITS]
        yield at, units[at, : int(sizes[at[0]])], sizes[at]


def forward(pieces: Pieces, scaled: np.ndarray, units: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Natural log of each unit's probability per language.  ``scaled``: piece
    probabilities x BYTE ** length, pieces by languages."""
    out = np.empty((len(sizes), scaled.shape[1]))
    for at, block, size in _in_blocks(units, sizes):
        found = pieces.matches(block, size)
        reached = np.zeros((block.shape[1] + 1, len(at), scaled.shape[1]))
        reached[0] = 1.0
        for j in range(1, len(found)):
            for rows, ids, length in found[j]:
                reached[j, rows] += reached[j - length, rows] * scaled[ids]
        out[at] = np.log(reached[size, np.arange(len(at))]) - size[:, None] * np.log(BYTE)
    return out


def expected(pieces: Pieces, scaled: np.ndarray, units: np.ndarray, sizes: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Expected uses of every piece (pieces by languages) over all cuts of the
    units, by forward and backward sums.  ``weight``: units by languages."""
    out = np.zeros((len(pieces.texts), weight.shape[1]))
    one = scaled.shape[1] == 1
    for at, block, size in _in_blocks(units, sizes):
        found = pieces.matches(block, size)
        ends = np.arange(len(at))
        ahead = np.zeros((block.shape[1] + 1, len(at), scaled.shape[1]))
        back = np.zeros_like(ahead)
        ahead[0] = 1.0
        for j in range(1, len(found)):
            for rows, ids, length in found[j]:
                ahead[j, rows] += ahead[j - length, rows] * scaled[ids]
        back[size, ends] = 1.0 / ahead[size, ends]
        for j in range(len(found) - 1, 0, -1):
            for rows, ids, length in found[j]:
                through = back[j, rows] * scaled[ids]
                back[j - length, rows] += through
                used = ahead[j - length, rows] * through
                w = weight[at[rows]]
                for g in range(weight.shape[1]):
                    out[:, g] += np.bincount(ids, used[:, 0 if one else g] * w[:, g], len(out))
    return out


@dataclass(frozen=True)
class LanguageModel:
    """``names`` (sorted), log shares of the training rows, and piece
    probabilities (pieces by languages)."""

    names: tuple[str, ...]
    prior: np.ndarray
    pieces: np.ndarray
    vocabulary: str = VOCABULARY


def _scaled(pieces: Pieces, probability: np.ndarray) -> np.ndarray:
    return probability * (BYTE ** np.array([len(t) for t in pieces.texts], float))[:, None]


def _chunk(text: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(index of distinct word per word, word ends per row, distinct words)."""
    flat, ends = split_words(text)
    coded = flat.dictionary_encode()
    return np.asarray(coded.indices, dtype=np.int64), ends, coded.dictionary


def train(labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang", vocabulary: str = VOCABULARY, rounds: int = ROUNDS) -> LanguageModel:
    """Fit on all rows with a language.

    The first round starts from equal probabilities, where the cuts into the
    fewest pieces weigh most; every round replaces them with the expected uses
    per language.  A task adds up one vector of the vocabulary per language, so
    what is shuffled and collected is bounded by vocabulary x languages,
    however large the corpus.  Null texts have no words.
    """
    rows = labelled.filter(F.col(f"`{lang_col}`").isNotNull()).select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"))
    share = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    names = tuple(sorted(share))
    size = len(load_pieces(vocabulary).texts)
    probability = np.full((size, 1), 1.0 / size)

    def counted(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, total = load_pieces(vocabulary), None
        scaled = _scaled(pieces, shared.value)
        for b in batches(it, "text", CHUNK_BYTES):
            index, ends, words = _chunk(b.column(0))
            at = {n: k for k, n in enumerate(names)}
            lang = np.array([at[x] for x in b.column(1).to_pylist()], np.int64)
            by_token = np.repeat(lang, np.diff(ends))
            units, sizes, owner = units_of(words)
            total = np.zeros((size, len(names))) if total is None else total
            for lo in sorted({int(x) // GROUP * GROUP for x in np.unique(lang)}):
                width = min(GROUP, len(names) - lo)
                mine = (by_token >= lo) & (by_token < lo + width)
                by_word = np.bincount((by_token[mine] - lo) * len(words) + index[mine], minlength=width * len(words)).reshape(width, len(words))
                cols = scaled if scaled.shape[1] == 1 else scaled[:, lo : lo + GROUP]
                total[:, lo : lo + GROUP] += expected(pieces, cols, units, sizes, by_word[:, owner].T.astype(float))
        if total is not None:
            piece, which = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(piece.astype(np.int32)), pa.array(which.astype(np.int32)), pa.array(total[piece, which])], ["piece", "lang", "uses"])

    for _ in range(rounds if names else 0):
        shared = rows.sparkSession.sparkContext.broadcast(probability)
        uses = rows.mapInArrow(counted, "piece int, lang int, uses double").groupBy("piece", "lang").agg(F.sum("uses").alias("uses")).toArrow()
        found = np.full((size, len(names)), ADD)
        found[np.asarray(uses["piece"]), np.asarray(uses["lang"])] += np.round(np.asarray(uses["uses"]), 6)
        probability = found / found.sum(axis=0)
        shared.unpersist()
    total = sum(share.values())
    return LanguageModel(names, np.log([share[n] / total for n in names]) if names else np.zeros(0), probability, vocabulary)


def identify(docs: DataFrame, model: LanguageModel, *, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The input's columns (or those of ``carry``) as a struct ``row``, with ``lang_pred`` and ``score``:
    the language of the highest probability (share of training rows x all
    words; ties to the first name) and its posterior among the learned ones.

    Null texts, texts without a letter and models without a language give
    ``und`` and 0; texts are read whole, in lower case; equal texts get equal
    results; extra columns ride along in ``row``; no rows give none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("row"), F.col(f"`{text_col}`").alias("text"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        pieces = load_pieces(fitted.vocabulary)
        scaled = _scaled(pieces, fitted.pieces)
        for b in batches(it, "text", CHUNK_BYTES):
            index, ends, words = _chunk(b.column(1))
            units, sizes, owner = units_of(words)
            total = np.tile(fitted.prior, (b.num_rows, 1))
            lettered = np.bincount(owner, minlength=len(words)) > 0
            some = np.add.reduceat(np.append(lettered[index], False).astype(np.int64), np.minimum(ends[:-1], len(index))) if b.num_rows else np.zeros(0)
            known = (np.diff(ends) > 0) & (some > 0)
            for lo in range(0, len(fitted.names), GROUP):
                by_unit = forward(pieces, scaled[:, lo : lo + GROUP], units, sizes)
                by_word = np.column_stack([np.bincount(owner, g, len(words)) for g in by_unit.T]) if len(words) else np.zeros((0, by_unit.shape[1]))
                for g in range(by_word.shape[1]):
                    run_ = np.add.reduceat(np.append(by_word[index, g], 0.0), np.minimum(ends[:-1], len(index)))
                    total[:, lo + g] += np.where(np.diff(ends) > 0, run_, 0.0)
            if len(fitted.names):
                best = total.argmax(axis=1)
                score = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                names = np.array([*fitted.names, UNKNOWN], object)[np.where(known, best, len(fitted.names))]
                score = np.where(known, score, 0.0)
            else:
                names, score = np.full(b.num_rows, UNKNOWN, object), np.zeros(b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.string()), pa.array(score)], ["row", "lang_pred", "score"])

    schema = T.StructType([rows.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, schema)
