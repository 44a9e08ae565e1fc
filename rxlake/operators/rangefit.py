"""The fit by rows (``newton.fit_by_rows``) with its vectors over the executors.

Rows lie in ranges of 4,096; a range holds its part of every vector, and terms lie
in blocks per shard, cut by range.  Shards are dealt to lots: a product by
``X X'`` sends a vector's ranges to every lot, a lot works on one shard at a time
(down to its terms, up to the rows), and the ranges add up what the lots found.
Blocks and ranges stay where they are, since both sides are dealt by one
function.  The driver holds the intercepts and a few sums.
"""

from __future__ import annotations

import sys
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlake.operators import termpacks
from rxlake.operators.newton import RowFit, _whole, softmax

# what runs in tasks is pickled by value: executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RANGE_BITS = 12
RANGES_A_TASK = 64
SHARD_CHARS = 1 << 22  # characters of text a shard stands for: a task works on one at a time
SPOOL_BYTES = 64 << 20  # of a vector that a task keeps in memory; beyond, in a temporary file
KEPT_PRODUCTS = 5  # until the ranges are written and the shuffles of the products given up
RANGE = "range long, label binary, weight binary"
PIECE = "shard int, range long, terms binary, idf binary, cols binary, counts binary, rows binary, tf binary, pieces int"
VECTORS = ("a", "ka", "d", "kd", "r", "kr", "p", "kp")

State = dict[str, np.ndarray]


def by_lot(lot: int) -> int:
    return lot


def by_range(key: int) -> int:
    return ((key + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 33


# ---------------------------------------------------------------- ranges and blocks
def packed_ranges(rows: DataFrame) -> DataFrame:
    """Ranges of ``a, label, weight``; ``a``: row numbers, ascending in a task."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None

        def done() -> pa.RecordBatch:
            label, weight = (np.concatenate(x) for x in zip(*held, strict=True))
            return pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), *[pa.array([x.tobytes()], pa.binary()) for x in (label, weight)]], [f.split()[0] for f in RANGE.split(", ")])

        for b in it:
            a, label, weight = (np.asarray(b.column(k), dtype=t) for k, t in enumerate((np.int64, np.int32, np.float64)))
            for k in np.unique(a >> RANGE_BITS):
                if key is not None and k != key:
                    yield done()
                    held = []
                key = int(k)
                held.append((label[a >> RANGE_BITS == k], weight[a >> RANGE_BITS == k]))
        if held:
            yield done()

    return rows.select("a", "label", "weight").mapInArrow(run, RANGE)


def shard_pieces(vocabulary: DataFrame, packs: DataFrame, shards: int) -> DataFrame:
    """Per shard, its terms and, by range, its distinct terms' places, their numbers of
    rows, these rows and counts."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, idf, shard, lots = None, None, None, []

        def block() -> Iterator[pa.RecordBatch]:
            key, col, tf = (np.concatenate([x[k] for x in lots] or [np.empty(0, np.int64)]) for k in range(3))
            by = np.lexsort((key, col, key >> RANGE_BITS))
            key, col, tf = key[by], col[by].astype(np.int32), tf[by].astype(np.float32)
            of, row = key >> RANGE_BITS, (key & (1 << RANGE_BITS) - 1).astype(np.uint16)
            edge = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]])) if len(of) else np.zeros(1, np.int64)

            def piece(at: int, *bodies, n: int | None = None) -> pa.RecordBatch:
                columns = [pa.array([None if x is None else x.tobytes()], pa.binary()) for x in bodies]
                return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([at], pa.int64()), *columns, pa.array([n], pa.int32())], [f.split()[0] for f in PIECE.split(", ")])

            yield piece(-1, terms, idf, None, None, None, None, n=len(edge) - 1)
            for lo, hi in zip(edge[:-1], edge[1:], strict=True):
                start = np.flatnonzero(np.concatenate([[True], col[lo + 1 : hi] != col[lo : hi - 1]]))
                yield piece(int(of[lo]), None, None, col[lo:hi][start], np.diff(np.append(start, hi - lo)).astype(np.int32), row[lo:hi], tf[lo:hi])

        for b in it:
            for k in range(b.num_rows):
                x = {n: b.column(n)[k] for n in ("shard", "kind", "terms", "idf", "a", "rows", "tf")}
                if x["kind"].as_py() == 0:
                    if shard is not None:
                        yield from block()
                    terms, idf, shard, lots = np.frombuffer(x["terms"].as_buffer(), np.uint64), np.frombuffer(x["idf"].as_buffer()), x["shard"].as_py(), []
                elif x["shard"].as_py() == shard:  # a shard without vocabulary has no row to meet
                    at, hit = termpacks.found(terms, np.frombuffer(x["terms"].as_buffer(), np.uint64))
                    key = np.frombuffer(x["a"].as_buffer(), np.int64)[np.frombuffer(x["rows"].as_buffer(), np.uint16)[hit]]
                    lots.append((key, at[hit], np.frombuffer(x["tf"].as_buffer(), np.int32)[hit]))
        if shard is not None:
            yield from block()

    return termpacks._meeting(vocabulary, packs, shards, 1).mapInArrow(run, PIECE)  # noqa: SLF001


class Spool:
    """Arrays of ``lines`` rows by key, in memory as long as they are small."""

    def __init__(self, lines: int) -> None:
        self.lines, self.at, self.end = lines, {}, 0
        self.file = tempfile.SpooledTemporaryFile(max_size=SPOOL_BYTES)

    def put(self, key: int, value: np.ndarray) -> None:
        at, size = self.at.setdefault(key, (self.end, value.nbytes))
        self.end = max(self.end, at + size)
        self.file.seek(at)
        self.file.write(np.ascontiguousarray(value).tobytes())

    def get(self, key: int) -> np.ndarray:
        at, size = self.at[key]
        self.file.seek(at)
        return np.frombuffer(self.file.read(size)).reshape(self.lines, -1)


class Piece:
    """A shard's counts x idf in one range of rows."""

    def __init__(self, idf: np.ndarray, cols, counts, rows, tf) -> None:
        self.cols, self.row = np.frombuffer(cols, np.int32), np.frombuffer(rows, np.uint16)
        counts = np.frombuffer(counts, np.int32)
        self.start = np.cumsum(counts) - counts
        self.of = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        self.value = np.frombuffer(tf, np.float32) * idf[self.cols][self.of]

    def down(self, into: np.ndarray, m: np.ndarray) -> None:
        for line, x in zip(into, m, strict=True):
            line[self.cols] += np.add.reduceat(self.value * x[self.row], self.start)

    def up(self, t: np.ndarray, n: int) -> np.ndarray:
        return np.stack([np.bincount(self.row, self.value * x[self.cols][self.of], n) for x in t])

    def squares(self, n: int) -> np.ndarray:
        return np.bincount(self.row, self.value * self.value, n)[None, :]


def of_lot(lines: int, kind: str) -> Callable[[Iterator], Iterator]:
    """Of a lot's ranges and then its shards' pieces: ``X X' m`` by range
    (``product``), sums of squares by range (``squares``) or, by shard, terms, idf and
    idf x (X' m) with the last class (``weights``)."""

    def work(given: Spool, out: Spool, idf: np.ndarray, pieces: list) -> np.ndarray:
        t, ready = np.zeros((lines, len(idf))), [(k, Piece(idf, *x)) for k, *x in pieces]
        if kind != "squares":
            for k, x in ready:
                x.down(t, given.get(k))
        if kind != "weights":
            for k, x in ready:
                n = given.get(k).shape[1]
                found = x.up(t, n) if kind == "product" else x.squares(n)
                out.put(k, out.get(k) + found if k in out.at else found)
        return t

    def run(it: Iterator) -> Iterator:
        given, out, heads, waiting, begun = Spool(lines), Spool(lines), {}, {}, False
        for _, x in it:
            if len(x) == 2:
                assert not begun, "a lot's ranges come before its shards"
                given.put(*x)
                continue
            begun = True
            shard, key, terms, idf, *body, n = x
            if key < 0:
                heads[shard] = terms, np.frombuffer(idf), n
            else:
                waiting.setdefault(shard, []).append((key, *body))
            if shard in heads and len(waiting.get(shard, ())) == heads[shard][2]:
                terms, idf, _ = heads.pop(shard)
                t = work(given, out, idf, waiting.pop(shard, []))
                if kind == "weights":
                    yield shard, bytes(terms), idf.tobytes(), (_whole(t) * idf).tobytes()
        assert not heads and not waiting, "pieces are missing"
        for k in out.at:
            yield k, out.get(k)

    return run


class Ranges:
    """The fit's vectors by range, and products by ``X X'`` over the lots."""

    def __init__(self, ranges: DataFrame, pieces: DataFrame, classes: int) -> None:
        self.sc, self.classes = ranges.sparkSession.sparkContext, classes
        self.lots = self.sc.defaultParallelism
        parts = max(self.lots, -(-ranges.count() // RANGES_A_TASK))
        lots, lines = self.lots, classes - 1

        def begin(r) -> tuple[int, State]:
            label, weight = np.frombuffer(r[1], np.int32), np.frombuffer(r[2])
            return r[0], {"label": label, "weight": weight, "scale": np.ones(len(label))} | {k: np.zeros((lines, len(label))) for k in VECTORS}

        self.shards = pieces.rdd.map(lambda r: (r[0] % lots, tuple(r))).partitionBy(lots, by_lot).persist(StorageLevel.MEMORY_AND_DISK)
        self.parts, self.made, self.products = parts, [], 0
        self.rows = self.kept = ranges.rdd.map(begin).partitionBy(parts, by_range)
        self.keep(self.rows, lambda s: np.zeros(1), write=True)

    def told(self, tell: Callable[[State], np.ndarray]) -> np.ndarray:
        """The sum of a few numbers of every range."""

        def run(it: Iterator) -> Iterator[np.ndarray]:
            total = None
            for _, s in it:
                total = tell(s) if total is None else total + tell(s)
            return iter([] if total is None else [total])

        return np.sum(self.rows.mapPartitions(run).collect(), axis=0)

    def turn(self, change: Callable[[State], State]) -> None:
        """Changed vectors, made by whatever reads the ranges next."""
        self.rows = self.rows.mapValues(lambda s: s | change(s))

    def keep(self, rows: RDD, tell: Callable[[State], np.ndarray], write: bool) -> np.ndarray:
        before, self.rows = self.kept, rows.persist(StorageLevel.MEMORY_AND_DISK)
        self.kept = self.rows
        if write:
            self.rows.checkpoint()
        out = self.told(tell)
        if before is not self.kept:
            before.unpersist()
        if write:
            for x in self.made:  # their sums lie in the written ranges
                x._jrdd.rdd().cleanShuffleDependencies(False)  # noqa: SLF001
            self.made = []
        return out

    def sent(self, make: Callable[[State], np.ndarray]) -> RDD:
        lots = self.lots

        def send(x: tuple[int, State]) -> Iterator:
            m = make(x[1]) * x[1]["scale"]
            return ((lot, (x[0], m)) for lot in range(lots))

        given = self.rows.flatMap(send).partitionBy(lots, by_lot)
        return self.sc.union([given, self.shards])

    def multiply(self, make: Callable[[State], np.ndarray], use: Callable[[State, np.ndarray, np.ndarray], State], tell: Callable[[State], np.ndarray], lines: int = 0, kind: str = "product") -> np.ndarray:
        """Every range's ``use(range, m, X X' m)`` with m = ``make(range)``; then ``told``."""
        sums = self.sent(make).mapPartitions(of_lot(lines or self.classes - 1, kind)).partitionBy(self.parts, by_range)

        def met(it: Iterator) -> Iterator:
            states, found = {}, {}
            for k, x in it:
                if isinstance(x, dict):
                    states[k] = x
                else:
                    found[k] = found[k] + x if k in found else x
            assert found.keys() <= states.keys(), "a range lies elsewhere than its sums"
            for k, s in states.items():
                m = make(s)
                yield k, s | use(s, m, found.pop(k, np.zeros(m.shape)) * s["scale"])

        self.products += 1
        self.made.append(sums)
        return self.keep(self.sc.union([self.rows, sums]).mapPartitions(met, True), tell, self.products % KEPT_PRODUCTS == 0)

    def weights(self) -> RDD:
        """``shard, terms, idf, weights`` of the fit."""
        return self.sent(lambda s: s["a"]).mapPartitions(of_lot(self.classes - 1, "weights"))

    def release(self) -> None:
        for x in (*self.made, self.shards):
            x._jrdd.rdd().cleanShuffleDependencies(False)  # noqa: SLF001
        self.shards.unpersist()
        self.kept.unpersist()


# ---------------------------------------------------------------- the solver
def _inner(x: np.ndarray, y: np.ndarray) -> float:
    return float((_whole(x) * _whole(y)).sum())


def _chances(s: State, free: np.ndarray) -> np.ndarray:
    return softmax((_whole(s["ka"]) + free[:, None]).T).T


def _objective(s: State, free: np.ndarray, d_free: np.ndarray, l2: float, scale: float) -> float:
    k = _whole(s["ka"] + scale * s["kd"])
    z = k + (free + scale * d_free)[:, None]
    top = z.max(axis=0)
    loss = float((s["weight"] * (top + np.log(np.exp(z - top).sum(axis=0)) - z[s["label"], np.arange(len(top))])).sum())
    return loss + 0.5 * l2 * float((_whole(s["a"] + scale * s["d"]) * k).sum())


def _descent(s: State, free: np.ndarray, l2: float) -> tuple[np.ndarray, np.ndarray]:
    """Minus the gradient's factors, and of the intercepts."""
    u = _chances(s, free)
    u[s["label"], np.arange(u.shape[1])] -= 1.0
    u *= s["weight"]
    return -(u[:-1] + l2 * s["a"]), -u.sum(axis=1)


def _curved(s: State, free: np.ndarray, p_free: np.ndarray, l2: float) -> tuple[np.ndarray, np.ndarray]:
    """The Hessian times ``p``, and the part of the intercepts."""
    chance, z = _chances(s, free), _whole(s["kp"]) + p_free[:, None]
    v = s["weight"] * chance * (z - (chance * z).sum(axis=0))
    return v[:-1] + l2 * s["p"], v.sum(axis=1)


def fit_by_ranges(ranges: Ranges, l2: float, tolerance: float = 1e-5, max_steps: int = 50, max_products: int = 60) -> RowFit:
    """The steps of ``fit_by_rows``; the factors by row stay in ``ranges`` (``a``)."""
    classes = ranges.classes
    products = 0

    def lengths(s: State, _: np.ndarray, squares: np.ndarray) -> State:
        at = np.sqrt(squares[0])
        return {"scale": np.divide(1.0, at, out=np.zeros(len(at)), where=at > 0)}

    total = ranges.multiply(lambda s: np.zeros((1, len(s["label"]))), lengths, lambda s: np.array([s["weight"].sum()]), 1, "squares")[0]

    def start_of_step(free: np.ndarray) -> tuple[float, np.ndarray]:
        def tell(s: State) -> np.ndarray:
            return np.array([_inner(s["r"], s["kr"]), *_descent(s, free, l2)[1]])

        got = ranges.multiply(lambda s: _descent(s, free, l2)[0], lambda s, m, km: {"r": m, "kr": km}, tell)
        return max(0.0, got[0] + float((got[1:] ** 2).sum())), got[1:]

    def curvature(free: np.ndarray, p_free: np.ndarray) -> tuple[float, float, np.ndarray]:
        def tell(s: State) -> np.ndarray:
            hp, of_free = _curved(s, free, p_free, l2)
            return np.array([_inner(s["kp"], hp), _inner(s["p"], s["kp"]), *of_free])

        got = ranges.told(tell)
        return got[0] + float((p_free * got[2:]).sum()), got[1] + float((p_free * p_free).sum()), got[2:]

    def go(free: np.ndarray, p_free: np.ndarray, length: float) -> float:
        def use(s: State, hp: np.ndarray, khp: np.ndarray) -> State:
            moved = {"d": "p", "kd": "kp"}
            return {k: s[k] + length * s[v] for k, v in moved.items()} | {"r": s["r"] - length * hp, "kr": s["kr"] - length * khp}

        return float(ranges.multiply(lambda s: _curved(s, free, p_free, l2)[0], use, lambda s: np.array([_inner(s["r"], s["kr"])]))[0])

    def turn(share: float) -> None:
        ranges.turn(lambda s: {"p": s["r"] + share * s["p"], "kp": s["kr"] + share * s["kp"]})

    def objectives(free: np.ndarray, d_free: np.ndarray, scale: float) -> tuple[float, float]:
        """Where ``scale`` times the direction is added, and the fall along it here."""

        def tell(s: State) -> np.ndarray:
            down, of_free = _descent(s, free, l2)
            return np.array([_objective(s, free, d_free, l2, scale), _inner(down, s["kd"]) + float((of_free * d_free).sum())])

        return tuple(ranges.told(tell).tolist())

    def move(scale: float) -> None:
        ranges.turn(lambda s: {"a": s["a"] + scale * s["d"], "ka": s["ka"] + scale * s["kd"]})

    free = np.zeros(classes)
    objective, first, norm, steps = objectives(free, np.zeros(classes), 0.0)[0], 0.0, 0.0, 0
    while True:
        rr, r_free = start_of_step(free)
        products += 1
        norm = rr**0.5
        first = first or norm
        if norm <= tolerance * total or steps == max_steps:
            break
        steps += 1
        # conjugate gradients on H d = -g
        d_free, p_free = np.zeros(classes), r_free
        ranges.turn(lambda s: {"d": np.zeros_like(s["d"]), "kd": np.zeros_like(s["kd"]), "p": s["r"], "kp": s["kr"]})
        goal = min(0.1, (norm / first) ** 0.5) * norm
        for _ in range(max_products):
            curve, size, h_free = curvature(free, p_free)
            if curve <= 1e-12 * size:
                break
            length = rr / curve
            d_free, r_free = d_free + length * p_free, r_free - length * h_free
            left = max(0.0, go(free, p_free, length) + float((r_free * r_free).sum()))
            products += 1
            if left**0.5 <= goal:
                break
            turn(left / rr)
            p_free = r_free + left / rr * p_free
            rr = left
        scale = 1.0
        while True:
            tried, falls = objectives(free, d_free, scale)
            if tried <= objective - 1e-4 * scale * falls or scale < 1e-6:
                break
            scale /= 2
        if tried >= objective:  # at the precision of the sum
            break
        move(scale)
        free, objective = free + scale * d_free, tried
    return RowFit(np.empty((0, classes)), free - free.mean(), objective, norm, steps, products)


def fit_terms(held: DataFrame, vocabulary: DataFrame, packs: DataFrame, shards: int, classes: int, l2: float, tolerance: float) -> tuple[RowFit, RDD, Ranges]:
    """The fit of ``a, label, weight`` and their packs, and its weights by shard
    (to be read before the ranges are released)."""
    pieces = shard_pieces(termpacks.packed_vocabulary(vocabulary, shards), packs, shards)
    ranges = Ranges(packed_ranges(held), pieces, classes)
    fit = fit_by_ranges(ranges, l2, tolerance)
    return fit, ranges.weights(), ranges
