"""Multinomial logistic regression by truncated Newton steps on sparse rows.

minimise  sum_i w_i loss(x_i, y_i) + l2 / 2 |W|^2   (intercepts are free)

The rows lie packed in blocks over the executors.  A Newton step is found by
conjugate gradients, each of whose iterations is one job: the direction is
broadcast, every block gives its Hessian-vector product, and the products are
summed by ranges of the vector, so no task and not the driver adds up one
vector per partition.  What travels is classes x features; the rows stay.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# what runs in tasks is pickled by value: executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 1024
SLICE_ROWS = 1 << 13  # of a fit by rows, worked on at a time
PACKED = "rows long, ends binary, indices binary, vals binary, label binary, weight binary"


@dataclass(frozen=True)
class Fit:
    """Coefficients (classes x features), intercepts, and what it took."""

    coefficients: np.ndarray
    intercepts: np.ndarray
    objective: float
    gradient_norm: float
    newton_steps: int
    products: int


@dataclass(frozen=True)
class RowFit:
    """Weights as ``by_row' X`` (rows x classes), intercepts, and what it took."""

    by_row: np.ndarray
    intercepts: np.ndarray
    objective: float
    gradient_norm: float
    newton_steps: int
    products: int


def pack_rows(rows: DataFrame, parts: int) -> DataFrame:
    """Blocks of rows from ``features`` (sparse vector), ``label``, ``weight``."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in it:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                b = whole.slice(at, BLOCK_ROWS)
                index, value = b.column(0), b.column(1)
                ends = np.concatenate([[0], np.cumsum(np.asarray(index.value_lengths(), dtype=np.int64))])
                arrays = (ends, np.asarray(index.flatten(), dtype=np.int32), np.asarray(value.flatten()),
                          np.asarray(b.column(2), dtype=np.float64).astype(np.int32), np.asarray(b.column(3), dtype=np.float64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.num_rows]), *[pa.array([a.tobytes()], pa.binary()) for a in arrays]], [f.split()[0] for f in PACKED.split(", ")]
                )

    plain = rows.select(F.unwrap_udt("features").alias("v"), "label", "weight").select("v.indices", "v.values", "label", "weight")
    return plain.repartition(parts).mapInArrow(run, PACKED)


class Block:
    """Sparse rows: products with dense matrices of classes x features."""

    def __init__(self, ends: bytes, indices: bytes, values: bytes, label: bytes, weight: bytes) -> None:
        self.ends, self.indices = np.frombuffer(ends, np.int64), np.frombuffer(indices, np.int32)
        self.values, self.label, self.weight = np.frombuffer(values), np.frombuffer(label, np.int32), np.frombuffer(weight)
        self.row = np.repeat(np.arange(len(self.label)), np.diff(self.ends))

    def times(self, w: np.ndarray) -> np.ndarray:
        """X w' + intercepts; ``w``: classes x (features + 1)."""
        out = np.empty((len(self.label), len(w)))
        for c in range(len(w)):
            out[:, c] = np.bincount(self.row, self.values * w[c, self.indices], len(self.label)) + w[c, -1]
        return out

    def back(self, u: np.ndarray, features: int) -> np.ndarray:
        """u' X, with the column sums of u behind."""
        out = np.empty((u.shape[1], features + 1))
        for c in range(u.shape[1]):
            out[c, :-1] = np.bincount(self.indices, self.values * u[self.row, c], features)
            out[c, -1] = u[:, c].sum()
        return out


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def loss_and_gradient(block: Block, w: np.ndarray) -> tuple[float, np.ndarray]:
    z = block.times(w)
    top = z.max(axis=1)
    own = z[np.arange(len(z)), block.label]
    loss = float((block.weight * (top + np.log(np.exp(z - top[:, None]).sum(axis=1)) - own)).sum())
    u = softmax(z)
    u[np.arange(len(z)), block.label] -= 1.0
    return loss, block.back(u * block.weight[:, None], w.shape[1] - 1)


def hessian_product(block: Block, w: np.ndarray, direction: np.ndarray) -> np.ndarray:
    p, z = softmax(block.times(w)), block.times(direction)
    u = block.weight[:, None] * p * (z - (p * z).sum(axis=1, keepdims=True))
    return block.back(u, w.shape[1] - 1)


def _summed(blocks: DataFrame, size: int, parts: int, one: Callable[[Block], tuple[float, np.ndarray]]) -> tuple[float, np.ndarray]:
    """Sum of ``one`` over all blocks: added up per task, then per range."""
    edges = np.linspace(0, size, parts + 1).astype(np.int64)

    def of_task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, loss = np.zeros(size), 0.0
        for b in it:
            for k in range(b.num_rows):
                part, vector = one(Block(*[b.column(c)[k].as_buffer() for c in range(1, 6)]))
                loss += part
                total += vector.ravel()
        bodies = [total[lo:hi].tobytes() for lo, hi in zip(edges[:-1], edges[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(parts), pa.int32()), pa.array([loss, *[0.0] * (parts - 1)]), pa.array(bodies, pa.binary())], ["part", "loss", "body"])

    def of_range(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for b in it:
            for part, loss, body in zip(*[c.to_pylist() for c in b.columns], strict=True):
                mine = held.setdefault(part, [0.0, np.zeros(int(edges[part + 1] - edges[part]))])
                mine[0] += loss
                mine[1] += np.frombuffer(body)
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(held, pa.int32()), pa.array([x[0] for x in held.values()]), pa.array([x[1].tobytes() for x in held.values()], pa.binary())],
                ["part", "loss", "body"],
            )

    schema = "part int, loss double, body binary"
    got = blocks.mapInArrow(of_task, schema).repartition(parts, "part").mapInArrow(of_range, schema).toArrow().sort_by("part")
    return float(np.asarray(got["loss"]).sum()), np.concatenate([np.frombuffer(x.as_buffer()) for x in got["body"]])


def fit_multinomial(
    rows: DataFrame, classes: int, features: int, l2: float, tolerance: float = 1e-5, max_steps: int = 50, max_products: int = 60
) -> Fit:
    """Fit on ``features, label, weight``; stops where the gradient's norm is
    at most ``tolerance`` x the sum of weights.  The forcing term shrinks with the
    gradient, so early steps are cheap and late ones accurate; a step is halved
    until the objective falls enough."""
    spark = rows.sparkSession
    parts = spark.sparkContext.defaultParallelism
    blocks = pack_rows(rows, parts).persist()
    shape = (classes, features + 1)
    size = classes * (features + 1)
    penalty = np.full(shape, l2)
    penalty[:, -1] = 0.0
    products = 0

    def shared(value: np.ndarray):
        return spark.sparkContext.broadcast(value)

    def evaluate(w: np.ndarray) -> tuple[float, np.ndarray]:
        at = shared(w)
        loss, g = _summed(blocks, size, parts, lambda b: loss_and_gradient(b, at.value))
        at.unpersist()
        return loss + 0.5 * float((penalty * w * w).sum()), g.reshape(shape) + penalty * w

    def product(at, direction: np.ndarray) -> np.ndarray:
        nonlocal products
        products += 1
        along = shared(direction)
        _, out = _summed(blocks, size, parts, lambda b: (0.0, hessian_product(b, at.value, along.value)))
        along.unpersist()
        return out.reshape(shape) + penalty * direction

    try:
        total = rows.agg(F.sum("weight")).first()[0] or 0.0
        w = np.zeros(shape)
        objective, g = evaluate(w)
        first = norm = float(np.linalg.norm(g))
        steps = 0
        while norm > tolerance * total and steps < max_steps:
            steps += 1
            at = shared(w)
            # conjugate gradients on H d = -g
            d, r = np.zeros(shape), -g
            p, rr = r.copy(), float((r * r).sum())
            goal = min(0.1, (norm / first) ** 0.5) * norm
            for _ in range(max_products):
                hp = product(at, p)
                curve = float((p * hp).sum())
                if curve <= 1e-12 * float((p * p).sum()):
                    break
                length = rr / curve
                d += length * p
                r = r - length * hp
                left = float((r * r).sum())
                if left**0.5 <= goal:
                    break
                p, rr = r + (left / rr) * p, left
            at.unpersist()
            slope, scale = float((g * d).sum()), 1.0
            while True:
                tried, moved = evaluate(w + scale * d)
                if tried <= objective + 1e-4 * scale * slope or scale < 1e-6:
                    break
                scale /= 2
            if tried >= objective:  # at the precision of the sum
                break
            w, objective, g = w + scale * d, tried, moved
            norm = float(np.linalg.norm(g))
    finally:
        blocks.unpersist()
    return Fit(w[:, :-1], w[:, -1] - w[:, -1].mean(), objective, norm, steps, products)


def _whole(x: np.ndarray) -> np.ndarray:
    """With the last class, which is minus the others' sum."""
    return np.vstack((x, -x.sum(axis=0)))


def fit_by_rows(
    gram: Callable[[np.ndarray], np.ndarray], label: np.ndarray, weight: np.ndarray, classes: int, l2: float,
    tolerance: float = 1e-5, max_steps: int = 50, max_products: int = 60,
) -> RowFit:
    """The steps of :func:`fit_multinomial` with every vector of features kept as
    its factors by row (the gradient ``U' X + l2 A' X`` has the factors
    ``U + l2 A``).  ``gram`` multiplies rows x classes by ``X X'``, once per
    conjugate-gradient iteration and once per step; a trial of the line search
    takes none.

    The factors of a row sum to zero over the classes, so the last class is
    neither kept nor multiplied.  Nine such vectors live at a time; what is made
    of them on the way is made for some thousand rows at once."""
    n = len(label)
    if not n or classes < 2:
        return RowFit(np.zeros((n, classes)), np.zeros(classes), 0.0, 0.0, 0, 0)
    cuts = [slice(k, min(k + SLICE_ROWS, n)) for k in range(0, n, SLICE_ROWS)]
    total = float(weight.sum())
    products = 0
    a, ka, d, kd, r, p, kp, hp = (np.zeros((classes - 1, n)) for _ in range(8))
    free, d_free = np.zeros(classes), np.zeros(classes)

    def multiplied(m: np.ndarray) -> np.ndarray:
        nonlocal products
        products += 1
        return gram(m.T).T

    def inner(x: np.ndarray, y: np.ndarray) -> float:
        return sum(float((_whole(x[:, c]) * _whole(y[:, c])).sum()) for c in cuts)

    def add(held: np.ndarray, step: float, other: np.ndarray) -> None:
        for c in cuts:
            held[:, c] += step * other[:, c]

    def chances(c: slice) -> np.ndarray:
        return softmax((_whole(ka[:, c]) + free[:, None]).T).T

    def objective_at(scale: float) -> float:
        """Where ``scale`` times the direction is added."""
        out = 0.0
        for c in cuts:
            k = _whole(ka[:, c] + scale * kd[:, c])
            z = k + (free + scale * d_free)[:, None]
            top = z.max(axis=0)
            out += float((weight[c] * (top + np.log(np.exp(z - top).sum(axis=0)) - z[label[c], np.arange(len(top))])).sum())
            out += 0.5 * l2 * float((_whole(a[:, c] + scale * d[:, c]) * k).sum())
        return out

    def descent(into: np.ndarray) -> np.ndarray:
        """Minus the gradient's factors; returns those of the intercepts."""
        of_free = np.zeros(classes)
        for c in cuts:
            u = chances(c)
            u[label[c], np.arange(u.shape[1])] -= 1.0
            u *= weight[c]
            of_free -= u.sum(axis=1)
            into[:, c] = -(u[:-1] + l2 * a[:, c])
        return of_free

    def curved() -> np.ndarray:
        """The Hessian times ``p`` into ``hp``; returns the part of the intercepts."""
        of_free = np.zeros(classes)
        for c in cuts:
            chance, z = chances(c), _whole(kp[:, c]) + p_free[:, None]
            v = weight[c] * chance * (z - (chance * z).sum(axis=0))
            of_free += v.sum(axis=1)
            hp[:, c] = v[:-1] + l2 * p[:, c]
        return of_free

    objective, first, norm, steps = objective_at(0.0), 0.0, 0.0, 0
    while True:
        r_free = descent(r)
        kr = multiplied(r)
        rr = max(0.0, inner(r, kr) + float((r_free * r_free).sum()))
        norm = rr**0.5
        first = first or norm
        if norm <= tolerance * total or steps == max_steps:
            break
        steps += 1
        # conjugate gradients on H d = -g
        for held in (d, kd, d_free):
            held[...] = 0.0
        p[...], kp[...], p_free = r, kr, r_free.copy()
        goal = min(0.1, (norm / first) ** 0.5) * norm
        for _ in range(max_products):
            h_free = curved()
            curve = inner(kp, hp) + float((p_free * h_free).sum())
            if curve <= 1e-12 * (inner(p, kp) + float((p_free * p_free).sum())):
                break
            length = rr / curve
            add(d, length, p)
            add(kd, length, kp)
            d_free += length * p_free
            add(kr, -length, multiplied(hp))
            add(r, -length, hp)
            r_free -= length * h_free
            left = max(0.0, inner(r, kr) + float((r_free * r_free).sum()))
            if left**0.5 <= goal:
                break
            for held, rest in ((p, r), (kp, kr), (p_free, r_free)):
                held *= left / rr
                held += rest
            rr = left
        start_free = descent(p)  # the step's first residual again; X X' is symmetric
        falls, scale = -(inner(p, kd) + float((start_free * d_free).sum())), 1.0
        while True:
            tried = objective_at(scale)
            if tried <= objective + 1e-4 * scale * falls or scale < 1e-6:
                break
            scale /= 2
        if tried >= objective:  # at the precision of the sum
            break
        add(a, scale, d)
        add(ka, scale, kd)
        free += scale * d_free
        objective = tried
    return RowFit(_whole(a).T, free - free.mean(), objective, norm, steps, products)
