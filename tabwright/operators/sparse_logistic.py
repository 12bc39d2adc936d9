"""Logistic regression on sparse vectors of so many places that the driver cannot hold thirty vectors of them, as MLlib does.

The steps are MLlib's: L-BFGS with ten kept steps, a line search for the strong Wolfe conditions and the same ends, over places
that are scaled to variance 1 and centred, with a penalty on the coefficients as they are and none on the intercepts. A pass hands
the coefficients to the tasks, which add up the gradient of their rows by blocks of places; Spark adds up the tasks' blocks. Equal
rows add up first, and rows lie in the order of their places, so a task meets few blocks of the first wide column.

The driver keeps its vectors in files without a name and reads them in slices; what it holds whole is one vector of coefficients
and one gradient while they travel, and the model.
"""

from __future__ import annotations

import math
import os
import tempfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.stage import materialise
from tabwright.operators.sparse_trees import _places

#: Numbers that the driver reads of a vector at once.
SLICE = 1 << 18
#: Numbers of a gradient that travel as one row.
BLOCK = 1 << 15
#: Steps that tell the curvature, as MLlib keeps them.
KEPT_STEPS = 10
#: MLlib's tolerance, values that are looked back at, and trials of a line search.
TOLERANCE, LOOK_BACK, TRIALS = 1e-6, 20, 10


class Vector:
    """``n`` numbers in a file of the driver that has no name and goes with this object."""

    def __init__(self, n: int):
        self.n = n
        self._file = tempfile.TemporaryFile(prefix="vector-")
        os.ftruncate(self._file.fileno(), 8 * n)

    def read(self, at: int, n: int) -> np.ndarray:
        return np.frombuffer(os.pread(self._file.fileno(), 8 * n, 8 * at))

    def write(self, at: int, numbers: np.ndarray) -> None:
        data = np.ascontiguousarray(numbers, float).data.cast("B")
        if os.pwrite(self._file.fileno(), data, 8 * at) != len(data):
            raise OSError("no room for a vector of coefficients")


def _slices(n: int, step: int) -> Iterator[tuple[int, int]]:
    return ((at, min(step, n - at)) for at in range(0, n, step))


def _products(vectors: list[Vector], step: int = SLICE) -> np.ndarray:
    """The inner products of all pairs."""
    out = np.zeros((len(vectors), len(vectors)))
    for at, n in _slices(vectors[0].n, step):
        some = np.stack([v.read(at, n) for v in vectors])
        out += some @ some.T
    return out


def _combine(into: Vector, shares: list[float], vectors: list[Vector], step: int = SLICE) -> None:
    for at, n in _slices(into.n, step):
        into.write(at, sum(s * v.read(at, n) for s, v in zip(shares, vectors, strict=True)))


class _Stuck(Exception):
    """No step from here with the curvature that is kept."""


def _direction(products: np.ndarray, kept: int) -> np.ndarray:
    """The shares of ``kept`` steps, newest first, of their changes of the gradient and of the gradient in the L-BFGS direction."""
    shares, weights = np.zeros(2 * kept + 1), []
    shares[-1] = 1.0
    scale = 1.0
    if kept:
        scale = products[0, kept] / products[kept, kept]
        if not products[0, kept] >= 0:
            raise _Stuck
    for i in range(kept):
        weights.append(products[i] @ shares / products[i, kept + i])
        if math.isnan(weights[i]):
            raise _Stuck
        shares[kept + i] -= weights[i]
    shares *= scale
    for i in reversed(range(kept)):
        shares[i] += weights[i] - products[kept + i] @ shares / products[i, kept + i]
    return -shares


def _between(low: tuple[float, float, float], high: tuple[float, float, float]) -> float:
    """The least value of the cubic through two points (place, value, slope), kept off the ends."""
    (l, l_value, l_slope), (r, r_value, r_slope) = low, high
    d1 = l_slope + r_slope - 3 * (l_value - r_value) / (l - r)
    with np.errstate(invalid="ignore"):
        d2 = float(np.sqrt(d1 * d1 - l_slope * r_slope))
    bottom = r_slope - l_slope + 2 * d2
    t = r - (r - l) * (r_slope + d2 - d1) / bottom if bottom else math.nan
    least, most = l + 0.1 * (r - l), l + 0.9 * (r - l)
    return least if t < least else most if t > most else t


def _step(at: Callable[[float], tuple[float, float, float]], value: float, slope: float, first: float) -> tuple[float, float]:
    """A step for the strong Wolfe conditions and the value there; ``at`` was called with it last."""
    if slope > 0:
        raise _Stuck

    def enough(c: tuple[float, float, float]) -> bool:
        return abs(c[2]) <= 0.9 * abs(slope)

    def too_high(c: tuple[float, float, float]) -> bool:
        return c[1] > value + 1e-4 * c[0] * slope

    def zoom(low: tuple[float, float, float], high: tuple[float, float, float]) -> tuple[float, float]:
        for _ in range(TRIALS):
            c = at(_between(high, low) if low[0] > high[0] else _between(low, high))
            if too_high(c) or c[1] >= low[1]:
                high = c
                continue
            if enough(c):
                return c[0], c[1]
            if c[2] * (high[0] - low[0]) >= 0:
                high = low
            low = c
        raise _Stuck

    t, low = first, (0.0, value, slope)
    for i in range(TRIALS):
        c = at(t)
        if not math.isfinite(c[1]):
            t /= 2
            continue
        if too_high(c) or (c[1] >= low[1] and i > 0):
            return zoom(low, c)
        if enough(c):
            return c[0], c[1]
        if c[2] >= 0:
            return zoom(c, low)
        low, t = c, t * 1.5
    raise _Stuck


def minimise(evaluate: Callable[[Vector, Vector], float], x: Vector, most: int) -> Vector:
    """Where L-BFGS comes to from ``x`` in at most ``most`` steps; ``evaluate`` writes a gradient and returns the value."""
    gradient, direction, next_x, next_gradient = (Vector(x.n) for _ in range(4))
    value = first = evaluate(x, gradient)
    values, steps, changes = [math.inf], [], []
    done, stuck = 0, False
    while True:
        found = _products([*steps, *changes, gradient])
        norm = math.sqrt(found[-1, -1])
        settled = len(values) >= 2 and abs(value - max(values)) <= TOLERANCE * first
        if done >= most or settled or norm <= max(TOLERANCE * value, 1e-8):
            return x
        try:
            shares = _direction(found, len(steps))
            _combine(direction, shares.tolist(), [*steps, *changes, gradient])
            length = math.sqrt(max(shares @ found @ shares, 0.0))

            def at(t: float) -> tuple[float, float, float]:
                _combine(next_x, [1.0, t], [x, direction])
                there = evaluate(next_x, next_gradient)
                return t, there, float(_products([next_gradient, direction])[0, 1])

            t, there = _step(at, value, float(found[-1] @ shares), 1.0 if done else 1.0 / length)
            if t * norm < 1e-10:
                raise _Stuck
        except _Stuck:
            if stuck:
                return x
            stuck, steps, changes = True, [], []
            continue
        if len(steps) == KEPT_STEPS:  # the oldest make room
            step, change = steps.pop(), changes.pop()
        else:
            step, change = Vector(x.n), Vector(x.n)
        _combine(step, [1.0, -1.0], [next_x, x])
        _combine(change, [1.0, -1.0], [next_gradient, gradient])
        steps, changes = [step, *steps], [change, *changes]
        x, next_x, gradient, next_gradient, value = next_x, x, next_gradient, gradient, there
        values = [*values, value][-LOOK_BACK:]
        done, stuck = done + 1, False


class Chunk:
    """Rows that travel together: their distinct places, and the row, the place among these and the value of each cell."""

    def __init__(self, places: np.ndarray, place: np.ndarray, lengths: np.ndarray, y: np.ndarray, value: np.ndarray, w: np.ndarray, squares: float):
        self.places, self.place, self.y, self.value, self.w, self.squares = places, place, y, value, w, squares
        self.row = np.repeat(np.arange(len(lengths)), lengths)

    @staticmethod
    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
        kinds = [np.int32] * 4 + [np.float64] * 2
        for batch in batches:
            for i in range(batch.num_rows):
                yield Chunk(*(np.frombuffer(c[i].as_buffer(), kind) for c, kind in zip(batch.columns, kinds)), batch.column(6)[i].as_py())

    @staticmethod
    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        cells = batch.column(0).flatten().to_numpy(zero_copy_only=False)
        places, place = np.unique(cells, return_inverse=True)
        lengths = pc.list_value_length(batch.column(0)).to_numpy(zero_copy_only=False)
        values, y, w = batch.column(1).flatten(), batch.column(2), batch.column(3)
        packed = [places.astype(np.int32), place.astype(np.int32), lengths.astype(np.int32), y.to_numpy().astype(np.int32), values.to_numpy(zero_copy_only=False).astype(float), w.to_numpy().astype(float)]
        columns = [pa.array([a.tobytes()], pa.binary()) for a in packed]
        squares = pa.array([float(batch.column(4).to_numpy().sum())])
        return pa.RecordBatch.from_arrays([*columns, squares], names=["places", "place", "lengths", "y", "values", "w", "squares"])


CHUNK = "places binary, place binary, lengths binary, y binary, values binary, w binary, squares double"


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (Chunk.of(b) for b in batches if b.num_rows)


class _Sums:
    """Sums by place of a few columns, in blocks of places; block -1 holds a few numbers that belong to no place."""

    def __init__(self, columns: int, others: int):
        self.columns, self.width = columns, max(BLOCK // columns, 1)
        self.blocks: dict[int, np.ndarray] = {-1: np.zeros(others)}

    def add(self, chunk: Chunk, cells: list[np.ndarray]) -> None:
        sums = np.stack([np.bincount(chunk.place, c, minlength=len(chunk.places)) for c in cells], axis=1)
        ends = np.searchsorted(chunk.places // self.width, np.unique(chunk.places // self.width), side="right").tolist()
        for begin, end in zip([0, *ends], ends):
            block, at = divmod(chunk.places[begin:end], self.width)
            kept = self.blocks.setdefault(int(block[0]), np.zeros((self.width, self.columns)))
            kept[at] += sums[begin:end]

    def rows(self) -> Iterator[pa.RecordBatch]:
        for block, sums in self.blocks.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([sums.tobytes()], pa.binary())], names=["block", "sums"])


def _added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    whole: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, sums in zip(batch.column(0).to_pylist(), batch.column(1)):
            new = np.frombuffer(sums.as_buffer())
            whole[block] = whole[block] + new if block in whole else new.copy()
    for block, sums in whole.items():
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([sums.tobytes()], pa.binary())], names=["block", "sums"])


@dataclass
class _Fit:
    """The table of chunks and what the driver knows of its places."""

    rows: DataFrame
    width: int
    n_classes: int
    #: Strength of the penalty.
    strength: float

    def __post_init__(self):
        self.sets = 1 if self.n_classes == 2 else self.n_classes
        self.step = max(SLICE // self.sets, 1)
        self._scale()

    def _collected(self, job: Callable, columns: int, into: Callable[[int, np.ndarray], None]) -> np.ndarray:
        """Hands the sums of each block to ``into``, by their first place; what belongs to no place is returned."""
        most = max(BLOCK // columns, 1)
        parts = max(1, min(-(-self.width // most), self.rows.sparkSession.sparkContext.defaultParallelism))
        kind = "block int, sums binary"
        found = self.rows.mapInArrow(job, kind).repartition(parts, "block").mapInArrow(_added_up, kind).toArrow()  # one row per block of places
        others = np.zeros(0)
        for batch in found.to_batches():
            for block, sums in zip(batch.column(0).to_pylist(), batch.column(1)):
                numbers = np.frombuffer(sums.as_buffer())
                if block < 0:
                    others = numbers
                else:
                    into(block * most, numbers.reshape(-1, columns)[: self.width - block * most])
        return others

    def _scale(self) -> None:
        """What scales each place to variance 1 (0 where it does not vary) and its mean then; sums of weights by class."""
        n_classes = self.n_classes

        def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = _Sums(2, 1 + n_classes)
            for chunk in Chunk.within(batches):
                w = chunk.w[chunk.row] * chunk.value
                sums.add(chunk, [w, w * chunk.value])
                sums.blocks[-1] += np.append(chunk.squares, np.bincount(chunk.y, chunk.w, minlength=n_classes))
            yield from sums.rows()

        self.inverse, self.mean = Vector(self.width), Vector(self.width)
        both = Vector(2 * self.width)
        others = self._collected(job, 2, lambda at, sums: both.write(2 * at, sums))
        self.by_class = others[1:]
        self.weight = self.by_class.sum()
        for at, n in _slices(self.width, self.step):
            total, squares = both.read(2 * at, 2 * n).reshape(n, 2).T
            # of places that are the same in all rows, rounding may leave a little
            varied = squares - total * total / self.weight
            varied = np.where(varied > 1e-14 * squares, varied, 0.0) / (self.weight - others[0] / self.weight)
            inverse = np.where(varied > 0, 1 / np.sqrt(np.where(varied > 0, varied, 1.0)), 0.0)
            self.inverse.write(at, inverse)
            self.mean.write(at, total / self.weight * inverse)

    def start(self) -> Vector:
        """No coefficients, and intercepts by the classes' weights."""
        x = Vector((self.width + 1) * self.sets)
        logs = np.log1p(self.by_class)
        first = [math.log(self.by_class[1] / self.by_class[0])] if self.sets == 1 else logs - logs.mean()
        x.write(self.width * self.sets, np.array(first))
        return x

    def plain(self, x: Vector) -> tuple[np.ndarray, np.ndarray, float]:
        """Coefficients by place and intercepts for the values as they are, and the sum of the coefficients' squares."""
        k = self.sets
        out, shift, squares = np.empty(self.width * k), np.zeros(k), 0.0
        for at, n in _slices(self.width, self.step):
            here = x.read(at * k, n * k).reshape(n, k) * self.inverse.read(at, n)[:, None]
            shift += self.mean.read(at, n) @ x.read(at * k, n * k).reshape(n, k)
            squares += float((here * here).sum())
            out[at * k : (at + n) * k] = here.ravel()
        return out, x.read(self.width * k, k) - shift, squares

    def evaluate(self, x: Vector, gradient: Vector) -> float:
        """The mean loss with its penalty; writes its gradient."""
        k = self.sets
        weights, intercepts, squares = self.plain(x)
        sent = self.rows.sparkSession.sparkContext.broadcast(weights)
        del weights
        for at, n in _slices(gradient.n, self.step):
            gradient.write(at, np.zeros(n))
        try:
            others = self._collected(_gradient(sent, intercepts, k), k, lambda at, sums: gradient.write(at * k, sums))
        finally:
            sent.destroy()
        loss, over = others[0] / self.weight, others[1:] / self.weight
        for at, n in _slices(self.width, self.step):
            inverse, mean = self.inverse.read(at, n)[:, None], self.mean.read(at, n)[:, None]
            found = gradient.read(at * k, n * k).reshape(n, k) * inverse / self.weight - over * mean
            gradient.write(at * k, found + self.strength * x.read(at * k, n * k).reshape(n, k) * inverse * inverse)
        gradient.write(self.width * k, over)
        return float(loss + 0.5 * self.strength * squares)


def _gradient(sent: Broadcast, intercepts: np.ndarray, k: int) -> Callable:
    """Sums of the loss, of its derivatives by intercept, and by place of its derivatives by coefficient."""

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = sent.value.reshape(-1, k)
        sums = _Sums(k, 1 + k)
        for chunk in Chunk.within(batches):
            own, n = weights[chunk.places], len(chunk.y)
            margins = np.stack([np.bincount(chunk.row, own[chunk.place, m] * chunk.value, minlength=n) for m in range(k)], axis=1) + intercepts
            if k == 1:
                away = np.where(chunk.y == 1, -margins[:, 0], margins[:, 0])
                loss = np.logaddexp(0.0, away)
                slope = np.where(chunk.y == 1, -1.0, 1.0) * np.exp(away - loss)
                slopes = (slope * chunk.w)[:, None]
            else:
                above = margins - margins.max(axis=1, keepdims=True)
                whole = np.log(np.exp(above).sum(axis=1))
                loss = whole - above[np.arange(n), chunk.y]
                slopes = np.exp(above - whole[:, None])
                slopes[np.arange(n), chunk.y] -= 1.0
                slopes *= chunk.w[:, None]
            sums.add(chunk, [slopes[chunk.row, m] * chunk.value for m in range(k)])
            sums.blocks[-1] += np.append(loss @ chunk.w, slopes.sum(axis=0))
        yield from sums.rows()

    return job


def _or_error(good: Column, value: Column, message: str) -> Column:
    return F.when(good, value).otherwise(F.raise_error(F.lit(message)).cast("double"))


def _rows(data: DataFrame, weight: str | None) -> DataFrame:
    """Equal rows once, with their weights, in chunks by the order of their places; written once."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    if weight:
        w = _or_error(w.isNotNull() & ~F.isnan(w) & (w >= 0) & (w < math.inf), w, "Weights MUST NOT be Null, NaN, Negative or Infinity")
    y = _or_error(F.col("__y").isNotNull(), F.col("__y"), "Labels MUST NOT be Null")
    places, values = _places(F.col("__x"))
    usable = F.forall(values, lambda v: ~F.isnan(v) & (F.abs(v) < math.inf))
    y = _or_error(F.coalesce(usable, F.lit(False)), y, "Vectors MUST NOT be Null, NaN or Infinity")
    rows = data.select(places.alias("places"), values.alias("values"), y.cast("int").alias("y"), w.alias("w"))
    equal = rows.groupBy("places", "values", "y").agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("w")).alias("squares"))
    ordered = equal.repartitionByRange("places").sortWithinPartitions("places")
    return materialise(ordered.mapInArrow(_chunked, CHUNK))


def _model(spark: SparkSession, like: LogisticRegression, n_classes: int, weights: np.ndarray, intercepts: np.ndarray) -> LogisticRegressionModel:
    """MLlib's model; its coefficients are handed over in slices."""
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    k = len(intercepts)
    numbers, width = sc._gateway.new_array(jvm.double, len(weights)), len(weights) // k
    for i, own in enumerate(weights.reshape(-1, k).T):  # row by row, as MLlib has them
        for at, n in _slices(width, SLICE):
            part = jvm.java.nio.ByteBuffer.wrap(bytearray(own[at : at + n].astype("<f8").tobytes()))
            part.order(jvm.java.nio.ByteOrder.LITTLE_ENDIAN).asDoubleBuffer().get(numbers, i * width + at, n)
    linalg = jvm.org.apache.spark.ml.linalg
    matrix = linalg.DenseMatrix(k, width, numbers, True)
    free = sc._gateway.new_array(jvm.double, k)
    for i, x in enumerate(intercepts.tolist()):
        free[i] = x
    made = jvm.org.apache.spark.ml.classification.LogisticRegressionModel(like.uid, matrix, linalg.DenseVector(free), n_classes, k > 1)
    return like._copyValues(LogisticRegressionModel(made))


def fit_sparse_logistic(data: DataFrame, like: LogisticRegression, width: int, n_classes: int, weight: str | None = None) -> LogisticRegressionModel:
    """Fit on a table with ``__x`` (vector of ``width`` places), ``__y`` (class number) and the weight column, if any.

    ``like`` has MLlib's parameters: maxIter, regParam. A missing class, weight or number is an error, as it is there.
    """
    fit = _Fit(_rows(data, weight), width, n_classes, like.getRegParam())
    if np.count_nonzero(fit.by_class) == 1:
        return like.fit(data)  # one class has all the weight: nothing is minimised
    weights, intercepts, _ = fit.plain(minimise(fit.evaluate, fit.start(), like.getMaxIter()))
    if len(intercepts) > 1:
        intercepts = intercepts - intercepts.mean()
    return _model(data.sparkSession, like, n_classes, weights, intercepts)
