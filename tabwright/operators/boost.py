"""Second-order boosting for two or more classes, grown level by level as grouped sums.

Features are cut into bins once, at quantiles; the rows travel in blocks, as one byte per feature. Every round grows a tree per class
(one tree for two classes) on the gradients and Hessians of the log loss. A level of all these trees is one pass: each
task adds up gradients and Hessians per (tree, node, feature, bin), Spark sums the tasks' cells, and the best cut of each
node is chosen in a window over its bins. Only cuts reach the driver. Margins are written every few rounds.

A node with sums G and H is worth T(G)**2 / (H + reg_lambda), its leaf holds -T(G) / (H + reg_lambda), where T moves G by
reg_alpha towards zero. Sums are whole numbers in units of 2**-30, so they do not depend on the order of addition.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.functions.stage import materialise

#: Bins of a feature; missing values have one of their own, the last.
BINS = 64
#: Rounds between two tables of margins.
KEPT_ROUNDS = 10
UNIT = float(1 << 30)
#: Rows travel in blocks whose bins take at most so many bytes.
BLOCK_BYTES = 1 << 18
#: What gains must exceed.
LEAST_GAIN = 1e-9
#: Numbers at or below this stand for a missing value.
MISSING_BELOW = -1e299


@dataclass
class Tree:
    """Nodes in heap order: the feature a node cuts (-1: leaf), the last bin on the left, where missing values go, and values."""

    feature: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray

    @staticmethod
    def root(depth: int) -> Tree:
        n = 1 << (depth + 1)
        return Tree(np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n, bool), np.zeros(n))

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row has come to so far (the root is 1)."""
        at = np.ones(len(bins), np.int64)
        rows = np.arange(len(bins))
        while True:
            inner = self.feature[at] >= 0
            if not inner.any():
                return at
            b = bins[rows[inner], self.feature[at[inner]]]
            here = at[inner]
            left = np.where(b == BINS, self.missing_left[here], b <= self.cut[here])
            at[inner] = 2 * here + ~left

    def margins(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.nodes(bins)]


def shares_of(margins: np.ndarray) -> np.ndarray:
    """Class probabilities; one column of margins means two classes."""
    if margins.shape[1] == 1:
        yes = 1 / (1 + np.exp(-margins[:, 0].clip(-700, 700)))
        return np.stack([1 - yes, yes], axis=1)
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def derivatives(margins: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients and Hessians of the weighted log loss by margin."""
    p = shares_of(margins)
    if margins.shape[1] == 1:
        p = p[:, 1:]
        goal = (y == 1).astype(float)[:, None]
    else:
        goal = (y[:, None] == np.arange(p.shape[1])).astype(float)
    return (p - goal) * w[:, None], np.maximum(p * (1 - p), 1e-16) * w[:, None]


@dataclass
class BoostedTrees:
    """Bin edges of every feature and, for each round, a tree per margin."""

    edges: list[list[float]]
    rounds: list[list[Tree]]
    n_margins: int
    gains: list[float]

    def binned(self, x: np.ndarray) -> np.ndarray:
        return binned(x, self.edges)

    def margins(self, bins: np.ndarray) -> np.ndarray:
        out = np.zeros((len(bins), self.n_margins))
        for trees in self.rounds:
            for m, tree in enumerate(trees):
                out[:, m] += tree.margins(bins)
        return out

    def shares(self, vector: Column) -> Column:
        """Class probabilities of a vector column, in Arrow batches."""
        model = self

        @F.arrow_udf("array<double>")
        def run(x: pa.Array) -> pa.Array:
            numbers = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), len(model.edges))
            shares = shares_of(model.margins(model.binned(numbers)))
            return pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * shares.shape[1], pa.array(shares.ravel()))

        return run(vector_to_array(vector))

    def importances(self) -> list[float]:
        """Each feature's share of all gains."""
        total = sum(self.gains)
        return [g / total if total else 0.0 for g in self.gains]

    def to_json(self) -> str:
        trees = [[[t.feature.tolist(), t.cut.tolist(), t.missing_left.tolist(), t.value.tolist()] for t in trees] for trees in self.rounds]
        return json.dumps({"edges": self.edges, "rounds": trees, "n_margins": self.n_margins, "gains": self.gains})

    @staticmethod
    def from_json(text: str) -> BoostedTrees:
        d = json.loads(text)
        rounds = [[Tree(np.array(f, np.int32), np.array(c, np.int32), np.array(m, bool), np.array(v, float)) for f, c, m, v in trees] for trees in d["rounds"]]
        return BoostedTrees(d["edges"], rounds, d["n_margins"], d["gains"])


def binned(x: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    """Bin of each number: how many edges are smaller; BINS where it is missing."""
    out = np.empty(x.shape, np.uint8)
    for j, cuts in enumerate(edges):
        out[:, j] = np.searchsorted(cuts, x[:, j], side="left")
    out[(x <= MISSING_BELOW) | np.isnan(x)] = BINS
    return out


def _edges(data: DataFrame, n: int) -> list[list[float]]:
    """At most BINS - 1 quantiles of each feature, from one aggregate; the largest value needs no edge."""
    known = [F.when(F.col("x")[j] > MISSING_BELOW, F.col("x")[j]) for j in range(n)]
    places = F.array(*[F.lit(i / BINS) for i in range(1, BINS)])
    row = data.agg(*[F.percentile_approx(v, places, F.lit(20_000)).alias(f"q{j}") for j, v in enumerate(known)], *[F.max(v).alias(f"m{j}") for j, v in enumerate(known)]).first()
    return [sorted({float(q) for q in row[f"q{j}"] or [] if q < row[f"m{j}"]}) for j in range(n)]


def _packed(bins: np.ndarray, y: np.ndarray, w: np.ndarray, draw: np.ndarray, margins: np.ndarray | None) -> pa.RecordBatch:
    """Blocks of at most BLOCK_BYTES of bins, one row each."""
    step = max(1, BLOCK_BYTES // max(bins.shape[1], 1))
    parts = [slice(at, at + step) for at in range(0, len(bins), step)]
    columns = [[np.ascontiguousarray(c[part]).tobytes() for part in parts] for c in (bins, y.astype(np.int32), w.astype(float), draw.astype(float))]
    columns.append([None if margins is None else np.ascontiguousarray(margins[part]).tobytes() for part in parts])
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], names=["bins", "y", "w", "draw", "margins"])


def _as_bins(edges: list[list[float]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            yield _packed(binned(x, edges), *(c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]), None)

    return run


def _arrays(batch: pa.RecordBatch, width: int, recent: list[list[Tree]], n_margins: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Bins, class, weight, draw and margins of each block of a batch; the margins by the written ones and the trees since then."""
    for i in range(batch.num_rows):
        bins, y, w, draw, written = (c[i].as_buffer() if c[i].is_valid else None for c in batch.columns)
        bins = np.frombuffer(bins, np.uint8).reshape(-1, width)
        y, w, draw = np.frombuffer(y, np.int32), np.frombuffer(w), np.frombuffer(draw)
        margins = np.zeros((len(bins), n_margins)) if written is None else np.frombuffer(written).reshape(-1, n_margins).copy()
        for trees in recent:
            for m, tree in enumerate(trees):
                margins[:, m] += tree.margins(bins)
        yield bins, y, w, draw, margins


def _histograms(width: int, recent: list[list[Tree]], growing: list[Tree], allowed: list[np.ndarray], level: int, share: float, n_round: int, seed: int):
    """Sums of gradients and Hessians per (tree, node, feature, bin) of a task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, slots = 1 << level, BINS + 1
        sums = [np.zeros((2, len(a), nodes * slots)) for a in allowed]
        for bins, y, w, draw, margins in itertools.chain.from_iterable(_arrays(b, width, recent, len(growing)) for b in batches):
            if share < 1:
                chosen = np.modf(draw * 2.0**20 + np.modf((n_round + 1) * 0.6180339887498949 + seed * 0.7548776662466927)[0])[0] < share
                bins, y, w, margins = bins[chosen], y[chosen], w[chosen], margins[chosen]
            g, h = derivatives(margins, y, w)
            for m, tree in enumerate(growing):
                at = tree.nodes(bins)
                open_ = at >= nodes  # rows whose node was not closed above
                place = (at[open_] - nodes) * slots
                for k, j in enumerate(allowed[m].tolist()):
                    cell = place + bins[open_, j]
                    sums[m][0, k] += np.bincount(cell, g[open_, m], minlength=nodes * slots)
                    sums[m][1, k] += np.bincount(cell, h[open_, m], minlength=nodes * slots)
        for m, both in enumerate(sums):
            k, cell = np.nonzero(both[1])
            if len(k):
                columns = [np.full(len(k), m), cell // slots + nodes, allowed[m][k], cell % slots]
                whole = [np.round(both[i][k, cell] * UNIT).astype(np.int64) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c.astype(np.int32)) for c in columns), *(pa.array(s) for s in whole)], names=["tree", "node", "feature", "bin", "g", "h"]
                )

    return run


def _worth(g: Column, h: Column, l1: float, l2: float) -> Column:
    shrunk = F.greatest(F.abs(g) - F.lit(l1), F.lit(0.0))
    return F.when(h + l2 > 0, shrunk * shrunk / (h + l2)).otherwise(F.lit(0.0))


def _cuts(cells: DataFrame, l1: float, l2: float, least_h: float) -> DataFrame:
    """Rows (tree, node, g, h, best): the node's sums and its best cut (gain, feature, bin, missing_left), if any gains."""
    sums = cells.groupBy("tree", "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    of_feature = W.partitionBy("tree", "node", "feature")  # at most BINS + 1 rows
    known = F.col("bin") < BINS
    upto = of_feature.orderBy("bin")
    both = {}
    for c in ("g", "h"):
        both[f"{c}_left"] = F.sum(F.when(known, F.col(c))).over(upto)
        both[f"{c}_all"] = F.sum(c).over(of_feature)
        both[f"{c}_missing"] = F.coalesce(F.sum(F.when(~known, F.col(c))).over(of_feature), F.lit(0))
    wide = sums.withColumns(both)
    real = {c: F.col(c) / F.lit(UNIT) for c in both}
    whole = _worth(real["g_all"], real["h_all"], l1, l2)
    options = []
    for missing_left in (False, True):  # without missing values both are the same cut, and the first wins
        g = real["g_left"] + (real["g_missing"] if missing_left else F.lit(0.0))
        h = real["h_left"] + (real["h_missing"] if missing_left else F.lit(0.0))
        gain = _worth(g, h, l1, l2) + _worth(real["g_all"] - g, real["h_all"] - h, l1, l2) - whole
        fits = known & (h >= least_h) & (real["h_all"] - h >= least_h) & (h > 0) & (real["h_all"] - h > 0) & (gain > LEAST_GAIN)
        options.append(F.when(fits, F.struct(gain.alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), F.lit(not missing_left).alias("r"))))
    best = F.max(F.greatest(*[F.coalesce(o, F.lit(None)) for o in options]))
    # sums of a node are the same in each of its features
    return wide.groupBy("tree", "node").agg(F.max("g_all").alias("g"), F.max("h_all").alias("h"), best.alias("best"))


def fit_boosted(data: DataFrame, n_classes: int, params: dict, seed: int, weight: str | None = None) -> BoostedTrees:
    """Fit on a table with ``__x`` (vector), ``__y`` (class number) and the weight column, if any.

    ``params``: n_estimators, max_depth, learning_rate, subsample, colsample_bytree, min_child_weight, reg_alpha, reg_lambda.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = data.select(vector_to_array("__x").alias("x"), F.col("__y").cast("int").alias("y"), w.alias("w"), F.rand(seed).alias("draw"))
    rows = materialise(rows)  # so that each row keeps its draw
    width = rows.select(F.size("x")).first()[0]
    edges = _edges(rows, width)
    schema = "bins binary, y binary, w binary, draw binary, margins binary"
    kept = materialise(rows.mapInArrow(_as_bins(edges), schema))
    n_margins = 1 if n_classes == 2 else n_classes
    model = BoostedTrees(edges, [], n_margins, [0.0] * width)
    depth, rate = int(params["max_depth"]), float(params["learning_rate"])
    l1, l2, least = float(params["reg_alpha"]), float(params["reg_lambda"]), float(params["min_child_weight"])
    columns = max(1, int(round(float(params["colsample_bytree"]) * width)))
    cell = "tree int, node int, feature int, bin int, g long, h long"
    recent: list[list[Tree]] = []
    for n_round in range(int(params["n_estimators"])):
        growing = [Tree.root(depth) for _ in range(n_margins)]
        allowed = [np.sort(np.random.default_rng([seed, n_round, m]).choice(width, columns, replace=False)) for m in range(n_margins)]
        for level in range(depth + 1):
            job = _histograms(width, recent, growing, allowed if level < depth else [a[:1] for a in allowed], level, float(params["subsample"]), n_round, seed)
            found = _cuts(kept.mapInArrow(job, cell), l1, l2, least).collect()  # a row for each open node
            if not _grow(found, growing, model, level < depth, rate, l1, l2):
                break
        model.rounds.append(growing)
        recent.append(growing)
        if len(recent) == KEPT_ROUNDS:
            kept, recent = materialise(kept.mapInArrow(_with_margins(width, recent, n_margins), schema)), []
    return model


def _grow(found: list, growing: list[Tree], model: BoostedTrees, may_cut: bool, rate: float, l1: float, l2: float) -> bool:
    """Give the nodes their values and cuts; whether any was cut."""
    cut = False
    for r in found:
        tree, g, h = growing[r.tree], r.g / UNIT, r.h / UNIT
        tree.value[r.node] = -np.sign(g) * max(abs(g) - l1, 0.0) / (h + l2) * rate if h + l2 > 0 else 0.0
        if may_cut and r.best is not None:
            cut = True
            tree.feature[r.node], tree.cut[r.node], tree.missing_left[r.node] = -r.best.f, -r.best.b, not r.best.r
            # a child that no drawn row reaches keeps its parent's value
            tree.value[2 * r.node] = tree.value[2 * r.node + 1] = tree.value[r.node]
            model.gains[-r.best.f] += r.best.gain
    return cut


def _with_margins(width: int, recent: list[list[Tree]], n_margins: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _arrays(batch, width, recent, n_margins):
                yield _packed(*block)

    return run
