"""Forests and second-order boosting on sparse vectors, grown level by level as grouped sums over the places that are not zero.

A row takes part in a level with the places where it is not zero: each task adds up the rows' sums per (tree, node, place, bin),
Spark adds up the tasks' cells, and the best cut of each node is chosen in a window over a place's bins. What a node's
rows hold at zero follows from the node's sums, which the cut above it left. Work and tables grow with the places that are not
zero, whatever the number of places. All trees of a forest, or of a round of boosting, grow at once. Only cuts reach the driver.

The sums of a row are one number per class (its weight, in a forest) or its gradient, a weight (or Hessian) and a count. A node is
worth the sum of T(g)**2 / (h + l2) over its numbers g, where T moves g by l1 towards zero: with classes this is the Gini index.
Sums are whole numbers in units of 2**-30, so they do not depend on the order of addition.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.functions.stage import materialise
from tabwright.operators.boost import BINS, KEPT_ROUNDS, LEAST_GAIN, MISSING_BELOW, UNIT, derivatives, shares_of

#: Steps through the places among which a node draws one; a step and an offset tell a node's share of the places.
STEPS = 1024
_GOLDEN, _WORD = 0x9E3779B97F4A7C15, (1 << 64) - 1
#: Chances that a row is drawn at most 0, 1, ... times with replacement.
_TIMES = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)])
#: How far a gain may come from rounding, as a share of the node's worth.
ROUNDING = 1e-15


def _mixed(x: np.ndarray, *salt: int) -> np.ndarray:
    """64 random bits for each of ``x`` (64-bit values) and the salt."""
    for s in (0, *salt):
        x = x + np.uint64((s + 1) * _GOLDEN & _WORD)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x = x ^ (x >> np.uint64(31))
    return x


def _uniform(draw: np.ndarray, *salt: int) -> np.ndarray:
    return (_mixed(np.ascontiguousarray(draw, float).view(np.uint64), *salt) >> np.uint64(11)) * 2.0**-53


class Rows:
    """Some rows: the row, the place and the value of everything that is not zero, by row and place."""

    def __init__(self, places: pa.Array, values: pa.Array, width: int):
        self.n, self.width = len(places), width
        self.row = np.repeat(np.arange(self.n), pc.list_value_length(places).fill_null(0).to_numpy(zero_copy_only=False))
        self.place = places.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        value = values.flatten().to_numpy(zero_copy_only=False)
        self.value = np.where(np.isnan(value), 10 * MISSING_BELOW, value)
        self.keys = self.row * width + self.place
        if np.any(self.keys[1:] < self.keys[:-1]):
            order = np.argsort(self.keys, kind="stable")
            self.row, self.place, self.value, self.keys = (a[order] for a in (self.row, self.place, self.value, self.keys))

    def at(self, row: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The value of each row at a place."""
        if not len(self.keys):
            return np.zeros(len(row))
        keys = row * self.width + place
        found = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[found] == keys, self.value[found], 0.0)


@dataclass
class Edges:
    """Bin edges of the places that hold more than zeros and one positive value; those have a single edge, at zero."""

    places: np.ndarray
    edges: list[np.ndarray]

    def _known(self, place: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if len(self.places):
            at = np.minimum(np.searchsorted(self.places, place), len(self.places) - 1)
            some = np.flatnonzero(self.places[at] == place)
            some = some[np.argsort(at[some], kind="stable")]
            for part in np.split(some, np.flatnonzero(np.diff(at[some])) + 1) if len(some) else []:
                yield part, self.edges[at[part[0]]]

    def bins(self, place: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many edges of its place are smaller than each value."""
        out = (value > 0).astype(np.int32)
        for part, edges in self._known(place):
            out[part] = np.searchsorted(edges, value[part], side="left")
        return out

    def zeros(self, place: np.ndarray) -> np.ndarray:
        """The bin of zero."""
        return self.bins(place, np.zeros(len(place)))

    def cut(self, place: int, bin_: int) -> float:
        at = np.searchsorted(self.places, place)
        return float(self.edges[at][bin_]) if at < len(self.places) and self.places[at] == place else 0.0


def _edges(rows: DataFrame) -> Edges:
    """At most BINS - 1 quantiles of a place's values that are not zero, with zero, the value below it and missing values apart."""
    cells = rows.select(F.explode(F.arrays_zip("places", "values")).alias("c")).select(F.col("c.places").alias("place"), F.nanvl("c.values", F.lit(10 * MISSING_BELOW)).alias("value")).where("value <> 0")
    many = cells.groupBy("place").agg(F.min("value").alias("least"), F.max("value").alias("most")).where("least < most OR least < 0").select("place")
    many = materialise(many)
    if many.isEmpty():
        return Edges(np.zeros(0, np.int64), [])
    known = F.when(F.col("value") > MISSING_BELOW, F.col("value"))
    at = F.array(*[F.lit(i / BINS) for i in range(1, BINS)])
    below = F.max(F.when(F.col("value") < 0, known))
    found = cells.join(many, "place").groupBy("place").agg(
        F.percentile_approx(known, at, F.lit(20_000)).alias("q"), F.max("value").alias("most"), below.alias("below"), F.min("value").alias("least")
    )  # a row for each place with several values
    out = {}
    for r in found.collect():
        cuts = {float(q) for q in r.q or []} | {0.0} | ({r.below} if r.below is not None else set()) | ({r.least} if r.least <= MISSING_BELOW else set())
        out[r.place] = np.array(sorted(c for c in cuts if c < max(r.most, 0.0)))
    places = sorted(out)
    return Edges(np.array(places, np.int64), [out[p] for p in places])


@dataclass
class Tree:
    """Nodes as they were made: the place a node cuts (-1: leaf), the largest value on the left, its left child (the right one is the next), values."""

    place: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    #: Nodes that may still be cut.
    open: np.ndarray | None = None

    def nodes(self, rows: Rows) -> np.ndarray:
        """The node that each row has come to (the root is 0)."""
        at, some = np.zeros(rows.n, np.int64), np.arange(rows.n)
        while len(some := some[self.place[at[some]] >= 0]):
            here = at[some]
            at[some] = self.left[here] + (rows.at(some, self.place[here]) > self.cut[here])
        return at

    def values(self, rows: Rows) -> np.ndarray:
        return self.value[self.nodes(rows)]


class _Growing:
    """A tree while it grows: lists of its nodes, and the sums of those that may still be cut."""

    def __init__(self, root: np.ndarray, value: Callable[[np.ndarray], list[float]], may_cut: Callable[[np.ndarray, int], bool]):
        self.place, self.cut, self.left, self.values, self.sums = [], [], [], [], {}
        self.value, self.may_cut, self.gain = value, may_cut, []
        self._add(root, 0)

    def _add(self, sums: np.ndarray, level: int) -> None:
        if self.may_cut(sums, level):
            self.sums[len(self.place)] = sums
        self.place.append(-1)
        self.cut.append(0.0)
        self.left.append(0)
        self.gain.append(0.0)
        self.values.append(self.value(sums))

    def split(self, node: int, place: int, cut: float, gain: float, sums: np.ndarray, left: np.ndarray, level: int) -> None:
        self.place[node], self.cut[node], self.left[node], self.gain[node] = place, cut, len(self.place), gain
        self._add(left, level)
        self._add(sums - left, level)

    def prune(self) -> None:
        """Undo cuts between leaves of the same class, as MLlib does; children come after their parents."""
        best = [int(np.argmax(v)) for v in self.values]
        for node in reversed(range(len(self.place))):
            left = self.left[node]
            if self.place[node] >= 0 and self.place[left] < 0 and self.place[left + 1] < 0 and best[left] == best[left + 1]:
                self.place[node] = -1

    def gains(self) -> dict[int, float]:
        out: dict[int, float] = {}
        for p, g in zip(self.place, self.gain, strict=True):
            if p >= 0:
                out[p] = out.get(p, 0.0) + g
        return out

    def tree(self) -> Tree:
        open_ = np.zeros(len(self.place), bool)
        open_[list(self.sums)] = True
        return Tree(np.array(self.place, np.int32), np.array(self.cut), np.array(self.left, np.int32), np.array(self.values), open_)


@dataclass
class SparseTrees:
    """A forest (one round, whose trees hold class shares) or rounds of a tree per margin."""

    votes: bool
    width: int
    rounds: list[list[Tree]]
    #: Share of all gains by place.
    gains: dict[int, float] = field(default_factory=dict)

    def margins(self, rows: Rows) -> np.ndarray:
        return np.stack([sum(trees[m].values(rows)[:, 0] for trees in self.rounds) for m in range(len(self.rounds[0]))], axis=1)

    def shares(self, vector: Column) -> Column:
        """Class probabilities of a vector column, in Arrow batches."""
        model = self

        @F.arrow_udf("array<double>")
        def run(places: pa.Array, values: pa.Array) -> pa.Array:
            rows = Rows(places, values, model.width)
            found = sum(t.values(rows) for t in model.rounds[0]) / len(model.rounds[0]) if model.votes else shares_of(model.margins(rows))
            return pa.ListArray.from_arrays(np.arange(rows.n + 1, dtype=np.int32) * found.shape[1], pa.array(found.ravel()))

        return run(*_places(vector))

    def importances(self) -> list[float]:
        return [self.gains.get(p, 0.0) for p in range(self.width)]

    def to_json(self) -> str:
        rounds = [[[t.place.tolist(), t.cut.tolist(), t.left.tolist(), t.value.tolist()] for t in trees] for trees in self.rounds]
        return json.dumps({"sparse": True, "votes": self.votes, "width": self.width, "rounds": rounds, "gains": list(self.gains.items())})

    @staticmethod
    def from_json(text: str) -> SparseTrees:
        d = json.loads(text)
        rounds = [[Tree(np.array(p, np.int32), np.array(c, float), np.array(at, np.int32), np.array(v, float)) for p, c, at, v in trees] for trees in d["rounds"]]
        return SparseTrees(d["votes"], d["width"], rounds, {int(p): g for p, g in d["gains"]})


def _places(vector: Column) -> tuple[Column, Column]:
    """Places and values of a vector column; nothing is filled with zeros."""
    plain = F.unwrap_udt(vector)
    dense = F.sequence(F.lit(0), F.size(plain["values"]) - 1)
    return F.when(plain["type"] == 1, dense).otherwise(plain["indices"]), plain["values"]


@dataclass
class _Pass:
    """What the tasks of a level need."""

    votes: bool
    width: int
    edges: Edges
    n_classes: int
    seed: int
    #: Share of the rows a round of boosting sees; whether a forest's trees draw rows with replacement.
    share: float
    bootstrap: bool
    #: Places that a node (or a tree) chooses from, and the steps to draw them with.
    n_places: int
    per_node: bool
    steps: np.ndarray
    n_round: int = 0
    recent: list[list[Tree]] = field(default_factory=list)
    growing: list[Tree] = field(default_factory=list)

    @property
    def names(self) -> list[str]:
        return [*[f"g{k}" for k in range(self.n_classes if self.votes else 1)], "h", "n"]

    def batch(self, batch: pa.RecordBatch) -> tuple[Rows, np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
        """Rows, class, weight, draw, and in boosting the margins by the written ones and the trees since then."""
        rows = Rows(batch.column(0), batch.column(1), self.width)
        y, w, draw = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4))
        if self.votes:
            return rows, y, w, draw, None
        n = 1 if self.n_classes == 2 else self.n_classes
        margins = batch.column(5).flatten().to_numpy(zero_copy_only=False).reshape(rows.n, n).copy()
        for trees in self.recent:
            for m, tree in enumerate(trees):
                margins[:, m] += tree.values(rows)[:, 0]
        return rows, y, w, draw, margins

    def sums(self, n_trees: int, y: np.ndarray, w: np.ndarray, draw: np.ndarray, margins: np.ndarray | None) -> Iterator[np.ndarray]:
        """The sums of each row, tree by tree."""
        if not self.votes:
            g, h = derivatives(margins, y, w)
            taken = _uniform(draw, self.seed, self.n_round) < self.share
            for m in range(n_trees):
                yield np.stack([np.round(g[:, m] * UNIT), np.round(h[:, m] * UNIT), np.ones(len(y))], axis=1).astype(np.int64) * taken[:, None]
            return
        for m in range(n_trees):
            times = np.searchsorted(_TIMES, _uniform(draw, self.seed, m), side="right") if self.bootstrap else np.ones(len(y), np.int64)
            weight = np.round(w * times * UNIT).astype(np.int64)
            out = np.zeros((len(y), self.n_classes + 2), np.int64)
            out[np.arange(len(y)), y] = weight
            out[:, -2], out[:, -1] = weight, times
            yield out

    def chosen(self, tree: int, node: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Whether a node may cut a place: exactly ``n_places`` of its places."""
        bits = _mixed((node if self.per_node else np.zeros_like(node)).astype(np.uint64), self.seed, self.n_round, tree)
        step = self.steps[(bits % np.uint64(len(self.steps))).astype(np.int64)]
        offset = ((bits >> np.uint64(32)) % np.uint64(self.width)).astype(np.int64)
        return (place * step + offset) % self.width < self.n_places

    def roots(self, n_trees: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                _, *of_row = self.batch(batch)
                whole = np.array([s.sum(axis=0) for s in self.sums(n_trees, *of_row)])
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(n_trees, dtype=np.int32)), *(pa.array(c) for c in whole.T.copy())], names=["tree", *self.names])

        return run

    def cells(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums per (tree, node, place, bin) of the places that are not zero, for nodes that may be cut."""
        for batch in batches:
            rows, *of_row = self.batch(batch)
            bins, zeros = self.edges.bins(rows.place, rows.value), self.edges.zeros(rows.place)
            for m, sums in enumerate(self.sums(len(self.growing), *of_row)):
                at = self.growing[m].nodes(rows)
                cell = np.flatnonzero((self.growing[m].open[at] & (sums[:, -1] > 0))[rows.row])
                if self.n_places < self.width:
                    cell = cell[self.chosen(m, at[rows.row[cell]], rows.place[cell])]
                if not len(cell):
                    continue
                cell = cell[np.lexsort((bins[cell], rows.place[cell], at[rows.row[cell]]))]
                keys = np.stack([at[rows.row[cell]], rows.place[cell], zeros[cell], bins[cell]])
                first = np.flatnonzero(np.append(True, np.any(keys[:, 1:] != keys[:, :-1], axis=0)))
                whole = np.add.reduceat(sums[rows.row[cell]], first, axis=0)
                columns = [np.full(len(first), m), *keys[:, first]]
                yield pa.RecordBatch.from_arrays([*(pa.array(c.astype(np.int32)) for c in columns), *(pa.array(c) for c in whole.T.copy())], names=["tree", "node", "place", "zero", "bin", *self.names])

    def with_margins(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = self.batch(batch)[4]
            ends = np.arange(len(margins) + 1, dtype=np.int32) * margins.shape[1]
            yield batch.set_column(5, "margins", pa.ListArray.from_arrays(ends, pa.array(margins.ravel())))


def _worth(sums: dict[str, Column], l1: float, l2: float) -> Column:
    """The sum of T(g)**2 / (h + l2)."""
    h = sums["h"] / F.lit(UNIT) + F.lit(l2)
    shrunk = [F.greatest(F.abs(g / F.lit(UNIT)) - F.lit(l1), F.lit(0.0)) for name, g in sums.items() if name.startswith("g")]
    squares = [s * s for s in shrunk]
    return F.when(h > 0, sum(squares[1:], squares[0]) / h).otherwise(F.lit(0.0))


def _cuts(cells: DataFrame, nodes: DataFrame, names: list[str], l1: float, l2: float, least_h: float, least_n: int) -> DataFrame:
    """Rows (tree, node, best): the best cut (gain, place, bin, sums on the left), if any gains.

    ``nodes`` holds the sums of the nodes. A row is a bin that some row of a node is in; the cuts after it and, above the bin of
    zero, before it are all that tell rows apart.
    """
    sums = cells.groupBy("tree", "node", "place", "zero", "bin").agg(*[F.sum(c).alias(c) for c in names])
    of_place = W.partitionBy("tree", "node", "place")  # at most as many rows as bins
    upto = of_place.orderBy("bin")
    wide = sums.withColumns({**{f"{c}_upto": F.sum(c).over(upto) for c in names}, **{f"{c}_some": F.sum(c).over(of_place) for c in names}})
    wide = wide.join(nodes.select("tree", "node", *[F.col(c).alias(f"{c}_all") for c in names]), ["tree", "node"])
    whole = {c: F.col(f"{c}_all") for c in names}
    rest = {c: F.col(f"{c}_all") - F.col(f"{c}_some") for c in names}
    after = {c: F.col(f"{c}_upto") + F.when(F.col("bin") >= F.col("zero"), rest[c]).otherwise(F.lit(0)) for c in names}
    before = {c: F.col(f"{c}_upto") - F.col(c) + rest[c] for c in names}
    options = []
    for left, bin_, possible in ((after, F.col("bin"), F.lit(True)), (before, F.col("bin") - 1, F.col("bin") > F.col("zero"))):
        right = {c: whole[c] - left[c] for c in names}
        worth = _worth(whole, l1, l2)
        gain = _worth(left, l1, l2) + _worth(right, l1, l2) - worth
        fits = [possible, gain > F.lit(LEAST_GAIN) + F.lit(ROUNDING) * worth]
        fits += [s for side in (left, right) for s in (side["n"] >= least_n, side["h"] > 0, side["h"] / F.lit(UNIT) >= F.lit(least_h))]
        good = fits[0]
        for f in fits[1:]:
            good = good & f
        made = F.struct(gain.alias("gain"), (-F.col("place")).alias("p"), (-bin_).alias("b"), F.array(*[left[c] for c in names]).alias("left"))
        options.append(F.when(good, made))
    return wide.groupBy("tree", "node").agg(F.max(F.greatest(*options)).alias("best")).where("best IS NOT NULL")


def _grow(rows: DataFrame, job: _Pass, n_trees: int, depth: int, value: Callable, l1: float, l2: float, least_h: float, least_n: int) -> tuple[list[Tree], list[dict[int, float]]]:
    """All trees of a round, level by level, and the gains of their places."""
    numbers = ", ".join(f"{c} long" for c in job.names)
    roots = rows.mapInArrow(job.roots(n_trees), f"tree int, {numbers}").groupBy("tree").agg(*[F.sum(c).alias(c) for c in job.names]).collect()  # a row a tree
    found = {r.tree: np.array([r[c] for c in job.names], np.int64) for r in roots}
    two = 2 * max(least_n, 1)

    def may_cut(sums: np.ndarray, level: int) -> bool:
        return level < depth and sums[-1] >= two and not (job.votes and sums[:-2].max() == sums[-2])

    none = np.zeros(len(job.names), np.int64)
    growing = [_Growing(found.get(m, none), value, may_cut) for m in range(n_trees)]
    for level in range(depth):
        open_ = [(m, node, *s.tolist()) for m, g in enumerate(growing) for node, s in g.sums.items()]
        if not open_:
            break
        job.growing = [g.tree() for g in growing]
        kinds = [("tree", pa.int32()), ("node", pa.int32()), *((c, pa.int64()) for c in job.names)]
        nodes = rows.sparkSession.createDataFrame(pa.table([pa.array(c, k) for c, (_, k) in zip(zip(*open_), kinds, strict=True)], names=[n for n, _ in kinds]))
        cells = rows.mapInArrow(job.cells, f"tree int, node int, place int, zero int, bin int, {numbers}")
        best = _cuts(cells, nodes, job.names, l1, l2, least_h, least_n).collect()  # a row for each node that is cut
        sums = [g.sums for g in growing]
        for g in growing:
            g.sums = {}
        for r in sorted(best, key=lambda r: (r.tree, r.node)):
            place, left = -r.best.p, np.array(r.best.left, np.int64)
            growing[r.tree].split(r.node, place, job.edges.cut(place, -r.best.b), r.best.gain, sums[r.tree][r.node], left, level + 1)
    for g in growing if job.votes else []:
        g.prune()
    return [g.tree() for g in growing], [g.gains() for g in growing]


def _prepared(data: DataFrame, weight: str | None, seed: int, n_margins: int) -> tuple[DataFrame, int]:
    """Places, values, class, weight, draw and margins of the rows, written once, and the number of places."""
    places, values = _places(F.col("__x"))
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    margins = F.array_repeat(F.lit(0.0), n_margins).alias("margins")
    size = F.coalesce(F.unwrap_udt("__x")["size"], F.size(values)).alias("size")
    rows = materialise(data.select(places.alias("places"), values.alias("values"), F.col("__y").cast("int").alias("y"), w.alias("w"), F.rand(seed).alias("draw"), margins, size))
    return rows.drop("size"), rows.select("size").first()[0]


def _pass(votes: bool, rows: DataFrame, width: int, n_classes: int, seed: int, share: float, bootstrap: bool, n_places: int, per_node: bool) -> _Pass:
    rng, steps = np.random.default_rng(seed), []
    while len(steps) < STEPS:
        steps += [int(s) for s in rng.integers(1, max(width, 2), STEPS) if math.gcd(int(s), width) == 1]
    return _Pass(votes, width, _edges(rows), n_classes, seed, share, bootstrap, min(max(n_places, 1), width), per_node, np.array(steps[:STEPS]))


def _subset(strategy: str, width: int) -> int:
    """Places among which a node chooses, as MLlib counts them."""
    named = {"all": width, "sqrt": math.ceil(math.sqrt(width)), "log2": math.ceil(math.log2(width)) if width > 1 else 1}
    if strategy in named:
        return named[strategy]
    return int(strategy) if strategy.isdigit() else math.ceil(float(strategy) * width)


def fit_forest(data: DataFrame, n_classes: int, params: dict, seed: int, weight: str | None = None) -> SparseTrees:
    """Fit on a table with ``__x`` (vector), ``__y`` (class number) and the weight column, if any.

    ``params`` as MLlib has them: numTrees, maxDepth, minInstancesPerNode, featureSubsetStrategy, bootstrap.
    """
    rows, width = _prepared(data, weight, seed, 0)
    job = _pass(True, rows, width, n_classes, seed, 1.0, params["bootstrap"], _subset(params["featureSubsetStrategy"], width), True)
    value = lambda s: (s[:-2] / s[-2] if s[-2] else np.full(n_classes, 1 / n_classes)).tolist()
    trees, gains = _grow(rows, job, params["numTrees"], params["maxDepth"], value, 0.0, 0.0, 0.0, params["minInstancesPerNode"])
    mean: dict[int, float] = {}
    for of_tree in gains:  # every tree counts the same
        for p, g in of_tree.items():
            mean[p] = mean.get(p, 0.0) + g / sum(of_tree.values())
    whole = sum(mean.values())
    return SparseTrees(True, width, [_bare(trees)], {p: g / whole for p, g in mean.items()})


def fit_sparse_boosted(data: DataFrame, n_classes: int, params: dict, seed: int, weight: str | None = None) -> SparseTrees:
    """The same for boosting, with the parameters of ``fit_boosted``; a missing value is less than all others."""
    n_margins = 1 if n_classes == 2 else n_classes
    rows, width = _prepared(data, weight, seed, n_margins)
    rate, l1, l2 = float(params["learning_rate"]), float(params["reg_alpha"]), float(params["reg_lambda"])
    job = _pass(False, rows, width, n_classes, seed, float(params["subsample"]), False, round(float(params["colsample_bytree"]) * width), False)

    def value(sums: np.ndarray) -> list[float]:
        g, h = sums[0] / UNIT, sums[1] / UNIT
        return [float(-np.sign(g) * max(abs(g) - l1, 0.0) / (h + l2) * rate) if h + l2 > 0 else 0.0]

    model, gains = SparseTrees(False, width, []), {}
    for job.n_round in range(int(params["n_estimators"])):
        job.growing = []
        trees, found = _grow(rows, job, n_margins, int(params["max_depth"]), value, l1, l2, float(params["min_child_weight"]), 1)
        model.rounds.append(_bare(trees))
        for of_tree in found:
            for p, g in of_tree.items():
                gains[p] = gains.get(p, 0.0) + g
        job.recent = [*job.recent, model.rounds[-1]]
        if len(job.recent) == KEPT_ROUNDS:
            job.growing = []
            rows = materialise(rows.mapInArrow(job.with_margins, rows.schema))
            job.recent = []
    whole = sum(gains.values())
    model.gains = {p: g / whole for p, g in gains.items()}
    return model


def _bare(trees: list[Tree]) -> list[Tree]:
    return [Tree(t.place, t.cut, t.left, t.value) for t in trees]
