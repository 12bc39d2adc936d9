"""Exact nearest neighbours inside each class, without comparing all pairs.

Small classes are compared whole, many of them in one task. In a large one, space is cut into boxes by a tree fitted on a
bounded sample. Every point is searched in waves: first against its own box, which gives a radius that its true neighbours
cannot exceed; then against the few nearest boxes, which shrinks the radius; then only against the rest of the boxes that
the radius still touches. Boxes with many points are cut into blocks, so no task holds more than one block of points.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.functions.stage import materialise

BOX_POINTS = 1000
MAX_BOXES = 32_768
#: Boxes of all classes together; beyond it they are made larger. Their trees travel with each task (16 bytes a box).
ALL_BOXES = 2_000_000
#: Nearest boxes that are searched before the rest.
NEAR_BOXES = 4
#: Points of small classes that one task compares.
PACKED_POINTS = 50_000
SAMPLE_PER_BOX = 24
SAMPLE_VALUES = 8_000_000
BLOCK_POINTS = 4000
CHUNK_CELLS = 2_000_000
#: Numbers in the largest array that the search for touched boxes holds: points at once times boxes times features.
TOUCH_CELLS = 4_000_000
VISITS_PER_COPY = 16_000
#: From so many features on, a matrix product picks the candidates.
ROUGH_FEATURES = 8
#: Sizes of so many boxes may be broadcast.
BROADCAST_BOXES = 100_000


@dataclass(frozen=True)
class BoxTree:
    """Split dimension and threshold per inner node, heap order; the leaves are the boxes."""

    dims: np.ndarray
    cuts: np.ndarray
    depth: int

    @staticmethod
    def fit(sample: np.ndarray, boxes: int) -> "BoxTree":
        depth = max(0, int(np.ceil(np.log2(max(boxes, 1)))))
        dims, cuts = np.zeros(2**depth, dtype=np.int64), np.zeros(2**depth)
        parts = {1: sample}
        for node in range(1, 2**depth):
            part = parts.pop(node)
            if len(part):
                dims[node] = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
                cuts[node] = float(np.median(part[:, dims[node]]))
            right = part[:, dims[node]] > cuts[node]
            parts[2 * node], parts[2 * node + 1] = part[~right], part[right]
        return BoxTree(dims, cuts, depth)

    def home(self, points: np.ndarray) -> np.ndarray:
        """Box of each point."""
        node = np.ones(len(points), dtype=np.int64)
        for _ in range(self.depth):
            right = points[np.arange(len(points)), self.dims[node]] > self.cuts[node]
            node = 2 * node + right
        return node - 2**self.depth

    def touched(self, points: np.ndarray, radius2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Triples (point, box, squared distance of the box) where the box comes within the point's squared radius."""
        who = np.arange(len(points))
        node = np.ones(len(points), dtype=np.int64)
        gaps, away = np.zeros_like(points), np.zeros(len(points))
        for _ in range(self.depth):
            dim, cut = self.dims[node], self.cuts[node]
            diff = points[who, dim] - cut
            right = diff > 0
            far = gaps.copy()
            rows = np.arange(len(who))
            far[rows, dim] = np.maximum(far[rows, dim], np.abs(diff))
            beyond = (far**2).sum(axis=1)
            # a hair of slack: rounding here must never lose a box
            reach = beyond <= radius2[who] * (1 + 1e-9)
            node, who, gaps, away = (
                np.concatenate([2 * node + right, (2 * node + ~right)[reach]]),
                np.concatenate([who, who[reach]]),
                np.concatenate([gaps, far[reach]]),
                np.concatenate([away, beyond[reach]]),
            )
        return who, node - 2**self.depth, away


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All squared distances, summed feature by feature so equal points give exactly 0."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        out += (a[:, j][:, None] - b[:, j][None, :]) ** 2
    return out


def _rough_distances(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances by one matrix product, and for each row of ``a`` what they may be off by at most."""
    inside = (b**2).sum(axis=1)
    own = (a**2).sum(axis=1)
    out = a @ (-2.0 * b.T)
    out += own[:, None]
    out += inside[None, :]
    return out, (own + inside.max()) * (1e-14 * (a.shape[1] + 8))


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of pairs, added up in the order of ``squared_distances``."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        out += (a[:, j] - b[:, j]) ** 2
    return out


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=float).reshape(len(column), -1)


def _nearest(asked: pd.DataFrame, block: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` nearest block points of every asked point, itself left out, ties by identifier."""
    empty = pd.DataFrame({"point": [], "near": [], "dist": []})
    if not len(asked) or not len(block):
        return empty
    q, b = _matrix(asked["vector"]), _matrix(block["vector"])
    ids, base = asked["point"].to_numpy(), block["point"].to_numpy()
    by_id = np.argsort(np.argsort(base, kind="stable"), kind="stable")  # text ids sort by place, too
    step = max(1, CHUNK_CELLS // len(block))
    # rough distances around the middle of the block leave a few points each, whose distances are then added up exactly
    middle = b.mean(axis=0)
    q0, b0 = q - middle, b - middle
    quick = b.shape[1] >= ROUGH_FEATURES and np.isfinite(q0).all() and np.isfinite(b0).all() and max(np.abs(q0).max(), np.abs(b0).max()) < 1e100
    rows = []
    for at in range(0, len(q), step):
        dist, slack = _rough_distances(q0[at : at + step], b0) if quick else (squared_distances(q[at : at + step], b), 0.0)
        dist[ids[at : at + step][:, None] == base[None, :]] = np.inf
        limit = np.partition(dist, k - 1, axis=1)[:, k - 1] if len(b) > k else np.full(len(dist), np.inf)
        who, near = np.nonzero((dist <= (limit + 2 * slack)[:, None]) & np.isfinite(dist))
        far = _exact(q[who + at], b[near]) if quick else dist[who, near]
        order = np.lexsort((by_id[near], far, who))
        who, near, far = who[order], near[order], far[order]
        first = np.arange(len(who)) - np.searchsorted(who, who) < k
        rows.append((who[first] + at, near[first], far[first]))
    who, near, dist = (np.concatenate(part) for part in zip(*rows))
    return pd.DataFrame(
        {
            "point": ids[who],
            "near": base[near],
            "dist": dist,
        }
    )


def _numbers(count: str) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), F.col(count).cast("bigint") - 1)


def nearest_points(points: DataFrame, k: int) -> DataFrame:
    """Rows ``point, near, dist, near_ids``: the ``k`` nearest other points of the same group, exactly.

    ``points`` has ``grp`` (of any type), ``point`` (bigint or text, unique), ``vector`` (array of doubles, distinct in its
    group), ``ids`` (rows at this place) and ``asked`` (whether its neighbours are wanted). Candidates carry ids and
    distances only.
    """
    best = _nearest_ids(points, k)
    beside = points.select(F.col("point").alias("near"), F.col("ids").alias("near_ids"))
    return best.join(beside, "near").select("point", "near", "dist", "near_ids")


def _nearest_ids(points: DataFrame, k: int) -> DataFrame:
    sizes = points.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("d"))
    large = sizes.where(F.col("n") > BLOCK_POINTS)
    counted = sizes.agg(F.sum("n").alias("n"), F.count_if(F.col("n") > BLOCK_POINTS).alias("large"), F.sum(F.when(F.col("n") > BLOCK_POINTS, F.col("n"))).alias("in_large")).first()
    if not counted.large:
        return _in_packs(points, counted.n or 0, k)
    large = materialise(large)  # a row for each BLOCK_POINTS points at most
    found = _in_waves(points.join(large.select("grp"), "grp"), large, counted.in_large, k)
    if counted.in_large == counted.n:
        return found
    return found.unionByName(_in_packs(points.join(large.select("grp"), "grp", "left_anti"), counted.n - counted.in_large, k))


def _in_packs(points: DataFrame, n: int, k: int) -> DataFrame:
    """Classes that fit in a block, many in one task."""
    kind = points.schema["point"].dataType.simpleString()
    packs = max(1, -(-n // PACKED_POINTS))

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([_nearest(own[own["asked"]], own, k) for _, own in pdf.groupby("grp", dropna=False)])

    packed = points.select("grp", "point", "vector", "asked", F.pmod(F.xxhash64("grp"), F.lit(packs)).alias("pack"))
    return packed.groupBy("pack").applyInPandas(whole, f"point {kind}, near {kind}, dist double")


def _in_waves(points: DataFrame, sizes: DataFrame, n: int, k: int) -> DataFrame:
    """Classes of any size, by boxes."""
    kind, group = (points.schema[c].dataType.simpleString() for c in ("point", "grp"))
    point_columns, found_columns = f"point {kind}, vector array<double>", f"point {kind}, near {kind}, dist double"
    trees = _fit_trees(points, sizes, n)

    def to_home(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for grp, part in pdf.groupby("grp"):
                yield part.assign(box=trees[grp].home(_matrix(part["vector"])))

    columns = f"grp {group}, {point_columns}"
    housed = materialise(points.select("grp", "point", "vector", "asked").mapInPandas(to_home, f"{columns}, asked boolean, box bigint"))
    held = materialise(housed.groupBy("grp", "box").agg(F.ceil(F.count(F.lit(1)) / BLOCK_POINTS).cast("int").alias("blocks")))
    blocks = F.broadcast(held) if held.count() <= BROADCAST_BOXES else held
    stored = housed.join(blocks, ["grp", "box"]).withColumn(
        "block", F.pmod(F.xxhash64("point"), F.col("blocks").cast("bigint"))
    )

    def first_look(pdf: pd.DataFrame) -> pd.DataFrame:
        return _nearest(pdf[pdf["asked"]], pdf, k)

    def search(visits: DataFrame) -> DataFrame:
        """The nearest points in the visited boxes (grp, box, point, vector); of the own box the own block is known."""
        every = visits.join(blocks, ["grp", "box"]).withColumn("block", F.explode(_numbers("blocks")))
        new = ~F.col("own") | (F.col("block") != F.pmod(F.xxhash64("point"), F.col("blocks").cast("bigint")))
        sent = materialise(every.where(new).select("grp", "box", "point", "vector", "block"))
        # a block asked by very many points is copied, and its visitors are spread over the copies
        home = ["grp", "box", "block"]
        copies = sent.groupBy(*home).agg(F.ceil(F.count(F.lit(1)) / VISITS_PER_COPY).cast("bigint").alias("copies"))
        left = sent.join(copies, home).withColumn("copy", F.pmod(F.xxhash64("point"), "copies"))
        right = stored.join(copies, home).withColumn("copy", F.explode(_numbers("copies")))

        def look(asked: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
            return _nearest(asked, block, k)

        place = [*home, "copy"]
        grouped = left.select("point", "vector", *place).groupBy(*place)
        return grouped.cogroup(right.select("point", "vector", *place).groupBy(*place)).applyInPandas(look, found_columns)

    def with_radius(found: DataFrame) -> DataFrame:
        """Asked points with the squared radius that k found points give (null: fewer)."""
        radius = found.groupBy("point").agg(F.when(F.count(F.lit(1)) >= k, F.max("dist")).alias("radius2"))
        return housed.where("asked").join(radius, "point", "left").select("grp", "point", "vector", "radius2")

    def to_boxes(near: int | None):
        """Visits of the ``near`` nearest boxes, the own one left out, or of all others touched but those already seen."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for grp, mine in pdf.groupby("grp"):
                    width = len(mine["vector"].iloc[0])
                    step = max(1, TOUCH_CELLS // (2 ** trees[grp].depth * max(width, 1)))
                    for at in range(0, len(mine), step):
                        part = mine.iloc[at : at + step]
                        vectors = _matrix(part["vector"])
                        wide = part["first2"].fillna(np.inf).to_numpy(dtype=float)
                        who, box, away = trees[grp].touched(vectors, wide)
                        order = np.lexsort((box, away, who))
                        who, box, away = who[order], box[order], away[order]
                        other = box != trees[grp].home(vectors)[who]
                        who, box, away = who[other], box[other], away[other]
                        nth = np.arange(len(who)) - np.searchsorted(who, who)
                        if near is not None:
                            chosen = nth < near
                        else:
                            radius2 = part["radius2"].fillna(np.inf).to_numpy(dtype=float)
                            chosen = (nth >= NEAR_BOXES) & (away <= radius2[who] * (1 + 1e-9))
                        yield part.iloc[who[chosen]][["grp", "point", "vector"]].assign(box=box[chosen], own=False)

        return run

    best = W.partitionBy("point").orderBy("dist", "near")

    def nearest(found: DataFrame) -> DataFrame:
        return materialise(found.withColumn("__rn", F.row_number().over(best)).where(F.col("__rn") <= k).drop("__rn"))

    own = nearest(stored.groupBy("grp", "box", "block").applyInPandas(first_look, found_columns))
    first = with_radius(own).withColumn("first2", F.col("radius2"))
    crowded = held.where("blocks > 1").select("grp", "box")
    beside = housed.where("asked").join(crowded, ["grp", "box"]).select("grp", "point", "vector", "box", F.lit(True).alias("own"))
    visits = first.mapInPandas(to_boxes(NEAR_BOXES), f"{columns}, box bigint, own boolean").unionByName(beside)
    second = search(visits)
    both = nearest(own.unionByName(second))
    shrunk = with_radius(both).join(first.select("point", "first2"), "point")
    third = search(shrunk.mapInPandas(to_boxes(None), f"{columns}, box bigint, own boolean"))
    return nearest(both.unionByName(third))


def _fit_trees(points: DataFrame, sizes: DataFrame, n: int) -> dict:
    """A tree for each class, each fitted in a task on a bounded sample; together they have at most ALL_BOXES boxes."""
    shrink = max(1.0, n / BOX_POINTS / ALL_BOXES)
    wanted = F.least(F.lit(MAX_BOXES), (F.col("n") / (BOX_POINTS * shrink)).cast("int"), (F.lit(SAMPLE_VALUES) / (SAMPLE_PER_BOX * F.greatest("d", F.lit(1)))).cast("int"))
    plan = sizes.select("grp", F.greatest(wanted, F.lit(1)).alias("boxes"), "n")
    # the hash picks the same bounded sample on every retry; it places the boxes and decides no result
    every = F.greatest(F.lit(1), F.expr(f"n DIV (boxes * {SAMPLE_PER_BOX})"))
    picked = points.select("grp", "point", "vector").join(plan, "grp").where(F.pmod(F.xxhash64("point"), every) == 0)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = BoxTree.fit(_matrix(pdf["vector"]), int(pdf["boxes"].iloc[0]))
        return pd.DataFrame({"grp": [pdf["grp"].iloc[0]], "dims": [tree.dims.tobytes()], "cuts": [tree.cuts.tobytes()], "depth": [tree.depth]})

    group = points.schema["grp"].dataType.simpleString()
    fitted = picked.select("grp", "vector", "boxes").groupBy("grp").applyInPandas(fit, f"grp {group}, dims binary, cuts binary, depth int")
    trees = {r.grp: BoxTree(np.frombuffer(r.dims, np.int64), np.frombuffer(r.cuts), r.depth) for r in fitted.collect()}
    for r in sizes.select("grp").collect():
        trees.setdefault(r.grp, BoxTree.fit(np.zeros((0, 1)), 1))
    return trees
