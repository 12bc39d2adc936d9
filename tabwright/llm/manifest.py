"""Merkle manifest of a dataset: a tree per source and one over the sources, with a version for each tampered leaf.

Leaves are hashed in Spark; only digests are shuffled. A tree is cut into aligned blocks of 3**7 leaves, each built in one
task; the blocks' tops are the leaves of the next round, so no task sees more than one block. A version copies the
ancestors of its leaf inside the block, shares all other nodes, and goes on along the block's path through the rounds
above, which is worked out once per block and joined to it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions.columns import quoted
from tabwright.functions.stage import materialise

#: Children of a node, and levels of a block (2187 leaves).
RUN, LEVELS = 3, 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = "tree string, pos long, digest string, n long"
PATH = "tree string, pos long, lefts array<string>, rights array<string>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@dataclass
class Tree:
    """The nodes of one block, level by level from its leaves to its top."""

    levels: list[list[str]]

    @staticmethod
    def over(leaves: list[str], rounds: int) -> Tree:
        levels = [leaves]
        for _ in range(rounds):
            below = levels[-1]
            levels.append([digest("".join(below[i : i + RUN])) for i in range(0, len(below), RUN)])
        return Tree(levels)

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def path(self, leaf: int) -> list[tuple[str, str]]:
        """What stands left and right of the leaf's ancestors in their runs, upwards."""
        out = []
        for below in self.levels[:-1]:
            first = leaf - leaf % RUN
            out.append(("".join(below[first:leaf]), "".join(below[leaf + 1 : first + RUN])))
            leaf //= RUN
        return out

    def version(self, leaf: int, new: str) -> Version:
        """A version in which one leaf differs: only its ancestors are copied."""
        copied = {(0, leaf): new}
        for level, (left, right) in enumerate(self.path(leaf)):
            new, leaf = digest(left + new + right), leaf // RUN
            copied[level + 1, leaf] = new
        return Version(self, copied)


@dataclass
class Version:
    """A tree that shares all nodes of ``base`` but the copied ones."""

    base: Tree
    copied: dict[tuple[int, int], str]

    def node(self, level: int, at: int) -> str:
        return self.copied.get((level, at)) or self.base.levels[level][at]

    @property
    def top(self) -> str:
        return self.node(len(self.base.levels) - 1, 0)


def folded(node: str, path: Sequence[tuple[str, str]]) -> str:
    """The version's root: each ancestor on the path is copied with the new node inside its run."""
    for left, right in path:
        node = digest(left + node + right)
    return node


def rounds(n: int, most: int) -> int:
    """Levels that a block of a tree of n nodes has: up to the root, ``most`` at most."""
    out = 0
    while n > 1 and out < most:
        n, out = -(-n // RUN), out + 1
    return out


def _block(table: pa.Table, levels: int) -> tuple[list[int], Tree]:
    """Rows of a block in order of place, and its tree."""
    places = table.column("pos").to_pylist()
    order = sorted(range(len(places)), key=places.__getitem__)
    digests = table.column("digest").to_pylist()
    return order, Tree.over([digests[i] for i in order], rounds(table.column("n")[0].as_py(), levels))


def _tops(key: tuple, table: pa.Table, levels: int) -> pa.Table:
    _, tree = _block(table, levels)
    n = table.column("n")[0].as_py()
    row = [key[0].as_py()], [key[1].as_py()], [tree.top], [-(-n // RUN**levels)]
    return pa.table([pa.array(v, t) for v, t in zip(row, (pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)], names=["tree", "pos", "digest", "n"])


def _upper(above: pa.Table) -> list[tuple[str, str]]:
    return list(zip(above.column("lefts")[0].as_py(), above.column("rights")[0].as_py(), strict=True))


def _paths(nodes: pa.Table, above: pa.Table, levels: int) -> pa.Table:
    """The path of each node: inside its block, then that of the block."""
    order, tree = _block(nodes, levels)
    upper = _upper(above)
    full = [tree.path(i) + upper for i in range(len(order))]
    strings = pa.list_(pa.string())
    return pa.table(
        [nodes.column("tree").take(order), nodes.column("pos").take(order),
         pa.array([[x for x, _ in p] for p in full], strings), pa.array([[x for _, x in p] for p in full], strings)],
        names=["tree", "pos", "lefts", "rights"],
    )


def _verified(nodes: pa.Table, above: pa.Table, levels: int) -> pa.Table:
    """Proof and folded root of every leaf of a block."""
    order, tree = _block(nodes, levels)
    upper = _upper(above)
    subroot, root = above.column("subroot")[0].as_py(), above.column("root")[0].as_py()
    tampered = nodes.column("tampered").to_pylist()
    proofs, tops = [], []
    for i, row in enumerate(order):
        own = tree.path(i)
        proofs.append(digest("".join([left + right for left, right in own + upper])))
        new = tampered[row]
        # a version's ancestors are copied inside the block, then along the path above it
        tops.append(folded(tree.top if new is None else tree.version(i, new).top, upper))
    n = len(order)
    return pa.table(
        [nodes.column("id").take(order), nodes.column("digest").take(order), pa.array([subroot] * n, pa.string()),
         pa.array([root] * n, pa.string()), pa.array(proofs, pa.string()), pa.array(tops, pa.string()),
         pa.array([t == root for t in tops], pa.bool_())],
        names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    )


def _in_blocks(nodes: DataFrame, levels: int):
    return nodes.withColumn("block", F.expr(f"pos DIV {RUN**levels}L")).groupBy("tree", "block")


def climb(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """The nodes and, for each round of blocks, the tops; in the last table every tree has one node."""
    out = [nodes]
    while len(out) == 1 or (out[-1].agg(F.max("n")).first()[0] or 0) > 1:
        tops = lambda key, table: _tops(key, table, levels)
        out.append(materialise(_in_blocks(out[-1], levels).applyInArrow(tops, NODE)))
    return out


def descend(tables: list[DataFrame], top: DataFrame, last: int, levels: int) -> DataFrame:
    """Paths of the nodes of ``tables[last]``, given those of the trees' roots."""
    above = top
    for nodes in reversed(tables[last:-1]):
        paths = lambda own, upper: _paths(own, upper, levels)
        above = materialise(_in_blocks(nodes, levels).cogroup(above.groupBy("tree", "pos")).applyInArrow(paths, PATH))
    return above


def placed(rows: DataFrame, tree: str, *order: str) -> DataFrame:
    """Add ``pos``, the place inside the tree, and ``n``, its number of rows.

    Rows are sorted into ranges; a row's number inside its range, and the counts of the ranges before it, give its place.
    """
    ranges = rows.repartitionByRange(quoted(tree), *map(quoted, order)).sortWithinPartitions(tree, *order)
    numbered = materialise(ranges.withColumns({"__row": F.monotonically_increasing_id(), "__part": F.spark_partition_id()}))
    starts = numbered.groupBy("__part", tree).agg(F.min("__row").alias("__first"), F.count("*").alias("__n"))
    of_tree = Window.partitionBy(tree)  # one row for each range that holds a part of the tree
    before = F.sum("__n").over(of_tree.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    spread = starts.select(
        "__part", tree, "__first", F.coalesce(before, F.lit(0).cast("long")).alias("__before"), F.sum("__n").over(of_tree).alias("n")
    )
    joined = numbered.join(spread, ["__part", tree])
    return joined.withColumn("pos", F.col("__row") - F.col("__first") + F.col("__before")).drop("__row", "__part", "__first", "__before")


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text), F.lit(":"), text))


def leaf(fields: Sequence[Column]) -> Column:
    """Digest of a row: each field as ``-`` where null, else its length in bytes, a colon and its value."""
    return F.sha2(F.concat(*[field(f) for f in fields]), 256)


def manifest(
    docs: DataFrame, tampered: dict[str, Column] | None = None, where: Column | None = None,
    fields: Sequence[str] = FIELDS, id_col: str = "doc_id", source_col: str = "source", levels: int = LEVELS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root and verified.

    ``tampered`` replaces columns in the rows where ``where`` holds; the root of such a row's version is folded_root, and
    verified tells whether it is the root. ``levels`` sets the size of blocks, not the result. Leaves ascend by id (null first), equal ids by their digest; rows that repeat
    are leaves of their own. A null source is a source, before all others. Null fields differ from empty ones. Columns
    other than ``fields`` are not read; an empty table gives no rows.
    """
    changed = F.lit(None).cast("string")
    if tampered:
        changed = F.when(where, leaf([tampered[f] if f in tampered else quoted(f) for f in fields]))
    leaves = docs.select(
        quoted(id_col).alias("id"), field(quoted(source_col)).alias("tree"),
        leaf([quoted(f) for f in fields]).alias("digest"), changed.alias("tampered"),
    )
    below = materialise(placed(materialise(leaves), "tree", "id", "digest"))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    tables = climb(below.select("tree", "pos", "digest", "n"), levels)
    name = "CASE WHEN tree <> '-' THEN substr(tree, instr(tree, ':') + 1) END"
    subroots = tables[-1].select("tree", F.expr(name).alias("source"), "digest")
    ranked = materialise(placed(subroots.withColumn("top", F.lit("")), "top", "source"))
    upper = climb(ranked.select(F.col("top").alias("tree"), "pos", "digest", "n"), levels)
    none = F.array().cast("array<string>")
    of_sources = descend(upper, upper[-1].select("tree", "pos", none.alias("lefts"), none.alias("rights")), 0, levels)
    root = upper[-1].select(F.col("digest").alias("root"))  # one row
    tops = ranked.select("pos", F.col("tree"), F.col("digest").alias("subroot"))
    tops = materialise(tops.join(of_sources.drop("tree"), "pos").select("tree", F.lit(0).cast("long").alias("pos"), "lefts", "rights", "subroot"))
    paths = descend(tables, tops.select("tree", "pos", "lefts", "rights"), 1, levels)
    first = root.first()
    above = paths.join(tops.select("tree", "subroot"), "tree").withColumn("root", F.lit(first.root if first else None).cast("string"))
    verified = lambda own, upper: _verified(own, upper, levels)
    return _in_blocks(below, levels).cogroup(above.groupBy("tree", "pos")).applyInArrow(verified, schema)
