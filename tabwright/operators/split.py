"""Exact stratified splits and folds as plain predicates.

Rows of a class are ordered by a hash of their key. A split needs only the row at which the quota ends, so the fit
counts hash prefixes per class, looks into the few prefixes that hold a quota end, and returns those rows. The
transform joins each row with the ends of its class and compares: no sort and no window over a class. The driver looks
for the ends while counts are few; beyond that the same is done in tables, so the number of classes is not limited.
"""

from __future__ import annotations

import logging
import math
from collections import defaultdict
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.functions.columns import quoted
from tabwright.functions.keys import HASH_BITS, key_hash
from tabwright.functions.stage import materialise

log = logging.getLogger(__name__)

PREFIX_BITS = 10
GATHER_ROWS = 2000
#: Class tables of at most so many rows are broadcast, larger ones are shuffled.
BROADCAST_ROWS = 100_000
#: Counts of at most so many hash prefixes of classes are fetched by the driver.
HELD_CELLS = 100_000
# Fixed defaults.
SEED = 42
TEST_SIZE = 0.2


def class_counts(df: DataFrame, label: str) -> dict:
    """Class sizes on the driver, for models, which hold a row per class there anyway."""
    rows = df.groupBy(quoted(label).alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()
    if any(r["c"] is None for r in rows):
        raise ValueError(f"label {label!r} has missing values")
    return {r["c"]: r["n"] for r in sorted(rows, key=lambda r: r["c"])}


def _sized(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


@dataclass(frozen=True)
class ClassCuts:
    """Rows ``c, first, ends``: how many cuts precede a class's first row, and the last row before each later cut.

    A row is a struct of its hash and its key values.
    """

    label: str
    key: tuple[str, ...]
    seed: int
    ends: DataFrame
    held: bool = False

    def numbered(self, df: DataFrame, name: str) -> DataFrame:
        """Add ``name``: 0 for rows up to the first cut of their class, 1 up to the second, and so on."""
        here = _hashed_row(self.key, self.seed)
        ends = self.ends.withColumnsRenamed({"c": "__c", "first": "__first", "ends": "__ends"})
        table = F.broadcast(ends) if self.held else _sized(ends)
        joined = df.withColumn("__here", here).join(table, quoted(self.label) == F.col("__c"))
        passed = F.col("__first") + F.size(F.filter("__ends", lambda e: F.col("__here") > e))
        return joined.select(*[quoted(c) for c in df.columns], passed.cast("int").alias(name))


def _hashed_row(key: Sequence[str], seed: int) -> Column:
    return F.struct(key_hash(key, seed).alias("h"), *[quoted(k).alias(f"k{i}") for i, k in enumerate(key)])


@dataclass(frozen=True)
class Quotas:
    """After how many rows of the hash order the cuts of each class fall, from its number of rows.

    ``of_counts`` takes and gives dicts by class, ``of_table`` takes rows ``c, n`` and gives rows ``c, wanted``.
    """

    of_counts: Callable[[dict], dict[object, list[int]]]
    of_table: Callable[[DataFrame], DataFrame]


def fit_cuts(df: DataFrame, label: str, key: Sequence[str], seed: int, quotas: Quotas) -> ClassCuts:
    """The rows at which the quotas of each class end.

    The key must identify a row; two rows with one key at a cut are an error. A quota of 0 cuts before the first row.
    """
    key = tuple(key)
    # written once: every pass reads two columns instead of the input, and hashes nothing
    hashed = materialise(df.select(quoted(label).alias("c"), _hashed_row(key, seed).alias("row")))
    cells = _prefixes(hashed, 0, PREFIX_BITS).limit(HELD_CELLS + 1).collect()
    if len(cells) > HELD_CELLS:
        table = materialise(hashed.groupBy("c").agg(F.count(F.lit(1)).alias("n")))
        if not table.where("c is null").isEmpty():
            raise ValueError(f"label {label!r} has missing values")
        return _cuts_in_tables(hashed, label, key, seed, quotas.of_table(table))
    counts: dict = defaultdict(int)
    for r in cells:
        counts[r.c] += r.n
    if None in counts:
        raise ValueError(f"label {label!r} has missing values")
    wanted = quotas.of_counts(dict(counts))
    found = _ends_on_driver(hashed, cells, wanted, label, key)
    rows = [(c, sum(q <= 0 for q in qs), sorted(found[c, q] for q in qs if q > 0)) for c, qs in wanted.items()]
    kind, row = hashed.schema["c"].dataType.simpleString(), hashed.schema["row"].dataType.simpleString()
    ends = df.sparkSession.createDataFrame(rows, f"c {kind}, first int, ends array<{row}>")
    return ClassCuts(label, key, seed, ends, held=True)


def _prefixes(hashed: DataFrame, bits: int, more: int, spots: DataFrame | None = None) -> DataFrame:
    """Rows ``c, p, child, n``: counts by the next ``more`` bits of the hash, in all classes or in the given spots."""
    inside = _inside(hashed, spots, bits) if spots is not None else hashed.withColumn("p", F.lit(0).cast("bigint"))
    child = F.shiftright("row.h", HASH_BITS - bits - more)
    return inside.groupBy("c", "p", child.alias("child")).agg(F.count(F.lit(1)).alias("n"))


def _ends_on_driver(hashed: DataFrame, cells: list, wanted: dict, label: str, key: Sequence[str]) -> dict:
    """The row at which each (class, quota) ends, by as many counts of prefixes as it takes to bound what is ranked."""
    spark, kind = hashed.sparkSession, hashed.schema["c"].dataType.simpleString()
    open_ = [(c, q, q, 0) for c, qs in wanted.items() for q in sorted(set(qs)) if q > 0]
    found, bits = {}, 0
    while open_:
        if bits:
            spots = spark.createDataFrame(sorted({(c, p) for c, _, _, p in open_}), f"c {kind}, p bigint")
            cells = _prefixes(hashed, bits, PREFIX_BITS, F.broadcast(spots)).collect()
        bits += PREFIX_BITS
        inside = defaultdict(list)
        for r in sorted(cells, key=lambda r: r.child):
            inside[r.c, r.p].append((r.child, r.n))
        placed = []
        for c, quota, rank, p in open_:
            for child, n in inside[c, p]:
                if rank <= n:
                    placed.append((c, quota, rank, child, n))
                    break
                rank -= n
            else:
                raise ValueError(f"a quota exceeds the rows of its class of {label!r}")
        open_ = [x[:4] for x in placed if x[4] > GATHER_ROWS]
        if open_ and bits + PREFIX_BITS > HASH_BITS:
            raise ValueError(f"the key {list(key)} does not identify a row: thousands of rows share one")
        small = [x[:4] for x in placed if x[4] <= GATHER_ROWS]
        if small:
            spots = spark.createDataFrame(small, f"c {kind}, quota bigint, rank bigint, p bigint")
            for r in _ranked(hashed, F.broadcast(spots), F.broadcast(spots.select("c", "p").distinct()), bits).collect():
                if r.twice:
                    raise ValueError(f"the key {list(key)} does not identify a row")
                found[r.c, r.quota] = r.row
    return found


def _ranked(hashed: DataFrame, spots: DataFrame, cells: DataFrame, bits: int) -> DataFrame:
    """The rows at the ranks of the spots inside their cells, and whether the next row is the same."""
    order = W.partitionBy("c", "p").orderBy("row")
    ranked = _inside(hashed, cells, bits).select(
        "c", "p", "row", F.row_number().over(order).alias("rank"), F.lead("row").over(order).alias("next")
    )
    ends = ranked.join(spots, ["c", "p", "rank"])
    return ends.select("c", "quota", "row", F.col("row").eqNullSafe(F.col("next")).alias("twice"))


def _cuts_in_tables(hashed: DataFrame, label: str, key: tuple[str, ...], seed: int, quotas: DataFrame) -> ClassCuts:
    """``quotas`` (``c, wanted``) lists for each class after how many rows of the hash order the cuts fall."""
    quotas = materialise(quotas)
    wanted = quotas.select("c", F.explode(F.array_distinct("wanted")).alias("quota")).where("quota > 0")
    # quota ends that are still looked for: inside prefix p of the hash, at place ``rank``
    open_ = materialise(wanted.select("c", "quota", F.col("quota").alias("rank"), F.lit(0).cast("bigint").alias("p")))
    found, bits = None, 0
    while not open_.isEmpty():
        counts = _prefixes(hashed, bits, PREFIX_BITS, _sized(open_.select("c", "p").distinct()))
        bits += PREFIX_BITS
        upto = F.sum("n").over(W.partitionBy("c", "p").orderBy("child"))  # at most 2**PREFIX_BITS rows
        placed = open_.join(counts.withColumn("upto", upto), ["c", "p"]).where("rank <= upto and rank > upto - n")
        placed = materialise(placed.select("c", "quota", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"), F.col("child").alias("p"), "n"))
        if placed.count() < open_.count():
            raise ValueError(f"a quota exceeds the rows of its class of {label!r}")
        small = placed.where(F.col("n") <= GATHER_ROWS).drop("n")
        open_ = placed.where(F.col("n") > GATHER_ROWS).drop("n")
        if bits + PREFIX_BITS > HASH_BITS and not open_.isEmpty():
            raise ValueError(f"the key {list(key)} does not identify a row: thousands of rows share one")
        ends = materialise(_ranked(hashed, _sized(small), _sized(small.select("c", "p").distinct()), bits))
        if not ends.where("twice").isEmpty():
            raise ValueError(f"the key {list(key)} does not identify a row")
        found = ends if found is None else found.unionByName(ends)
    first = F.size(F.filter("wanted", lambda q: q <= 0)).alias("first")
    if found is None:
        kind = hashed.schema["row"].dataType.simpleString()
        return ClassCuts(label, key, seed, quotas.select("c", first, F.array().cast(f"array<{kind}>").alias("ends")))
    # a quota that occurs twice cuts twice
    every = quotas.select("c", F.explode("wanted").alias("quota")).join(found, ["c", "quota"])
    ends = every.groupBy("c").agg(F.array_sort(F.collect_list("row")).alias("ends"))
    whole = quotas.select("c", first).join(ends, "c", "left")
    return ClassCuts(label, key, seed, materialise(whole.withColumn("ends", F.coalesce("ends", F.array().cast(ends.schema["ends"].dataType)))))


def _inside(hashed: DataFrame, spots: DataFrame, bits: int) -> DataFrame:
    """Rows whose class and first ``bits`` of the hash are among the spots, with that prefix as ``p``."""
    prefix = F.shiftright("row.h", HASH_BITS - bits) if bits else F.lit(0).cast("bigint")
    return hashed.withColumn("p", prefix).join(spots, ["c", "p"])


def shared_quotas(counts: dict, test_size: float) -> dict[object, list[int]]:
    """Train rows per class. The total is shared by largest remainder, ties to the smaller class."""
    n = sum(counts.values())
    n_train = _train_rows(n, len(counts), min(counts.values(), default=0), test_size)
    parts = {c: divmod(n_train * k, n) for c, k in counts.items()}
    left = n_train - sum(q for q, _ in parts.values())
    first = sorted(sorted(counts), key=lambda c: -parts[c][1])[:left]
    return {c: [q + (c in first)] for c, (q, _) in parts.items()}


def _train_rows(n: int, k: int, least: int, test_size: float) -> int:
    if not n or least < 2:
        raise ValueError("every class needs at least 2 rows for a stratified split")
    n_test = math.ceil(n * test_size)
    if n_test < k or n - n_test < k:
        raise ValueError("test and train part need at least one row per class")
    return n - n_test


def train_quotas(table: DataFrame, test_size: float) -> DataFrame:
    """The same as rows ``c, wanted``, for any number of classes."""
    whole = table.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), F.min("n").alias("least")).first()
    n_train = _train_rows(whole.n, whole.k, whole.least, test_size)
    # whole numbers only: the fractional parts of n_train * n / total compare as remainders
    product = F.col("n").cast("decimal(38,0)") * F.lit(n_train).cast("decimal(19,0)")
    share = F.expr(f"(CAST(n AS DECIMAL(19,0)) * {n_train}BD) DIV {whole.n}BD").cast("bigint")
    shared = table.select("c", share.alias("q"), F.pmod(product, F.lit(whole.n).cast("decimal(38,0)")).alias("rest"))
    left = n_train - shared.agg(F.sum("q")).first()[0]
    place = F.row_number().over(W.orderBy(F.col("rest").desc(), "c"))  # one row per class
    return shared.select("c", F.array(F.col("q") + (place <= left).cast("bigint")).alias("wanted"))


def check_share(test_size: float) -> None:
    if not 0 < test_size < 1:
        raise ValueError(f"test_size: {test_size} does not lie between 0 and 1")


def stratified_split(
    df: DataFrame, label: str, key: Sequence[str], test_size: float = TEST_SIZE, seed: int = SEED
) -> DataFrame:
    """Add the boolean ``is_test``; class shares are kept exactly."""
    check_share(test_size)
    cuts = fit_cuts(df, label, key, seed, Quotas(lambda n: shared_quotas(n, test_size), lambda t: train_quotas(t, test_size)))
    return cuts.numbered(df, "__slice").select(*[quoted(c) for c in df.columns], (F.col("__slice") == 1).alias("is_test"))


def split_parts(df: DataFrame, label: str, key: Sequence[str], test_size: float = TEST_SIZE, seed: int = SEED):
    """Train and test part of ``df``."""
    marked = stratified_split(df, label, key, test_size, seed)
    return marked.where(~F.col("is_test")).drop("is_test"), marked.where("is_test").drop("is_test")


def written_parts(df: DataFrame, label: str, key: Sequence[str], test_size: float = TEST_SIZE, seed: int = SEED):
    """Train and test part of ``df``, both written in one pass over it."""
    marked = materialise(stratified_split(df, label, key, test_size, seed), by=["is_test"])
    return marked.where(~F.col("is_test")).drop("is_test"), marked.where("is_test").drop("is_test")


def assign_folds(df: DataFrame, label: str, key: Sequence[str], k: int, seed: int = SEED, name: str = "fold") -> DataFrame:
    """Add the fold number 0..k-1; per class the fold sizes differ by at most one, the larger ones come first."""
    if k < 2:
        raise ValueError(f"number of folds must be >= 2, got {k}")

    def checked(least: int, most: int) -> None:
        if not most or most < k:
            raise ValueError(f"{k} folds, but no class has that many rows")
        if least < k:
            log.warning("the smallest class has %d rows for %d folds", least, k)

    def of_counts(counts: dict) -> dict[object, list[int]]:
        checked(min(counts.values(), default=0), max(counts.values(), default=0))
        return {c: [n // k * i + min(i, n % k) for i in range(1, k)] for c, n in counts.items()}

    def of_table(table: DataFrame) -> DataFrame:
        sizes = table.agg(F.min("n").alias("least"), F.max("n").alias("most")).first()
        checked(sizes.least, sizes.most)
        place = F.sequence(F.lit(1).cast("bigint"), F.lit(k - 1).cast("bigint"))
        ends = F.transform(place, lambda i: F.expr(f"n DIV {k}") * i + F.least(i, F.col("n") % k))
        return table.select("c", ends.alias("wanted"))

    return fit_cuts(df, label, key, seed, Quotas(of_counts, of_table)).numbered(df, name)
