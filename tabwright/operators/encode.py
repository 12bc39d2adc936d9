"""One-hot and label encoding of categorical columns."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.columns import existing, long_format, quoted, replaced
from tabwright.functions.names import clashes
from tabwright.functions.stage import materialise
from tabwright.functions.vectors import one_of

log = logging.getLogger(__name__)

#: A column with more values becomes one sparse vector instead of one 0/1 column per value.
DENSE_LEVELS = 1000
LITERAL_LEVELS = 50
BROADCAST_LEVELS = 100_000


@dataclass(frozen=True)
class OneHotEncoder:
    """Sorted levels per column; one 0/1 column per level, appended after the other columns.

    ``wide`` columns have too many levels for that: each becomes one sparse vector ``<column>_onehot`` over its levels,
    whose codes are looked up in a table ``(__value, __code)`` of any length; ``sizes`` has their numbers of levels.
    """

    levels: dict[str, list[str]]
    wide: dict[str, DataFrame] = field(default_factory=dict)
    sizes: dict[str, int] = field(default_factory=dict)

    def names(self) -> list[str]:
        return [*[f"{c}_{v}" for c, values in self.levels.items() for v in values], *[f"{c}_onehot" for c in self.wide]]

    def transform(self, df: DataFrame) -> DataFrame:
        kept = [c for c in df.columns if c not in self.levels and c not in self.wide]
        doubled = clashes([*kept, *self.names()])
        if doubled:
            raise ValueError(f"encoded column names clash: {doubled}")
        dummies = [
            F.coalesce((quoted(c).cast("string") == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}")
            for c, values in self.levels.items()
            for v in values
        ]
        out = df.select(*[quoted(c) for c in [*kept, *self.wide]], *dummies)
        for c, table in self.wide.items():
            codes = F.broadcast(table) if self.sizes[c] <= BROADCAST_LEVELS else table
            coded = out.join(codes, quoted(c).cast("string") == F.col("__value"), "left")
            vector = one_of(F.col("__code"), self.sizes[c]).alias(f"{c}_onehot")
            out = coded.select(*[quoted(x) for x in out.columns if x != c], vector)
        return out


def fit_onehot(df: DataFrame, columns: Sequence[str], dense_levels: int = DENSE_LEVELS) -> OneHotEncoder:
    """Distinct non-null values of every column, written in one job; few become columns, many a sparse vector.

    Only the values of columns with at most ``dense_levels`` of them reach the driver.
    """
    names = existing(df, columns, "categorical")
    if not names:
        return OneHotEncoder({})
    distinct = materialise(long_format(df, names).where(F.col("value").isNotNull()).distinct())
    sizes = {r["column"]: r["count"] for r in distinct.groupBy("column").count().collect()}
    wide = [c for c in names if sizes.get(c, 0) > dense_levels]
    found: dict[str, list[str]] = {c: [] for c in names if c not in wide}
    for r in distinct.where(~F.col("column").isin(wide)).collect():
        found[r["column"]].append(r["value"])
    numeric = {c for c in names if isinstance(df.schema[c].dataType, T.NumericType)}
    levels = {c: sorted(v, key=float) if c in numeric else sorted(v) for c, v in found.items()}
    tables = {}
    for c in wide:
        values = distinct.where(F.col("column") == c).select(F.col("value").alias("__value"))
        first = F.col("__value").cast("double" if c in numeric else "string")
        tables[c] = _codes(values.withColumn("__first", first))
    return OneHotEncoder(levels, tables, {c: sizes[c] for c in wide})


@dataclass(frozen=True)
class LabelEncoder:
    """Codes by first appearance; a missing or unknown value becomes -1.

    ``small`` lists the values of a column by code. ``large`` holds ``(value, code)`` tables for columns with more
    values than may be broadcast. Nothing is fitted while transforming.
    """

    small: dict[str, list[str]]
    large: dict[str, DataFrame] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        literal = {c: v for c, v in self.small.items() if len(v) <= LITERAL_LEVELS}
        new = {}
        for c, values in literal.items():
            code = F.lit(-1)
            for i, v in reversed(list(enumerate(values))):
                code = F.when(quoted(c).cast("string") == F.lit(v), F.lit(i)).otherwise(code)
            new[c] = code.cast("bigint")
        out = replaced(df, new) if new else df
        for c, values in self.small.items():
            if c not in literal:
                spark = df.sparkSession
                table = spark.createDataFrame(list(zip(values, range(len(values)))), "__value string, __code bigint")
                out = _coded(out, c, F.broadcast(table))
        for c, table in self.large.items():
            # one row per value on the right, so adaptive execution can split what hot or missing values fill on the left
            out = _coded(out, c, table)
        return out


def _coded(df: DataFrame, column: str, table: DataFrame) -> DataFrame:
    joined = df.join(table, quoted(column).cast("string") == F.col("__value"), "left")
    code = F.coalesce(F.col("__code"), F.lit(-1)).cast("bigint")
    return joined.select(*[(code if c == column else quoted(c)).alias(c) for c in df.columns])


def fit_label(
    df: DataFrame, columns: Sequence[str], order: str | Sequence[str], broadcast_levels: int = BROADCAST_LEVELS
) -> LabelEncoder:
    """0-based codes in the order in which values first appear along the ``order`` columns, ties by value.

    The codes are the same for every size and partitioning; only where they are kept depends on their number.
    """
    keys = [order] if isinstance(order, str) else list(order)
    small: dict[str, list[str]] = {}
    large: dict[str, DataFrame] = {}
    for c in existing(df, columns, "categorical"):
        first = F.min(F.struct(*[quoted(k).alias(f"k{i}") for i, k in enumerate(keys)]))
        seen = df.where(quoted(c).isNotNull()).groupBy(quoted(c).cast("string").alias("__value")).agg(first.alias("__first"))
        table = _codes(seen)
        if table.count() <= broadcast_levels:
            small[c] = [r["__value"] for r in table.orderBy("__code").collect()]
        else:
            large[c] = table
    return LabelEncoder(small, large)


def _codes(seen: DataFrame) -> DataFrame:
    """Ranks by range: each part of the ordered table is ranked by itself and starts where the parts before it end."""
    parts = seen.repartitionByRange("__first", "__value").withColumn("__part", F.spark_partition_id())
    parts = materialise(parts)
    sizes = parts.groupBy("__part").agg(F.count(F.lit(1)).alias("n"))  # one row per part
    before = F.sum("n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
    starts = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("start"))
    place = F.row_number().over(W.partitionBy("__part").orderBy("__first", "__value"))
    ranked = parts.join(F.broadcast(starts), "__part")
    return materialise(ranked.select("__value", (F.col("start") + place - 1).cast("bigint").alias("__code")))
