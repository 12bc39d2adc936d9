"""Dates, imputation and removal of duplicate rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.columns import (
    DATED,
    auto_numeric,
    auto_strings,
    existing,
    is_missing,
    long_format,
    numeric_only,
    present,
    quoted,
    replaced,
)
from tabwright.operators.quantiles import exact_quantiles

DATE_PATTERN = "yyyy-M-d"
NO_MODE = "Unknown"


def parse_dates(df: DataFrame, columns: Sequence[str], pattern: str = DATE_PATTERN) -> DataFrame:
    """Text to timestamp by one pattern, unparsable text to NULL; date and timestamp columns stay as they are."""
    new = {}
    for c in existing(df, columns, "date"):
        kind = df.schema[c].dataType
        if isinstance(kind, DATED):
            new[c] = quoted(c).cast("timestamp")
        else:
            new[c] = F.try_to_timestamp(quoted(c).cast("string"), F.lit(pattern))
    return replaced(df, new) if new else df


@dataclass(frozen=True)
class Imputer:
    """Fill values per column."""

    numbers: dict[str, float] = field(default_factory=dict)
    strings: dict[str, str] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        new = {}
        for c, value in self.numbers.items():
            kind = df.schema[c].dataType
            whole = isinstance(kind, T.IntegralType) and float(value).is_integer()
            target = kind if whole or isinstance(kind, T.FractionalType) else T.DoubleType()
            new[c] = F.coalesce(present(df, c).cast(target), F.lit(value).cast(target))
        for c, text in self.strings.items():
            new[c] = F.coalesce(quoted(c), F.lit(text))
        return replaced(df, new) if new else df


def fit_imputer(
    df: DataFrame, numeric: Sequence[str] | None = None, exclude: Sequence[str] = ()
) -> Imputer:
    """Medians for numbers, most frequent value for strings.

    A given ``numeric`` list is taken alone; without one all int/long/float/double columns are candidates. Only columns
    that miss values are fitted.
    """
    numbers = [c for c in numeric_only(df, numeric) if c not in exclude] if numeric else auto_numeric(df, exclude)
    strings = auto_strings(df, exclude)
    candidates = [*numbers, *strings]
    if not candidates:
        return Imputer()
    gaps = df.agg(*[F.max(is_missing(df, c)).alias(f"g{i}") for i, c in enumerate(candidates)]).first()
    holed = {c for c, gap in zip(candidates, gaps) if gap}
    medians = exact_quantiles(df, [c for c in numbers if c in holed], [0.5])
    filled = {c: m[0] for c, m in medians.items() if m[0] is not None}
    return Imputer(filled, fit_modes(df, [c for c in strings if c in holed]))


def fit_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent value per column, the smallest on ties, a placeholder where there is none."""
    if not columns:
        return {}
    counts = long_format(df, columns).where(F.col("value").isNotNull()).groupBy("column", "value").count()
    best = counts.groupBy("column").agg(F.min(F.struct(-F.col("count"), F.col("value").alias("value"))).alias("top"))
    found = {r["column"]: r["value"] for r in best.select("column", "top.value").collect()}
    return {c: found.get(c, NO_MODE) for c in columns}


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that equal another in every column are kept once."""
    return df.dropDuplicates()


def duplicate_report(df: DataFrame) -> DataFrame:
    """One row: ``n_rows, n_kept, n_removed, removed_ratio``."""
    copies = df.groupBy(*[quoted(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("__copies"))
    kept, rows = F.count(F.lit(1)), F.coalesce(F.sum("__copies"), F.lit(0))
    return copies.agg(
        rows.alias("n_rows"),
        kept.alias("n_kept"),
        (rows - kept).alias("n_removed"),
        F.when(rows > 0, (rows - kept).cast("double") / rows).alias("removed_ratio"),
    )
