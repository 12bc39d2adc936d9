"""Typed column access: missing values, name filters and numeric views."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

# Types taken when the caller names no numeric columns.
AUTO_NUMERIC = (T.LongType, T.IntegerType, T.DoubleType, T.FloatType)
DATED = (T.DateType, T.TimestampType, T.TimestampNTZType)
_FLOATING = (T.DoubleType, T.FloatType)


def ticked(name: str) -> str:
    """The name as SQL text."""
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str) -> Column:
    """The column called ``name``, whatever characters the name holds."""
    return F.col(ticked(name))


# Wide tables need many of these expressions, and SQL text costs one call to the JVM instead of one per function.


def present_sql(df: DataFrame, name: str) -> str:
    if isinstance(df.schema[name].dataType, _FLOATING):
        return f"CASE WHEN NOT isnan({ticked(name)}) THEN {ticked(name)} END"
    return ticked(name)


def missing_sql(df: DataFrame, name: str) -> str:
    if isinstance(df.schema[name].dataType, _FLOATING):
        return f"({ticked(name)} IS NULL OR isnan({ticked(name)}))"
    return f"({ticked(name)} IS NULL)"


def number_sql(df: DataFrame, name: str) -> str:
    kind = df.schema[name].dataType
    if isinstance(kind, T.BooleanType):
        return f"CAST(CAST({ticked(name)} AS INT) AS DOUBLE)"
    if isinstance(kind, T.DoubleType):
        return f"({present_sql(df, name)})"
    return f"CAST({present_sql(df, name)} AS DOUBLE)"


def present(df: DataFrame, name: str) -> Column:
    """Column ``name`` with NaN read as NULL."""
    return F.expr(present_sql(df, name))


def is_missing(df: DataFrame, name: str) -> Column:
    return F.expr(missing_sql(df, name))


def any_missing(df: DataFrame, names: Sequence[str]) -> Column:
    """Whether the row misses one of the columns."""
    return F.expr(" OR ".join(missing_sql(df, c) for c in names) or "false")


def number(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a double, NaN read as NULL, booleans as 0/1."""
    return F.expr(number_sql(df, name))


def nan_to_null(df: DataFrame) -> DataFrame:
    """One notion of missing for the whole table."""
    if not any(isinstance(f.dataType, _FLOATING) for f in df.schema):
        return df
    return df.selectExpr(*[f"{present_sql(df, c)} AS {ticked(c)}" for c in df.columns])


def existing(df: DataFrame, names: Iterable[str] | None, role: str = "requested") -> list[str]:
    """The names that exist in ``df``; the others are reported and left out."""
    names = list(names or [])
    absent = [n for n in names if n not in df.columns]
    if absent:
        log.warning("%s columns not in the table: %s", role, absent)
    return [n for n in names if n in df.columns]


def is_numeric(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.NumericType, T.BooleanType))


def numeric_only(df: DataFrame, names: Iterable[str] | None) -> list[str]:
    """The existing names whose type is numeric or boolean."""
    found = existing(df, names, "numeric")
    skipped = [n for n in found if not is_numeric(df, n)]
    if skipped:
        log.warning("not numeric, skipped: %s", skipped)
    return [n for n in found if n not in skipped]


def auto_numeric(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    out = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, AUTO_NUMERIC) and f.name not in out]


def auto_strings(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    out = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in out]


def replaced(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """``df`` with some columns replaced in place, as one projection."""
    return df.select(*[(new[c] if c in new else quoted(c)).alias(c) for c in df.columns])


def long_format(df: DataFrame, columns: Sequence[str], kind: str = "string") -> DataFrame:
    """Rows ``(column, value)`` for the given columns; a projection, no shuffle."""
    pairs = [F.struct(F.lit(c).alias("column"), quoted(c).cast(kind).alias("value")) for c in columns]
    return df.select(F.explode(F.array(*pairs)).alias("pair")).select("pair.column", "pair.value")
