"""Codes to ordered classes, and class counts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.columns import present, quoted, replaced

# Accident code to severity (0 low, 1 medium, 2 high).
SEVERITY = {"210": 0, "701": 1, "703": 1, "705": 2, "707": 2}
UNMAPPED_CLASS = 0


def code_text(df: DataFrame, column: str) -> Column:
    """The code as text; whole doubles lose their ``.0``."""
    kind = df.schema[column].dataType
    value = present(df, column)
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.when(value == F.floor(value), value.cast("bigint").cast("string")).otherwise(value.cast("string"))
    return value.cast("string")


def mapped_code(df: DataFrame, column: str, mapping: Mapping[str, int] = SEVERITY) -> Column:
    """The class of the code, NULL where the code is missing or unknown."""
    code = code_text(df, column)
    found = F.lit(None).cast("int")
    for level in sorted(set(mapping.values())):
        codes = [k for k, v in mapping.items() if v == level]
        found = F.when(code.isin(codes), F.lit(level)).otherwise(found)
    return found


def to_severity(
    df: DataFrame,
    column: str,
    mapping: Mapping[str, int] = SEVERITY,
    default: int | None = UNMAPPED_CLASS,
    output: str | None = None,
) -> DataFrame:
    """Replace ``column`` (or add ``output``) by its class; unmapped and missing codes take ``default``."""
    level = mapped_code(df, column, mapping)
    if default is not None:
        level = F.coalesce(level, F.lit(default))
    if output is None or output == column:
        return replaced(df, {column: level})
    return df.select("*", level.alias(output))


def unmapped_codes(df: DataFrame, column: str, mapping: Mapping[str, int] = SEVERITY) -> DataFrame:
    """Rows ``code, n`` for codes the mapping does not hold."""
    return (
        df.where(mapped_code(df, column, mapping).isNull())
        .groupBy(code_text(df, column).alias("code"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows ``label, n`` in class order."""
    return df.groupBy(quoted(label).alias("label")).agg(F.count(F.lit(1)).alias("n")).orderBy("label")
