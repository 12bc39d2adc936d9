"""Table checks and missing-value profiles, one aggregate each."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.columns import is_missing, missing_sql, quoted
from tabwright.functions.names import clashes, clean_name

log = logging.getLogger(__name__)

# Fixed limits.
MIN_ROWS = 2
MAX_MISSING_RATIO = 0.5


def table_profile(df: DataFrame) -> DataFrame:
    """One row: ``n_rows, n_cols, null_cells, missing_ratio``."""
    width = len(df.columns)
    cells = [F.expr(f"count_if({missing_sql(df, c)}) AS m{i}") for i, c in enumerate(df.columns)]
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"), *cells)
    nulls = F.expr(" + ".join(f"m{i}" for i in range(width)))
    return counted.select(
        "n_rows",
        F.lit(width).cast("bigint").alias("n_cols"),
        nulls.alias("null_cells"),
        F.when(F.col("n_rows") > 0, nulls.cast("double") / (F.col("n_rows") * width)).alias("missing_ratio"),
    )


def validate_table(
    df: DataFrame,
    description: str = "table",
    min_rows: int = MIN_ROWS,
    max_missing_ratio: float | None = MAX_MISSING_RATIO,
) -> DataFrame:
    """Return ``df`` unchanged, or raise ``ValueError`` naming the first broken rule."""
    doubled = clashes(df.columns)
    if doubled:
        raise ValueError(f"{description}: names used twice: {doubled}")
    seen = table_profile(df).first()
    if seen.n_rows == 0:
        raise ValueError(f"{description}: no rows")
    if seen.n_rows < min_rows:
        raise ValueError(f"{description}: rows = {seen.n_rows}, wanted {min_rows} or more")
    if max_missing_ratio is not None and seen.missing_ratio > max_missing_ratio:
        raise ValueError(f"{description}: share of missing cells = {seen.missing_ratio:.4f}, wanted {max_missing_ratio} or less")
    return df


def features_profile(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """One row: ``n_rows, missing_features, missing_targets``."""
    cells = F.expr(" + ".join(f"CAST({missing_sql(df, c)} AS BIGINT)" for c in features))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(cells), F.lit(0)).alias("missing_features"),
        F.coalesce(F.sum(is_missing(df, label).cast("bigint")), F.lit(0)).alias("missing_targets"),
    )


def check_features(df: DataFrame, features: Sequence[str], label: str) -> dict[str, int]:
    """Missing features are reported, a missing target or an empty table is an error."""
    absent = [c for c in [*features, label] if c not in df.columns]
    if absent:
        raise ValueError(f"absent: {absent}")
    if not features:
        raise ValueError("a model needs a feature, none was given")
    seen = features_profile(df, features, label).first().asDict()
    if seen["n_rows"] == 0:
        raise ValueError("no rows to learn from")
    if seen["missing_targets"]:
        raise ValueError(f"target {label!r} is unknown in {seen['missing_targets']} rows")
    if seen["missing_features"]:
        log.warning("%d missing values in features", seen["missing_features"])
    return seen


def missing_report(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """Rows ``column, n_missing, missing_ratio``."""
    counts = [F.expr(f"count_if({missing_sql(df, c)}) AS m{i}") for i, c in enumerate(df.columns)]
    one = df.agg(F.count(F.lit(1)).alias("n"), *counts)
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("n_missing")) for i, c in enumerate(df.columns)]
    rows = one.select("n", F.explode(F.array(*entries)).alias("e"))
    report = rows.select(
        "e.column",
        "e.n_missing",
        F.when(F.col("n") > 0, F.col("e.n_missing").cast("double") / F.col("n")).alias("missing_ratio"),
    )
    return report.where("n_missing > 0") if only_missing else report


def clean_column_names(df: DataFrame) -> DataFrame:
    """Rename every column by the one name rule; fails where two names become the same."""
    names = [clean_name(c) for c in df.columns]
    doubled = clashes(names)
    if doubled:
        raise ValueError(f"column names become the same after cleaning: {doubled}")
    return df.toDF(*names)


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[quoted(n) for n in names])
