"""Capping of extreme values at fitted bounds."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.columns import auto_numeric, number, numeric_only, replaced
from tabwright.operators.quantiles import exact_quantiles

log = logging.getLogger(__name__)

# Fixed default for both methods.
THRESHOLD = 3.0


@dataclass(frozen=True)
class Capper:
    """Lower and upper bound per column."""

    bounds: dict[str, tuple[float, float]]

    def transform(self, df: DataFrame) -> DataFrame:
        new = {c: _clip(number(df, c), lo, hi) for c, (lo, hi) in self.bounds.items()}
        return replaced(df, new) if new else df

    def report(self, df: DataFrame) -> DataFrame:
        """Rows ``column, lower, upper, n_outliers``, counted on the table before capping."""
        names = list(self.bounds)
        outside = [(number(df, c) < lo) | (number(df, c) > hi) for c, (lo, hi) in self.bounds.items()]
        one = df.agg(*[F.count_if(o).alias(f"n{i}") for i, o in enumerate(outside)])
        entries = [
            F.struct(
                F.lit(c).alias("column"),
                F.lit(float(self.bounds[c][0])).alias("lower"),
                F.lit(float(self.bounds[c][1])).alias("upper"),
                F.col(f"n{i}").alias("n_outliers"),
            )
            for i, c in enumerate(names)
        ]
        return one.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def _clip(value: Column, lo: float, hi: float) -> Column:
    # greatest/least skip NULL, so a missing value needs its own branch to stay missing
    return F.when(value.isNotNull(), F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), value)))


def fit_capper(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    method: str = "iqr",
    threshold: float = THRESHOLD,
    exclude: Sequence[str] = (),
) -> Capper:
    """``iqr``: quartiles widened by ``threshold`` ranges; ``zscore``: mean ± ``threshold`` sample deviations."""
    names = [c for c in (numeric_only(df, columns) if columns else auto_numeric(df)) if c not in exclude]
    if method == "iqr":
        fitted = exact_quantiles(df, names, [0.25, 0.75])
        bounds = {
            c: (q1 - threshold * (q3 - q1), q3 + threshold * (q3 - q1))
            for c, (q1, q3) in fitted.items()
            if q1 is not None
        }
    elif method == "zscore":
        bounds = _zscore_bounds(df, names, threshold)
    else:
        log.warning("unknown outlier method %r, no column capped", method)
        bounds = {}
    return Capper(bounds)


def _zscore_bounds(df: DataFrame, names: Sequence[str], threshold: float) -> dict[str, tuple[float, float]]:
    if not names:
        return {}
    aggs = [f(number(df, c)).alias(f"{tag}{i}") for i, c in enumerate(names) for tag, f in (("m", F.avg), ("s", F.stddev_samp))]
    row = df.agg(*aggs).first()
    out = {}
    for i, c in enumerate(names):
        mean, dev = row[f"m{i}"], row[f"s{i}"]
        if mean is not None and dev is not None:
            out[c] = (mean - threshold * dev, mean + threshold * dev)
    return out
