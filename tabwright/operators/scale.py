"""Standard and min-max scaling."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.columns import auto_numeric, number, numeric_only, replaced

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Scaler:
    """``(x - offset) / width`` per column; a constant column has width 1 and becomes 0."""

    offsets: dict[str, float]
    widths: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        new = {c: (number(df, c) - F.lit(o)) / F.lit(self.widths[c]) for c, o in self.offsets.items()}
        return replaced(df, new) if new else df


def fit_scaler(
    df: DataFrame, columns: Sequence[str] | None = None, method: str = "standard", exclude: Sequence[str] = ()
) -> Scaler:
    """``standard`` uses the population deviation, ``minmax`` the value range; missing values are skipped."""
    names = [c for c in (numeric_only(df, columns) if columns else auto_numeric(df)) if c not in exclude]
    if not names:
        return Scaler({}, {})
    if method not in ("standard", "minmax"):
        log.warning("unknown scaler %r, using standard", method)
    aggs = []
    for i, c in enumerate(names):
        x = number(df, c)
        aggs += [F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
        if method != "minmax":
            aggs += [F.avg(x).alias(f"mean{i}"), F.stddev_pop(x).alias(f"dev{i}")]
    row = df.agg(*aggs).first()
    offsets, widths = {}, {}
    for i, c in enumerate(names):
        lo, hi = row[f"lo{i}"], row[f"hi{i}"]
        if lo is None:
            continue
        if lo == hi:
            offsets[c], widths[c] = lo, 1.0
        elif method == "minmax":
            offsets[c], widths[c] = lo, hi - lo
        else:
            offsets[c], widths[c] = row[f"mean{i}"], row[f"dev{i}"]
    return Scaler(offsets, widths)
