"""Exact quantiles in a few bounded aggregates.

``percentile`` keeps every distinct value of a column in one buffer. Here a sketch proposes cut values, a counting pass
says on which side of them the wanted rank lies, and only a small counted remainder is ever gathered.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.columns import number

SKETCH_ACCURACY = 10_000
GATHER_ROWS = 20_000
MARGIN = 4.0 / SKETCH_ACCURACY
# share of the rows that can lie between the two cuts: the margin on both sides and the sketch's error at both ends
BETWEEN = 2 * MARGIN + 2.0 / SKETCH_ACCURACY


@dataclass
class _Search:
    """One order statistic: ``rank`` (0-based) lies strictly between ``low`` and ``high``."""

    column: str
    rank: int
    below: int
    inside: int
    low: float | None = None
    high: float | None = None
    cuts: tuple[float, ...] = ()
    answer: float | None = None

    @property
    def span(self) -> tuple[str, float | None, float | None]:
        return (self.column, self.low, self.high)

    @property
    def centre(self) -> float:
        return (self.rank - self.below + 0.5) / self.inside


def _sketch(value: Column, centre: float) -> Column:
    """Two values that enclose the wanted rank but for the error of the sketch."""
    ends = [max(0.0, centre - MARGIN), min(1.0, centre + MARGIN)]
    return F.percentile_approx(value, ends, SKETCH_ACCURACY)


def _within(value: Column, low: float | None, high: float | None) -> Column:
    kept = value
    if low is not None:
        kept = F.when(value > F.lit(low), kept)
    if high is not None:
        kept = F.when(value < F.lit(high), kept)
    return kept


def _one_row(df: DataFrame, exprs: list[Column]) -> list:
    return list(df.agg(*[e.alias(f"x{i}") for i, e in enumerate(exprs)]).first())


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of several columns; missing values are left out, all-missing gives ``None``."""
    columns = list(columns)
    if not columns:
        return {}
    values = {c: number(df, c) for c in columns}
    # the first pass counts and sketches at once
    first = _one_row(df, [F.count(values[c]) for c in columns] + [_sketch(values[c], p) for c in columns for p in probs])
    totals, cuts = dict(zip(columns, first)), iter(first[len(columns) :])

    searches: dict[tuple[str, int], _Search] = {}
    for c in columns:
        for p in probs:
            pair = next(cuts)
            if totals[c]:
                spot = p * (totals[c] - 1)
                for rank in {math.floor(spot), math.ceil(spot)}:
                    searches.setdefault((c, rank), _Search(c, rank, 0, totals[c], cuts=tuple(pair)))
    while open_ := [s for s in searches.values() if s.answer is None]:
        _propose(df, values, [s for s in open_ if not s.cuts])
        _narrow(df, values, open_)

    out: dict[str, list[float | None]] = {}
    for c in columns:
        row: list[float | None] = []
        for p in probs:
            if not totals[c]:
                row.append(None)
                continue
            spot = p * (totals[c] - 1)
            lo, hi = searches[(c, math.floor(spot))].answer, searches[(c, math.ceil(spot))].answer
            row.append(lo + (hi - lo) * (spot - math.floor(spot)) if hi != lo else lo)
        out[c] = row
    return out


def _propose(df: DataFrame, values: dict[str, Column], group: list[_Search]) -> None:
    if group:
        pairs = _one_row(df, [_sketch(_within(values[s.column], s.low, s.high), s.centre) for s in group])
        for s, pair in zip(group, pairs):
            s.cuts = tuple(pair)


def _narrow(df: DataFrame, values: dict[str, Column], group: list[_Search]) -> None:
    """Count at the cuts; where the rows between them are few enough by the sketch's bound, gather them as well."""
    spots = sorted({(s.column, x) for s in group for x in s.cuts})
    spans = sorted({(s.column, *s.cuts) for s in group if s.inside * BETWEEN <= GATHER_ROWS and s.cuts[0] < s.cuts[1]})
    row = _one_row(
        df,
        [F.count_if(values[c] < F.lit(x)) for c, x in spots]
        + [F.count_if(values[c] <= F.lit(x)) for c, x in spots]
        + [F.sort_array(F.collect_list(_within(values[c], a, b))) for c, a, b in spans],
    )
    less = dict(zip(spots, row))
    upto = dict(zip(spots, row[len(spots) :]))
    lists = dict(zip(spans, row[2 * len(spots) :]))
    for s in group:
        end = s.below + s.inside
        for x in s.cuts:
            if less[(s.column, x)] <= s.rank < upto[(s.column, x)]:
                s.answer = x
            elif s.rank < less[(s.column, x)] and (s.high is None or x < s.high):
                s.high, end = x, less[(s.column, x)]
            elif s.rank >= upto[(s.column, x)] and (s.low is None or x > s.low):
                s.low, s.below = x, upto[(s.column, x)]
        s.inside, s.cuts = end - s.below, ()
        if s.answer is None and s.span in lists:
            s.answer = lists[s.span][s.rank - s.below]
