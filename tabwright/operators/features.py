"""Interactions, guarded ratios, polynomial terms and date parts."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.columns import DATED, existing, is_missing, is_numeric, number, numeric_only, quoted

log = logging.getLogger(__name__)

# Fixed values.
SAFE_DENOMINATOR = 1e-10
DEGREE = 2


def as_pairs(names: Sequence[str] | None) -> list[tuple[str, str]]:
    """A flat list read two by two; a single last name is left out."""
    names = list(names or [])
    if len(names) % 2:
        log.warning("odd number of interaction columns, %r left out", names[-1])
    return list(zip(names[::2], names[1::2]))


@dataclass(frozen=True)
class Interactions:
    """Products for every pair, ratios for the pairs whose denominator was safe in the fitted table."""

    pairs: list[tuple[str, str]]
    ratios: list[tuple[str, str]]

    def transform(self, df: DataFrame) -> DataFrame:
        added = []
        for a, b in self.pairs:
            added.append((number(df, a) * number(df, b)).alias(f"{a}_{b}_interaction"))
            if (a, b) in self.ratios:
                added.append(F.try_divide(number(df, a), number(df, b)).alias(f"{a}_to_{b}_ratio"))
        return df.select("*", *added) if added else df


def fit_interactions(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> Interactions:
    """A denominator is safe when it never misses a value and never comes within 1e-10 of zero."""
    usable = []
    for a, b in pairs:
        if a in df.columns and b in df.columns and is_numeric(df, a) and is_numeric(df, b):
            usable.append((a, b))
        else:
            log.warning("pair (%s, %s) is missing or not numeric, skipped", a, b)
    below = list(dict.fromkeys(b for _, b in usable))
    if not below:
        return Interactions([], [])
    unsafe = [
        F.count_if(is_missing(df, b) | (F.abs(number(df, b)) <= F.lit(SAFE_DENOMINATOR))).alias(f"u{i}")
        for i, b in enumerate(below)
    ]
    counts = df.agg(*unsafe).first()
    safe = {b for b, n in zip(below, counts) if n == 0}
    for b in below:
        if b not in safe:
            log.warning("no ratio over %r: zero, near-zero or missing values", b)
    return Interactions(usable, [p for p in usable if p[1] in safe])


def polynomial_terms(features: Sequence[str], degree: int) -> list[tuple[str, list[str]]]:
    """Names and factors of all monomials of degree 2 to ``degree``, by degree, then in the order of the features."""
    terms = []
    for d in range(2, degree + 1):
        for combo in combinations_with_replacement(features, d):
            parts = [f"{c}^{combo.count(c)}" if combo.count(c) > 1 else c for c in dict.fromkeys(combo)]
            terms.append((" ".join(parts), list(combo)))
    return terms


def add_polynomials(
    df: DataFrame, features: Sequence[str], degree: int = DEGREE, include_bias: bool = False
) -> DataFrame:
    """Append the monomials (and a constant ``1`` if asked); the inputs stay."""
    if degree < 1:
        raise ValueError(f"polynomial degree must be >= 1, got {degree}")
    names = numeric_only(df, features)
    if not names:
        log.warning("no numeric columns for polynomial terms")
        return df
    added = [F.lit(1.0).alias("1")] if include_bias else []
    for name, factors in polynomial_terms(names, degree):
        product = number(df, factors[0])
        for c in factors[1:]:
            product = product * number(df, c)
        added.append(product.alias(name))
    return df.select("*", *added)


def date_parts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Year, month, day, weekday (Monday 0), quarter and weekend flag; the date column itself is dropped."""
    names = existing(df, columns, "date")
    added = []
    for c in names:
        kind = df.schema[c].dataType
        when = quoted(c) if isinstance(kind, DATED) else F.try_to_timestamp(quoted(c).cast("string"))
        added += [
            F.year(when).alias(f"{c}_year"),
            F.month(when).alias(f"{c}_month"),
            F.dayofmonth(when).alias(f"{c}_day"),
            F.weekday(when).alias(f"{c}_dayofweek"),
            F.quarter(when).alias(f"{c}_quarter"),
            F.coalesce((F.weekday(when) >= 5).cast("int"), F.lit(0)).alias(f"{c}_is_weekend"),
        ]
    return df.select(*[quoted(c) for c in df.columns if c not in names], *added)
