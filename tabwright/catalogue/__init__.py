"""Named queries over the test tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabwright.catalogue import building, cleaning, evaluation, jobs, modelling, sampling

PARTS = (cleaning, building, sampling, evaluation, modelling, jobs)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q for part in PARTS for name, q in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in PARTS for name, sql in part.ORACLES.items()}
