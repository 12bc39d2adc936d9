"""Principal components."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import zip_longest

import numpy as np
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.columns import any_missing, number, number_sql, numeric_only, quoted

log = logging.getLogger(__name__)

# Fixed value.
VARIANCE_THRESHOLD = 0.95
SUMMED_FEATURES = 20


@dataclass(frozen=True)
class Components:
    """Means and loadings; ``loadings[k][j]`` is the weight of feature ``j`` in component ``k``."""

    features: list[str]
    means: list[float]
    loadings: list[list[float]]
    ratios: list[float]

    def transform(self, df: DataFrame) -> DataFrame:
        """Centred projection onto ``PC1..PCk``; the inputs are dropped."""
        if not self.loadings:
            return df
        scores = []
        for k, weights in enumerate(self.loadings):
            terms = [
                (number(df, c) - F.lit(m)) * F.lit(w) for c, m, w in zip(self.features, self.means, weights)
            ]
            while len(terms) > 1:  # in pairs, so that hundreds of features don't make a chain as deep
                terms = [a if b is None else a + b for a, b in zip_longest(terms[::2], terms[1::2])]
            scores.append(terms[0].alias(f"PC{k + 1}"))
        return df.select(*[quoted(c) for c in df.columns if c not in self.features], *scores)

    def variance_rows(self) -> list[tuple[str, float, float]]:
        rows, total = [], 0.0
        for k, r in enumerate(self.ratios):
            total += r
            rows.append((f"PC{k + 1}", r, total))
        return rows

    def variance_table(self, df: DataFrame) -> DataFrame:
        """Rows ``component, ratio, cumulative``."""
        return df.sparkSession.createDataFrame(
            self.variance_rows(), "component string, ratio double, cumulative double"
        )


def fit_components(
    df: DataFrame,
    features: Sequence[str],
    n_components: int,
    method: str = "pca",
    variance_threshold: float = VARIANCE_THRESHOLD,
) -> Components:
    """Components of the centred, unscaled features; the largest loading of each is positive.

    With no more features than components, or an unknown method, nothing is reduced.
    """
    names = numeric_only(df, features)
    if method != "pca":
        log.warning("unknown reduction method %r, skipped", method)
        return Components([], [], [], [])
    if len(names) <= n_components:
        log.warning("%d features for %d components, reduction skipped", len(names), n_components)
        return Components([], [], [], [])
    stats = [F.avg(number(df, c)).alias(f"m{i}") for i, c in enumerate(names)]
    holes = F.count_if(any_missing(df, names)).alias("holes")
    row = df.agg(*stats, holes).first()
    if row.holes:
        raise ValueError(f"{row.holes} rows miss a value in the features to reduce")
    means = [row[f"m{i}"] for i in range(len(names))]
    # centring first keeps the covariance free of cancellation
    centred = df.selectExpr(*[f"{number_sql(df, c)} - {m!r}D AS f{i}" for i, (c, m) in enumerate(zip(names, means))])
    vectors, ratios = (_by_sums if len(names) <= SUMMED_FEATURES else _by_vectors)(centred, n_components)
    loadings = [[float(x) if max(v, key=abs) > 0 else -float(x) for x in v] for v in vectors]
    if sum(ratios) < variance_threshold:
        log.warning("components explain %.3f of the variance, below %.2f", sum(ratios), variance_threshold)
    return Components(names, means, loadings, ratios)


def _by_sums(centred: DataFrame, k: int) -> tuple[list, list[float]]:
    """All products in one aggregate; only the small matrix of sums reaches the driver."""
    d = len(centred.columns)
    cells = [(i, j) for i in range(d) for j in range(i, d)]
    sums = centred.agg(*[F.expr(f"sum(f{i} * f{j}) AS s{i}_{j}") for i, j in cells]).first()
    matrix = np.zeros((d, d))
    for (i, j), total in zip(cells, sums):
        matrix[i, j] = matrix[j, i] = total
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(values)[::-1][:k]
    return [vectors[:, i] for i in order], [float(values[i] / values.sum()) for i in order]


def _by_vectors(centred: DataFrame, k: int) -> tuple[list, list[float]]:
    """For many features: distributed covariance over vectors."""
    vectors = VectorAssembler(inputCols=centred.columns, outputCol="v").transform(centred).select("v")
    model = PCA(k=k, inputCol="v", outputCol="p").fit(vectors)
    return list(model.pc.toArray().T), [float(x) for x in model.explainedVariance.toArray()]
