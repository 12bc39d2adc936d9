"""Univariate feature scores against a class and selection of the best."""

from __future__ import annotations

import logging
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.columns import number, numeric_only, quoted
from tabwright.functions.stage import materialise
from tabwright.functions.vectors import is_sparse
from tabwright.operators.quantiles import exact_quantiles

log = logging.getLogger(__name__)

BINS = 10


def _checked(groups: DataFrame, target: str) -> DataFrame:
    """Counts per class, written once; rows without a class are an error."""
    groups = materialise(groups)
    if not groups.where("__class is null").isEmpty():
        raise ValueError(f"missing values in target {target!r}")
    return groups


def anova_scores(df: DataFrame, features: Sequence[str], target: str) -> dict[str, float | None]:
    """One-way F statistic per feature, from one grouped aggregate; ``None`` for a constant feature."""
    aggs, entries = [], []
    for i, c in enumerate(features):
        x = number(df, c)
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}")]
        entries.append(F.struct(F.lit(i).alias("i"), F.col(f"n{i}").alias("n"), F.col(f"m{i}").alias("m"), F.col(f"v{i}").alias("v")))
    groups = _checked(df.groupBy(quoted(target).alias("__class")).agg(*aggs), target)
    rows = groups.select(F.explode(F.array(*entries)).alias("e")).select("e.*").where("n > 0")
    means = rows.groupBy("i").agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("grand"))
    parts = rows.join(F.broadcast(means), "i").groupBy("i").agg(  # one row per feature
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("k"),
        F.sum(F.col("n") * F.pow(F.col("m") - F.col("grand"), 2)).alias("between"),
        F.sum(F.col("n") * F.col("v")).alias("inner"),
    )
    out: dict[str, float | None] = dict.fromkeys(features)
    for r in parts.collect():
        if r.k >= 2 and r.n > r.k:
            inner, between = r.inner, r.between
            out[features[r.i]] = (between / (r.k - 1)) / (inner / (r.n - r.k)) if inner > 0 else (math.inf if between > 0 else None)
    return out


def mutual_information(df: DataFrame, features: Sequence[str], target: str, bins: int = BINS) -> dict[str, float | None]:
    """Mutual information (in nats) of each feature, cut at its exact quantiles, with the class."""
    edges = exact_quantiles(df, features, [i / bins for i in range(1, bins)])
    entries = []
    for i, c in enumerate(features):
        x = number(df, c)
        cuts = sorted({e for e in edges[c] if e is not None})
        cell = sum(((x > F.lit(e)).cast("int") for e in cuts), F.lit(0))
        entries.append(F.struct(F.lit(i).alias("i"), F.when(x.isNotNull(), cell).alias("bin")))
    rows = df.select(quoted(target).alias("__class"), F.explode(F.array(*entries)).alias("e"))
    cells = _checked(rows.where("e.bin is not null").groupBy("e.i", "e.bin", "__class").agg(F.count(F.lit(1)).alias("n")), target)
    by_bin = cells.groupBy("i", "bin").agg(F.sum("n").alias("of_bin"))
    by_class = cells.groupBy("i", "__class").agg(F.sum("n").alias("of_class"))
    whole = cells.groupBy("i").agg(F.sum("n").alias("of_all"))
    wide = cells.join(F.broadcast(by_bin), ["i", "bin"]).join(by_class, ["i", "__class"]).join(F.broadcast(whole), "i")
    ratio = F.col("n") * F.col("of_all") / (F.col("of_bin") * F.col("of_class"))
    scores = wide.groupBy("i").agg(F.sum(F.col("n") / F.col("of_all") * F.log(ratio)).alias("score"))
    out: dict[str, float | None] = dict.fromkeys(features)
    out.update((features[r.i], r.score) for r in scores.collect())
    return out


@dataclass(frozen=True)
class Selection:
    """Scores of all candidates and the chosen names in table order; sparse vectors have no score and stay."""

    target: str
    scores: dict[str, float | None]
    chosen: list[str]

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """The chosen features and the target; ``keep`` names columns that ride along."""
        if not self.chosen:
            return df
        tail = [self.target] if self.target in df.columns else []
        front = [c for c in keep if c not in self.chosen and c not in tail]
        wide = [c for c in df.columns if is_sparse(df, c) and c not in front]
        return df.select(*[quoted(c) for c in [*front, *self.chosen, *wide, *tail]])

    def score_table(self, df: DataFrame) -> DataFrame:
        """Rows ``feature, score, selected``, best first."""
        rows = [(c, s, c in self.chosen) for c, s in self.scores.items()]
        table = df.sparkSession.createDataFrame(rows, "feature string, score double, selected boolean")
        return table.orderBy(F.col("score").desc_nulls_last(), "feature")


def fit_selection(
    df: DataFrame, features: Sequence[str], target: str, n_features: int, method: str = "f_test"
) -> Selection:
    """Keep the ``n_features`` best; with no more candidates than that, all numeric candidates are kept."""
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not in the table")
    names = [c for c in numeric_only(df, features) if c != target]
    if not names:
        log.warning("no numeric columns to select from")
        return Selection(target, {}, [])
    if len(names) <= n_features:
        return Selection(target, {c: None for c in names}, names)
    if method == "mutual_info":
        scores = mutual_information(df, names, target)
    else:
        if method != "f_test":
            log.warning("unknown selection method %r, using f_test", method)
        scores = anova_scores(df, names, target)
    # worst first; among equal scores the later column is the better one
    ordered = sorted(range(len(names)), key=lambda i: (scores[names[i]] is not None, scores[names[i]] or 0.0, i))
    best = set(ordered[-n_features:]) if n_features > 0 else set()
    return Selection(target, scores, [c for i, c in enumerate(names) if i in best])
