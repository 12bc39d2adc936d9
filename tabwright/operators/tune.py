"""Cross-validation and parameter search over distributed fits."""

from __future__ import annotations

import itertools
import json
import logging
import random
import statistics
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.stage import materialise, scratch_scope
from tabwright.functions.vectors import widths
from tabwright.operators.balance import NEIGHBOURS, smote, with_class_weights
from tabwright.operators.evaluate import METRICS, summary_metrics
from tabwright.operators.models import PARALLEL_FITS, FittedModel, assembled, fit_model, model_kind, spark_params
from tabwright.operators.split import SEED, assign_folds, class_counts

log = logging.getLogger(__name__)

# Fixed defaults.
CV_FOLDS = 5
SEARCH_FOLDS = 3
SEARCH_METHODS = ("grid", "random")
SEARCH_ITERATIONS = 50
SCORING = "f1_macro"
#: Models that one scan of the folds scores.
SCORED_AT_ONCE = 12
#: Coefficients that the driver holds in such models; at least one model at a time is fitted and scored.
HELD_COEFFICIENTS = 1 << 22
# The candidate values of each parameter.
SEARCH_SPACES: dict[str, dict[str, list]] = {
    "lr": {
        "C": [0.001, 0.01, 0.1, 1.0, 10.0, 100.0, 1000.0],
        "solver": ["lbfgs", "liblinear", "newton-cg"],
        "max_iter": [1000, 2000, 3000],
        "penalty": ["l2"],
    },
    "rf": {
        "n_estimators": [50, 100, 200, 300, 500],
        "max_depth": [None, 5, 10, 15, 20, 30],
        "min_samples_split": [2, 5, 10, 15, 20],
        "min_samples_leaf": [1, 2, 4, 6, 8],
        "max_features": ["sqrt", "log2", None],
        "bootstrap": [True, False],
    },
    "xgboost": {
        "n_estimators": [50, 100, 200, 300, 500],
        "max_depth": [3, 4, 5, 6, 8, 10],
        "learning_rate": [0.01, 0.05, 0.1, 0.15, 0.2, 0.3],
        "subsample": [0.7, 0.8, 0.9, 1.0],
        "colsample_bytree": [0.7, 0.8, 0.9, 1.0],
        "reg_alpha": [0, 0.1, 0.5, 1.0],
        "reg_lambda": [0, 0.1, 0.5, 1.0],
    },
}


@dataclass(frozen=True)
class Balance:
    """How a training table is balanced before a fit."""

    method: str = "none"
    key: tuple[str, ...] = ()
    seed: int = SEED
    strategy: str = "auto"
    neighbours: int = NEIGHBOURS

    def __post_init__(self):
        if self.method not in ("smote", "class_weight", "none"):
            raise ValueError(f"unknown imbalance method {self.method!r}")

    def apply(self, df: DataFrame, features: Sequence[str], label: str) -> tuple[DataFrame, str | None]:
        """The balanced table and the name of its weight column, if any."""
        if self.method == "smote":
            return smote(df, features, label, self.key, self.seed, self.strategy, self.neighbours), None
        if self.method == "class_weight":
            return with_class_weights(df, label, name="__weight"), "__weight"
        return df, None


@dataclass
class Scores:
    """Scores of one parameter choice over the folds."""

    params: dict
    test: list[float]
    train: list[float] = field(default_factory=list)

    @property
    def mean(self) -> float:
        return statistics.fmean(self.test)

    def row(self) -> tuple:
        train = self.train or [None]
        known = self.train or None
        return (
            json.dumps(self.params, sort_keys=True),
            self.mean,
            statistics.pstdev(self.test),
            statistics.fmean(train) if known else None,
            statistics.pstdev(train) if known else None,
        )


SCORE_SCHEMA = "params string, mean_test double, std_test double, mean_train double, std_train double"


@dataclass
class _Fold:
    fitted_on: DataFrame
    weight: str | None
    counts: dict


class Folds:
    """Train and test parts of every fold, balanced inside the fold and kept for all candidates."""

    def __init__(self, df: DataFrame, features: Sequence[str], label: str, key: Sequence[str], k: int, seed: int, balance: Balance):
        self.label, self.features = label, list(features)
        columns = list(dict.fromkeys([*features, label, *key]))
        marked = assign_folds(df.select(*[F.col(f"`{c}`") for c in columns]), label, key, k, seed, "__fold")
        # every fit of every candidate reads these tables: written once, they outlive lost executors
        self.marked = materialise(marked)
        self.folds: list[_Fold] = []
        for i in range(k):
            train = self.marked.where(F.col("__fold") != i).drop("__fold")
            with scratch_scope(df.sparkSession):
                ready, weight = balance.apply(train, features, label)
                if balance.method != "none":
                    ready = materialise(ready, outlast=True)
            self.folds.append(_Fold(ready, weight, class_counts(ready, label)))

    def score_all(self, model_type: str, candidates: Sequence[dict | None], seed: int, scoring: str, with_train: bool) -> list[Scores]:
        """Scores of every candidate; models are fitted side by side and scored together, SCORED_AT_ONCE per scan, or as many as fit."""
        if scoring not in METRICS:
            raise ValueError(f"unknown scoring {scoring!r}, available: {METRICS}")

        def fit(job: tuple[int, int]) -> FittedModel:
            f = self.folds[job[1]]
            return fit_model(f.fitted_on, self.features, self.label, model_type, candidates[job[0]], seed, f.weight, f.counts)

        jobs = [(c, i) for c in range(len(candidates)) for i in range(len(self.folds))]
        run = inheritable_thread_target(self.marked.sparkSession)(fit)
        found: dict[tuple, float] = {}
        step = self._at_once(model_type)
        with ThreadPoolExecutor(PARALLEL_FITS) as pool:
            for at in range(0, len(jobs), step):
                some = jobs[at : at + step]
                found |= self._scored(model_type, dict(zip(some, pool.map(run, some))), scoring, with_train)
        out = []
        for c, params in enumerate(candidates):
            test = [found[c, i, True] for i in range(len(self.folds))]
            out.append(Scores(dict(params or {}), test, [found[c, i, False] for i in range(len(self.folds))] if with_train else []))
        return out

    def _at_once(self, model_type: str) -> int:
        """Models that are fitted before a scan; those with a coefficient for each place of a vector may be large."""
        if not model_kind(model_type).linear:
            return SCORED_AT_ONCE
        size = sum(widths(self.marked, self.features)) * max(len(f.counts) for f in self.folds)
        return max(1, min(SCORED_AT_ONCE, HELD_COEFFICIENTS // size))

    def _scored(self, model_type: str, models: dict[tuple[int, int], FittedModel], scoring: str, with_train: bool) -> dict[tuple, float]:
        """The score of each model on its test part (and on its training part), from one scan and one count."""
        vectors = assembled(self.marked, self.features, model_kind(model_type).missing, ["__fold", self.label])
        votes = []
        for n, ((c, i), model) in enumerate(models.items()):
            vectors = model.decided(vectors, f"__m{n}")
            mine = F.col("__fold") == i
            vote = F.struct(F.lit(c).alias("candidate"), F.lit(i).alias("fold"), mine.alias("test"), F.col(f"__m{n}").alias("prediction"))
            votes.append(vote if with_train else F.when(mine, vote))
        rows = vectors.select(F.col(f"`{self.label}`").alias("label"), F.explode(F.array_compact(F.array(*votes))).alias("v"))
        cells = rows.groupBy("v.candidate", "v.fold", "v.test", "label", "v.prediction").agg(F.count(F.lit(1)).alias("n"))
        scores = summary_metrics(cells, "candidate", "fold", "test").select("candidate", "fold", "test", scoring)
        return {(r.candidate, r.fold, r.test): r[scoring] for r in scores.collect()}


def cross_validate(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    key: Sequence[str],
    model_type: str,
    params: dict | None = None,
    k: int = CV_FOLDS,
    scoring: str = SCORING,
    seed: int = SEED,
    balance: Balance = Balance(),
    folds: Folds | None = None,
) -> Scores:
    """One score per fold of a stratified, seeded k-fold split, or of folds that have been made already."""
    folds = folds or Folds(df, features, label, key, k, seed, balance)
    return folds.score_all(model_type, [params], seed, scoring, with_train=False)[0]


def grid_size(space: dict[str, list]) -> int:
    size = 1
    for values in space.values():
        size *= len(values)
    return size


def grid(space: dict[str, list]) -> list[dict]:
    """Every combination of the space."""
    names = list(space)
    return [dict(zip(names, combo)) for combo in itertools.product(*[space[n] for n in names])]


def random_choices(space: dict[str, list], n: int, seed: int) -> list[dict]:
    """``n`` different combinations, seeded; all of them when the space is smaller."""
    total = grid_size(space)
    picked = range(total) if n >= total else random.Random(seed).sample(range(total), n)
    out = []
    for spot in picked:
        choice = {}
        for name in reversed(list(space)):
            spot, at = divmod(spot, len(space[name]))
            choice[name] = space[name][at]
        out.append({name: choice[name] for name in space})
    return out


@dataclass
class SearchResult:
    best_params: dict
    best_score: float
    scores: list[Scores]
    method: str
    model: FittedModel | None = None

    def table(self, df: DataFrame) -> DataFrame:
        """Rows ``params, mean_test, std_test, mean_train, std_train``."""
        return df.sparkSession.createDataFrame([s.row() for s in self.scores], SCORE_SCHEMA)


def search(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    key: Sequence[str],
    model_type: str,
    space: dict[str, list] | None = None,
    method: str = "grid",
    k: int = SEARCH_FOLDS,
    n_iter: int = SEARCH_ITERATIONS,
    scoring: str = SCORING,
    seed: int = SEED,
    balance: Balance = Balance(),
    refit: bool = True,
    folds: Folds | None = None,
) -> SearchResult:
    """Score every candidate over the same folds and refit the best on the whole balanced table.

    Candidates that mean the same to Spark (such as two solvers) share one set of fits.
    """
    space = space or SEARCH_SPACES.get(model_type, {})
    if not space:
        raise ValueError(f"no parameter space for {model_type!r}")
    if method.lower() == "grid":
        candidates = grid(space)
    elif method.lower() == "random":
        candidates = random_choices(space, n_iter, seed)
    else:
        raise ValueError(f"search method {method!r} is unsupported, there are {SEARCH_METHODS}")
    kinds = {json.dumps(spark_params(model_type, c, 1), sort_keys=True): c for c in reversed(candidates)}
    log.info("%d candidates, %d different ones, %d folds", len(candidates), len(kinds), k)
    folds = folds or Folds(df, features, label, key, k, seed, balance)
    known = dict(zip(kinds, folds.score_all(model_type, list(kinds.values()), seed, scoring, with_train=True)))
    scores = []
    for c in candidates:
        same = known[json.dumps(spark_params(model_type, c, 1), sort_keys=True)]
        scores.append(Scores(c, same.test, same.train))
    best = max(scores, key=lambda s: s.mean)
    model = None
    if refit:
        ready, weight = balance.apply(df, features, label)
        model = fit_model(ready, features, label, model_type, best.params, seed, weight)
    return SearchResult(best.params, best.mean, scores, method, model)
