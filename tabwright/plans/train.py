"""Split, balance, fit, cross-validate, search, save and evaluate several model types."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame

from tabwright.functions.stage import materialise, scratch_scope
from tabwright.operators.evaluate import model_comparison
from tabwright.operators.models import FittedModel, fit_model
from tabwright.operators.profile import check_features
from tabwright.operators.split import class_counts, written_parts
from tabwright.operators.target import to_severity
from tabwright.operators.tune import Balance, Folds, Scores, SearchResult, cross_validate, search
from tabwright.plans.evaluate import Evaluation, evaluate_model
from tabwright.plans.preprocess import IS_TEST, fit_rows
from tabwright.sources.models import save_model
from tabwright.sources.tables import write_csv
from tabwright.spec import PipelineSpec

log = logging.getLogger(__name__)

LABEL = "__class"


@dataclass
class Prepared:
    """Train and test rows with their class, and the balanced training table."""

    train: DataFrame
    test: DataFrame
    ready: DataFrame
    weight: str | None
    counts: dict
    features: list[str]
    key: list[str]
    balance: Balance
    made: dict[tuple, Folds] = field(default_factory=dict)

    def folds(self, k: int, seed: int, balanced: bool = False) -> Folds:
        """Folds of the training rows (``balanced``: of the balanced ones), made once for all model types."""
        if (k, seed, balanced) not in self.made:
            table, key, balance = (self.ready, ["row_key"], Balance()) if balanced else (self.train, self.key, self.balance)
            self.made[k, seed, balanced] = Folds(table, self.features, LABEL, key, k, seed, balance)
        return self.made[k, seed, balanced]


@dataclass
class TrainingResult:
    data_info: dict[str, Any]
    test: DataFrame
    models: dict[str, FittedModel] = field(default_factory=dict)
    evaluations: dict[str, Evaluation] = field(default_factory=dict)
    cross_validation: dict[str, Scores] = field(default_factory=dict)
    searches: dict[str, SearchResult] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)
    comparison: DataFrame | None = None
    best: str | None = None


def prepare(df: DataFrame, spec: PipelineSpec, features: Sequence[str], key: Sequence[str]) -> Prepared:
    """Map the target, check, split exactly by class, balance the training part only."""
    if spec.target not in df.columns:
        raise ValueError(f"target column {spec.target!r} not in the table")
    absent = [c for c in features if c not in df.columns]
    if absent:
        raise ValueError(f"missing feature columns: {absent}")
    labelled = to_severity(df, spec.target, spec.severity_mapping, spec.unmapped_class, LABEL)
    check_features(labelled, features, LABEL)
    if IS_TEST in labelled.columns:
        train, test = materialise(fit_rows(labelled)), materialise(labelled.where(IS_TEST))
    else:
        train, test = written_parts(labelled, LABEL, key, spec.test_size, spec.random_state)
    balance = Balance(spec.handle_imbalance, tuple(key), spec.random_state, spec.smote_strategy, spec.smote_neighbours)
    with scratch_scope(df.sparkSession):
        ready, weight = balance.apply(train, features, LABEL)
        if spec.handle_imbalance != "none":
            ready = materialise(ready, outlast=True)
    return Prepared(train, test, ready, weight, class_counts(ready, LABEL), list(features), list(key), balance)


def train_models(
    df: DataFrame,
    spec: PipelineSpec,
    key: Sequence[str],
    features: Sequence[str] | None = None,
    output: str | None = None,
) -> TrainingResult:
    """Train every model type of the spec; one that fails is listed with its error and the others go on."""
    spark = df.sparkSession
    fixed = {*spec.untouched, *key, IS_TEST}
    features = list(features) if features else [c for c in df.columns if c not in fixed]
    data = prepare(df, spec, features, key)
    n_train, n_test = sum(data.counts.values()), data.test.count()
    result = TrainingResult(
        {
            "total_samples": data.train.count() + n_test,
            "training_samples": n_train,
            "test_samples": n_test,
            "n_features": len(features),
            "target_column": spec.target,
            "imbalance_method": spec.handle_imbalance,
        },
        data.test.drop(LABEL),
    )
    for kind in spec.model_types():
        try:
            _train_one(kind, data, spec, result)
            if output:
                save_model(result.models[kind], spark, f"{output}/{kind}", kind)
                result.evaluations[kind].write(f"{output}/{kind}_evaluation")
                if kind in result.searches:
                    write_csv(result.searches[kind].table(df).coalesce(1), f"{output}/{kind}_search.csv", validate=False)
        except Exception as e:
            log.error("model %s failed: %s", kind, e)
            result.errors[kind] = str(e)
    if result.evaluations:
        ranked = {k: e.metrics.first().f1_macro for k, e in result.evaluations.items()}
        result.best = max(ranked, key=ranked.get)
        if output:
            save_model(result.models[result.best], spark, f"{output}/best_model", "best_model")
    if len(result.evaluations) > 1:
        result.comparison = model_comparison({k: e.metrics for k, e in result.evaluations.items()})
        if output:
            write_csv(result.comparison.coalesce(1), f"{output}/model_comparison.csv", validate=False)
    return result


def _train_one(kind: str, data: Prepared, spec: PipelineSpec, result: TrainingResult) -> None:
    params = spec.model_params.get(kind)
    seed = spec.random_state
    if spec.optimize_hyperparameters:
        folds = data.folds(spec.search_cv, seed)
        found = search(
            data.train,
            data.features,
            LABEL,
            data.key,
            kind,
            spec.search_spaces.get(kind),
            spec.search_method,
            spec.search_cv,
            spec.search_n_iter,
            seed=seed,
            balance=data.balance,
            refit=False,
            folds=folds,
        )
        result.searches[kind] = found
        params = found.best_params
    model = fit_model(data.ready, data.features, LABEL, kind, params, seed, data.weight, data.counts)
    if spec.n_splits >= 2:
        balanced = spec.balance_before_cv and spec.handle_imbalance == "smote"
        result.cross_validation[kind] = cross_validate(
            data.train, data.features, LABEL, data.key, kind, params, spec.n_splits, seed=seed,
            folds=data.folds(spec.n_splits, seed, balanced),
        )
    identifiers = [c for c in spec.untouched if c in data.test.columns]
    result.models[kind] = model
    result.evaluations[kind] = evaluate_model(model, data.test, LABEL, data.key, kind, identifiers)
