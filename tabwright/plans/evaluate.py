"""Evaluation of one or many fitted models on a table."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tabwright.functions.columns import quoted
from tabwright.functions.stage import materialise
from tabwright.operators import evaluate as ev
from tabwright.operators.models import FittedModel
from tabwright.operators.profile import check_features
from tabwright.operators.target import SEVERITY, UNMAPPED_CLASS, to_severity
from tabwright.sources.models import load_model, load_models, rows_of, write_report
from tabwright.sources.tables import read_table, write_csv, write_table

log = logging.getLogger(__name__)


@dataclass
class Evaluation:
    """All result tables of one model; predictions and the two curves may be large, the others are small."""

    name: str
    predictions: DataFrame
    metrics: DataFrame
    report: DataFrame
    confusion: DataFrame
    roc: DataFrame
    auc: DataFrame
    pr: DataFrame
    top: DataFrame
    overall: DataFrame
    analysis: DataFrame
    features: DataFrame

    def write(self, folder: str) -> None:
        """Every table below ``folder``: the small ones as CSV, predictions and curves as Parquet."""
        small = {"metrics": self.metrics, "report": self.report, "confusion": self.confusion, "auc": self.auc, "top": self.top}
        small |= {"overall": self.overall, "analysis": self.analysis, "feature_importance": self.features}
        for name, df in small.items():
            write_csv(df.coalesce(1), f"{folder}/{self.name}_{name}.csv", validate=False)
        for name, df in {"predictions": self.predictions, "roc": self.roc, "pr": self.pr}.items():
            write_table(df, f"{folder}/{self.name}_{name}")

    def summary(self) -> dict[str, Any]:
        """The bounded results as plain values, for a report."""
        return {
            "model_name": self.name,
            **self.metrics.first().asDict(),
            "classification_report": rows_of(self.report),
            "confusion_matrix": rows_of(self.confusion.orderBy("label", "prediction")),
            "auc": rows_of(self.auc.orderBy("class")),
            "top_features": rows_of(self.features),
        }


def evaluate_model(
    model: FittedModel,
    df: DataFrame,
    label: str,
    key: Sequence[str],
    name: str | None = None,
    identifiers: Sequence[str] = (),
    top_n: int = ev.TOP_ROWS,
) -> Evaluation:
    """Predict once, then derive every table from the written predictions."""
    check_features(df, model.features, label)
    riding = list(dict.fromkeys([*key, *[c for c in identifiers if c in df.columns], label]))
    predicted = model.predict(df).select(*[quoted(c) for c in riding], "prediction", "probability")
    predicted = materialise(predicted)
    # three tables are read off the running totals
    curves = materialise(ev.cumulative_scores(predicted, model.classes, label))
    # at most classes² counts and top_n rows per class: fetched once, so the tables below cost no further scan
    cells = _fetched(ev.confusion_counts(predicted, label))
    top = _fetched(ev.top_predictions(predicted, model.classes, key, identifiers, top_n, label))
    return Evaluation(
        name or model.model_type,
        predicted,
        ev.summary_metrics(cells),
        ev.report_rows(cells),
        ev.confusion_grid(cells),
        ev.roc_points(curves),
        _fetched(ev.roc_auc(curves)),
        ev.pr_points(curves),
        top,
        ev.overall_row(cells),
        ev.class_analysis(cells, top, top_n),
        ev.top_features(model.importances(), predicted),
    )


def _fetched(df: DataFrame) -> DataFrame:
    """A table of few rows, held by the driver."""
    return df.sparkSession.createDataFrame(df.toArrow())


def evaluate_saved(
    spark: SparkSession,
    model_path: str,
    table: str | DataFrame,
    target: str,
    key: Sequence[str],
    output: str | None = None,
    mapping: Mapping[str, int] = SEVERITY,
    default: int | None = UNMAPPED_CLASS,
    features: list[str] | None = None,
    identifiers: Sequence[str] = (),
    name: str | None = None,
) -> Evaluation:
    """Load a model and a table, map the target to classes, evaluate, and write a report if asked."""
    df = read_table(spark, table) if isinstance(table, str) else table
    model = load_model(spark, model_path, features)
    mapped = to_severity(df, target, mapping, default)
    name = name or model_path.rstrip("/").rsplit("/", 1)[-1]
    result = evaluate_model(model, mapped, target, key, name, identifiers)
    if output:
        result.write(output)
        write_report(spark, result.summary(), output, "single_model_evaluation")
    return result


@dataclass
class FolderEvaluation:
    evaluations: dict[str, Evaluation]
    errors: dict[str, str]
    comparison: DataFrame | None
    summary: dict[str, Any] = field(default_factory=dict)


def evaluate_folder(
    spark: SparkSession,
    folder: str,
    table: str | DataFrame,
    target: str,
    key: Sequence[str],
    output: str | None = None,
    mapping: Mapping[str, int] = SEVERITY,
    default: int | None = UNMAPPED_CLASS,
    identifiers: Sequence[str] = (),
) -> FolderEvaluation:
    """Evaluate every model below a folder; a model that fails is listed with its error."""
    models, errors = load_models(spark, folder)
    if not models and not errors:
        raise ValueError(f"no models found below {folder}")
    df = read_table(spark, table) if isinstance(table, str) else table
    mapped = to_severity(df, target, mapping, default)
    if len(models) > 1:
        mapped = materialise(mapped)  # each model reads it twice
    done: dict[str, Evaluation] = {}
    for name, model in models.items():
        try:
            done[name] = evaluate_model(model, mapped, target, key, name, identifiers)
        except Exception as e:
            log.error("evaluation of %s failed: %s", name, e)
            errors[name] = str(e)
    comparison = ev.model_comparison({n: e.metrics for n, e in done.items()}) if done else None
    widest = max((len(m.features) for m in models.values()), default=0)
    summary = {
        "total_models": len(models) + len([e for e in errors if e not in models]),
        "successful_evaluations": len(done),
        "test_samples": next(iter(done.values())).metrics.first().sample_count if done else 0,
        "n_features": widest,
        "target_column": target,
    }
    if output:
        results = {
            "evaluation_summary": summary,
            "individual_results": {**{n: e.summary() for n, e in done.items()}, **{n: {"error": t} for n, t in errors.items()}},
            "model_comparison": rows_of(comparison) if comparison is not None else [],
        }
        for e in done.values():
            e.write(output)
        if comparison is not None:
            write_csv(comparison.coalesce(1), f"{output}/model_comparison.csv", validate=False)
        write_report(spark, results, output, "multiple_models_evaluation")
    return FolderEvaluation(done, errors, comparison, summary)
