"""The four modes of a run, chained over written tables."""

from __future__ import annotations

import hashlib
import json
import logging
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.keys import row_digest, with_content_key
from tabwright.functions.stage import materialise
from tabwright.operators.encode import OneHotEncoder
from tabwright.operators.profile import validate_table
from tabwright.plans.evaluate import Evaluation, evaluate_saved
from tabwright.plans.featurise import FittedFeatures, fit_features
from tabwright.plans.preprocess import ROW_ID, FittedPreprocessing, fit_preprocessing, mark_test_rows
from tabwright.plans.train import TrainingResult, train_models
from tabwright.sources.models import find_models, load_model, write_report
from tabwright.sources.tables import read_table, write_table
from tabwright.spec import PipelineSpec

log = logging.getLogger(__name__)

MODES = ("preprocess", "feature", "train", "evaluate", "full")


@dataclass
class RunResult:
    """What each stage of the run produced."""

    paths: dict[str, str] = field(default_factory=dict)
    preprocessing: FittedPreprocessing | None = None
    features: FittedFeatures | None = None
    training: TrainingResult | None = None
    evaluation: Evaluation | None = None


class _Finished:
    """Which stages of a run are done, by a line each below ``output``; a line counts for the same input and settings only."""

    def __init__(self, spark: SparkSession, output: str, spec: PipelineSpec, table: DataFrame, resume: bool):
        self.spark, self.folder, self.resume, self.mark = spark, f"{output}/finished", resume, ""
        if resume:
            # counts and two sums of row digests tell whether the table is the one of before, in whatever order
            digest = row_digest(table)
            halves = [F.conv(F.substring(digest, i, 15), 16, 10).cast("decimal(38,0)") for i in (1, 17)]
            row = table.agg(F.count(F.lit(1)), *[F.sum(h) for h in halves]).first()
            text = json.dumps([asdict(spec), table.schema.simpleString(), [str(x) for x in row]], sort_keys=True, default=str)
            self.mark = hashlib.sha256(text.encode()).hexdigest()

    def has(self, stage: str) -> bool:
        if not self.resume:
            return False
        try:
            done = self.spark.read.text(f"{self.folder}/{stage}").first().value == self.mark
        except Exception:
            done = False
        if done:
            log.info("stage %s was finished before", stage)
        return done

    def add(self, stage: str) -> None:
        if self.resume:
            self.spark.createDataFrame([(self.mark,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.folder}/{stage}")


def run(
    spark: SparkSession, spec: PipelineSpec, table: str | DataFrame, output: str, mode: str = "full", resume: bool = False
) -> RunResult:
    """Run one mode, or all of them in order; each stage reads what the one before has written.

    With ``resume`` each finished stage is noted below ``output``, and a run that was broken off goes on after the last one
    when it is started again with the same table and settings. What a skipped training has fitted is read from its files.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, available: {MODES}")
    result = RunResult()
    current = read_table(spark, table, **spec.csv) if isinstance(table, str) else table
    encoded: list[str] = []
    validate_table(current, "input table")
    finished = _Finished(spark, output, spec, current, resume)
    if mode in ("preprocess", "full"):
        if finished.has("preprocess"):
            result.preprocessing = FittedPreprocessing.read(spark, f"{output}/fitted/preprocessing")
            current = _read_back(spark, f"{output}/preprocessed_data", result, "preprocessed")
        else:
            if spec.fit_on == "train":
                current = mark_test_rows(current, spec)
            result.preprocessing, done = fit_preprocessing(current, spec)
            result.preprocessing.write(spark, f"{output}/fitted/preprocessing")
            current = _written(spark, done, f"{output}/preprocessed_data", result, "preprocessed")
            finished.add("preprocess")
        if isinstance(result.preprocessing.encoder, OneHotEncoder):
            encoded = result.preprocessing.encoder.names()
    if mode in ("feature", "full"):
        if finished.has("feature"):
            result.features = FittedFeatures.read(spark, f"{output}/fitted/features")
            current = _read_back(spark, f"{output}/featured_data", result, "featured")
        else:
            result.features = fit_features(current, spec, encoded)
            result.features.write(spark, f"{output}/fitted/features")
            current = _written(spark, result.features.transform(current), f"{output}/featured_data", result, "featured")
            finished.add("feature")
    key = spec.key or [c for c in [ROW_ID] if c in current.columns]
    if mode in ("train", "evaluate") and not key:
        current, key = materialise(with_content_key(current, ROW_ID, distinct=False)), [ROW_ID]
    if mode in ("train", "full"):
        if finished.has("train"):
            result.training = _training_read_back(spark, f"{output}/models", spark.read.parquet(f"{output}/test_data"))
            current = _read_back(spark, f"{output}/test_data", result, "test")
        else:
            result.training = train_models(current, spec, key, output=f"{output}/models")
            write_report(spark, _training_summary(result.training), output, "training_report")
            if mode == "full" and result.training.best is None:
                raise RuntimeError(f"no model could be trained: {result.training.errors}")
            if mode == "full":
                # the evaluation sees only rows that no model was trained on
                current = _written(spark, result.training.test, f"{output}/test_data", result, "test")
                finished.add("train")
    if mode in ("evaluate", "full"):
        result.evaluation = evaluate_saved(
            spark,
            f"{output}/models/best_model",
            current,
            spec.target,
            key,
            f"{output}/evaluation",
            spec.severity_mapping,
            spec.unmapped_class,
            identifiers=spec.untouched,
        )
    return result


def score(spark: SparkSession, table: str | DataFrame, output: str, **csv) -> DataFrame:
    """Predictions for a new raw table by what a full run has written: its preprocessing, its features, its best model."""
    raw = read_table(spark, table, **csv) if isinstance(table, str) else table
    prepared = FittedPreprocessing.read(spark, f"{output}/fitted/preprocessing").transform(raw)
    featured = FittedFeatures.read(spark, f"{output}/fitted/features").transform(prepared)
    return load_model(spark, f"{output}/models/best_model").predict(featured)


def _written(spark: SparkSession, df: DataFrame, path: str, result: RunResult, name: str) -> DataFrame:
    write_table(df, path)
    result.paths[name] = path
    return spark.read.parquet(path)


def _read_back(spark: SparkSession, path: str, result: RunResult, name: str) -> DataFrame:
    result.paths[name] = path
    return spark.read.parquet(path)


def _training_read_back(spark: SparkSession, folder: str, test: DataFrame) -> TrainingResult:
    """The models of a training that was finished before; its tables and scores are in its reports."""
    models = {name: load_model(spark, path) for name, path in find_models(spark, folder).items()}
    best = models.pop("best_model", None)
    return TrainingResult({}, test, models, best=best.model_type if best else None)


def _training_summary(training: TrainingResult) -> dict[str, Any]:
    return {
        "data_info": training.data_info,
        "models": {
            **{k: e.summary() for k, e in training.evaluations.items()},
            **{k: {"error": t} for k, t in training.errors.items()},
        },
        "cross_validation": {
            k: {"cv_scores": s.test, "cv_mean": s.mean, "cv_std": s.row()[2]} for k, s in training.cross_validation.items()
        },
        "hyperparameter_search": {
            k: {"best_params": s.best_params, "best_score": s.best_score, "n_candidates": len(s.scores)}
            for k, s in training.searches.items()
        },
        "best_model": training.best,
    }
