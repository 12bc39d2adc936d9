"""Saving and loading fitted models and evaluation reports."""

from __future__ import annotations

import json
import logging
from datetime import datetime, timezone
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.operators.boost import BoostedTrees
from tabwright.operators.models import FittedModel
from tabwright.operators.sparse_trees import SparseTrees

log = logging.getLogger(__name__)

META_SCHEMA = "model_name string, model_type string, features array<string>, classes string, params string, seed int, parts int, widths array<int>, grown boolean"


def save_model(model: FittedModel, spark: SparkSession, path: str, name: str | None = None) -> str:
    """Write the MLlib models and one JSON row that describes them."""
    if not model.parts:
        raise ValueError("cannot save a model that is not fitted")
    grown = isinstance(model.parts[0], (BoostedTrees, SparseTrees))
    for i, part in enumerate(model.parts):
        if grown:
            spark.createDataFrame([(part.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/part_{i}")
            continue
        PipelineModel([part]).write().overwrite().save(f"{path}/part_{i}")
    row = (
        name or model.model_type,
        model.model_type,
        model.features,
        json.dumps(model.classes),
        json.dumps(model.params),
        model.seed,
        len(model.parts),
        model.widths,
        grown,
    )
    spark.createDataFrame([row], META_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{path}/about")
    return path


def load_model(
    spark: SparkSession, path: str, features: list[str] | None = None, classes: list | None = None
) -> FittedModel:
    """Read a saved model; a bare MLlib pipeline is accepted too, with its feature names given."""
    try:
        about = spark.read.schema(META_SCHEMA).json(f"{path}/about").first()
    except Exception:
        about = None
    if about is None:
        if features is None:
            raise FileNotFoundError(f"no model description under {path}; give the feature names of a bare model")
        bare = PipelineModel.load(path).stages[-1]
        return FittedModel("bare", list(features), classes or list(range(bare.numClasses)), {}, 0, [bare])
    if about.grown:
        texts = [spark.read.text(f"{path}/part_{i}").first().value for i in range(about.parts)]
        parts = [(SparseTrees if json.loads(text).get("sparse") else BoostedTrees).from_json(text) for text in texts]
    else:
        parts = [PipelineModel.load(f"{path}/part_{i}").stages[0] for i in range(about.parts)]
    return FittedModel(
        about.model_type, list(about.features), json.loads(about.classes), json.loads(about.params), about.seed, parts, about.widths
    )


def find_models(spark: SparkSession, folder: str) -> dict[str, str]:
    """Path of every model below ``folder`` at any depth, described or bare, by its path below ``folder``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    about = files.option("pathGlobFilter", "*.json").load(folder).select(F.regexp_extract("path", r"^(.*)/about/[^/]*$", 1).alias("path"))
    # a bare pipeline is a folder with metadata and stages; those inside a described model belong to it
    metadata = files.option("pathGlobFilter", "part-*").load(folder).select(F.regexp_extract("path", r"^(.*)/metadata/[^/]*$", 1).alias("path"))
    described = sorted({r.path for r in about.where("path <> ''").distinct().collect()})
    others = sorted({r.path for r in metadata.where("path <> ''").distinct().collect()})
    bare = [p for p in others if not any(p.startswith(f"{d}/") for d in [*described, *(o for o in others if o != p)])]
    root = folder.split("://")[-1].removeprefix("file:").strip("/")
    return {p.split(root, 1)[-1].strip("/") or p.rsplit("/", 1)[-1]: p for p in sorted([*described, *bare])}


def load_models(spark: SparkSession, folder: str) -> tuple[dict[str, FittedModel], dict[str, str]]:
    """All readable models below ``folder``, and the error text of each one that is not."""
    models, errors = {}, {}
    for name, path in find_models(spark, folder).items():
        try:
            models[name] = load_model(spark, path)
        except Exception as e:
            log.error("model %s at %s cannot be read: %s", name, path, e)
            errors[name] = str(e)
    return models, errors


def write_report(spark: SparkSession, results: dict[str, Any], folder: str, name: str = "evaluation_report") -> str:
    """One JSON line: metadata and the (small) results."""
    path = f"{folder}/{name}"
    meta = {"report_generated_at": datetime.now(timezone.utc).isoformat(), "evaluation_output_dir": folder}
    text = json.dumps({"metadata": meta, **results}, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def rows_of(df: DataFrame) -> list[dict]:
    """Rows of a table whose size is bounded by classes or models."""
    return [r.asDict(recursive=True) for r in df.collect()]
