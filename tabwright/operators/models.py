"""Classifiers: multinomial logistic regression and random forest on MLlib; grown here are boosted trees and, on sparse vectors, all
trees and regression with many places."""

from __future__ import annotations

import itertools
import logging
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType
from pyspark.storagelevel import StorageLevel

from tabwright.functions.columns import number_sql, quoted
from tabwright.functions.stage import ensure_checkpoints
from tabwright.functions.vectors import as_vectors, gathered, is_sparse, widths
from tabwright.operators.boost import BoostedTrees, fit_boosted
from tabwright.operators.sparse_logistic import fit_sparse_logistic
from tabwright.operators.sparse_trees import SparseTrees, fit_forest, fit_sparse_boosted
from tabwright.operators.split import SEED, class_counts

log = logging.getLogger(__name__)

MODEL_TYPES = ("lr", "rf", "xgboost")
# Default parameters under the names users know them by.
DEFAULTS: dict[str, dict[str, Any]] = {
    "lr": {"max_iter": 1000, "C": 1.0, "solver": "lbfgs", "penalty": "l2"},
    "rf": {
        "n_estimators": 100,
        "max_depth": None,
        "min_samples_split": 2,
        "min_samples_leaf": 1,
        "max_features": "sqrt",
        "bootstrap": True,
    },
    "xgboost": {
        "n_estimators": 100,
        "max_depth": 6,
        "learning_rate": 0.1,
        "subsample": 0.8,
        "colsample_bytree": 0.8,
        "min_child_weight": 1,
        "reg_alpha": 0.0,
        "reg_lambda": 1.0,
    },
}
# MLlib's boosting on first-order residuals, for two classes, one model per class beyond.
DEFAULTS["gbt"] = {k: v for k, v in DEFAULTS["xgboost"].items() if not k.startswith("reg_")}
# MLlib grows a forest level by level, one pass per level, and refuses more levels than this.
DEEPEST = 30
PARALLEL_FITS = 3
MISSING_VALUE = -1e300
#: Coefficients up to which MLlib fits a regression; its driver holds some thirty vectors of them.
MLLIB_COEFFICIENTS = 1 << 18


def _lr_params(p: dict, n: int) -> dict:
    return {"maxIter": int(p["max_iter"]), "regParam": 1.0 / (float(p["C"]) * n)}


def _rf_params(p: dict, n: int) -> dict:
    subset = {None: "all", "sqrt": "sqrt", "log2": "log2"}.get(p["max_features"], str(p["max_features"]))
    depth = DEEPEST if p["max_depth"] is None else int(p["max_depth"])
    if depth > DEEPEST:
        raise ValueError(f"max_depth {depth} is more than the {DEEPEST} levels that Spark can grow")
    return {
        "numTrees": int(p["n_estimators"]),
        "maxDepth": depth,
        "minInstancesPerNode": int(p["min_samples_leaf"]),
        "featureSubsetStrategy": subset,
        "bootstrap": bool(p["bootstrap"]),
    }


def _gbt_params(p: dict, n: int) -> dict:
    share = float(p["colsample_bytree"])
    return {
        "maxIter": int(p["n_estimators"]),
        "maxDepth": int(p["max_depth"]),
        "stepSize": float(p["learning_rate"]),
        "subsamplingRate": float(p["subsample"]),
        "featureSubsetStrategy": "all" if share >= 1.0 else str(share),
        "minInstancesPerNode": max(1, int(p["min_child_weight"])),
    }


def _boost_params(p: dict, n: int) -> dict:
    return {k: float(p[k]) for k in DEFAULTS["xgboost"]}


@dataclass(frozen=True)
class ModelKind:
    """How a model type is built: parameter translation, estimator, and whether it knows two classes only.

    ``grow`` fits a kind without an estimator, ``grow_sparse`` any kind that has it where a feature is a sparse vector. A ``linear``
    kind has a coefficient for each place of a vector.
    """

    translate: Callable[[dict, int], dict]
    estimator: Callable[..., Any] | None
    defaults: dict[str, Any]
    binary: bool = False
    missing: str = "error"
    grow: Callable[..., Any] | None = None
    grow_sparse: Callable[..., Any] | None = None
    linear: bool = False


def _lr(classes: int, seed: int, **params) -> LogisticRegression:
    family = "binomial" if classes == 2 else "multinomial"
    return LogisticRegression(family=family, elasticNetParam=0.0, standardization=False, **params)


def _lr_sparse(data: DataFrame, n_classes: int, params: dict, seed: int, weight: str | None = None):
    """The same steps on both sides of the limit; beyond it the driver keeps its vectors in files."""
    wanted = {"featuresCol": "__x", "labelCol": "__y", **({"weightCol": weight} if weight else {})}
    estimator = _lr(n_classes, seed, **wanted, **params)
    first = data.select(F.unwrap_udt("__x")["size"].alias("size")).first()
    width = first.size if first and first.size else 0
    if width * (1 if n_classes == 2 else n_classes) <= MLLIB_COEFFICIENTS:
        return estimator.fit(data)
    return fit_sparse_logistic(data, estimator, width, n_classes, weight)


def _rf(classes: int, seed: int, **params) -> RandomForestClassifier:
    return RandomForestClassifier(seed=seed, **params)


def _gbt(classes: int, seed: int, **params) -> GBTClassifier:
    return GBTClassifier(seed=seed, **params)


KINDS: dict[str, ModelKind] = {
    "lr": ModelKind(_lr_params, _lr, DEFAULTS["lr"], grow_sparse=_lr_sparse, linear=True),
    "rf": ModelKind(_rf_params, _rf, DEFAULTS["rf"], grow_sparse=fit_forest),
    "xgboost": ModelKind(_boost_params, None, DEFAULTS["xgboost"], missing="lowest", grow=fit_boosted, grow_sparse=fit_sparse_boosted),
    "gbt": ModelKind(_gbt_params, _gbt, DEFAULTS["gbt"], binary=True, missing="lowest"),
}


def register_model(name: str, kind: ModelKind) -> None:
    """Make a further model type available under ``name``."""
    KINDS[name] = kind


def model_kind(name: str) -> ModelKind:
    if name not in KINDS:
        raise ValueError(f"unknown model type {name!r}, available: {sorted(KINDS)}")
    return KINDS[name]


def full_params(model_type: str, params: dict | None) -> dict:
    """Defaults overlaid by ``params``; names without a Spark counterpart are reported once."""
    defaults = model_kind(model_type).defaults
    unknown = sorted(set(params or {}) - set(defaults))
    if unknown:
        log.warning("%s: no counterpart for %s", model_type, unknown)
    return {**defaults, **(params or {})}


def spark_params(model_type: str, params: dict | None, n: int) -> dict:
    return model_kind(model_type).translate(full_params(model_type, params), n)


def assembled(df: DataFrame, features: Sequence[str], missing: str, keep: Sequence[str] = ()) -> DataFrame:
    """``df`` (or its ``keep`` columns) with the feature vector ``__x``; one projection and one assembler.

    A missing feature is an error, or with ``lowest`` a value below all others, which a tree can split off. With sparse
    columns among the features the vector is sparse, too, and the table is written once.
    """
    if any(is_sparse(df, c) for c in features):
        instead = f"{MISSING_VALUE!r}D" if missing == "lowest" else "CAST(raise_error('a feature is missing') AS DOUBLE)"
        rows = df.select(*([quoted(c) for c in keep] or ["*"]), gathered(df, features, instead).alias("__x"))
        return as_vectors(rows, ["__x"])
    names = [f"__f{i}" for i in range(len(features))]
    fill = f"coalesce({{}}, {MISSING_VALUE!r}D)" if missing == "lowest" else "{}"
    numbers = [F.expr(f"{fill.format(number_sql(df, c))} AS {n}") for c, n in zip(features, names)]
    wide = df.select(*([quoted(c) for c in keep] or ["*"]), *numbers)
    vector = VectorAssembler(inputCols=names, outputCol="__x", handleInvalid="error")
    return vector.transform(wide).drop(*names)


@dataclass
class FittedModel:
    """A fitted classifier with the names it needs to be applied to any table."""

    model_type: str
    features: list[str]
    classes: list
    params: dict
    seed: int
    parts: list = field(repr=False)
    #: Places of each feature in the vector, where some have more than one.
    widths: list[int] | None = None

    @property
    def missing(self) -> str:
        return KINDS[self.model_type].missing if self.model_type in KINDS else "error"

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``prediction`` (a class) and ``probability`` (an array in the order of ``classes``)."""
        kept = [quoted(c) for c in df.columns if c.lower() not in ("prediction", "probability")]
        shares, out = self._shares(assembled(df, self.features, self.missing))
        scored = out.select(*kept, shares.alias("probability"))
        return scored.withColumn("prediction", self._best("probability"))

    def decided(self, vectors: DataFrame, name: str) -> DataFrame:
        """Add the predicted class to a table that has the feature vector ``__x``, and nothing else."""
        shares, out = self._shares(vectors)
        scored = out.select(*[quoted(c) for c in vectors.columns], shares.alias("__shares"))
        return scored.select(*[quoted(c) for c in vectors.columns], self._best("__shares").alias(name))

    def _best(self, shares: str) -> Column:
        best = F.array_position(shares, F.array_max(shares))
        return F.element_at(F.array(*[F.lit(c) for c in self.classes]), best.cast("int"))

    def _shares(self, out: DataFrame) -> tuple[Column, DataFrame]:
        """Class probabilities over the columns that the parts add to a table with ``__x``."""
        if isinstance(self.parts[0], (BoostedTrees, SparseTrees)):
            return self.parts[0].shares(F.col("__x")), out
        columns = []
        for i, part in enumerate(self.parts):
            part.setFeaturesCol("__x").setPredictionCol(f"__p{i}").setProbabilityCol(f"__q{i}").setRawPredictionCol(f"__r{i}")
            out = part.transform(out)
            columns.append(vector_to_array(F.col(f"__q{i}")))
        if len(columns) == 1:
            return columns[0], out
        yes = [F.element_at(c, 2) for c in columns]
        total = sum(yes[1:], yes[0])
        return F.array(*[F.when(total > 0, y / total).otherwise(F.lit(1.0 / len(yes))) for y in yes]), out

    def importances(self) -> dict[str, float]:
        """Tree importances (mean over the parts), or absolute coefficients of the first class; a sparse column's are added up."""
        first = self.parts[0]
        if isinstance(first, (BoostedTrees, SparseTrees)):
            values = first.importances()
        elif hasattr(first, "coefficientMatrix"):
            values = [abs(float(x)) for x in first.coefficientMatrix.toArray()[0]]
        elif hasattr(first, "featureImportances"):
            rows = [p.featureImportances.toArray() for p in self.parts]
            values = [float(sum(r[j] for r in rows) / len(rows)) for j in range(len(rows[0]))]
        else:
            return {}
        if self.widths:
            ends = list(itertools.accumulate(self.widths))
            values = [sum(values[e - w : e]) for e, w in zip(ends, self.widths)]
        return dict(zip(self.features, values))


def fit_model(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    model_type: str,
    params: dict | None = None,
    seed: int = SEED,
    weight: str | None = None,
    counts: dict | None = None,
) -> FittedModel:
    """Fit one classifier; ``weight`` names a column of row weights, ``counts`` the known class sizes."""
    kind = model_kind(model_type)
    counts = counts or class_counts(df, label)
    classes = list(counts)
    if len(classes) < 2:
        raise ValueError("cannot fit a classifier on fewer than two classes")
    settings = kind.translate(full_params(model_type, params), sum(counts.values()))
    known = F.array(*[F.lit(c) for c in classes]).cast(ArrayType(df.schema[label].dataType))
    index = (F.array_position(known, F.col("__label")) - 1).cast("double")
    labelled = df.withColumn("__label", quoted(label))
    keep = ["__label", *([weight] if weight else [])]
    ensure_checkpoints(df.sparkSession)
    data = assembled(labelled, features, kind.missing, keep).withColumn("__y", index)
    wanted = {"featuresCol": "__x", "labelCol": "__y", **({"weightCol": weight} if weight else {})}
    grow = kind.grow_sparse if any(is_sparse(df, c) for c in features) and kind.grow_sparse else kind.grow
    if grow:
        parts = [grow(data, len(classes), settings, seed, weight)]
    elif not kind.binary or len(classes) == 2:
        parts = [kind.estimator(len(classes), seed, **wanted, **settings).fit(data)]
    else:
        data = data.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            parts = _one_vs_rest(kind, data, len(classes), seed, wanted, settings)
        finally:
            data.unpersist()
    sizes = widths(df, features)
    return FittedModel(
        model_type, list(features), classes, full_params(model_type, params), seed, parts, sizes if max(sizes) > 1 else None
    )


def _one_vs_rest(kind: ModelKind, data: DataFrame, k: int, seed: int, wanted: dict, settings: dict) -> list:
    def one(i: int):
        mine = data.withColumn("__is", (F.col("__y") == F.lit(float(i))).cast("double"))
        return kind.estimator(2, seed, **{**wanted, "labelCol": "__is"}, **settings).fit(mine)

    with ThreadPoolExecutor(min(k, PARALLEL_FITS)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(data.sparkSession)(one), i) for i in range(k)]]
