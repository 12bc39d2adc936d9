"""One description of a whole run."""

from __future__ import annotations

import json
import logging
from collections.abc import Sequence
from dataclasses import dataclass, field, fields
from typing import Any

from pyspark.sql import SparkSession

from tabwright.functions.names import clean_list, clean_name
from tabwright.operators.balance import METHODS, NEIGHBOURS, STRATEGIES
from tabwright.operators.features import DEGREE, as_pairs
from tabwright.operators.models import KINDS, MODEL_TYPES
from tabwright.operators.outliers import THRESHOLD
from tabwright.operators.split import SEED, TEST_SIZE, check_share
from tabwright.operators.target import SEVERITY, UNMAPPED_CLASS
from tabwright.operators.tune import CV_FOLDS, SEARCH_FOLDS, SEARCH_ITERATIONS, SEARCH_METHODS

log = logging.getLogger(__name__)

# Settings with a list of values, and settings with a smallest value and when that counts.
CHOICES = {"fit_on": ("all", "train"), "handle_imbalance": METHODS, "search_method": SEARCH_METHODS, "encoding_method": ("onehot", "label", "none"), "smote_strategy": STRATEGIES}
LEAST = {
    "n_splits": (0, lambda s: True),
    "polynomial_degree": (1, lambda s: True),
    "smote_neighbours": (1, lambda s: True),
    "search_cv": (2, lambda s: s.optimize_hyperparameters),
    "search_n_iter": (1, lambda s: s.optimize_hyperparameters and s.search_method == "random"),
}
# Fixed default.
TARGET = "사고유형코드"


@dataclass(frozen=True)
class PipelineSpec:
    """Roles of the columns and settings of every stage.

    ``key_columns`` must identify a row; without them a row number is added when the cleaned table is written.
    ``fit_on="train"`` splits first and fits every step on the training rows only.
    """

    target_column: str = TARGET
    key_columns: Sequence[str] = ()
    csv_separator: str = ","
    csv_encoding: str = "utf-8"
    csv_multiline: bool = True
    numeric_columns: Sequence[str] = ()
    categorical_columns: Sequence[str] = ()
    date_columns: Sequence[str] = ()
    identifier_columns: Sequence[str] = ()
    handle_outliers_cols: Sequence[str] = ()
    outlier_method: str = "iqr"
    outlier_threshold: float = THRESHOLD
    scaler_type: str = "standard"
    encoding_method: str = "onehot"

    interaction_features: Sequence[str] = ()
    polynomial_features: Sequence[str] = ()
    polynomial_degree: int = DEGREE
    pca_components: int | None = None
    n_select_features: int | None = None
    selection_method: str = "f_test"

    severity_mapping: dict[str, int] = field(default_factory=lambda: dict(SEVERITY))
    unmapped_class: int | None = UNMAPPED_CLASS
    fit_on: str = "all"
    model_type: str | Sequence[str] = "all"
    model_params: dict[str, dict[str, Any]] = field(default_factory=dict)
    handle_imbalance: str = "smote"
    smote_strategy: str = "auto"
    smote_neighbours: int = NEIGHBOURS
    balance_before_cv: bool = False
    test_size: float = TEST_SIZE
    random_state: int = SEED
    n_splits: int = CV_FOLDS
    optimize_hyperparameters: bool = False
    search_method: str = "grid"
    search_cv: int = SEARCH_FOLDS
    search_n_iter: int = SEARCH_ITERATIONS
    search_spaces: dict[str, dict[str, list]] = field(default_factory=dict)

    def __post_init__(self):
        for name, allowed in CHOICES.items():
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name}: {getattr(self, name)!r} is none of {', '.join(allowed)}")
        for name, (least, needed) in LEAST.items():
            if needed(self) and getattr(self, name) < least:
                raise ValueError(f"{name}: {getattr(self, name)} is below {least}")
        check_share(self.test_size)
        if self.fit_on == "train" and not self.key_columns:
            raise ValueError("fit_on: the training part can only be told apart by key_columns")
        self.model_types()

    @staticmethod
    def from_dict(settings: dict[str, Any]) -> "PipelineSpec":
        """Settings by name, with ``-`` or ``_``; names of other tools' settings are reported and have no effect."""
        named = {k.replace("-", "_"): v for k, v in settings.items()}
        known = {f.name for f in fields(PipelineSpec)}
        if not isinstance(named.get("model_params", {}), dict):
            log.warning("model parameters without a model type have no effect: %s", named.pop("model_params"))
        extra = sorted(set(named) - known)
        if extra:
            log.warning("settings without effect: %s", extra)
        return PipelineSpec(**{k: v for k, v in named.items() if k in known and v is not None})

    @staticmethod
    def load(spark: SparkSession, path: str) -> "PipelineSpec":
        """Settings from a JSON file."""
        return PipelineSpec.from_dict(json.loads(spark.read.text(path, wholetext=True).first().value))

    def model_types(self) -> list[str]:
        wanted = [self.model_type] if isinstance(self.model_type, str) else list(self.model_type)
        if wanted == ["all"]:
            return list(MODEL_TYPES)
        unknown = [m for m in wanted if m not in KINDS]
        if unknown:
            raise ValueError(f"invalid model types {unknown}, available: {sorted(KINDS)}")
        return wanted

    # Names as they read after column cleaning; identifiers and the target are left out of every list.

    @property
    def target(self) -> str:
        return clean_name(self.target_column)

    @property
    def key(self) -> list[str]:
        return clean_list(self.key_columns)

    @property
    def untouched(self) -> list[str]:
        return list(dict.fromkeys([*self.key, *clean_list(self.identifier_columns), self.target]))

    def role(self, names: Sequence[str]) -> list[str]:
        return [n for n in clean_list(names) if n not in self.untouched]

    @property
    def csv(self) -> dict[str, Any]:
        """How CSV files are read."""
        return {"sep": self.csv_separator, "encoding": self.csv_encoding, "multiline": self.csv_multiline}

    @property
    def pairs(self) -> list[tuple[str, str]]:
        out = set(self.untouched)
        return [(a, b) for a, b in as_pairs(clean_list(self.interaction_features)) if a not in out and b not in out]
