"""Feature construction, reduction and selection in their fixed order."""

from __future__ import annotations

import json
import logging
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from tabwright.functions.columns import existing
from tabwright.functions.vectors import is_sparse
from tabwright.operators.features import Interactions, add_polynomials, date_parts, fit_interactions
from tabwright.operators.reduce import Components, fit_components
from tabwright.operators.select import Selection, fit_selection
from tabwright.plans.preprocess import IS_TEST, ROW_ID, fit_rows
from tabwright.spec import PipelineSpec

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class FittedFeatures:
    interactions: Interactions
    polynomials: list[str]
    degree: int
    dates: list[str]
    components: Components
    selection: Selection | None
    keep: list[str]

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.components.transform(self._built(df))
        return self.selection.transform(out, existing(out, self.keep, "identifier")) if self.selection else out

    def write(self, spark: SparkSession, folder: str) -> None:
        """The fitted values as one line of text."""
        text = json.dumps(asdict(self), ensure_ascii=False)
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(folder)

    @staticmethod
    def read(spark: SparkSession, folder: str) -> "FittedFeatures":
        d = json.loads(spark.read.text(folder).first().value)
        pairs = {k: [tuple(x) if isinstance(x, list) else x for x in v] for k, v in d["interactions"].items()}
        selection = Selection(**d["selection"]) if d["selection"] else None
        return FittedFeatures(
            **{**d, "interactions": Interactions(**pairs), "components": Components(**d["components"]), "selection": selection}
        )

    def _built(self, df: DataFrame) -> DataFrame:
        out = self.interactions.transform(df)
        if self.polynomials:
            out = add_polynomials(out, self.polynomials, self.degree)
        return date_parts(out, self.dates)


def fit_features(df: DataFrame, spec: PipelineSpec, categorical: Sequence[str] = ()) -> FittedFeatures:
    """Interactions, polynomials, date parts, components, selection.

    ``categorical`` names the encoded columns that take part in the reduction next to the numeric ones; by default
    those that begin with the name of a categorical column.
    """
    fixed = [c for c in dict.fromkeys([*spec.untouched, ROW_ID, IS_TEST]) if c in df.columns and c != spec.target]
    interactions = fit_interactions(fit_rows(df), spec.pairs)
    polynomials = [c for c in spec.role(spec.polynomial_features) if c in df.columns]
    dates = [c for c in spec.role(spec.date_columns) if c in df.columns]
    none = Components([], [], [], [])
    start = FittedFeatures(interactions, polynomials, spec.polynomial_degree, dates, none, None, fixed)
    built = fit_rows(start.transform(df))
    if not spec.pca_components and not (spec.n_select_features and spec.target in built.columns):
        return start
    components = none
    if spec.pca_components:
        if not categorical:
            stems = tuple(f"{c}_" for c in spec.role(spec.categorical_columns))
            categorical = [c for c in df.columns if stems and c.startswith(stems)]
        inputs = [c for c in [*spec.role(spec.numeric_columns), *categorical] if c in built.columns and c != spec.target]
        wide = [c for c in inputs if is_sparse(built, c)]
        if wide:
            log.warning("%s are sparse vectors and stay out of the components", wide)
        inputs = [c for c in inputs if c not in wide]
        components = fit_components(built, inputs, spec.pca_components)
    selection = None
    if spec.n_select_features and spec.target in built.columns:
        reduced = components.transform(built)
        candidates = [c for c in reduced.columns if c != spec.target and c not in fixed]
        selection = fit_selection(reduced, candidates, spec.target, spec.n_select_features, spec.selection_method)
    return FittedFeatures(interactions, polynomials, spec.polynomial_degree, dates, components, selection, fixed)
