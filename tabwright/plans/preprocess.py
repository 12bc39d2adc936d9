"""Cleaning and preprocessing of one table."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.columns import auto_strings, nan_to_null
from tabwright.functions.keys import with_content_key
from tabwright.functions.stage import materialise
from tabwright.operators.clean import Imputer, drop_duplicate_rows, fit_imputer, parse_dates
from tabwright.operators.encode import LabelEncoder, OneHotEncoder, fit_label, fit_onehot
from tabwright.operators.outliers import Capper, fit_capper
from tabwright.operators.profile import clean_column_names
from tabwright.operators.scale import Scaler, fit_scaler
from tabwright.operators.split import stratified_split
from tabwright.operators.target import to_severity
from tabwright.spec import PipelineSpec

ROW_ID = "row_id"
IS_TEST = "is_test"


def fit_rows(df: DataFrame) -> DataFrame:
    """The rows that steps may be fitted on: all, or the training part where the split is already marked."""
    return df.where(~F.col(IS_TEST)) if IS_TEST in df.columns else df


def mark_test_rows(df: DataFrame, spec: PipelineSpec) -> DataFrame:
    """Split before anything is fitted; the mark rides along like an identifier."""
    cleaned = drop_duplicate_rows(nan_to_null(clean_column_names(df)))
    labelled = to_severity(cleaned, spec.target, spec.severity_mapping, spec.unmapped_class, "__class")
    # written once: every later fit reads it instead of repeating the de-duplication
    return materialise(stratified_split(labelled, "__class", spec.key, spec.test_size, spec.random_state).drop("__class"))


@dataclass(frozen=True)
class FittedCleaning:
    """Names, dates, fill values and removal of duplicate rows, in this order."""

    dates: list[str]
    imputer: Imputer

    def transform(self, df: DataFrame) -> DataFrame:
        return drop_duplicate_rows(self.imputer.transform(_read(df, self.dates)))


def _read(df: DataFrame, dates: Sequence[str]) -> DataFrame:
    return parse_dates(nan_to_null(clean_column_names(df)), dates)


def fit_cleaning(
    df: DataFrame, dates: Sequence[str] = (), numeric: Sequence[str] | None = None, exclude: Sequence[str] = ()
) -> FittedCleaning:
    return FittedCleaning(list(dates), fit_imputer(fit_rows(_read(df, dates)), numeric, exclude))


@dataclass(frozen=True)
class FittedPreprocessing:
    """Cleaning, then capping, scaling and encoding with fitted values only."""

    cleaning: FittedCleaning
    capper: Capper
    scaler: Scaler
    encoder: OneHotEncoder | LabelEncoder | None

    def transform(self, df: DataFrame) -> DataFrame:
        return self.after_cleaning(self.cleaning.transform(df))

    def after_cleaning(self, df: DataFrame) -> DataFrame:
        out = self.scaler.transform(self.capper.transform(df))
        return self.encoder.transform(out) if self.encoder else out

    def tables(self) -> dict[str, DataFrame]:
        """Code tables of very wide columns."""
        if isinstance(self.encoder, OneHotEncoder):
            return self.encoder.wide
        return self.encoder.large if self.encoder else {}

    def to_json(self) -> str:
        """The fitted values as text; code tables of very wide columns are not part of it (see ``write``)."""
        if self.tables():
            raise ValueError("codes of very wide columns live in tables, use write() for those")
        return self._text()

    def _text(self) -> str:
        onehot = self.encoder if isinstance(self.encoder, OneHotEncoder) else None
        return json.dumps(
            {
                "dates": self.cleaning.dates,
                "imputer": asdict(self.cleaning.imputer),
                "bounds": self.capper.bounds,
                "scaler": asdict(self.scaler),
                "onehot": onehot.levels if onehot else None,
                "sizes": onehot.sizes if onehot else None,
                "label": self.encoder.small if isinstance(self.encoder, LabelEncoder) else None,
                "tables": list(self.tables()),
            },
            ensure_ascii=False,
        )

    def write(self, spark: SparkSession, folder: str) -> None:
        """All fitted values and code tables, to be read by ``read`` in another session."""
        for i, table in enumerate(self.tables().values()):
            table.write.mode("overwrite").parquet(f"{folder}/codes_{i}")
        spark.createDataFrame([(self._text(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/fitted")

    @staticmethod
    def read(spark: SparkSession, folder: str) -> "FittedPreprocessing":
        text = spark.read.text(f"{folder}/fitted").first().value
        fitted = FittedPreprocessing.from_json(text)
        tables = {c: spark.read.parquet(f"{folder}/codes_{i}") for i, c in enumerate(json.loads(text).get("tables", []))}
        if not tables:
            return fitted
        if isinstance(fitted.encoder, OneHotEncoder):
            return replace(fitted, encoder=replace(fitted.encoder, wide=tables))
        return replace(fitted, encoder=LabelEncoder(fitted.encoder.small, tables))

    @staticmethod
    def from_json(text: str) -> "FittedPreprocessing":
        d = json.loads(text)
        encoder = None
        if d["onehot"] is not None:
            encoder = OneHotEncoder(d["onehot"], {}, d.get("sizes") or {})
        elif d["label"] is not None:
            encoder = LabelEncoder(d["label"])
        return FittedPreprocessing(
            FittedCleaning(d["dates"], Imputer(**d["imputer"])),
            Capper({c: tuple(b) for c, b in d["bounds"].items()}),
            Scaler(**d["scaler"]),
            encoder,
        )


def fit_preprocessing(df: DataFrame, spec: PipelineSpec) -> tuple[FittedPreprocessing, DataFrame]:
    """Fit all steps; also returns the preprocessed table, whose cleaned form has been written once."""
    cleaning = fit_cleaning(df, spec.role(spec.date_columns), spec.role(spec.numeric_columns), spec.untouched)
    cleaned = cleaning.transform(df)
    if not spec.key:
        cleaned = with_content_key(cleaned, ROW_ID, distinct=True)
    # every later fit reads the cleaned rows: write them once instead of repeating the de-duplication
    cleaned = materialise(cleaned)
    fixed = [*spec.untouched, ROW_ID]
    outliers = spec.role(spec.handle_outliers_cols)
    capper = Capper({})
    if outliers:
        capper = fit_capper(fit_rows(cleaned), outliers, spec.outlier_method, spec.outlier_threshold, fixed)
    capped = fit_rows(capper.transform(cleaned))
    numeric = spec.role(spec.numeric_columns)
    scaler = fit_scaler(capped, numeric, spec.scaler_type, fixed) if numeric else Scaler({}, {})
    encoder = None
    if spec.categorical_columns:
        wanted = spec.role(spec.categorical_columns)
        every = [c for c in cleaned.columns if c in wanted or c in auto_strings(cleaned, fixed)]
        if spec.encoding_method == "onehot":
            encoder = fit_onehot(fit_rows(cleaned), every)
        elif spec.encoding_method == "label":
            encoder = fit_label(fit_rows(cleaned), every, spec.key or [ROW_ID])
    fitted = FittedPreprocessing(cleaning, capper, scaler, encoder)
    return fitted, fitted.after_cleaning(cleaned)
