"""CSV and Parquet tables."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.columns import nan_to_null, quoted
from tabwright.operators.profile import validate_table

log = logging.getLogger(__name__)

# Texts that stand for a missing value in a CSV file.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]
WHOLE_NUMBER = r"^\s*[+-]?\d{1,19}\s*$"
DECIMAL_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$|^\s*[+-]?[iI]nf(inity)?\s*$"
TRUTH = r"^([Tt]rue|TRUE|[Ff]alse|FALSE)$"


def read_csv(
    spark: SparkSession,
    path: str,
    encoding: str = "utf-8",
    validate: bool = True,
    sep: str = ",",
    multiline: bool = True,
    **options,
) -> DataFrame:
    """Read a CSV file or folder with a header; types are found by one aggregate over the text columns.

    A quoted field may hold line breaks, so each file is read by one task; for large files without such fields turn
    ``multiline`` off.
    """
    if options.pop("check_suffix", True) and not path.rstrip("/").lower().endswith(".csv"):
        raise ValueError(f"not a CSV path: {path}")
    reader = spark.read.option("header", True).option("encoding", encoding).option("sep", sep)
    reader = reader.option("mode", "FAILFAST").option("multiLine", multiline).option("escape", '"')
    for name, value in options.items():
        reader = reader.option(name, value)
    raw = reader.csv(path)
    if not raw.columns:
        raise ValueError(f"no header in {path}")
    text = raw.select(*[_known(c).alias(c) for c in raw.columns])
    table = _typed(text)
    return validate_table(table, "loaded CSV data") if validate else table


def _known(name: str) -> Column:
    return F.when(~quoted(name).isin(MISSING_TEXTS), quoted(name))


def _typed(text: DataFrame) -> DataFrame:
    """Long, double, boolean or string: the first type that every known value of the column fits."""
    checks = []
    for i, c in enumerate(text.columns):
        v = quoted(c)
        checks += [
            F.count(v).alias(f"n{i}"),
            F.count_if(v.rlike(WHOLE_NUMBER) & F.trim(v).try_cast("bigint").isNotNull()).alias(f"long{i}"),
            F.count_if(v.rlike(DECIMAL_NUMBER)).alias(f"double{i}"),
            F.count_if(v.rlike(TRUTH)).alias(f"boolean{i}"),
        ]
    row = text.agg(*checks).first()
    out = []
    for i, c in enumerate(text.columns):
        n = row[f"n{i}"]
        kind = "double" if n == 0 else next((k for k in ("long", "double", "boolean") if row[f"{k}{i}"] == n), "string")
        v = quoted(c)
        out.append((v if kind == "string" else F.trim(v).try_cast(kind)).alias(c))
    return text.select(*out)


def write_csv(df: DataFrame, path: str, description: str = "processed data", validate: bool = True, **options) -> None:
    """Write a folder of CSV parts with a header; missing values become empty fields."""
    if validate:
        validate_table(df, description)
    writer = df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    for name, value in options.items():
        writer = writer.option(name, value)
    writer.csv(path)


def read_table(spark: SparkSession, path: str, **csv) -> DataFrame:
    """CSV by suffix (``csv``: options of ``read_csv``), else Parquet; NaN becomes NULL."""
    if path.rstrip("/").lower().endswith(".csv"):
        return read_csv(spark, path, validate=False, **csv)
    return nan_to_null(spark.read.parquet(path))


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
