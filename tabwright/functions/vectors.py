"""Sparse vectors as plain structs, which Spark joins, writes and concatenates itself, and as vectors for models.

The struct has the fields of MLlib's vector type, so a written struct is read back as a vector; nothing is converted row by
row, and no column carries a description of each of its places.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.columns import number_sql, quoted, ticked
from tabwright.functions.stage import scratch_path

#: Kind of vector (0: sparse), number of places, and the places that are not zero with their values.
SPARSE = T.StructType(
    [
        T.StructField("type", T.ByteType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("indices", T.ArrayType(T.IntegerType())),
        T.StructField("values", T.ArrayType(T.DoubleType())),
    ]
)


def is_sparse(df: DataFrame, name: str) -> bool:
    kind = df.schema[name].dataType
    return isinstance(kind, T.StructType) and kind.fieldNames() == SPARSE.fieldNames()


def sparse(size: Column, indices: Column, values: Column) -> Column:
    parts = {"type": F.lit(0), "size": size, "indices": indices, "values": values}
    return F.struct(*[F.coalesce(parts[f.name].cast(f.dataType), F.array().cast(f.dataType) if isinstance(f.dataType, T.ArrayType) else F.lit(0).cast(f.dataType)).alias(f.name) for f in SPARSE])


def one_of(code: Column, size: int) -> Column:
    """The vector of ``size`` places with a 1 at ``code``; all zeros where there is no code."""
    known = code.isNotNull()
    none = F.array()
    return sparse(F.lit(size), F.when(known, F.array(code.cast("int"))).otherwise(none.cast("array<int>")), F.when(known, F.array(F.lit(1.0))).otherwise(none.cast("array<double>")))


def gathered(df: DataFrame, names: Sequence[str], missing: str) -> Column:
    """One sparse vector of numbers and sparse columns in the given order.

    ``missing`` is the SQL of what stands for a missing number.
    """
    at, indices, values = F.lit(0), [], []
    for c in names:
        if is_sparse(df, c):
            indices.append(_shifted(F.col(f"{ticked(c)}.indices"), at))
            values.append(F.col(f"{ticked(c)}.values"))
            at = at + F.col(f"{ticked(c)}.size")
        else:
            indices.append(F.array(at))
            values.append(F.array(F.expr(f"coalesce({number_sql(df, c)}, {missing})")))
            at = at + F.lit(1)
    return sparse(at, F.concat(*indices), F.concat(*values))


def _shifted(indices: Column, by: Column) -> Column:
    return F.transform(indices, lambda i: i + by)


def widths(df: DataFrame, names: Sequence[str]) -> list[int]:
    """Places that each column takes in a vector of them all; the same in every row."""
    wide = [c for c in names if is_sparse(df, c)]
    first = df.select(*[F.col(f"{ticked(c)}.size").alias(f"s{i}") for i, c in enumerate(wide)]).first() if wide else None
    size = {c: (first[i] if first else 0) for i, c in enumerate(wide)}
    return [size.get(c, 1) for c in names]


def as_vectors(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df``, written once and read back with the named struct columns as vectors."""
    spark = df.sparkSession
    shaped = df.select(*[(quoted(c).cast(SPARSE) if c in names else quoted(c)).alias(c) for c in df.columns])
    path = scratch_path(spark)
    shaped.write.parquet(path)
    fields = [T.StructField(f.name, VectorUDT() if f.name in names else f.dataType) for f in shaped.schema]
    return spark.read.schema(T.StructType(fields)).parquet(path)
