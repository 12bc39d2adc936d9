"""Reproducible pseudo-randomness derived from row keys.

The values depend on the key and the seed only, never on partitioning, row order or retries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions.columns import quoted

HASH_BITS = 60


def text_hash(*parts: Column) -> Column:
    """The first 60 bits of the MD5 of the parts joined by ``:``, as a bigint."""
    digest = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def key_hash(key: Sequence[str], seed: int) -> Column:
    return text_hash(*[quoted(k) for k in key], F.lit(seed))


def unit(hashed: Column) -> Column:
    """A hash as a number in [0, 1)."""
    return hashed.cast("double") / F.lit(float(1 << HASH_BITS))


def row_digest(df: DataFrame) -> Column:
    """128 bits of all columns of a row as text; a missing value differs from an empty text."""
    texts = [quoted(c).cast("string") for c in df.columns]
    return F.md5(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.length(t).cast("string"), F.lit(":"), t)) for t in texts]))


def with_content_key(df: DataFrame, name: str, distinct: bool) -> DataFrame:
    """Add a key that follows from the row's values, so that it is the same for any partitioning and after any retry.

    Rows that are not ``distinct`` are numbered among their equals, which are interchangeable.
    """
    keyed = df.withColumn(name, row_digest(df))
    if distinct:
        return keyed
    nth = F.row_number().over(Window.partitionBy(name).orderBy(F.lit(0)))
    return keyed.withColumn("__nth", nth).withColumn(name, F.concat_ws(":", quoted(name), "__nth")).drop("__nth")
