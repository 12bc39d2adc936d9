"""Bounded samples that are the same on every retry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_by_hash(df: DataFrame, most: int, n: int) -> DataFrame:
    """At most ``most`` distinct rows of ``df`` with the smallest ``h``, a column of evenly spread 64-bit hashes.

    ``n`` is about the number of rows. Where it is large, a cut at about twice the wanted share comes first, so that the
    task that sorts them out reads few rows whatever the number of tasks that send them.
    """
    if n > 4 * most:
        df = df.where(F.col("h") <= int(-(2**63) + 2 * most * 2**64 // n))
    return df.dropDuplicates(["h"]).orderBy("h").limit(most)
