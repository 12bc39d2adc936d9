"""Input tables of the queries and the same tables in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.stage import materialise
from tabwright.sources.tables import read_table


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, f"{folder}/{name}.parquet")


def gap(key: str, step: int, column: str) -> Column:
    """The column with a missing value on every ``step``-th key; the test tables have no gaps of their own."""
    return F.when(F.col(key) % step != 0, F.col(column)).alias(column)


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Float results rounded, since sums in another order differ in the last digits; -0.0 reads 0.0."""
    names = set(columns)
    return df.select(
        *[(F.round(F.col(f"`{c}`"), places) + F.lit(0.0) if c in names else F.col(f"`{c}`")).alias(c) for c in df.columns]
    )


def holed_orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey",
        "o_custkey",
        gap("o_orderkey", 11, "o_orderstatus"),
        gap("o_orderkey", 7, "o_totalprice"),
        gap("o_orderkey", 13, "o_orderpriority"),
        "o_orderdate",
    )


HOLED_ORDERS = """
SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderkey % 11 <> 0 THEN o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS o_totalprice,
  CASE WHEN o_orderkey % 13 <> 0 THEN o_orderpriority END AS o_orderpriority,
  o_orderdate
FROM orders
"""


# Order priorities stand in for codes; one of them is left unmapped.
PRIORITY_CLASS = {"5-LOW": 0, "3-MEDIUM": 1, "2-HIGH": 2, "1-URGENT": 2}


def cases(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order with the figures of its customer; the priority is the code."""
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderdate", "o_orderpriority", "c_acctbal", "c_mktsegment", "c_nationkey"
    )


CASES = """
SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderdate, o_orderpriority, c_acctbal, c_mktsegment, c_nationkey
FROM orders JOIN customer ON o_custkey = c_custkey
"""


def rated_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents with length figures; class = 2 * toxic + quality, very uneven."""
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return documents.join(labels, "doc_id").select(
        "doc_id",
        "lang",
        "source",
        F.col("n_chars").cast("double").alias("chars"),
        F.size(F.split("text", " ")).cast("double").alias("words"),
        F.size(F.split("text", "\n")).cast("double").alias("lines"),
        "quality",
        "toxic",
        (F.col("toxic") * 2 + F.col("quality")).cast("int").alias("class"),
    )


def written_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows, written once: for jobs that read them many times the texts are split only once."""
    return materialise(rated_documents(spark, folder))


RATED_DOCUMENTS = """
SELECT d.doc_id, lang, source, n_chars::DOUBLE AS chars, len(string_split(text, ' '))::DOUBLE AS words,
  len(string_split(text, chr(10)))::DOUBLE AS lines, quality, toxic, (toxic * 2 + quality)::INTEGER AS class
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""
