"""Target classes, exact splits and folds, weights and synthetic minority rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.catalogue.tables import PRIORITY_CLASS, RATED_DOCUMENTS, rated_documents, rounded, table, written_documents
from tabwright.operators import balance
from tabwright.operators.split import assign_folds, stratified_split
from tabwright.operators.target import class_distribution as distribution
from tabwright.operators.target import to_severity
from tabwright.operators.target import unmapped_codes as unmapped


def _severity(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return to_severity(orders, "o_orderpriority", PRIORITY_CLASS, output="severity")


def severity_map(spark: SparkSession, folder: str) -> DataFrame:
    return _severity(spark, folder)


def severity_numeric(spark: SparkSession, folder: str) -> DataFrame:
    """Codes held as doubles: 210.0 and 210 are one code; the rest is unmapped."""
    codes = F.when(F.col("o_orderkey") % 6 == 0, F.lit(None).cast("double")).otherwise(
        F.element_at(F.array(*[F.lit(x) for x in (210.0, 701.0, 703.0, 705.0, 707.0, 999.0)]), (F.col("o_orderkey") % 6 + 1).cast("int"))
    )
    return to_severity(table(spark, folder, "orders").select("o_orderkey", codes.alias("code")), "code")


def unmapped_codes(spark: SparkSession, folder: str) -> DataFrame:
    return unmapped(table(spark, folder, "orders"), "o_orderpriority", PRIORITY_CLASS)


def class_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return distribution(_severity(spark, folder), "severity")


def class_weights(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(balance.class_weights(rated_documents(spark, folder), "class"), "weight", places=9)


def weighted_rows(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(balance.with_class_weights(_severity(spark, folder), "severity"), "weight", places=9)


def stratified(spark: SparkSession, folder: str) -> DataFrame:
    return stratified_split(_severity(spark, folder), "severity", ["o_orderkey"])


def stratified_rare(spark: SparkSession, folder: str) -> DataFrame:
    return stratified_split(rated_documents(spark, folder).select("doc_id", "class"), "class", ["doc_id"], 0.3, 7)


def folds(spark: SparkSession, folder: str) -> DataFrame:
    return assign_folds(_severity(spark, folder), "severity", ["o_orderkey"], 5)


def _many(spark: SparkSession, folder: str) -> DataFrame:
    """Orders in up to 700 classes."""
    return table(spark, folder, "orders").select("o_orderkey", (F.col("o_custkey") % 700).alias("bucket"))


def split_many_classes(spark: SparkSession, folder: str) -> DataFrame:
    return stratified_split(_many(spark, folder), "bucket", ["o_orderkey"])


def folds_many_classes(spark: SparkSession, folder: str) -> DataFrame:
    return assign_folds(_many(spark, folder), "bucket", ["o_orderkey"], 4)


def weights_many_classes(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(balance.with_class_weights(_many(spark, folder), "bucket"), "weight", places=9)


DOCUMENT_FEATURES = ["chars", "words", "lines"]


def smote_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Whole numbers, so many rows share a place."""
    made = balance.smote(written_documents(spark, folder), DOCUMENT_FEATURES, "class", ["doc_id"])
    return rounded(made.select(*DOCUMENT_FEATURES, "class", "is_synthetic"), *DOCUMENT_FEATURES)


WIDTH = 64


def smote_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """64 features and ten classes of nearly equal size."""
    names = [f"v{i}" for i in range(WIDTH)]
    vectors = table(spark, folder, "embeddings").select(
        "vec_id", "label", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)]
    )
    made = balance.smote(vectors, names, "label", ["vec_id"])
    return rounded(made.select(*names, "label", "is_synthetic"), *names, places=5)


QUERIES = {
    "severity_map": severity_map,
    "severity_numeric": severity_numeric,
    "unmapped_codes": unmapped_codes,
    "class_distribution": class_distribution,
    "class_weights": class_weights,
    "weighted_rows": weighted_rows,
    "stratified_split": stratified,
    "stratified_split_rare": stratified_rare,
    "kfold_assign": folds,
    "split_many_classes": split_many_classes,
    "folds_many_classes": folds_many_classes,
    "weights_many_classes": weights_many_classes,
    "smote_balance": smote_documents,
    "smote_vectors": smote_vectors,
}

_CLASS = """
SELECT o_orderkey, o_orderpriority, CASE o_orderpriority WHEN '3-MEDIUM' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '1-URGENT' THEN 2
  ELSE 0 END::INTEGER AS severity FROM orders"""


_MANY = "SELECT o_orderkey, o_custkey % 700 AS bucket FROM orders"


def _hash(*parts: str) -> str:
    text = " || ':' || ".join(f"({p})::VARCHAR" for p in parts)
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


def _split(source: str, label: str, key: str, test_size: str, seed: int) -> str:
    """Quotas by largest remainder of the train part, then the first rows of each class in hash order."""
    return f"""
WITH t AS ({source}), n AS (SELECT count(*) AS n, count(*) - ceil(count(*) * {test_size})::BIGINT AS tr FROM t),
c AS (SELECT {label} AS c, count(*) AS k FROM t GROUP BY 1),
q AS (SELECT c, tr * k // n AS base, row_number() OVER (ORDER BY (tr * k) % n DESC, c) AS pos, tr FROM c, n),
u AS (SELECT c, base + (pos <= tr - (SELECT sum(base) FROM q))::INT AS quota FROM q),
r AS (SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY {_hash(key, str(seed))}, {key}) AS rk FROM t)
SELECT r.* EXCLUDE (rk), rk > quota AS is_test FROM r JOIN u ON r.{label} = u.c"""


def _smote(source: str, key: str, label: str, features: list[str], dist: str, shown: list[str], places: int) -> str:
    """All pairs inside a class, the five nearest by distance and key, new rows by hash.

    Nothing is added when a class to be raised has no more than five rows.
    """
    moved = ", ".join(f"round(b.{f} + u * (z.{f} - b.{f}), {places}) + 0.0 AS {f}" for f in shown)
    kept = ", ".join(f"round({f}, {places}) + 0.0 AS {f}" for f in shown)
    return f"""
WITH t AS ({source}), c AS (SELECT {label} AS c, count(*) AS k FROM t GROUP BY 1), m AS (SELECT max(k) AS top FROM c),
b AS (SELECT t.*, k, top - k AS lack, row_number() OVER (PARTITION BY {label} ORDER BY {_hash(key, '42')}, {key}) AS hr
  FROM t JOIN c ON t.{label} = c.c, m WHERE k < top),
p AS (SELECT x.{key} AS i, y.{key} AS j, row_number() OVER (PARTITION BY x.{key} ORDER BY {dist}, y.{key}) AS rn
  FROM b x JOIN b y ON x.{label} = y.{label} AND x.{key} <> y.{key}),
near AS (SELECT i, j, rn - 1 AS spot FROM p WHERE rn <= 5),
s AS (SELECT {key} AS i, unnest(generate_series(1, lack // k + (hr <= lack % k)::INT)) AS copy FROM b),
w AS (SELECT i, copy, {_hash('i', 'copy', '42', "'pick'")} % 5 AS spot,
  {_hash('i', 'copy', '42', "'share'")} / 1152921504606846976.0 AS u FROM s)
SELECT {kept}, {label}, false AS is_synthetic FROM t
UNION ALL SELECT {moved}, b.{label}, true FROM w JOIN near ON w.i = near.i AND w.spot = near.spot
  JOIN b ON b.{key} = w.i JOIN b z ON z.{key} = near.j WHERE (SELECT min(k) FROM c, m WHERE k < top) > 5"""


_VECTORS = "SELECT vec_id, label, " + ", ".join(f"embedding[{i + 1}]::DOUBLE AS v{i}" for i in range(WIDTH)) + " FROM embeddings"

ORACLES = {
    "severity_map": _CLASS,
    "severity_numeric": """
SELECT o_orderkey, CASE o_orderkey % 6 WHEN 1 THEN 1 WHEN 2 THEN 1 WHEN 3 THEN 2 WHEN 4 THEN 2 ELSE 0 END::INTEGER AS code
FROM orders""",
    "unmapped_codes": """
SELECT o_orderpriority AS code, count(*) AS n FROM orders WHERE o_orderpriority NOT IN
  ('5-LOW', '3-MEDIUM', '2-HIGH', '1-URGENT') GROUP BY 1""",
    "class_distribution": f"SELECT severity AS label, count(*) AS n FROM ({_CLASS}) GROUP BY 1",
    "class_weights": f"""
WITH t AS ({RATED_DOCUMENTS}), c AS (SELECT class AS label, count(*) AS n FROM t GROUP BY 1)
SELECT label, n, round((SELECT sum(n) FROM c)::DOUBLE / ((SELECT count(*) FROM c) * n), 9) + 0.0 AS weight FROM c""",
    "weighted_rows": f"""
WITH t AS ({_CLASS}), c AS (SELECT severity AS label, count(*) AS n FROM t GROUP BY 1)
SELECT t.*, round((SELECT sum(n) FROM c)::DOUBLE / ((SELECT count(*) FROM c) * n), 9) + 0.0 AS weight
FROM t JOIN c ON severity = label""",
    "stratified_split": _split(_CLASS, "severity", "o_orderkey", "0.2::DOUBLE", 42),
    "stratified_split_rare": _split(f"SELECT doc_id, class FROM ({RATED_DOCUMENTS})", "class", "doc_id", "0.3::DOUBLE", 7),
    "kfold_assign": f"""
SELECT *, (ntile(5) OVER (PARTITION BY severity ORDER BY {_hash('o_orderkey', '42')}, o_orderkey) - 1)::INTEGER AS fold
FROM ({_CLASS})""",
    "split_many_classes": _split(_MANY, "bucket", "o_orderkey", "0.2::DOUBLE", 42),
    "folds_many_classes": f"""
SELECT *, (ntile(4) OVER (PARTITION BY bucket ORDER BY {_hash('o_orderkey', '42')}, o_orderkey) - 1)::INTEGER AS fold
FROM ({_MANY})""",
    "weights_many_classes": f"""
WITH t AS ({_MANY}), c AS (SELECT bucket AS label, count(*) AS n FROM t GROUP BY 1)
SELECT t.*, round((SELECT sum(n) FROM c)::DOUBLE / ((SELECT count(*) FROM c) * n), 9) + 0.0 AS weight
FROM t JOIN c ON bucket = label""",
    "smote_balance": _smote(
        RATED_DOCUMENTS,
        "doc_id",
        "class",
        DOCUMENT_FEATURES,
        "(x.chars - y.chars) ** 2 + (x.words - y.words) ** 2 + (x.lines - y.lines) ** 2",
        DOCUMENT_FEATURES,
        6,
    ),
    "smote_vectors": _smote(
        _VECTORS,
        "vec_id",
        "label",
        [f"v{i}" for i in range(WIDTH)],
        " + ".join(f"(x.v{i} - y.v{i}) ** 2" for i in range(WIDTH)),
        [f"v{i}" for i in range(WIDTH)],
        5,
    ),
}
