"""Evaluation tables on rule-based predictions, so that every number can be checked in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.catalogue.tables import PRIORITY_CLASS, RATED_DOCUMENTS, rated_documents, rounded, table
from tabwright.operators import evaluate as ev
from tabwright.operators.target import to_severity


def _banded(spark: SparkSession, folder: str, low: float = 120_000, high: float = 330_000) -> DataFrame:
    """Class by price band; the highest band predicts class 3, which no order has."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    price = F.col("o_totalprice")
    band = F.when(price < low, 0).when(price < high, 1).when(price < 450_000, 2).otherwise(3)
    return to_severity(orders, "o_orderpriority", PRIORITY_CLASS, output="label").withColumn("prediction", band)


def _banded_sql(low: float = 120_000, high: float = 330_000) -> str:
    return f"""
SELECT o_orderkey, CASE o_orderpriority WHEN '3-MEDIUM' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '1-URGENT' THEN 2 ELSE 0 END::INTEGER
  AS label, CASE WHEN o_totalprice < {low} THEN 0 WHEN o_totalprice < {high} THEN 1 WHEN o_totalprice < 450000 THEN 2
  ELSE 3 END::INTEGER AS prediction FROM orders"""


RATIOS = ["accuracy", "f1_macro", "f1_weighted", "precision_macro", "recall_macro"]


def confusion(spark: SparkSession, folder: str) -> DataFrame:
    return ev.confusion_matrix(_banded(spark, folder))


def metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ev.metrics(_banded(spark, folder)), *RATIOS, places=9)


def class_report(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ev.class_report(_banded(spark, folder)), "precision", "recall", "f1", places=9)


def overall_analysis(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ev.overall_analysis(_banded(spark, folder)), "accuracy", places=9)


CLASSES = [0, 1]


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    """Quality guessed from length, in coarse steps so that scores are tied."""
    d = rated_documents(spark, folder)
    p = F.floor(F.col("chars") / (F.col("chars") + 1500) * 200) / 200
    scored = d.select("doc_id", "lang", "source", F.col("quality").alias("label"), p.alias("p"))
    return scored.select(
        "doc_id",
        "lang",
        "source",
        "label",
        F.when(F.col("p") > 0.5, 1).otherwise(0).alias("prediction"),
        F.array(1 - F.col("p"), F.col("p")).alias("probability"),
    )


SCORED = f"""
SELECT doc_id, lang, source, quality AS label, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS prediction, p AS p1, 1 - p AS p0
FROM (SELECT *, floor(chars / (chars + 1500) * 200) / 200 AS p FROM ({RATED_DOCUMENTS}))"""


def roc_points(spark: SparkSession, folder: str) -> DataFrame:
    curves = ev.cumulative_scores(_scored(spark, folder), CLASSES, rows_per_range=50)
    return rounded(ev.roc_points(curves), "threshold", "fpr", "tpr", places=9)


def pr_points(spark: SparkSession, folder: str) -> DataFrame:
    curves = ev.cumulative_scores(_scored(spark, folder), CLASSES, rows_per_range=50)
    return rounded(ev.pr_points(curves), "threshold", "precision", "recall", places=9)


def roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ev.roc_auc(ev.cumulative_scores(_scored(spark, folder), CLASSES)), "auc", places=9)


def top_predictions(spark: SparkSession, folder: str) -> DataFrame:
    top = ev.top_predictions(_scored(spark, folder), CLASSES, ["doc_id"], ["lang", "source"])
    return rounded(top, "class_probability", "Class_0_Prob", "Class_1_Prob", places=9)


def prediction_analysis(spark: SparkSession, folder: str) -> DataFrame:
    out = ev.prediction_analysis(_scored(spark, folder), CLASSES, ["doc_id"], 40)
    return rounded(out, "top_min_probability", "top_max_probability", "top_correct_share", "top_actual_share", places=9)


MODELS = {"narrow": (120_000, 330_000), "wide": (60_000, 420_000), "skewed": (250_000, 300_000)}


def _named(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: ev.metrics(_banded(spark, folder, lo, hi)) for name, (lo, hi) in MODELS.items()}


def model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    return ev.model_comparison(_named(spark, folder))


def model_comparison_sorted(spark: SparkSession, folder: str) -> DataFrame:
    out = ev.detailed_comparison(_named(spark, folder), ["f1_macro", "accuracy", "roc_auc"])
    return rounded(out, "F1_Macro", "Accuracy", places=9)


QUERIES = {
    "confusion": confusion,
    "metrics": metrics,
    "class_report": class_report,
    "overall_analysis": overall_analysis,
    "roc_points": roc_points,
    "roc_auc": roc_auc,
    "pr_points": pr_points,
    "top_predictions": top_predictions,
    "prediction_analysis": prediction_analysis,
    "model_comparison": model_comparison,
    "model_comparison_sorted": model_comparison_sorted,
}


def _classes(source: str) -> str:
    return f"""
t AS ({source}), k AS (SELECT label AS c FROM t UNION SELECT prediction FROM t),
g AS (SELECT c, (SELECT count(*) FROM t WHERE label = c) AS support, (SELECT count(*) FROM t WHERE prediction = c) AS predicted,
  (SELECT count(*) FROM t WHERE label = c AND prediction = c) AS hits FROM k),
r AS (SELECT c, CASE WHEN predicted > 0 THEN hits::DOUBLE / predicted ELSE 0 END AS precision,
  CASE WHEN support > 0 THEN hits::DOUBLE / support ELSE 0 END AS recall, 2.0::DOUBLE * hits / (support + predicted) AS f1,
  support, predicted, hits FROM g)"""


def _metric_row(source: str, select: str) -> str:
    return f"WITH {_classes(source)} SELECT {select} FROM r"


_ALL = """round(sum(hits)::DOUBLE / sum(support), {p}) + 0.0 AS {a}, round(avg(f1), {p}) + 0.0 AS {b},
  round(sum(f1 * support) / sum(support), {p}) + 0.0 AS {c}, round(avg(precision), {p}) + 0.0 AS {d},
  round(avg(recall), {p}) + 0.0 AS {e}, sum(support)::BIGINT AS {f}"""

_CUMULATED = f"""
WITH t AS ({SCORED}), l AS (SELECT 0 AS class, p0 AS score, (label = 0)::INT AS hit FROM t
  UNION ALL SELECT 1, p1, (label = 1)::INT FROM t),
s AS (SELECT class, score, sum(hit) AS pos, sum(1 - hit) AS neg FROM l GROUP BY ALL),
q AS (SELECT *, sum(pos) OVER (PARTITION BY class ORDER BY score DESC) AS cp, sum(neg) OVER (PARTITION BY class ORDER BY score DESC)
  AS cn, sum(pos) OVER (PARTITION BY class) AS ap, sum(neg) OVER (PARTITION BY class) AS an FROM s)"""

_TOP = f"""
t AS ({SCORED}), l AS (SELECT 0 AS class, p0 AS p, * FROM t UNION ALL SELECT 1, p1, * FROM t),
n AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY p DESC, doc_id)::INTEGER AS rank FROM l)"""

ORACLES = {
    "confusion": f"""
WITH t AS ({_banded_sql()}), k AS (SELECT label AS c FROM t UNION SELECT prediction FROM t),
g AS (SELECT label, prediction, count(*) AS n FROM t GROUP BY ALL)
SELECT a.c AS label, b.c AS prediction, coalesce(n, 0)::BIGINT AS n FROM k a CROSS JOIN k b
LEFT JOIN g ON g.label = a.c AND g.prediction = b.c""",
    "metrics": _metric_row(
        _banded_sql(), _ALL.format(p=9, a="accuracy", b="f1_macro", c="f1_weighted", d="precision_macro", e="recall_macro", f="sample_count")
    ),
    "class_report": f"""
WITH {_classes(_banded_sql())}, w AS (SELECT sum(hits)::DOUBLE / sum(support) AS acc, avg(precision) AS p, avg(recall) AS r,
  avg(f1) AS f, sum(precision * support) / sum(support) AS wp, sum(recall * support) / sum(support) AS wr,
  sum(f1 * support) / sum(support) AS wf, sum(support)::BIGINT AS s FROM r),
u AS (SELECT c::VARCHAR AS name, precision, recall, f1, support FROM r UNION ALL SELECT 'accuracy', acc, acc, acc, s FROM w
  UNION ALL SELECT 'macro avg', p, r, f, s FROM w UNION ALL SELECT 'weighted avg', wp, wr, wf, s FROM w)
SELECT name, round(precision, 9) + 0.0 AS precision, round(recall, 9) + 0.0 AS recall, round(f1, 9) + 0.0 AS f1, support FROM u""",
    "overall_analysis": _metric_row(
        _banded_sql(),
        "sum(support)::BIGINT AS n_samples, round(sum(hits)::DOUBLE / sum(support), 9) + 0.0 AS accuracy, count(*) AS n_classes",
    ),
    "roc_points": f"""{_CUMULATED}
SELECT class, round(score, 9) + 0.0 AS threshold, round(cn::DOUBLE / an, 9) + 0.0 AS fpr, round(cp::DOUBLE / ap, 9) + 0.0 AS tpr FROM q
UNION ALL SELECT DISTINCT class, NULL, 0.0, 0.0 FROM q""",
    "pr_points": f"""{_CUMULATED}
SELECT class, round(score, 9) + 0.0 AS threshold, round(cp::DOUBLE / (cp + cn), 9) + 0.0 AS precision,
  round(cp::DOUBLE / ap, 9) + 0.0 AS recall FROM q
UNION ALL SELECT DISTINCT class, NULL, 1.0, 0.0 FROM q""",
    "roc_auc": f"""{_CUMULATED}
SELECT class, round(sum((cp - pos + pos / 2.0::DOUBLE) * neg)::DOUBLE / (max(ap) * max(an))::DOUBLE, 9) + 0.0 AS auc
FROM q GROUP BY class""",
    "top_predictions": f"""
WITH {_TOP} SELECT class, rank, round(p, 9) + 0.0 AS class_probability, prediction AS predicted_class, label AS true_class,
  doc_id, lang, source, round(p0, 9) + 0.0 AS "Class_0_Prob", round(p1, 9) + 0.0 AS "Class_1_Prob" FROM n WHERE rank <= 10""",
    "prediction_analysis": f"""
WITH {_TOP}, a AS (SELECT class, min(p) AS lo, max(p) AS hi, count(*) FILTER (WHERE prediction = label) AS ok,
  count(*) FILTER (WHERE label = class) AS own, count(*) FILTER (WHERE p >= 0.8) AS h,
  count(*) FILTER (WHERE p >= 0.6 AND p < 0.8) AS m, count(*) FILTER (WHERE p < 0.6) AS w FROM n WHERE rank <= 40 GROUP BY class)
SELECT class, (SELECT count(*) FROM t WHERE label = class) AS true_count,
  (SELECT count(*) FROM t WHERE prediction = class) AS predicted_count, round(lo, 9) + 0.0 AS top_min_probability,
  round(hi, 9) + 0.0 AS top_max_probability, ok AS top_correct, own AS top_actual, h AS high_confidence,
  m AS medium_confidence, w AS low_confidence, round(ok / 40.0::DOUBLE, 9) + 0.0 AS top_correct_share,
  round(own / 40.0::DOUBLE, 9) + 0.0 AS top_actual_share FROM a""",
    "model_comparison": " UNION ALL ".join(
        f"SELECT * FROM ({_metric_row(_banded_sql(*bands), chr(39) + name + chr(39) + ' AS \"Model\", ' + _ALL.format(p=4, a='Accuracy', b=chr(34) + 'F1-Macro' + chr(34), c=chr(34) + 'F1-Weighted' + chr(34), d=chr(34) + 'Precision-Macro' + chr(34), e=chr(34) + 'Recall-Macro' + chr(34), f=chr(34) + 'Sample Count' + chr(34)))})"
        for name, bands in MODELS.items()
    ),
    "model_comparison_sorted": " UNION ALL ".join(
        f"SELECT * FROM ({_metric_row(_banded_sql(*bands), chr(39) + name + chr(39) + ' AS \"Model\", round(avg(f1), 9) + 0.0 AS \"F1_Macro\", round(sum(hits)::DOUBLE / sum(support), 9) + 0.0 AS \"Accuracy\", ' + chr(39) + 'N/A' + chr(39) + ' AS \"Roc_Auc\", sum(support)::BIGINT AS \"Sample_Count\"')})"
        for name, bands in MODELS.items()
    ),
}
