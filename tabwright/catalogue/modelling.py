"""Models, cross-validation, search, storage and whole jobs.

SQL cannot say most of these; the tests compare them with brute force on small tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.catalogue.tables import CASES, PRIORITY_CLASS, cases, rounded, table, written_documents
from tabwright.functions.stage import scratch_path
from tabwright.operators.evaluate import roc_auc as auc_table
from tabwright.operators.evaluate import cumulative_scores, metrics, top_features
from tabwright.operators.models import fit_model
from tabwright.operators.split import split_parts
from tabwright.operators.target import to_severity
from tabwright.operators.tune import Balance, cross_validate, search
from tabwright.plans.evaluate import evaluate_folder
from tabwright.plans.preprocess import FittedPreprocessing, fit_preprocessing
from tabwright.plans.run import run
from tabwright.plans.train import train_models
from tabwright.sources.models import load_model, load_models, save_model
from tabwright.spec import PipelineSpec

FEATURES = ["o_totalprice", "c_acctbal", "c_nationkey", "month", "is_open"]
KEY = ["o_orderkey"]
# Small settings: the point is the job, not the score on random figures.
SMALL = {
    "lr": {"max_iter": 50},
    "rf": {"n_estimators": 10, "max_depth": 5},
    "xgboost": {"n_estimators": 5, "max_depth": 3},
}


def _figures(spark: SparkSession, folder: str) -> DataFrame:
    c = cases(spark, folder).select(
        "o_orderkey",
        F.col("o_totalprice") / 1e5,
        F.col("c_acctbal") / 1e3,
        "c_nationkey",
        F.month("o_orderdate").alias("month"),
        (F.col("o_orderstatus") == "O").alias("is_open"),
        "o_orderpriority",
    )
    return c.toDF("o_orderkey", "o_totalprice", "c_acctbal", "c_nationkey", "month", "is_open", "o_orderpriority")


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    return to_severity(_figures(spark, folder), "o_orderpriority", PRIORITY_CLASS, output="label")


def _predict(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    train, test = split_parts(_labelled(spark, folder), "label", KEY)
    model = fit_model(train, FEATURES, "label", kind, SMALL[kind])
    shares = [F.col("probability")[i].alias(f"p{i}") for i in range(len(model.classes))]
    return rounded(model.predict(test).select("o_orderkey", "label", "prediction", *shares), "p0", "p1", "p2", places=4)


def lr_predict(spark: SparkSession, folder: str) -> DataFrame:
    return _predict(spark, folder, "lr")


def rf_predict(spark: SparkSession, folder: str) -> DataFrame:
    return _predict(spark, folder, "rf")


def gbt_predict(spark: SparkSession, folder: str) -> DataFrame:
    return _predict(spark, folder, "xgboost")


def _levels(spark: SparkSession, folder: str) -> DataFrame:
    """Cases whose only features are levels, so that a saturated model gives the class shares of each level."""
    named = {c: (F.col("c_mktsegment") == s).cast("int") for c, s in zip("abcd", ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"))}
    segment = sum(((i + 1) * v for i, v in enumerate(named.values())), F.lit(0))
    labelled = to_severity(cases(spark, folder), "o_orderpriority", PRIORITY_CLASS, output="label")
    return labelled.select(
        "o_orderkey", "label", "c_nationkey", segment.alias("segment"), *[v.alias(c) for c, v in named.items()],
        (F.col("label") > 0).cast("int").alias("urgent"), F.lit(1).alias("same"),
    )


def _shares(model, data: DataFrame, places: int) -> DataFrame:
    shares = {f"p{i}": F.col("probability")[i] for i in range(len(model.classes))}
    found = model.predict(data).select("o_orderkey", "prediction", *[v.alias(n) for n, v in shares.items()])
    return rounded(found, *shares, places=places)


ONE_TREE = {"n_estimators": 1, "max_depth": None, "max_features": None, "bootstrap": False}
ONE_ROUND = {"n_estimators": 1, "max_depth": 6, "subsample": 1.0, "colsample_bytree": 1.0}


def rf_levels(spark: SparkSession, folder: str) -> DataFrame:
    """One whole tree over one column of levels: the commonest class of each level (Spark merges leaves that agree)."""
    data = _levels(spark, folder)
    return fit_model(data, ["c_nationkey"], "label", "rf", ONE_TREE).predict(data).select("o_orderkey", "prediction")


def lr_levels(spark: SparkSession, folder: str) -> DataFrame:
    """Logistic regression on dummies with hardly any penalty: the class shares of each level."""
    data = _levels(spark, folder)
    return _shares(fit_model(data, ["a", "b", "c", "d"], "label", "lr", {"C": 1e9}), data, 2)


def gbt_levels(spark: SparkSession, folder: str) -> DataFrame:
    """One round of boosting over one column of levels: 1 / (1 + exp(-2 m)) with m the mean of the label as -1 or 1."""
    data = _levels(spark, folder)
    return _shares(fit_model(data, ["segment"], "urgent", "gbt", ONE_ROUND), data, 9)


def boost_levels(spark: SparkSession, folder: str) -> DataFrame:
    """One round of second-order boosting for three classes: the softmax of -T(G) / (H + lambda) of each level."""
    tenth, other = F.col("o_orderkey") % 10, F.col("segment") % 2
    # shares of the classes: 0.6, 0.3, 0.1 on one level and 0.1, 0.2, 0.7 on the other
    drawn = F.when(tenth < F.when(other == 0, 6).otherwise(1), 0).when(tenth < F.when(other == 0, 9).otherwise(3), 1).otherwise(2)
    data = _levels(spark, folder).select("o_orderkey", other.alias("level"), drawn.cast("int").alias("label"))
    settings = {**ONE_ROUND, "learning_rate": 0.3, "reg_lambda": 1.0, "reg_alpha": 0.5}
    return _shares(fit_model(data, ["level"], "label", "xgboost", settings), data, 6)


def importance_levels(spark: SparkSession, folder: str) -> DataFrame:
    """A column without information has no importance, the other has all."""
    data = _levels(spark, folder)
    return rounded(top_features(fit_model(data, ["c_nationkey", "same"], "label", "rf", ONE_TREE).importances(), data), "importance")


def models_in_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Two models of one name and a bare one: all are found and evaluated, each by its path."""
    data = _levels(spark, folder)
    path = scratch_path(spark)
    tree = fit_model(data, ["c_nationkey"], "label", "rf", ONE_TREE)
    save_model(tree, spark, f"{path}/first", "tree")
    save_model(tree, spark, f"{path}/deep/second", "tree")
    models, errors = load_models(spark, path)
    out = [(name, m.predict(data).where(F.col("prediction") == F.col("label")).count()) for name, m in models.items()]
    return spark.createDataFrame(out + [(n, -1) for n in errors], "name string, correct bigint")


SCORE_SPEC = PipelineSpec(
    target_column="o_orderpriority",
    key_columns=KEY,
    numeric_columns=["o_totalprice"],
    categorical_columns=["o_orderstatus"],
    scaler_type="minmax",
    severity_mapping=PRIORITY_CLASS,
)


def score_new_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Preprocessing fitted on all orders, written, read again and applied to them."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    path = scratch_path(spark)
    fitted, _ = fit_preprocessing(orders, SCORE_SPEC)
    fitted.write(spark, path)
    done = FittedPreprocessing.read(spark, path).transform(orders)
    return rounded(done.withColumnsRenamed({c: c.lower() for c in done.columns}), "o_totalprice", places=9)


DOCUMENTS = ["chars", "words", "lines"]


def document_quality(spark: SparkSession, folder: str) -> DataFrame:
    """A two-class model scored by its area under the curve."""
    documents = written_documents(spark, folder)
    train, test = split_parts(documents, "quality", ["doc_id"], 0.3)
    model = fit_model(train, DOCUMENTS, "quality", "rf", SMALL["rf"])
    return rounded(auc_table(cumulative_scores(model.predict(test), model.classes, "quality")), "auc", places=4)


def feature_importance(spark: SparkSession, folder: str) -> DataFrame:
    data = _labelled(spark, folder)
    return rounded(top_features(fit_model(data, FEATURES, "label", "rf", SMALL["rf"]).importances(), data), "importance", places=4)


def cv_scores(spark: SparkSession, folder: str) -> DataFrame:
    scores = cross_validate(_labelled(spark, folder), FEATURES, "label", KEY, "lr", SMALL["lr"], k=3)
    rows = [(i, s) for i, s in enumerate(scores.test)]
    return rounded(spark.createDataFrame(rows, "fold int, f1_macro double"), "f1_macro", places=4)


def cv_balanced(spark: SparkSession, folder: str) -> DataFrame:
    """Synthetic rows are made inside each fold's training part only."""
    documents = written_documents(spark, folder)
    scores = cross_validate(documents, DOCUMENTS, "quality", ["doc_id"], "lr", SMALL["lr"], k=3, balance=Balance("smote", ("doc_id",)))
    rows = [(i, s) for i, s in enumerate(scores.test)]
    return rounded(spark.createDataFrame(rows, "fold int, f1_macro double"), "f1_macro", places=4)


def grid_search(spark: SparkSession, folder: str) -> DataFrame:
    data = _labelled(spark, folder)
    space = {"C": [0.1, 10.0], "solver": ["lbfgs", "liblinear"], "max_iter": [20]}
    found = search(data, FEATURES, "label", KEY, "lr", space, k=2, refit=False, balance=Balance("class_weight"))
    return rounded(found.table(data), "mean_test", "std_test", "mean_train", "std_train", places=4)


def random_search(spark: SparkSession, folder: str) -> DataFrame:
    data = _labelled(spark, folder)
    space = {"n_estimators": [3, 5], "max_depth": [2, 3], "min_samples_leaf": [1, 5]}
    found = search(data, FEATURES, "label", KEY, "rf", space, "random", k=2, n_iter=2, refit=False)
    return rounded(found.table(data), "mean_test", "std_test", "mean_train", "std_train", places=4)


TRAIN_SPEC = PipelineSpec(
    target_column="o_orderpriority",
    key_columns=KEY,
    severity_mapping=PRIORITY_CLASS,
    model_type=["lr", "rf"],
    model_params=SMALL,
    handle_imbalance="class_weight",
    n_splits=0,
)


def train_compare(spark: SparkSession, folder: str) -> DataFrame:
    return train_models(_figures(spark, folder), TRAIN_SPEC, KEY, FEATURES).comparison


def model_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions of a model before saving and after loading agree."""
    data = _labelled(spark, folder)
    model = fit_model(data, FEATURES, "label", "rf", SMALL["rf"])
    path = save_model(model, spark, scratch_path(spark))
    before = model.predict(data).select("o_orderkey", F.col("prediction").alias("before"))
    after = load_model(spark, path).predict(data).select("o_orderkey", F.col("prediction").alias("after"))
    both = before.join(after, "o_orderkey")
    return both.groupBy((F.col("before") == F.col("after")).alias("same")).agg(F.count(F.lit(1)).alias("n"))


def evaluate_dir(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark)
    data = _labelled(spark, folder)
    for kind in ("lr", "rf"):
        save_model(fit_model(data, FEATURES, "label", kind, SMALL[kind]), spark, f"{path}/models/{kind}", kind)
    raw = _figures(spark, folder)
    done = evaluate_folder(spark, f"{path}/models", raw, "o_orderpriority", KEY, f"{path}/reports", PRIORITY_CLASS)
    return done.comparison


RUN_SPEC = PipelineSpec(
    target_column="o_orderpriority",
    key_columns=KEY,
    numeric_columns=["o_totalprice", "c_acctbal"],
    categorical_columns=["o_orderstatus", "c_mktsegment"],
    date_columns=["o_orderdate"],
    handle_outliers_cols=["o_totalprice", "c_acctbal"],
    interaction_features=["c_acctbal", "o_totalprice"],
    polynomial_features=["o_totalprice", "c_acctbal"],
    n_select_features=8,
    severity_mapping=PRIORITY_CLASS,
    model_type=["lr"],
    model_params=SMALL,
    handle_imbalance="class_weight",
    n_splits=2,
)


def full_run(spark: SparkSession, folder: str) -> DataFrame:
    """Preprocess, build features, train, evaluate; the result is the metrics row of the best model."""
    done = run(spark, RUN_SPEC, cases(spark, folder), scratch_path(spark))
    return rounded(done.evaluation.metrics, "accuracy", "f1_macro", "f1_weighted", "precision_macro", "recall_macro", places=4)


def balanced_training(spark: SparkSession, folder: str) -> DataFrame:
    """Split, balance the training part with synthetic rows, fit, and score the untouched test part."""
    documents = written_documents(spark, folder)
    train, test = split_parts(documents, "class", ["doc_id"], 0.3)
    ready, _ = Balance("smote", ("doc_id",)).apply(train, DOCUMENTS, "class")
    model = fit_model(ready, DOCUMENTS, "class", "rf", SMALL["rf"])
    out = metrics(model.predict(test), "class")
    return rounded(out, "accuracy", "f1_macro", "f1_weighted", "precision_macro", "recall_macro", places=4)


QUERIES = {
    "rf_levels": rf_levels,
    "lr_levels": lr_levels,
    "gbt_levels": gbt_levels,
    "boost_levels": boost_levels,
    "importance_levels": importance_levels,
    "models_in_folder": models_in_folder,
    "score_new_rows": score_new_rows,
    "lr_predict": lr_predict,
    "rf_predict": rf_predict,
    "gbt_predict": gbt_predict,
    "document_quality": document_quality,
    "feature_importance": feature_importance,
    "cv_scores": cv_scores,
    "cv_balanced": cv_balanced,
    "grid_search": grid_search,
    "random_search": random_search,
    "train_compare": train_compare,
    "model_roundtrip": model_roundtrip,
    "evaluate_dir": evaluate_dir,
    "full_run": full_run,
    "balanced_training": balanced_training,
}
_LEVELS = f"""
SELECT o_orderkey, c_nationkey, c_mktsegment, CASE o_orderpriority WHEN '3-MEDIUM' THEN 1 WHEN '2-HIGH' THEN 2
  WHEN '1-URGENT' THEN 2 ELSE 0 END::INTEGER AS label FROM orders JOIN customer ON o_custkey = c_custkey"""


def _level_shares(level: str, places: int) -> str:
    """Class shares of each level; the prediction is the first of the largest."""
    return f"""
WITH t AS ({_LEVELS}), s AS (SELECT {level} AS v, avg((label = 0)::INT) AS s0, avg((label = 1)::INT) AS s1,
  avg((label = 2)::INT) AS s2 FROM t GROUP BY 1)
SELECT o_orderkey, CASE WHEN s0 >= s1 AND s0 >= s2 THEN 0 WHEN s1 >= s2 THEN 1 ELSE 2 END::INTEGER AS prediction,
  round(s0, {places}) + 0.0 AS p0, round(s1, {places}) + 0.0 AS p1, round(s2, {places}) + 0.0 AS p2
FROM t JOIN s ON {level} = v"""


ORACLES: dict[str, str] = {
    "rf_levels": f"SELECT o_orderkey, prediction FROM ({_level_shares('c_nationkey', 9)})",
    "lr_levels": _level_shares("c_mktsegment", 2),
    "gbt_levels": f"""
WITH t AS ({_LEVELS}), s AS (SELECT c_mktsegment AS v, 1 / (1 + exp(-2 * (2 * avg((label > 0)::INT) - 1))) AS y FROM t GROUP BY 1)
SELECT o_orderkey, (y > 0.5)::INTEGER AS prediction, round(1 - y, 9) + 0.0 AS p0, round(y, 9) + 0.0 AS p1
FROM t JOIN s ON c_mktsegment = v""",
    "boost_levels": f"""
WITH t AS (SELECT o_orderkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'FURNITURE' THEN 1 ELSE 0 END AS v, o_orderkey % 10 AS d FROM ({_LEVELS})),
n AS (SELECT o_orderkey, v, CASE WHEN d < 6 - 5 * v THEN 0 WHEN d < 9 - 6 * v THEN 1 ELSE 2 END AS y FROM t),
g AS (SELECT v, c, count(*) / 3.0::DOUBLE - sum((y = c)::INT) AS g, count(*) * 2 / 9.0::DOUBLE AS h FROM n, (VALUES (0), (1), (2)) AS k(c) GROUP BY 1, 2),
m AS (SELECT v, c, -sign(g) * greatest(abs(g) - 0.5, 0) / (h + 1) * 0.3 AS m FROM g),
s AS (SELECT v, max(exp(m)) FILTER (WHERE c = 0) AS e0, max(exp(m)) FILTER (WHERE c = 1) AS e1, max(exp(m)) FILTER (WHERE c = 2) AS e2 FROM m GROUP BY v)
SELECT o_orderkey, CASE WHEN e0 >= e1 AND e0 >= e2 THEN 0 WHEN e1 >= e2 THEN 1 ELSE 2 END::INTEGER AS prediction,
  round(e0 / (e0 + e1 + e2), 6) + 0.0 AS p0, round(e1 / (e0 + e1 + e2), 6) + 0.0 AS p1, round(e2 / (e0 + e1 + e2), 6) + 0.0 AS p2
FROM n JOIN s USING (v)""",
    "importance_levels": """
SELECT * FROM (VALUES (1, 'c_nationkey', 1.0::DOUBLE), (2, 'same', 0.0::DOUBLE)) AS x(rank, feature, importance)""",
    "models_in_folder": f"""
WITH t AS ({_LEVELS}), c AS (SELECT c_nationkey, label, count(*) AS n FROM t GROUP BY 1, 2),
b AS (SELECT sum(m)::BIGINT AS correct FROM (SELECT max(n) AS m FROM c GROUP BY c_nationkey))
SELECT name, b.correct AS correct FROM b, (VALUES ('first'), ('deep/second')) AS x(name)""",
    "score_new_rows": """
WITH e AS (SELECT min(o_totalprice) AS a, max(o_totalprice) AS b FROM orders)
SELECT o_orderkey, round((o_totalprice - a) / (b - a), 9) + 0.0 AS o_totalprice, o_orderpriority,
  (o_orderstatus = 'F')::INTEGER AS o_orderstatus_f, (o_orderstatus = 'O')::INTEGER AS o_orderstatus_o,
  (o_orderstatus = 'P')::INTEGER AS o_orderstatus_p FROM orders, e""",
    "model_roundtrip": f"SELECT true AS same, count(*) AS n FROM ({CASES})",
}
