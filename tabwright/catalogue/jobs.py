"""Whole jobs whose results SQL can say: cross-validation, search, training, evaluation and full runs on one whole tree.

The only feature is a column of levels, so the tree predicts the commonest class of each level; results are read back from
what the jobs have written. Wide columns and many classes are here, too.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.catalogue.sampling import _smote, _split
from tabwright.catalogue.tables import PRIORITY_CLASS, cases, rounded, table
from tabwright.functions.stage import materialise, scratch_path
from tabwright.operators import balance
from tabwright.operators.encode import fit_onehot
from tabwright.operators.models import fit_model
from tabwright.operators.target import to_severity
from tabwright.operators.tune import Balance, cross_validate, search
from tabwright.plans.evaluate import evaluate_folder, evaluate_saved
from tabwright.plans.run import run
from tabwright.plans.train import train_models
from tabwright.sources.models import save_model
from tabwright.sources.tables import read_csv
from tabwright.spec import PipelineSpec

KEY = ["o_orderkey"]
ONE_TREE = {"n_estimators": 1, "max_depth": None, "max_features": None, "bootstrap": False}
#: A leaf that large leaves the tree without a split.
LEAVES = [1, 1_000_000_000]
MEASURES = ("accuracy", "f1_macro", "f1_weighted", "precision_macro", "recall_macro")


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    return cases(spark, folder).select("o_orderkey", "c_nationkey", "o_orderpriority")


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    return to_severity(_raw(spark, folder), "o_orderpriority", PRIORITY_CLASS, output="label")


def cv_levels(spark: SparkSession, folder: str) -> DataFrame:
    scores = cross_validate(_labelled(spark, folder), ["c_nationkey"], "label", KEY, "rf", ONE_TREE, k=5)
    return rounded(spark.createDataFrame(list(enumerate(scores.test)), "fold int, f1_macro double"), "f1_macro", places=9)


def _searched(spark: SparkSession, folder: str, method: str, scoring: str) -> DataFrame:
    data = _labelled(spark, folder)
    space = {**{k: [v] for k, v in ONE_TREE.items()}, "min_samples_leaf": LEAVES}
    found = search(data, ["c_nationkey"], "label", KEY, "rf", space, method, k=3, n_iter=2, scoring=scoring, refit=False)
    leaf = F.get_json_object("params", "$.min_samples_leaf").cast("int").alias("leaf")
    best = (F.col("params") == json.dumps(found.best_params, sort_keys=True)).alias("best")
    columns = ["mean_test", "std_test", "mean_train", "std_train"]
    return rounded(found.table(data).select(leaf, best, *columns), *columns, places=9)


def grid_levels(spark: SparkSession, folder: str) -> DataFrame:
    """A whole tree and one without a split, with their scores over three folds."""
    return _searched(spark, folder, "grid", "f1_macro")


def random_levels(spark: SparkSession, folder: str) -> DataFrame:
    return _searched(spark, folder, "random", "accuracy")


JOB_SPEC = PipelineSpec(
    target_column="o_orderpriority",
    key_columns=KEY,
    numeric_columns=["c_nationkey"],
    scaler_type="minmax",
    severity_mapping=PRIORITY_CLASS,
    model_type="rf",
    model_params={"rf": ONE_TREE},
    handle_imbalance="none",
    n_splits=3,
)


def _compared(spark: SparkSession, path: str) -> DataFrame:
    """A written comparison, its columns named like the measures."""
    written = read_csv(spark, path, validate=False)
    return written.toDF(*[c.lower().replace("-", "_") for c in written.columns])


def _report(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first().value)


def train_levels(spark: SparkSession, folder: str) -> DataFrame:
    """Split, fit, cross-validate, evaluate and report: the numbers of the written report."""
    path = scratch_path(spark)
    spec = PipelineSpec(**{**JOB_SPEC.__dict__, "optimize_hyperparameters": True, "search_cv": 2, "search_spaces": {"rf": {**{k: [v] for k, v in ONE_TREE.items()}, "min_samples_leaf": LEAVES}}})
    run(spark, spec, _raw(spark, folder), path, "train")
    report = _report(spark, f"{path}/training_report")
    made, info = report["models"]["rf"], report["data_info"]
    found = read_csv(spark, f"{path}/models/rf_search.csv", validate=False)
    searched = found.select(F.max("mean_test")).first()[0]
    row = (info["total_samples"], info["test_samples"], report["best_model"], *[made[m] for m in MEASURES], *report["cross_validation"]["rf"]["cv_scores"], searched)
    names = "total bigint, tested bigint, best string, " + ", ".join(f"{m} double" for m in MEASURES) + ", cv0 double, cv1 double, cv2 double, searched double"
    return rounded(spark.createDataFrame([row], names), *MEASURES, "cv0", "cv1", "cv2", "searched", places=9)


def train_levels_compared(spark: SparkSession, folder: str) -> DataFrame:
    """Two model types on one split: the comparison as it is written. Logistic regression sees dummies of the levels."""
    data = _raw(spark, folder)
    dummies = [(F.col("c_nationkey") == i).cast("int").alias(f"n{i}") for i in range(25)]
    path = scratch_path(spark)
    spec = PipelineSpec(**{**JOB_SPEC.__dict__, "model_type": ["rf", "lr"], "n_splits": 0, "model_params": {"rf": ONE_TREE, "lr": {"C": 1e9, "max_iter": 100}}})
    done = train_models(data.select("*", *dummies), spec, KEY, ["c_nationkey", *[f"n{i}" for i in range(25)]], path)
    written = _compared(spark, f"{path}/model_comparison.csv")
    return rounded(written.where("model = 'rf'").select("model", *MEASURES), *MEASURES, places=9) if not done.errors else written


def evaluate_levels(spark: SparkSession, folder: str) -> DataFrame:
    """Two models of a folder and one that cannot be applied: the comparison and the summary as they are written."""
    path = scratch_path(spark)
    data = materialise(_labelled(spark, folder))  # three fits read it several times each
    for name, leaf in (("whole", 1), ("bare", LEAVES[1])):
        model = fit_model(data, ["c_nationkey"], "label", "rf", {**ONE_TREE, "min_samples_leaf": leaf})
        save_model(model, spark, f"{path}/models/{name}", name)
    strange = fit_model(data.withColumn("other", F.col("c_nationkey")), ["other"], "label", "rf", ONE_TREE)
    save_model(strange, spark, f"{path}/models/strange", "strange")
    evaluate_folder(spark, f"{path}/models", _raw(spark, folder), "o_orderpriority", KEY, f"{path}/reports", PRIORITY_CLASS)
    summary = _report(spark, f"{path}/reports/multiple_models_evaluation")["evaluation_summary"]
    written = _compared(spark, f"{path}/reports/model_comparison.csv")
    counts = [F.lit(summary[c]).cast("bigint").alias(c) for c in ("total_models", "successful_evaluations", "test_samples")]
    return rounded(written.select("model", *MEASURES, *counts), *MEASURES, places=9)


def report_levels(spark: SparkSession, folder: str) -> DataFrame:
    """The report of one model, read back: its confusion matrix."""
    path = scratch_path(spark)
    model = fit_model(_labelled(spark, folder), ["c_nationkey"], "label", "rf", ONE_TREE)
    save_model(model, spark, f"{path}/model", "tree")
    evaluate_saved(spark, f"{path}/model", _raw(spark, folder), "o_orderpriority", KEY, f"{path}/report", PRIORITY_CLASS)
    cells = _report(spark, f"{path}/report/single_model_evaluation")["confusion_matrix"]
    return spark.createDataFrame([(c["label"], c["prediction"], c["n"]) for c in cells], "label int, prediction int, n bigint")


def full_run_levels(spark: SparkSession, folder: str) -> DataFrame:
    """All stages from the raw table on: the written metrics of the best model on rows that it has not seen."""
    path = scratch_path(spark)
    done = run(spark, JOB_SPEC, _raw(spark, folder), path)
    written = read_csv(spark, f"{path}/evaluation/best_model_metrics.csv", validate=False)
    kept = F.lit(spark.read.parquet(done.paths["test"]).count()).cast("bigint").alias("kept")
    return rounded(written.select(*MEASURES, F.col("sample_count").cast("bigint").alias("sample_count"), kept), *MEASURES, places=9)


def wide_run(spark: SparkSession, folder: str) -> DataFrame:
    """A column with a value per customer reaches every model; the class follows from it, and logistic regression finds it."""
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("customer"), (F.col("o_custkey") % 2).cast("int").alias("label"))
    encoder = fit_onehot(orders, ["customer"], dense_levels=50)
    data = encoder.transform(orders)
    small = {"lr": {"C": 1e4, "max_iter": 100}, "rf": {"n_estimators": 2, "max_depth": 2}, "xgboost": {"n_estimators": 2, "max_depth": 2}}
    rows = [("levels", encoder.sizes["customer"])]
    for kind, params in small.items():
        found = fit_model(data, ["customer_onehot"], "label", kind, params).predict(data)
        rows.append((f"{kind} rows", found.where("prediction IS NOT NULL").count()))
        if kind == "lr":
            rows.append(("lr correct", found.where("prediction = label").count()))
    folds = cross_validate(data, ["customer_onehot"], "label", KEY, "lr", small["lr"], k=2, balance=Balance("class_weight"))
    rows.append(("folds", len(folds.test)))
    try:
        Balance("smote", tuple(KEY)).apply(data, ["customer_onehot"], "label")
    except ValueError as e:
        rows.append((str(e).split(":")[0], 0))
    return spark.createDataFrame(rows, "what string, n bigint")


#: Blocks of thirteen keys hold a class of six rows and one of seven: over 20,000 classes at the bench's scale.
_BLOCKS = "CAST(o_orderkey DIV 13 * 2 + CAST(o_orderkey % 13 >= 6 AS INT) AS BIGINT)"
SPOTS = [f"v{i}" for i in range(64)]


def _blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Orders in whole blocks, with 64 features made from key and customer."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", F.expr(_BLOCKS).alias("block"))
    full = orders.groupBy("block").agg(F.count(F.lit(1)).alias("held"))
    spots = [F.expr(f"CAST((o_orderkey * {37 * i + 11} + o_custkey * {i + 1}) % 1009 AS DOUBLE) AS v{i}") for i in range(64)]
    return orders.join(full.where("held >= 6"), "block").select("o_orderkey", "block", *spots)


def smote_many_classes(spark: SparkSession, folder: str) -> DataFrame:
    made = balance.smote(_blocks(spark, folder), SPOTS, "block", KEY)
    return rounded(made.select("v0", "v31", "v63", "block", "is_synthetic"), "v0", "v31", "v63", places=6)


def weights_huge(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", F.expr(_BLOCKS).alias("block"))
    return rounded(balance.with_class_weights(orders, "block"), "weight", places=9)


QUERIES = {
    "cv_levels": cv_levels,
    "grid_levels": grid_levels,
    "random_levels": random_levels,
    "train_levels": train_levels,
    "train_levels_compared": train_levels_compared,
    "evaluate_levels": evaluate_levels,
    "report_levels": report_levels,
    "full_run_levels": full_run_levels,
    "wide_run": wide_run,
    "smote_many_classes": smote_many_classes,
    "weights_huge": weights_huge,
}
_LEVELS = """
SELECT o_orderkey, c_nationkey, CASE o_orderpriority WHEN '3-MEDIUM' THEN 1 WHEN '2-HIGH' THEN 2
  WHEN '1-URGENT' THEN 2 ELSE 0 END::INTEGER AS label FROM orders JOIN customer ON o_custkey = c_custkey"""


def _folds(source: str, k: int) -> str:
    h = "('0x' || substr(md5(o_orderkey::VARCHAR || ':42'), 1, 15))::BIGINT"
    return f"SELECT *, ntile({k}) OVER (PARTITION BY label ORDER BY {h}, o_orderkey) - 1 AS fold FROM ({source})"


def _predicted(train: str, tested: str, groups: str, level: str = "c_nationkey") -> str:
    """Rows of ``tested`` with the commonest class of their level in ``train``, per ``groups``; ties to the smaller class."""
    return f"""
SELECT t.*, m.prediction FROM ({tested}) t JOIN (SELECT {groups}, {level} AS v, label AS prediction FROM
  (SELECT {groups}, {level}, label, count(*) AS n FROM ({train}) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY {groups}, {level} ORDER BY n DESC, label) = 1) m
ON m.v = t.{level} AND {" AND ".join(f"m.{g} = t.{g}" for g in groups.split(", "))}"""


def _measured(predicted: str, groups: str) -> str:
    """The measures of predictions, per ``groups``."""
    ratio = "CASE WHEN {1} > 0 THEN {0}::DOUBLE / {1} ELSE 0.0 END"
    f1, p, r = (ratio.format(a, b) for a, b in (("2 * hits", "(s + q)"), ("hits", "q"), ("hits", "s")))
    return f"""
SELECT {groups}, sum(hits)::DOUBLE / sum(s) AS accuracy, avg({f1}) AS f1_macro, sum({f1} * s) / sum(s) AS f1_weighted,
  avg({p}) AS precision_macro, avg({r}) AS recall_macro, sum(s)::BIGINT AS n FROM
  (SELECT {groups}, c, sum(s) AS s, sum(q) AS q, sum(hits) AS hits FROM
    (SELECT {groups}, label AS c, 1 AS s, 0 AS q, (label = prediction)::INT AS hits FROM ({predicted})
     UNION ALL SELECT {groups}, prediction, 0, 1, 0 FROM ({predicted})) GROUP BY {groups}, c) GROUP BY {groups}"""


def _crossed(source: str, k: int, level: str = "c_nationkey") -> str:
    """Rows (i, test, label, prediction) of every fold's model, on its test part and on its training part."""
    train = f"SELECT i, f.* FROM f, (SELECT unnest(range({k})) AS i) WHERE fold <> i"
    both = f"SELECT i, fold = i AS test, f.* FROM f, (SELECT unnest(range({k})) AS i)"
    return f"WITH f AS ({_folds(source, k)}) {_predicted(train, both, 'i', level)}"


def _search_rows(measure: str) -> str:
    parts = []
    for leaf, level in ((LEAVES[0], "c_nationkey"), (LEAVES[1], "one")):
        rows = _crossed(f"SELECT *, 1 AS one FROM ({_LEVELS})", 3, level)
        parts.append(f"SELECT {leaf} AS leaf, test, i, {measure} AS score FROM ({_measured(rows, 'i, test')})")
    return f"""
WITH s AS ({" UNION ALL ".join(parts)}), a AS (SELECT leaf, avg(score) FILTER (WHERE test) AS mean_test,
  stddev_pop(score) FILTER (WHERE test) AS std_test, avg(score) FILTER (WHERE NOT test) AS mean_train,
  stddev_pop(score) FILTER (WHERE NOT test) AS std_train FROM s GROUP BY leaf)
SELECT leaf::INTEGER AS leaf, row_number() OVER (ORDER BY mean_test DESC, leaf) = 1 AS best, round(mean_test, 9) + 0.0 AS mean_test,
  round(std_test, 9) + 0.0 AS std_test, round(mean_train, 9) + 0.0 AS mean_train, round(std_train, 9) + 0.0 AS std_train FROM a"""


_PARTS = _split(_LEVELS, "label", "o_orderkey", "0.2::DOUBLE", 42)
_HELD_OUT = f"WITH s AS ({_PARTS}) " + _predicted("SELECT 1 AS g, * FROM s WHERE NOT is_test", "SELECT 1 AS g, * FROM s WHERE is_test", "g")
_COMPARED = ", ".join(f"round({m}, 4) + 0.0 AS {m}" for m in MEASURES)  # as comparisons show them
_ROUNDED = ", ".join(f"round({m}, 9) + 0.0 AS {m}" for m in MEASURES)
_TRAIN_ROWS = f"SELECT * EXCLUDE (is_test) FROM ({_PARTS}) WHERE NOT is_test"
_TRAIN_CV = f"SELECT i, round(f1_macro, 9) + 0.0 AS score FROM ({_measured(f'SELECT * FROM ({_crossed(_TRAIN_ROWS, 3)}) WHERE test', 'i')})"
_SEARCHED = " UNION ALL ".join(
    f"SELECT {n} AS leaf, avg(f1_macro) AS score FROM ({_measured(f'SELECT * FROM ({_crossed(f"SELECT *, 1 AS one FROM ({_TRAIN_ROWS})", 2, level)}) WHERE test', 'i')})"
    for n, level in ((LEAVES[0], "c_nationkey"), (LEAVES[1], "one"))
)
_WHOLE = {
    name: _measured(_predicted(f"SELECT 1 AS g, 1 AS one, * FROM ({_LEVELS})", f"SELECT 1 AS g, 1 AS one, * FROM ({_LEVELS})", "g", level), "g")
    for name, level in (("whole", "c_nationkey"), ("bare", "one"))
}
_BLOCK_SQL = "(o_orderkey // 13 * 2 + (o_orderkey % 13 >= 6)::INT)::BIGINT"
_SPOTS_SQL = f"""
SELECT o_orderkey, block, {", ".join(f"((o_orderkey * {37 * i + 11} + o_custkey * {i + 1}) % 1009)::DOUBLE AS v{i}" for i in range(64))}
FROM (SELECT *, {_BLOCK_SQL} AS block, count(*) OVER (PARTITION BY {_BLOCK_SQL}) AS held FROM orders) WHERE held >= 6"""

ORACLES: dict[str, str] = {
    "cv_levels": f"""
SELECT i::INTEGER AS fold, round(f1_macro, 9) + 0.0 AS f1_macro FROM ({_measured(f"SELECT * FROM ({_crossed(_LEVELS, 5)}) WHERE test", "i")})""",
    "grid_levels": _search_rows("f1_macro"),
    "random_levels": _search_rows("accuracy"),
    "train_levels": f"""
WITH t AS ({_PARTS}), m AS ({_measured(_HELD_OUT, "g")}), c AS ({_TRAIN_CV}), s AS ({_SEARCHED})
SELECT (SELECT count(*) FROM t) AS total, m.n AS tested, 'rf' AS best, {_ROUNDED}, (SELECT score FROM c WHERE i = 0) AS cv0,
  (SELECT score FROM c WHERE i = 1) AS cv1, (SELECT score FROM c WHERE i = 2) AS cv2,
  round((SELECT max(score) FROM s), 9) + 0.0 AS searched FROM m""",
    "train_levels_compared": f"SELECT 'rf' AS model, {_COMPARED} FROM ({_measured(_HELD_OUT, 'g')})",
    "evaluate_levels": " UNION ALL ".join(
        f"SELECT '{name}' AS model, {_COMPARED}, 3::BIGINT AS total_models, 2::BIGINT AS successful_evaluations, n AS test_samples FROM ({sql})"
        for name, sql in _WHOLE.items()
    ),
    "report_levels": f"""
WITH p AS ({_predicted(f"SELECT 1 AS g, * FROM ({_LEVELS})", f"SELECT 1 AS g, * FROM ({_LEVELS})", "g")}),
c AS (SELECT label AS v FROM p UNION SELECT prediction FROM p)
SELECT a.v AS label, b.v AS prediction, (SELECT count(*) FROM p WHERE p.label = a.v AND p.prediction = b.v) AS n FROM c a, c b""",
    "full_run_levels": f"SELECT {_ROUNDED}, n AS sample_count, n AS kept FROM ({_measured(_HELD_OUT, 'g')})",
    "wide_run": """
WITH n AS (SELECT count(*) AS n, count(DISTINCT o_custkey) AS k FROM orders)
SELECT what, CASE what WHEN 'levels' THEN k WHEN 'folds' THEN 2 WHEN '[''customer_onehot''] are sparse vectors, between which no rows are made'
  THEN 0 ELSE n END AS n FROM n, (VALUES ('levels'), ('lr rows'), ('lr correct'), ('rf rows'), ('xgboost rows'), ('folds'),
  ('[''customer_onehot''] are sparse vectors, between which no rows are made')) AS x(what)""",
    "smote_many_classes": _smote(
        _SPOTS_SQL, "o_orderkey", "block", SPOTS, " + ".join(f"(x.{v} - y.{v}) ** 2" for v in SPOTS), ["v0", "v31", "v63"], 6
    ),
    "weights_huge": f"""
WITH t AS (SELECT o_orderkey, {_BLOCK_SQL} AS block FROM orders), c AS (SELECT block AS b, count(*) AS n FROM t GROUP BY 1)
SELECT t.*, round((SELECT sum(n) FROM c)::DOUBLE / ((SELECT count(*) FROM c) * n), 9) + 0.0 AS weight FROM t JOIN c ON block = b""",
}
