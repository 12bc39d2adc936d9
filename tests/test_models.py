import json
import os
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.sql import functions as F

from tabwright.operators import boost, models, sparse_logistic, sparse_trees, tune
from tabwright.operators.boost import shares_of
from tabwright.functions.keys import with_content_key
from tabwright.functions.stage import materialise, scratch_scope
from tabwright.functions.vectors import as_vectors, gathered, one_of
from tabwright.operators.encode import fit_onehot
from tabwright.operators.evaluate import metrics
from tabwright.operators.features import add_polynomials, as_pairs, fit_interactions, polynomial_terms
from tabwright.operators.models import KINDS, ModelKind, fit_model, full_params, register_model, spark_params
from tabwright.operators.reduce import fit_components
from tabwright.operators.select import anova_scores, fit_selection
from tabwright.operators.split import assign_folds, stratified_split
from tabwright.operators.tune import Balance, cross_validate, grid_size, random_choices, search
from tabwright.plans.evaluate import evaluate_folder, evaluate_saved
from tabwright.plans import run as run_plan
from tabwright.plans.preprocess import ROW_ID, fit_preprocessing
from tabwright.plans.run import run, score
from tabwright.sources.models import load_model, save_model
from tabwright.spec import PipelineSpec

TARGET = "사고유형코드"
FEATURES = [f"feature_{i}" for i in range(5)]
SMALL = {"lr": {"max_iter": 8}, "rf": {"n_estimators": 5, "max_depth": 4}, "xgboost": {"n_estimators": 3, "max_depth": 2}}


@pytest.fixture(scope="module")
def cases(spark):
    """Two hundred rows whose class shows in the first feature."""
    rng = np.random.default_rng(42)
    rows = []
    for i in range(200):
        c = int(rng.choice(3, p=[0.5, 0.3, 0.2]))
        rows.append((i, *[float(x) for x in rng.normal(size=5) + [3 * c, 0, 0, 0, 0]], str([210, 701, 705][c]), c))
    names = ["id bigint", *[f"{f} double" for f in FEATURES], f"`{TARGET}` string", "label int"]
    return spark.createDataFrame(rows, ", ".join(names)).coalesce(2).persist()


@pytest.mark.parametrize("kind", ["lr", "rf", "xgboost"])
def test_fit_predict_save_load(spark, cases, tmp_path, kind):
    model = fit_model(cases, FEATURES, "label", kind, SMALL[kind])
    out = model.predict(cases)
    rows = out.collect()
    assert out.columns == [*cases.columns, "probability", "prediction"] and len(rows) == 200
    assert all(abs(sum(r.probability) - 1) < 1e-9 and r.prediction == int(np.argmax(r.probability)) for r in rows)
    assert metrics(out).first().accuracy > 0.75
    ranked = sorted(model.importances().items(), key=lambda kv: -kv[1])
    assert ranked[0][0] == "feature_0" and len(ranked) == 5
    path = save_model(model, spark, str(tmp_path / kind))
    back = load_model(spark, path)
    assert (back.features, back.classes, back.params, back.seed) == (model.features, model.classes, model.params, model.seed)
    assert [r.prediction for r in back.predict(cases).orderBy("id").collect()] == [r.prediction for r in out.orderBy("id").collect()]


@pytest.fixture(scope="module")
def wide(spark):
    """Rows whose class follows a text column of 1300 values."""
    rows = [(i, f"note {i % 1300}", float(i % 7), str([210, 701, 705][i % 1300 % 3]), i % 1300 % 3) for i in range(5200)]
    return spark.createDataFrame(rows, f"id bigint, note string, amount double, `{TARGET}` string, label int").coalesce(2).persist()


@pytest.mark.parametrize("kind", ["lr", "rf", "xgboost"])
def test_a_column_of_many_values_reaches_a_model(spark, wide, tmp_path, kind):
    encoder = fit_onehot(wide, ["note"])
    assert encoder.levels == {} and encoder.sizes == {"note": 1300}
    coded = encoder.transform(wide)
    assert coded.columns == ["id", "amount", TARGET, "label", "note_onehot"]
    assert coded.select(F.sum(F.size("note_onehot.indices"))).first()[0] == 5200
    model = fit_model(coded, ["note_onehot", "amount"], "label", kind, {**SMALL[kind], "max_iter": 60, "C": 1e4} if kind == "lr" else SMALL[kind])
    found = model.predict(coded)
    assert found.count() == 5200 and list(model.importances()) == ["note_onehot", "amount"]
    if kind == "lr":
        assert found.where("prediction = label").count() == 5200
        assert model.importances()["note_onehot"] > model.importances()["amount"]
    back = load_model(spark, save_model(model, spark, str(tmp_path / kind)))
    assert back.widths == [1300, 1]
    new = spark.createDataFrame([(1, "unseen", 1.0, "210", 0), (2, None, 1.0, "210", 0)], wide.schema)
    assert [len(r.probability) for r in back.predict(encoder.transform(new)).collect()] == [3, 3]


def test_sparse_vectors_hold_what_the_columns_hold(spark):
    df = spark.createDataFrame([("a", 1.5, True), ("b", None, False), (None, -2.0, None)], "s string, x double, y boolean")
    coded = fit_onehot(df, ["s"], dense_levels=1).transform(df)
    full = as_vectors(coded.select(gathered(coded, ["x", "s_onehot", "y"], "-9D").alias("v")), ["v"])
    rows = sorted(r.v.toArray().tolist() for r in full.collect())
    assert rows == [[-9.0, 0.0, 1.0, 0.0], [-2.0, 0.0, 0.0, -9.0], [1.5, 1.0, 0.0, 1.0]]
    with pytest.raises(Exception, match="missing"):
        fit_model(coded.withColumn("c", F.col("x").isNull().cast("int")), ["x", "s_onehot"], "c", "lr", SMALL["lr"])


def test_whole_run_with_a_column_of_many_values(spark, wide, tmp_path):
    spec = PipelineSpec(
        key_columns=["id"], numeric_columns=["amount"], categorical_columns=["note"], n_select_features=1, model_type=["lr", "rf"],
        model_params={"lr": {"max_iter": 60, "C": 1e4}, "rf": SMALL["rf"]}, n_splits=2, handle_imbalance="class_weight", pca_components=1,
    )
    table = wide.drop("label")
    done = run(spark, spec, table, str(tmp_path / "out"))
    assert not done.training.errors and len(done.training.cross_validation["lr"].test) == 2
    assert done.evaluation.metrics.first().accuracy > 0.95
    assert score(spark, table, str(tmp_path / "out")).where("prediction is not null").count() == 5200
    with pytest.raises(ValueError, match="note_onehot.*sparse"):
        run(spark, replace(spec, handle_imbalance="smote"), table.where("id % 3 > 0 or id > 2000"), str(tmp_path / "smote"))


def _plain_boosting(x, y, k, rounds, depth, rate, l1, l2, least):
    """The same trees by plain loops over all thresholds."""
    margins = np.zeros((len(x), 1 if k == 2 else k))
    worth = lambda g, h: max(abs(g) - l1, 0) ** 2 / (h + l2)

    def grow(rows, g, h, level, out):
        total = g[rows].sum(), h[rows].sum()
        out[rows] = -np.sign(total[0]) * max(abs(total[0]) - l1, 0) / (total[1] + l2) * rate
        if level == depth:
            return
        best = (1e-9, None, None)
        for j in range(x.shape[1]):
            for v in np.unique(x[rows, j])[:-1]:
                left = x[rows, j] <= v
                a, b = (g[rows][left].sum(), h[rows][left].sum()), (g[rows][~left].sum(), h[rows][~left].sum())
                gain = worth(*a) + worth(*b) - worth(*total)
                if min(a[1], b[1]) >= least and gain > best[0] + 1e-9:
                    best = (gain, j, v)
        if best[1] is not None:
            left = x[rows, best[1]] <= best[2]
            grow(rows[left], g, h, level + 1, out)
            grow(rows[~left], g, h, level + 1, out)

    for _ in range(rounds):
        p = shares_of(margins)
        step = np.zeros_like(margins)
        for m in range(margins.shape[1]):
            q, goal = (p[:, 1], y == 1) if k == 2 else (p[:, m], y == m)
            grow(np.arange(len(x)), q - goal, q * (1 - q), 0, step[:, m])
        margins += step
    return shares_of(margins)


@pytest.mark.parametrize("k,l1,l2,least", [(3, 0.0, 1.0, 1.0), (3, 0.7, 0.0, 0.0), (2, 0.2, 3.0, 2.0)])
def test_boosting_equals_plain_loops(spark, monkeypatch, k, l1, l2, least):
    monkeypatch.setattr(boost, "KEPT_ROUNDS", 2)
    rng = np.random.default_rng(k)
    x = rng.integers(0, 9, size=(240, 3)).astype(float)
    y = ((x[:, 0] + 2 * x[:, 1] + rng.integers(0, 5, 240)) // 9).astype(int) % k
    df = spark.createDataFrame([(*map(float, r), int(c)) for r, c in zip(x, y)], "a double, b double, c double, label int").repartition(3)
    params = {"n_estimators": 5, "max_depth": 3, "learning_rate": 0.4, "subsample": 1.0, "colsample_bytree": 1.0, "min_child_weight": least, "reg_alpha": l1, "reg_lambda": l2}
    found = fit_model(df, ["a", "b", "c"], "label", "xgboost", params).predict(df).collect()
    rows = np.array([[r.a, r.b, r.c] for r in found])
    want = _plain_boosting(rows, np.array([r.label for r in found]), k, 5, 3, 0.4, l1, l2, least)
    assert np.allclose(np.array([r.probability for r in found]), want, atol=1e-6)


def test_boosting_draws_rows_and_columns(spark, cases):
    params = {**SMALL["xgboost"], "subsample": 0.6, "colsample_bytree": 0.4}
    one, two = (fit_model(cases, FEATURES, "label", "xgboost", params).parts[0] for _ in range(2))
    assert one.to_json() == two.to_json()
    other = fit_model(cases, FEATURES, "label", "xgboost", params, seed=5).parts[0]
    assert other.to_json() != one.to_json()
    models = [fit_model(cases, FEATURES, "label", "xgboost", {**SMALL["xgboost"], "reg_alpha": a, "reg_lambda": b}).parts[0].to_json() for a in (0, 0.5) for b in (0, 1.0)]
    assert len(set(models)) == 4


def test_boosting_sends_missing_values_where_they_gain(spark):
    rows = [(float(i % 10) if i % 4 else None, int(i % 4 == 0 or i % 10 > 6)) for i in range(400)]
    df = spark.createDataFrame(rows, "x double, label int")
    for kind in ({"max_depth": 2}, {"max_depth": 3}):
        model = fit_model(df, ["x"], "label", "xgboost", {**SMALL["xgboost"], **kind, "n_estimators": 8, "learning_rate": 1.0})
        assert model.predict(df).where("prediction = label").count() == 400


def test_two_classes_and_odd_class_names(spark, cases):
    named = cases.withColumn("answer", F.when(F.col("label") == 0, -1).otherwise(7))
    for kind in ("lr", "xgboost"):
        model = fit_model(named, FEATURES, "answer", kind, SMALL[kind])
        assert model.classes == [-1, 7] and len(model.parts) == 1
        assert metrics(model.predict(named), "answer").first().accuracy > 0.8


def test_bare_pipeline_is_accepted(spark, cases, tmp_path):
    model = fit_model(cases, FEATURES, "label", "lr", SMALL["lr"])
    PipelineModel(model.parts).write().save(str(tmp_path / "bare"))
    back = load_model(spark, str(tmp_path / "bare"), FEATURES)
    assert back.predict(cases).where("prediction = label").count() > 150
    with pytest.raises(FileNotFoundError):
        load_model(spark, str(tmp_path / "bare"))


def test_fit_errors(cases):
    with pytest.raises(ValueError, match="unknown model type"):
        fit_model(cases, FEATURES, "label", "svm")
    with pytest.raises(ValueError, match="fewer than two"):
        fit_model(cases.where("label = 0"), FEATURES, "label", "lr")


def test_missing_features(spark, cases):
    holed = cases.withColumn("feature_1", F.when(F.col("id") % 3 != 0, F.col("feature_1")))
    model = fit_model(holed, FEATURES, "label", "xgboost", SMALL["xgboost"])
    assert model.predict(holed).count() == 200
    with pytest.raises(Exception):
        fit_model(holed, FEATURES, "label", "lr", SMALL["lr"])


def test_parameter_translation():
    assert spark_params("lr", {"C": 0.5}, 100) == {"maxIter": 1000, "regParam": 0.02}
    with pytest.raises(ValueError, match="max_depth 50"):
        spark_params("rf", {"max_depth": 50}, 1)
    rf = spark_params("rf", {"max_depth": None, "max_features": None}, 1)
    assert rf["maxDepth"] == 30 and rf["featureSubsetStrategy"] == "all"
    gbt = spark_params("gbt", {"colsample_bytree": 1.0, "min_child_weight": 0}, 1)
    assert gbt["featureSubsetStrategy"] == "all" and gbt["minInstancesPerNode"] == 1
    assert full_params("rf", {"n_estimators": 7})["n_estimators"] == 7
    assert spark_params("xgboost", {"reg_alpha": 0.5}, 1) != spark_params("xgboost", {"reg_alpha": 1.0}, 1)


def test_search_spaces():
    assert {k: grid_size(v) for k, v in tune.SEARCH_SPACES.items()} == {"lr": 63, "rf": 4500, "xgboost": 46080}
    picked = random_choices(tune.SEARCH_SPACES["rf"], 20, 1)
    assert picked == random_choices(tune.SEARCH_SPACES["rf"], 20, 1)
    assert len({json.dumps(p) for p in picked}) == 20
    assert len(random_choices({"a": [1, 2], "b": [3]}, 10, 1)) == 2


def test_cross_validation_is_a_loop_over_folds(spark, cases):
    scores = cross_validate(cases, FEATURES, "label", ["id"], "lr", SMALL["lr"], k=2)
    folded = assign_folds(cases, "label", ["id"], 2)
    want = []
    for i in range(2):
        model = fit_model(folded.where(F.col("fold") != i), FEATURES, "label", "lr", SMALL["lr"])
        want.append(metrics(model.predict(folded.where(F.col("fold") == i))).first().f1_macro)
    assert np.allclose(scores.test, want, atol=1e-6)
    with pytest.raises(ValueError, match="scoring"):
        cross_validate(cases, FEATURES, "label", ["id"], "lr", SMALL["lr"], k=2, scoring="speed")


def test_search_shares_equal_candidates(spark, cases):
    space = {"C": [0.01, 1.0], "solver": ["lbfgs", "newton-cg"], "max_iter": [6]}
    found = search(cases, FEATURES, "label", ["id"], "lr", space, k=2, balance=Balance("smote", ("id",)))
    assert len(found.scores) == 4 and found.scores[0].test == found.scores[1].test
    assert found.best_score == max(s.mean for s in found.scores) and found.model.params["C"] == found.best_params["C"]
    assert found.table(cases).count() == 4
    with pytest.raises(ValueError, match="unsupported"):
        search(cases, FEATURES, "label", ["id"], "lr", space, "bayesian")


def test_components_equal_numpy(spark, cases):
    x = np.array([[r[f] for f in FEATURES] for r in cases.orderBy("id").collect()])
    centred = x - x.mean(axis=0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    vt = np.array([v if max(v, key=abs) > 0 else -v for v in vt[:2]])
    for limit in (20, 2):
        import tabwright.operators.reduce as reduce

        old, reduce.SUMMED_FEATURES = reduce.SUMMED_FEATURES, limit
        try:
            fitted = fit_components(cases, FEATURES, 2)
        finally:
            reduce.SUMMED_FEATURES = old
        got = np.array([[r.PC1, r.PC2] for r in fitted.transform(cases).orderBy("id").collect()])
        assert np.allclose(got, centred @ vt.T, atol=1e-8)
        assert np.allclose(fitted.ratios, (s**2 / (s**2).sum())[:2])
    assert fit_components(cases, FEATURES[:2], 2).transform(cases) is cases


def test_anova_equals_the_formula(spark, cases):
    rows = cases.collect()
    x, y = np.array([r.feature_0 for r in rows]), np.array([r.label for r in rows])
    parts = [x[y == c] for c in range(3)]
    between = sum(len(p) * (p.mean() - x.mean()) ** 2 for p in parts) / 2
    inner = sum(((p - p.mean()) ** 2).sum() for p in parts) / (len(x) - 3)
    scores = anova_scores(cases.withColumn("still", F.lit(1.0)), ["feature_0", "still"], "label")
    assert np.isclose(scores["feature_0"], between / inner) and scores["still"] is None
    chosen = fit_selection(cases.withColumn("still", F.lit(1.0)), ["still", *FEATURES], "label", 5).chosen
    assert chosen == FEATURES
    with pytest.raises(ValueError):
        fit_selection(cases, FEATURES, "absent", 2)


def test_ratio_guard(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1e-11, 0.0, None), (2.0, 4.0, 1.0, 1.0, 1.0)], "a double, ok double, tiny double, zero double, gap double")
    pairs = [("a", c) for c in ("ok", "tiny", "zero", "gap", "absent")]
    made = fit_interactions(df, pairs).transform(df)
    assert [c for c in made.columns if c.endswith("_ratio")] == ["a_to_ok_ratio"]
    assert [c for c in made.columns if c.endswith("_interaction")] == [f"a_{c}_interaction" for c in ("ok", "tiny", "zero", "gap")]
    assert as_pairs(["a", "b", "c"]) == [("a", "b")]


def test_polynomial_names(spark):
    names = [n for n, _ in polynomial_terms(["a", "b"], 3)]
    assert names == ["a^2", "a b", "b^2", "a^3", "a^2 b", "a b^2", "b^3"]
    df = spark.createDataFrame([(2.0, 3.0)], "a double, b double")
    assert add_polynomials(df, ["a", "b"], 2, True).columns == ["a", "b", "1", "a^2", "a b", "b^2"]
    assert add_polynomials(df, ["a", "b"], 1).columns == ["a", "b"]
    with pytest.raises(ValueError):
        add_polynomials(df, ["a"], 0)


def test_whole_run_from_a_file(spark, cases, tmp_path):
    """No key is given: the run numbers the cleaned rows itself; a failing model does not stop the others."""
    csv = str(tmp_path / "in.csv")
    cases.drop("id", "label").withColumn("Kind", F.when(F.col("feature_1") > 0, "up").otherwise("down")).write.option("header", True).csv(csv)
    spec = PipelineSpec.from_dict(
        {
            "target-column": TARGET, "numeric-columns": FEATURES, "categorical-columns": ["Kind"], "handle-outliers-cols": FEATURES,
            "interaction-features": ["feature_0", "feature_1"], "model-type": ["lr", "rf"], "model_params": {**SMALL, "rf": {"n_estimators": -1}},
            "n-splits": 2, "enable-pca": True,
        }
    )
    out = str(tmp_path / "out")
    done = run(spark, spec, csv, out)
    training = done.training
    assert set(training.evaluations) == {"lr"} and set(training.errors) == {"rf"} and training.best == "lr"
    assert training.data_info["total_samples"] == 200 and training.data_info["test_samples"] == 40
    assert len(training.cross_validation["lr"].test) == 2
    assert done.evaluation.metrics.first().accuracy > 0.6
    report = json.loads(spark.read.text(f"{out}/evaluation/single_model_evaluation").first().value)
    assert report["sample_count"] == 40 and "report_generated_at" in report["metadata"]
    featured = spark.read.parquet(f"{out}/featured_data")
    assert {"kind_up", "kind_down", "feature_0_feature_1_interaction", "row_id"} <= set(featured.columns)
    assert spark.read.option("header", True).csv(f"{out}/models/lr_evaluation/lr_confusion.csv").count() == 9
    assert spark.read.parquet(f"{out}/evaluation/best_model_roc").where("class = 0").count() > 2
    again = run(spark, spec, featured, out, "evaluate")
    assert again.evaluation.metrics.first().sample_count == 200


def test_keys_from_contents(spark, cases):
    """Without a key, rows are told apart by their values: splits do not depend on partitions, repeated rows are numbered."""
    plain = cases.drop("id", "label")
    spec = PipelineSpec(numeric_columns=FEATURES, handle_imbalance="none")
    parts = []
    for n in (1, 13):
        _, done = fit_preprocessing(plain.repartition(n), spec)
        assert done.select(ROW_ID).distinct().count() == done.count() == 200
        split = stratified_split(done, TARGET, [ROW_ID], 0.2).where("is_test")
        parts.append({tuple(round(r[f], 9) for f in FEATURES) for r in split.collect()})
    assert parts[0] == parts[1] and len(parts[0]) == 40
    rows = spark.createDataFrame([("a", None), ("a", None), ("a", ""), ("", "a"), ("a", None)], "x string, y string")
    keyed = with_content_key(rows, "k", distinct=False)
    assert keyed.select("k").distinct().count() == 5
    assert with_content_key(rows, "k", distinct=True).select("k").distinct().count() == 3


def test_a_run_goes_on_where_it_was_broken_off(spark, cases, tmp_path, monkeypatch):
    out, table = str(tmp_path / "out"), cases.drop("label")
    spec = PipelineSpec(key_columns=["id"], numeric_columns=FEATURES, model_type=["lr"], model_params=SMALL, n_splits=0, handle_imbalance="class_weight")

    def broken(*args, **names):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(run_plan, "evaluate_saved", broken)
        with pytest.raises(KeyboardInterrupt):
            run(spark, spec, table, out, resume=True)
    with monkeypatch.context() as m:
        for stage in ("fit_preprocessing", "fit_features", "train_models"):
            m.setattr(run_plan, stage, broken)
        done = run(spark, spec, table.repartition(5), out, resume=True)
        assert done.training.best == "lr" and set(done.training.models) == {"lr"}
        assert done.evaluation.metrics.first().sample_count == 40
        with pytest.raises(KeyboardInterrupt):  # other settings, other rows, or a run that doesn't resume start anew
            run(spark, replace(spec, random_state=7), table, out, resume=True)
        with pytest.raises(KeyboardInterrupt):
            run(spark, spec, table.where("id <> 3"), out, resume=True)
        with pytest.raises(KeyboardInterrupt):
            run(spark, spec, table, out)


def test_scratch_tables_go_with_their_scope(spark):
    with scratch_scope(spark) as folder:
        inner, outer = materialise(spark.range(5)), materialise(spark.range(7), outlast=True)
        assert inner.count() == 5 and os.path.isdir(folder.replace("file:", ""))
        with scratch_scope(spark):
            kept = materialise(spark.range(3), outlast=True)
        assert kept.count() == 3
    assert outer.count() == 7 and not os.path.exists(folder.replace("file:", ""))


def test_fitting_on_the_training_part(spark, cases, tmp_path):
    spec = PipelineSpec(
        key_columns=["id"], numeric_columns=FEATURES, handle_outliers_cols=FEATURES[:1], n_select_features=3,
        model_type="lr", model_params=SMALL, n_splits=0, handle_imbalance="none", fit_on="train",
    )
    done = run(spark, spec, cases.drop("label"), str(tmp_path))
    test = spark.read.parquet(done.paths["test"])
    train = cases.join(test, "id", "left_anti")
    assert test.count() == 40 and train.count() == 160
    means = train.agg(*[F.avg(f).alias(f) for f in FEATURES[1:]]).first()
    assert all(np.isclose(done.preprocessing.scaler.offsets[f], means[f]) for f in FEATURES[1:])
    assert done.training.data_info["training_samples"] == 160
    with pytest.raises(ValueError, match="key_columns"):
        PipelineSpec(fit_on="train")


def test_folder_keeps_errors(spark, cases, tmp_path):
    folder = str(tmp_path / "models")
    save_model(fit_model(cases, FEATURES, "label", "lr", SMALL["lr"]), spark, f"{folder}/good/lr", "good")
    save_model(fit_model(cases.withColumn("x", F.lit(1.0)), ["x", *FEATURES], "label", "lr", SMALL["lr"]), spark, f"{folder}/bad", "bad")
    done = evaluate_folder(spark, folder, cases.drop("label"), TARGET, ["id"], str(tmp_path / "reports"))
    assert set(done.evaluations) == {"good/lr"} and set(done.errors) == {"bad"}
    assert done.summary["total_models"] == 2 and done.summary["successful_evaluations"] == 1
    one = evaluate_saved(spark, f"{folder}/good/lr", cases.drop("label"), TARGET, ["id"], identifiers=["feature_4"])
    assert one.top.columns[:5] == ["class", "rank", "class_probability", "predicted_class", "true_class"]
    assert one.roc.count() > 3 and one.analysis.count() == 3
    with pytest.raises(ValueError, match="no models"):
        (tmp_path / "empty").mkdir()
        evaluate_folder(spark, str(tmp_path / "empty"), cases, TARGET, ["id"])


def test_a_further_model_type(spark, cases):
    def tree(classes, seed, **params):
        return DecisionTreeClassifier(seed=seed, **params)

    register_model("tree", ModelKind(lambda p, n: {"maxDepth": p["max_depth"]}, tree, {"max_depth": 3}))
    try:
        model = fit_model(cases, FEATURES, "label", "tree")
        assert model.predict(cases).where("prediction = label").count() > 150
        assert PipelineSpec(model_type=["tree"]).model_types() == ["tree"]
    finally:
        KINDS.pop("tree")


def test_spec_from_a_file(spark, tmp_path):
    settings = {
        "input-path": "in.csv", "target-column": TARGET, "mode": "full", "numeric-columns": ["asset", "sales"],
        "identifier-columns": ["사고번호"], "enable-pca": True, "date-features": True, "pca-components": 10,
        "model-type": "all", "model-params": ["n_estimators=100"], "interaction-features": ["asset", "sales"],
    }
    (tmp_path / "config.json").write_text(json.dumps(settings, ensure_ascii=False, indent=1), encoding="utf-8")
    spec = PipelineSpec.load(spark, str(tmp_path / "config.json"))
    assert spec.pairs == [("asset", "sales")] and spec.pca_components == 10 and spec.model_params == {}


def test_spec_checks():
    for wrong in ({"test_size": 0}, {"n_splits": -1}, {"polynomial_degree": 0}, {"model_type": "svm"}, {"handle_imbalance": "magic"}):
        with pytest.raises(ValueError):
            PipelineSpec(**wrong)
    spec = PipelineSpec(numeric_columns=["A b", "사고번호"], identifier_columns=["사고번호"], interaction_features=["A b", "C", "D"])
    assert spec.role(spec.numeric_columns) == ["a_b"] and spec.pairs == [("a_b", "c")]
    assert spec.model_types() == ["lr", "rf", "xgboost"]


def test_boosting_moves_blocks_not_rows(monkeypatch):
    monkeypatch.setattr(boost, "BLOCK_BYTES", 60)
    x = [[float(i % 7), float(i % 3)] for i in range(100)]
    edges = [[1.0, 3.0], [0.5]]
    batch = pa.RecordBatch.from_arrays([pa.array(x), pa.array([i % 2 for i in range(100)], pa.int32()), pa.array([0.5] * 100), pa.array([i / 100 for i in range(100)])], names=["x", "y", "w", "draw"])
    packed = list(boost._as_bins(edges)(iter([batch])))
    assert [b.num_rows for b in packed] == [4]
    back = list(boost._arrays(packed[0], 2, [], 2))
    assert [len(b[0]) for b in back] == [30, 30, 30, 10]
    bins, y, w, draw, margins = (np.concatenate(c) for c in zip(*back))
    assert (bins == boost.binned(np.array(x), edges)).all() and y.tolist() == [i % 2 for i in range(100)]
    assert (w == 0.5).all() and draw.tolist() == [i / 100 for i in range(100)] and not margins.any()


@pytest.fixture(scope="module")
def dense_and_sparse(spark):
    """Numbers and dummies of a column, each number and dummy by itself and in one sparse column, with classes and weights."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(600):
        level, x, z = int(rng.integers(12)), float(rng.normal()), float(rng.integers(-2, 3))
        score = (level % 3) + (x > 0.4) + 0.5 * (z < 0) + rng.normal() * 0.4
        rows.append((i, str(level), x, z, int(score > 1.5) + int(score > 2.5), int(score > 1.5), 0.5 + i % 3))
    df = spark.createDataFrame(rows, "id bigint, level string, x double, z double, three int, label int, w double").repartition(3, "id")
    coded = fit_onehot(df, ["level"], dense_levels=5).transform(df)
    dummies = [F.when(F.element_at("level_onehot.indices", 1) == k, 1.0).otherwise(0.0).alias(f"d{k}") for k in range(12)]
    return materialise(coded.select("*", *dummies)), [f"d{k}" for k in range(12)]


def _shares_of(model, df):
    return np.array([list(r.probability) for r in model.predict(df).orderBy("id").collect()])


@pytest.mark.parametrize("label", ["label", "three"])
def test_trees_on_sparse_vectors_are_those_on_columns(spark, dense_and_sparse, tmp_path, label, monkeypatch):
    monkeypatch.setattr(sparse_trees, "KEPT_ROUNDS", 2)
    df, dummies = dense_and_sparse
    plain, gathered_ = ["x", *dummies, "z"], ["x", "level_onehot", "z"]
    params = {"n_estimators": 1, "max_depth": 4, "min_samples_leaf": 5, "max_features": None, "bootstrap": False}
    steps = df.withColumn("x", F.floor(F.least(F.greatest(F.col("x"), F.lit(-1.5)), F.lit(1.5)) * 3).cast("double"))  # each value is a bin
    two = [fit_model(steps, f, label, "rf", params, weight="w") for f in (plain, gathered_)]
    assert isinstance(two[1].parts[0], sparse_trees.SparseTrees)
    assert np.abs(_shares_of(two[0], steps) - _shares_of(two[1], steps)).max() < 1e-6
    assert two[1].importances()["level_onehot"] == pytest.approx(sum(two[0].importances()[d] for d in dummies), abs=1e-6)
    # before, boosting on sparse vectors was another kind, without reg_alpha and reg_lambda
    params = {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.3, "subsample": 1.0, "colsample_bytree": 1.0, "reg_alpha": 0.2, "reg_lambda": 2.0}
    two = [fit_model(steps, f, label, "xgboost", params) for f in (plain, gathered_)]
    shares = _shares_of(two[1], steps)
    assert np.abs(_shares_of(two[0], steps) - shares).max() < 1e-6
    back = load_model(spark, save_model(two[1], spark, str(tmp_path / "model")))
    assert np.array_equal(_shares_of(back, steps), shares) and back.importances() == two[1].importances()


def test_a_forest_on_sparse_vectors_learns_from_drawn_rows_and_places(spark, dense_and_sparse):
    df, dummies = dense_and_sparse
    params = {"n_estimators": 30, "max_depth": 8}
    right = [fit_model(df, f, "label", "rf", params).predict(df).where("prediction = label").count() for f in (["x", *dummies, "z"], ["x", "level_onehot", "z"])]
    assert right[1] > 0.95 * right[0]
    again = [_shares_of(fit_model(df, ["x", "level_onehot", "z"], "label", "rf", {"n_estimators": 3}), df) for _ in range(2)]
    assert np.array_equal(*again) and np.allclose(again[0].sum(axis=1), 1)


def test_missing_numbers_beside_a_sparse_column_are_below_all_others(spark, dense_and_sparse):
    df, _ = dense_and_sparse
    holes = df.withColumn("x", F.when(F.col("id") % 4 > 0, -1 - F.abs("x"))).withColumn("label", F.col("x").isNull().cast("int"))
    model = fit_model(holes, ["x", "level_onehot"], "label", "xgboost", {"n_estimators": 5, "subsample": 1.0, "colsample_bytree": 1.0})
    assert model.predict(holes).where("prediction = label").count() == 600


def test_cells_of_sparse_trees_follow_the_places_that_are_not_zero(spark):
    """A million places: a number for each row and place would be 8 GB, the cells are one a row."""
    df = spark.range(0, 2000, numPartitions=2).select("id", (F.col("id") % 2).cast("int").alias("label"))
    code = (F.col("id") % 500 * 1999).cast("int")
    coded = df.select("id", "label", one_of(code, 1_000_000).alias("v"))
    for kind, params in {"rf": {"n_estimators": 2, "max_depth": 3, "max_features": None, "bootstrap": False}, "xgboost": {"n_estimators": 2, "max_depth": 2}}.items():
        model = fit_model(coded, ["v"], "label", kind, params)
        assert model.predict(coded).where("prediction IN (0, 1)").count() == 2000
        assert all(len(t.place) <= 15 and t.place.max() < 1_000_000 for t in model.parts[0].rounds[0])


@pytest.mark.parametrize("label", ["label", "three"])
def test_regression_on_many_places_takes_the_steps_of_mllib(spark, dense_and_sparse, tmp_path, label, monkeypatch):
    df = dense_and_sparse[0].withColumn("same", F.lit(7.0))
    features, params = ["x", "level_onehot", "same", "z"], {"C": 100.0, "max_iter": 8}
    plain = fit_model(df, features, label, "lr", params, weight="w")
    monkeypatch.setattr(models, "MLLIB_COEFFICIENTS", 0)
    monkeypatch.setattr(sparse_logistic, "BLOCK", 8)
    monkeypatch.setattr(sparse_logistic, "SLICE", 16)
    # before, MLlib's driver held some thirty vectors of all places at once
    monkeypatch.setattr(LogisticRegression, "fit", lambda *a: pytest.fail("fitted on the driver"))
    model = fit_model(df, features, label, "lr", params, weight="w")
    two = [m.parts[0].coefficientMatrix.toArray() for m in (plain, model)]
    assert two[0].shape == two[1].shape and np.abs(two[0] - two[1]).max() < 1e-9
    shares = _shares_of(model, df)
    assert np.abs(_shares_of(plain, df) - shares).max() < 1e-9
    back = load_model(spark, save_model(model, spark, str(tmp_path / "model")))
    assert np.array_equal(_shares_of(back, df), shares) and back.importances() == model.importances()
    with pytest.raises(Exception, match="Weights MUST NOT be"):
        fit_model(df.withColumn("w", F.when(F.col("id") > 0, F.col("w"))), features, label, "lr", params, weight="w")


def test_large_models_are_fitted_and_scored_one_at_a_time(spark, dense_and_sparse, monkeypatch):
    df, scans = dense_and_sparse[0], []
    scored = tune.Folds._scored
    monkeypatch.setattr(tune.Folds, "_scored", lambda self, kind, models, *more: scans.append(len(models)) or scored(self, kind, models, *more))
    found = []
    for held in (1 << 22, 1):
        monkeypatch.setattr(tune, "HELD_COEFFICIENTS", held)
        found.append(cross_validate(df, ["x", "level_onehot"], "label", ["id"], "lr", {"max_iter": 3}, k=2).test)
    assert scans == [2, 1, 1] and found[0] == pytest.approx(found[1], abs=1e-12)


def test_steps_are_searched_along_a_bent_valley():
    """Rosenbrock's function needs shortened and lengthened steps."""
    calls = []

    def evaluate(at, gradient):
        x, y = at.read(0, 2)
        gradient.write(0, np.array([-400 * x * (y - x * x) - 2 * (1 - x), 200 * (y - x * x)]))
        calls.append((x, y))
        return float(100 * (y - x * x) ** 2 + (1 - x) ** 2)

    start = sparse_logistic.Vector(2)
    start.write(0, np.array([-1.2, 1.0]))
    assert np.abs(sparse_logistic.minimise(evaluate, start, 200).read(0, 2) - 1).max() < 1e-3 and len(calls) < 100
