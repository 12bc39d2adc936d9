import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.operators import evaluate as ev


def _scored(spark, n=400, seed=0, ties=True):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        p = rng.dirichlet([1, 1, 1])
        p = [round(float(x), 2 if ties else 12) for x in p]
        rows.append((i, int(rng.choice(3, p=[0.6, 0.3, 0.1])), int(np.argmax(p)), p))
    return spark.createDataFrame(rows, "id bigint, label int, prediction int, probability array<double>"), rows


def _auc(pairs):
    pos = [s for s, y in pairs if y]
    neg = [s for s, y in pairs if not y]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("per_range", [7, 100_000])
def test_auc_and_curves(spark, per_range):
    df, rows = _scored(spark)
    curves = ev.cumulative_scores(df, [0, 1, 2], rows_per_range=per_range)
    for r in ev.roc_auc(curves).collect():
        want = _auc([(p[r["class"]], y == r["class"]) for _, y, _, p in rows])
        assert math.isclose(r.auc, want, rel_tol=1e-12)
    for c in range(3):
        points = sorted((r.fpr, r.tpr) for r in ev.roc_points(curves).where(F.col("class") == c).collect())
        assert points[0] == (0.0, 0.0) and points[-1] == (1.0, 1.0)
        area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
        assert math.isclose(area, _auc([(p[c], y == c) for _, y, _, p in rows]), rel_tol=1e-9)
        pr = ev.pr_points(curves).where(F.col("class") == c).collect()
        assert [r.precision for r in pr if r.threshold is None] == [1.0] and max(r.recall for r in pr) == 1.0


def test_auc_keeps_under_monotone_scores(spark):
    df, _ = _scored(spark, ties=False)
    moved = df.withColumn("probability", F.transform("probability", lambda x: F.exp(3 * x) - 1))
    a, b = ({r["class"]: r.auc for r in ev.roc_auc(ev.cumulative_scores(d, [0, 1, 2])).collect()} for d in (df, moved))
    assert all(math.isclose(a[c], b[c], rel_tol=1e-12) for c in a)


def test_auc_of_an_absent_class(spark):
    df, _ = _scored(spark, 50)
    curves = ev.cumulative_scores(df.where("label <> 2"), [0, 1, 2])
    assert {r["class"]: r.auc is None for r in ev.roc_auc(curves).collect()} == {0: False, 1: False, 2: True}
    assert {r.recall for r in ev.pr_points(curves).where("class = 2 and threshold is not null").collect()} == {1.0}


def test_metrics_with_zero_divisions(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1), (2, 3)], "label int, prediction int")
    m = ev.metrics(df).first()
    assert m.sample_count == 5 and math.isclose(m.accuracy, 0.4)
    # class 2 is never predicted right, class 3 is predicted only
    assert math.isclose(m.recall_macro, (0.5 + 1 + 0 + 0) / 4) and math.isclose(m.precision_macro, (1 + 1 / 3 + 0 + 0) / 4)
    f = [2 / 3, 0.5, 0.0, 0.0]
    assert math.isclose(m.f1_macro, sum(f) / 4) and math.isclose(m.f1_weighted, (2 * f[0] + f[1]) / 5)
    cells = {(r.label, r.prediction): r.n for r in ev.confusion_matrix(df).collect()}
    assert len(cells) == 16 and sum(cells.values()) == 5 and cells[(3, 3)] == 0
    names = [r.name for r in ev.class_report(df).collect()]
    assert sorted(names) == ["0", "1", "2", "3", "accuracy", "macro avg", "weighted avg"]


def test_top_rows(spark):
    df, rows = _scored(spark, 30)
    top = ev.top_predictions(df, [0, 1, 2], ["id"], n=4).collect()
    for c in range(3):
        want = sorted(rows, key=lambda r: (-r[3][c], r[0]))[:4]
        got = sorted((r.rank, r.id) for r in top if r["class"] == c)
        assert got == [(i + 1, w[0]) for i, w in enumerate(want)]
    few = ev.prediction_analysis(df.limit(3), [0, 1, 2], ["id"], 10).collect()
    assert all(r.top_correct_share == r.top_correct / 10 for r in few if r.top_correct is not None)
    plan = ev.top_predictions(df, [0, 1, 2], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_comparisons(spark):
    good = spark.createDataFrame([(0, 0), (1, 1)], "label int, prediction int")
    bad = spark.createDataFrame([(0, 1), (1, 1), (1, 1)], "label int, prediction int")
    named = {"bad": ev.metrics(bad), "good": ev.metrics(good)}
    table = {r.Model: r for r in ev.model_comparison(named).collect()}
    assert table["good"]["F1-Macro"] == 1.0 and table["bad"]["Accuracy"] == 0.6667 and table["bad"]["Sample Count"] == 3
    rows = ev.detailed_comparison(named, ["accuracy", "speed"]).collect()
    assert [r.Model for r in rows] == ["good", "bad"] and rows[0].Speed == "N/A"
    with pytest.raises(ValueError):
        ev.model_comparison({})


def test_top_rows_with_clashing_names(spark):
    df, _ = _scored(spark, 20)
    named = df.withColumnRenamed("id", "class").withColumn("rank", F.lit("r"))
    top = ev.top_predictions(named, [0, 1, 2], ["class"], ["rank"], n=2)
    assert top.columns[5:7] == ["class_id", "rank_id"] and top.count() == 6
