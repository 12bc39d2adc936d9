import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabwright.functions.names import clean_name
from tabwright.operators import quantiles
from tabwright.operators.clean import drop_duplicate_rows, duplicate_report, fit_imputer, fit_modes, parse_dates
from tabwright.operators.encode import fit_label, fit_onehot
from tabwright.operators.outliers import fit_capper
from tabwright.operators.profile import check_features, clean_column_names, missing_report, validate_table
from tabwright.operators.scale import fit_scaler
from tabwright.plans.preprocess import FittedPreprocessing, fit_preprocessing
from tabwright.sources.tables import read_csv, write_csv
from tabwright.spec import PipelineSpec

NAN = float("nan")


def _column(df, name, key="k"):
    return [r[name] for r in df.orderBy(key).collect()]


def _x2(rows=100):
    rng = np.random.default_rng(42)
    return pd.DataFrame(
        {
            "feature_1": rng.normal(size=rows),
            "feature_2": rng.integers(0, 10, rows),
            "feature_3": rng.choice(["A", "B", "C"], rows),
            "target": rng.integers(0, 3, rows),
        }
    )


def test_validation_limits(spark):
    good = spark.createDataFrame(_x2())
    assert validate_table(good) is good
    with pytest.raises(ValueError, match="no rows"):
        validate_table(good.where("false"))
    with pytest.raises(ValueError, match="10 or more"):
        validate_table(good.limit(5), min_rows=10)
    with pytest.raises(ValueError, match="used twice"):
        validate_table(good.toDF("feature_1", "feature_1", "c", "d"))
    holed = good.withColumn("feature_1", F.when(F.col("feature_2") < 0, 1.0))
    assert validate_table(holed, max_missing_ratio=0.25) is holed
    with pytest.raises(ValueError, match="missing cells"):
        validate_table(holed, max_missing_ratio=0.2)


def test_nan_and_null_are_one_kind_of_missing(spark):
    df = spark.createDataFrame([(1, 1.0), (2, NAN), (3, None)], "k int, x double")
    assert missing_report(df).collect()[0].n_missing == 2
    assert check_features(df, ["x"], "k") == {"n_rows": 3, "missing_features": 2, "missing_targets": 0}
    with pytest.raises(ValueError, match="target"):
        check_features(df, ["k"], "x")
    assert _column(fit_imputer(df, ["x"]).transform(df), "x") == [1.0, 1.0, 1.0]


def test_column_names(spark):
    names = ["Feature 1!@#", "  Feature 2  ", "Feature-3 (Special)", "Normal_Feature", "사고  유형*"]
    assert [clean_name(n) for n in names] == ["feature_1", "feature_2", "feature3_special", "normal_feature", "사고_유형"]
    with pytest.raises(ValueError, match="become the same"):
        clean_column_names(spark.createDataFrame([(1, 2)], "`A-b` int, ab int"))


def test_dates(spark):
    texts = ["2024-1-6", "20240106", "2024-01-06 10:00", "", None, "2024-02-30", "2024-12-31"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, d string")
    parsed = _column(parse_dates(df, ["d", "absent"]), "d")
    assert [x and x.strftime("%Y-%m-%d") for x in parsed] == ["2024-01-06", None, None, None, None, None, "2024-12-31"]
    typed = spark.sql("SELECT 1 AS k, timestamp_ntz'2024-01-06 10:00:00' AS d")
    assert _column(parse_dates(typed, ["d"]), "d")[0].hour == 10


def test_modes(spark):
    df = spark.createDataFrame(
        [(1, "b", None, "x"), (2, "a", None, None), (3, None, None, "y"), (4, None, None, "y")],
        "k int, tie string, empty string, plain string",
    )
    assert fit_modes(df, ["tie", "empty", "plain"]) == {"tie": "a", "empty": "Unknown", "plain": "y"}
    filled = fit_imputer(df, exclude=["k"]).transform(df)
    assert _column(filled, "empty") == ["Unknown"] * 4 and _column(filled, "tie") == ["b", "a", "a", "a"]


def test_integer_median_keeps_or_leaves_the_type(spark):
    df = spark.createDataFrame([(1, 1, 1), (2, 2, 3), (3, None, None)], "k int, half bigint, whole bigint")
    filled = fit_imputer(df, ["half", "whole"]).transform(df)
    assert dict(filled.dtypes) == {"k": "int", "half": "double", "whole": "bigint"}
    assert _column(filled, "half") == [1.0, 2.0, 1.5] and _column(filled, "whole") == [1, 3, 2]


def test_duplicates(spark):
    rows = [(1, None, NAN), (1, None, NAN), (1, "a", 0.0), (1, "a", -0.0), (2, "a", 0.0)]
    df = spark.createDataFrame(rows, "a int, b string, c double")
    assert drop_duplicate_rows(df).count() == 3
    assert duplicate_report(df).collect()[0].asDict() == {"n_rows": 5, "n_kept": 3, "n_removed": 2, "removed_ratio": 0.4}


def _interpolated(ordered, p):
    spot = p * (len(ordered) - 1)
    lo, hi = ordered[math.floor(spot)], ordered[math.ceil(spot)]
    return lo if lo == hi else lo + (hi - lo) * (spot - math.floor(spot))


@pytest.mark.parametrize("values", [
    [1.0], [1.0, 2.0], [1.0, 2.0, 3.0, 4.0], [5.0] * 400 + [7.0] * 400,
    list(np.random.default_rng(1).normal(size=3001)), list(np.random.default_rng(2).integers(0, 4, 2000).astype(float)),
    [0.0] * 900 + list(np.arange(100.0)) + [1e300, -1e300], [float("inf")] * 30 + [float("-inf")] * 700 + [1.0] * 71,
])
@pytest.mark.parametrize("gather", [20_000, 3])
def test_quantiles_equal_a_sort(spark, monkeypatch, values, gather):
    monkeypatch.setattr(quantiles, "GATHER_ROWS", gather)
    monkeypatch.setattr(quantiles, "SKETCH_ACCURACY", 10_000 if gather > 3 else 50)
    monkeypatch.setattr(quantiles, "MARGIN", 4.0 / quantiles.SKETCH_ACCURACY)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (NAN,)], "x double").repartition(3)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    found = quantiles.exact_quantiles(df, ["x"], probs)["x"]
    assert np.allclose(found, [_interpolated(sorted(values), p) for p in probs], rtol=1e-12, equal_nan=True)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert quantiles.exact_quantiles(df, ["x"], [0.5]) == {"x": [None]}
    assert quantiles.exact_quantiles(df, [], [0.5]) == {}


def test_capping_keeps_missing_values(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(9)] + [(9, 1000.0), (10, None)], "k int, x double")
    capper = fit_capper(df, ["x"], "iqr", 1.5)
    lo, hi = capper.bounds["x"]
    q1, q3 = np.quantile([*range(9), 1000], [0.25, 0.75])
    assert math.isclose(hi, q3 + 1.5 * (q3 - q1)) and math.isclose(lo, q1 - 1.5 * (q3 - q1))
    out = _column(capper.transform(df), "x")
    assert out[9] == hi and out[10] is None
    assert capper.report(df).collect()[0].n_outliers == 1
    assert fit_capper(df, ["x"], "other").bounds == {}


def test_scaling(spark):
    df = spark.createDataFrame([(1, 1.0, 4.0, None), (2, 3.0, 4.0, None), (3, None, 4.0, None)], "k int, x double, c double, n double")
    out = fit_scaler(df, ["x", "c", "n"]).transform(df)
    assert _column(out, "x") == [-1.0, 1.0, None] and _column(out, "c") == [0.0] * 3 and _column(out, "n") == [None] * 3
    out = fit_scaler(df, ["x", "c"], "minmax").transform(df)
    assert _column(out, "x") == [0.0, 1.0, None] and _column(out, "c") == [0.0] * 3


def test_onehot(spark):
    df = spark.createDataFrame([(1, "b", 10), (2, "a", 9), (3, None, 10)], "k int, s string, n int")
    out = fit_onehot(df, ["s", "n"]).transform(df)
    assert out.columns == ["k", "s_a", "s_b", "n_9", "n_10"]
    assert [tuple(r) for r in out.orderBy("k").collect()] == [(1, 0, 1, 0, 1), (2, 1, 0, 1, 0), (3, 0, 0, 0, 1)]
    many = spark.range(50).select((F.col("id") % 40).alias("n"), F.lit("x").alias("s"))
    wide = fit_onehot(many, ["n", "s"], 20).transform(many)
    assert wide.columns == ["s_x", "n_onehot"]
    assert [list(r.n_onehot.indices) for r in wide.collect()] == [[i % 40] for i in range(50)]


def test_label_codes_by_first_appearance(spark):
    rows = [(i, v) for i, v in enumerate(["c", None, "a", "c", "b", "a"])]
    df = spark.createDataFrame(rows, "k int, v string").repartition(4)
    expected = list(pd.factorize(pd.Series([v for _, v in rows]))[0])
    for cap in (100, 1):
        assert _column(fit_label(df, ["v"], "k", cap).transform(df), "v") == expected


def test_label_codes_of_composite_and_text_keys(spark):
    rows = [(i // 3, f"t{i % 3}", f"v{(i * 7) % 500}") for i in range(3000)]
    df = spark.createDataFrame(rows, "a int, b string, v string").repartition(7)
    codes = {}
    for r in sorted(rows):
        codes.setdefault(r[2], len(codes))
    for order in (["a", "b"],):
        for cap in (10, 10_000):
            out = fit_label(df, ["v"], order, cap).transform(df)
            assert {(r.a, r.b): r.v for r in out.collect()} == {(a, b): codes[v] for a, b, v in rows}
    assert fit_label(df, ["v"], ["b"], 10).large["v"].count() == 500


def test_label_codes_with_a_hot_value(spark):
    values = ["hot" if i % 3 else f"v{i}" for i in range(3000)]
    df = spark.createDataFrame(list(enumerate(values)), "k bigint, v string")
    out = _column(fit_label(df, ["v"], "k", 10).transform(df), "v")
    assert out == list(pd.factorize(pd.Series(values))[0])


def test_csv(spark, tmp_path):
    folder = str(tmp_path / "t.csv")
    df = spark.createDataFrame(
        [(1, 1.5, 'a "b", c', True, None), (2, None, None, False, "x")], "i bigint, d double, s string, b boolean, n string"
    )
    write_csv(df, folder)
    back = read_csv(spark, folder)
    assert back.dtypes == df.dtypes
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    text = tmp_path / "raw.csv"
    text.write_text("code,num,word\n007,1e3,NA\n12,n/a,null\n99999999999999999999,-.5,#N/A\n", encoding="utf-8")
    raw = read_csv(spark, str(text), validate=False)
    assert raw.dtypes == [("code", "double"), ("num", "double"), ("word", "double")]
    with pytest.raises(ValueError, match="not a CSV"):
        read_csv(spark, str(tmp_path / "t.txt"))


def test_fitted_preprocessing_survives_text(spark):
    pdf = _x2(60)
    df = spark.createDataFrame(pdf).withColumn("id", F.monotonically_increasing_id())
    spec = PipelineSpec(
        target_column="target", key_columns=["id"], numeric_columns=["feature_1"], categorical_columns=["feature_3"],
        handle_outliers_cols=["feature_1"],
    )
    fitted, done = fit_preprocessing(df, spec)
    again = FittedPreprocessing.from_json(fitted.to_json())
    assert again == fitted
    assert sorted(map(tuple, again.transform(df).collect())) == sorted(map(tuple, done.collect()))
    scaled = [r.feature_1 for r in done.collect()]
    assert abs(np.mean(scaled)) < 1e-9 and abs(np.std(scaled) - 1) < 1e-9
    assert {sum((r.feature_3_A, r.feature_3_B, r.feature_3_C)) for r in done.collect()} == {1}
