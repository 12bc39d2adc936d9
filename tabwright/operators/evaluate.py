"""Evaluation tables from a prediction table.

A prediction table holds a label, a predicted class and, for curves and top lists, an array of class probabilities
whose order is given by ``classes``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.functions.columns import quoted
from tabwright.functions.stage import materialise
from tabwright.operators.ranks import ROWS_PER_RANGE, range_edges, running_totals

# Fixed values.
TOP_ROWS = 10
TOP_FEATURES = 20
HIGH_CONFIDENCE = 0.8
MEDIUM_CONFIDENCE = 0.6
TOP_COLUMNS = ("class", "rank", "class_probability", "predicted_class", "true_class")
METRICS = ("accuracy", "f1_macro", "f1_weighted", "precision_macro", "recall_macro")


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top.cast("double") / bottom).otherwise(F.lit(0.0))


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Non-zero cells ``label, prediction, n``: the only shuffle of the prediction table, at most k² rows."""
    return df.groupBy(quoted(label).alias("label"), quoted(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """All cells over the union of true and predicted classes, zeros included."""
    return confusion_grid(confusion_counts(df, label, prediction))


# The functions on ``cells`` take the counts of ``confusion_counts``, so one pass over the predictions serves them all.


def confusion_grid(cells: DataFrame) -> DataFrame:
    # every class appears at least once on either side, so the k classes come from the cells themselves
    grid = (
        cells.agg(F.array_sort(F.array_union(F.collect_set("label"), F.collect_set("prediction"))).alias("all"))
        .select(F.explode("all").alias("label"), "all")
        .select("label", F.explode("all").alias("prediction"))
    )
    return grid.join(cells, ["label", "prediction"], "left").select(
        "label", "prediction", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def per_class(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows ``label, precision, recall, f1, support, predicted``; a ratio over zero is 0."""
    return class_ratios(confusion_counts(df, label, prediction))


def class_ratios(cells: DataFrame, *groups: str) -> DataFrame:
    """The same from counts; with ``groups`` for each of the groups that these columns of the counts tell apart."""
    sides = cells.select(
        *groups,
        F.explode(
            F.array(
                F.struct(
                    F.col("label").alias("label"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("bigint").alias("predicted"),
                    F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0)).alias("hits"),
                ),
                F.struct(
                    F.col("prediction").alias("label"),
                    F.lit(0).cast("bigint").alias("support"),
                    F.col("n").alias("predicted"),
                    F.lit(0).cast("bigint").alias("hits"),
                ),
            )
        ).alias("s")
    ).select(*groups, "s.*")
    sums = sides.groupBy(*groups, "label").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits")
    )
    return sums.select(
        *groups,
        "label",
        _ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        _ratio(F.col("hits"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("hits"), F.col("support") + F.col("predicted")).alias("f1"),
        "support",
        "predicted",
        "hits",
    )


def metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy, macro precision, recall and F1, weighted F1, number of samples."""
    return summary_metrics(confusion_counts(df, label, prediction))


def summary_metrics(cells: DataFrame, *groups: str) -> DataFrame:
    classes = class_ratios(cells, *groups)
    total = F.sum("support")
    return classes.groupBy(*groups).agg(
        _ratio(F.sum("hits"), total).alias("accuracy"),
        F.avg("f1").alias("f1_macro"),
        _ratio(F.sum(F.col("f1") * F.col("support")), total).alias("f1_weighted"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
        total.alias("sample_count"),
    )


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows ``name, precision, recall, f1, support``: every class, accuracy, macro and weighted average."""
    return report_rows(confusion_counts(df, label, prediction))


def report_rows(cells: DataFrame) -> DataFrame:
    classes = class_ratios(cells)
    total = F.sum("support")

    def weighted(c: str) -> Column:
        return _ratio(F.sum(F.col(c) * F.col("support")), total)

    accuracy = _ratio(F.sum("hits"), total)
    summary = classes.agg(
        F.array(
            F.struct(
                F.lit("accuracy").alias("name"),
                accuracy.alias("precision"),
                accuracy.alias("recall"),
                accuracy.alias("f1"),
                total.alias("support"),
            ),
            F.struct(
                F.lit("macro avg").alias("name"),
                F.avg("precision").alias("precision"),
                F.avg("recall").alias("recall"),
                F.avg("f1").alias("f1"),
                total.alias("support"),
            ),
            F.struct(
                F.lit("weighted avg").alias("name"),
                weighted("precision").alias("precision"),
                weighted("recall").alias("recall"),
                weighted("f1").alias("f1"),
                total.alias("support"),
            ),
        ).alias("rows")
    ).select(F.explode("rows").alias("r"))
    named = classes.select(F.col("label").cast("string").alias("name"), "precision", "recall", "f1", "support")
    return named.unionByName(summary.select("r.*"))


def class_scores(
    df: DataFrame, classes: Sequence, label: str = "label", probability: str = "probability"
) -> DataFrame:
    """Rows ``class, score, pos, neg``: one per class and distinct score, for one-vs-rest curves."""
    pairs = F.arrays_zip(
        F.array(*[F.lit(c) for c in classes]).alias("class"), quoted(probability).alias("score")
    )
    long = df.select(quoted(label).alias("__label"), F.explode(pairs).alias("p"))
    hit = (F.col("__label") == F.col("p.class")).cast("bigint")
    return long.groupBy(F.col("p.class").alias("class"), F.col("p.score").alias("score")).agg(
        F.sum(hit).alias("pos"), F.sum(1 - hit).alias("neg")
    )


def cumulative_scores(
    df: DataFrame,
    classes: Sequence,
    label: str = "label",
    probability: str = "probability",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """``class, score, pos, neg, cum_pos, cum_neg, all_pos, all_neg``, totals taken from the highest score down."""
    # written once: points and areas read the totals several times
    scores = materialise(class_scores(df, classes, label, probability))
    every = df.select(F.explode(quoted(probability)).alias("score"))
    edges = range_edges(every, "score", rows_per_range)
    return materialise(running_totals(scores, ["class"], "score", ["pos", "neg"], edges, descending=True))


def _classes(cumulative: DataFrame) -> DataFrame:
    return cumulative.select("class").distinct()


def roc_points(cumulative: DataFrame) -> DataFrame:
    """Rows ``class, threshold, fpr, tpr``; the first point (0, 0) has no threshold."""
    points = cumulative.select(
        "class",
        F.col("score").alias("threshold"),
        F.when(F.col("all_neg") > 0, F.col("cum_neg").cast("double") / F.col("all_neg")).alias("fpr"),
        F.when(F.col("all_pos") > 0, F.col("cum_pos").cast("double") / F.col("all_pos")).alias("tpr"),
    )
    start = _classes(cumulative).select(
        "class", F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(start)


def roc_auc(cumulative: DataFrame) -> DataFrame:
    """Rows ``class, auc``; equal scores count one half, NULL where a class has no positives or no negatives."""
    # area below a step: negatives of this score times the positives above it plus half of those level with it
    area = F.sum((F.col("cum_pos") - F.col("pos") + F.col("pos") / 2.0) * F.col("neg"))
    pairs = F.max("all_pos").cast("double") * F.max("all_neg")
    return cumulative.groupBy("class").agg(F.when(pairs > 0, area / pairs).alias("auc"))


def pr_points(cumulative: DataFrame) -> DataFrame:
    """Rows ``class, threshold, precision, recall``; the last point (recall 0, precision 1) has no threshold."""
    points = cumulative.select(
        "class",
        F.col("score").alias("threshold"),
        (F.col("cum_pos").cast("double") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        F.when(F.col("all_pos") > 0, F.col("cum_pos").cast("double") / F.col("all_pos"))
        .otherwise(F.lit(1.0))
        .alias("recall"),
    )
    end = _classes(cumulative).select(
        "class", F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end)


def top_predictions(
    df: DataFrame,
    classes: Sequence,
    key: Sequence[str],
    identifiers: Sequence[str] = (),
    n: int = TOP_ROWS,
    label: str = "label",
    prediction: str = "prediction",
    probability: str = "probability",
) -> DataFrame:
    """The ``n`` rows most probable for each class, ties in key order, with all probabilities.

    Columns: ``class, rank, class_probability, predicted_class, true_class``, key, identifiers, ``Class_<c>_Prob``;
    a key or identifier that bears one of the first five names gets ``_id`` appended.
    """
    riding = {c: f"{c}_id" if c.lower() in TOP_COLUMNS else c for c in [*key, *[c for c in identifiers if c in df.columns]]}
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("class"), F.element_at(quoted(probability), i + 1).alias("class_probability"))
            for i, c in enumerate(classes)
        ]
    )
    long = df.select(
        F.explode(entries).alias("e"),
        quoted(prediction).alias("predicted_class"),
        quoted(label).alias("true_class"),
        *[quoted(c).alias(name) for c, name in riding.items()],
        quoted(probability).alias("__all"),
    ).select("e.*", "predicted_class", "true_class", *[quoted(c) for c in riding.values()], "__all")
    # the rank limit is applied per task before the shuffle, so a class never travels whole
    order = W.partitionBy("class").orderBy(F.col("class_probability").desc(), *[quoted(riding[k]) for k in key])
    ranked = long.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    others = [F.element_at("__all", i + 1).alias(f"Class_{c}_Prob") for i, c in enumerate(classes)]
    return ranked.select(
        "class", "rank", "class_probability", "predicted_class", "true_class", *[quoted(c) for c in riding.values()], *others
    )


def overall_analysis(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: ``n_samples, accuracy, n_classes`` over the union of true and predicted classes."""
    return overall_row(confusion_counts(df, label, prediction))


def overall_row(cells: DataFrame) -> DataFrame:
    return class_ratios(cells).agg(
        F.sum("support").alias("n_samples"),
        _ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
        F.count(F.lit(1)).alias("n_classes"),
    )


def prediction_analysis(
    df: DataFrame,
    classes: Sequence,
    key: Sequence[str],
    n: int = TOP_ROWS,
    label: str = "label",
    prediction: str = "prediction",
    probability: str = "probability",
) -> DataFrame:
    """Per class: true and predicted counts and a profile of its top ``n`` rows; shares are of ``n``."""
    top = top_predictions(df, classes, key, (), n, label, prediction, probability)
    return class_analysis(confusion_counts(df, label, prediction), top, n)


def class_analysis(cells: DataFrame, top: DataFrame, n: int = TOP_ROWS) -> DataFrame:
    """The analysis from confusion counts and top rows."""
    p = F.col("class_probability")
    profile = top.groupBy("class").agg(
        F.min(p).alias("top_min_probability"),
        F.max(p).alias("top_max_probability"),
        F.count_if(F.col("predicted_class") == F.col("true_class")).alias("top_correct"),
        F.count_if(F.col("true_class") == F.col("class")).alias("top_actual"),
        F.count_if(p >= HIGH_CONFIDENCE).alias("high_confidence"),
        F.count_if((p >= MEDIUM_CONFIDENCE) & (p < HIGH_CONFIDENCE)).alias("medium_confidence"),
        F.count_if(p < MEDIUM_CONFIDENCE).alias("low_confidence"),
    )
    counts = class_ratios(cells).select(
        F.col("label").alias("class"), F.col("support").alias("true_count"), F.col("predicted").alias("predicted_count")
    )
    return counts.join(profile, "class", "left").select(
        "*",
        (F.col("top_correct") / F.lit(float(n))).alias("top_correct_share"),
        (F.col("top_actual") / F.lit(float(n))).alias("top_actual_share"),
    )


def model_comparison(named: dict[str, DataFrame]) -> DataFrame:
    """One row per model from its metrics row, rounded to 4 places; models without metrics are simply not given."""
    rows = None
    for name, one in named.items():
        row = one.select(
            F.lit(name).alias("Model"),
            F.round("accuracy", 4).alias("Accuracy"),
            F.round("f1_macro", 4).alias("F1-Macro"),
            F.round("f1_weighted", 4).alias("F1-Weighted"),
            F.round("precision_macro", 4).alias("Precision-Macro"),
            F.round("recall_macro", 4).alias("Recall-Macro"),
            F.col("sample_count").alias("Sample Count"),
        )
        rows = row if rows is None else rows.unionByName(row)
    if rows is None:
        raise ValueError("no model results to compare")
    return rows


def detailed_comparison(named: dict[str, DataFrame], wanted: Sequence[str] = METRICS[:3]) -> DataFrame:
    """Chosen metrics per model, best first by the first metric; a metric that does not exist reads ``N/A``."""
    rows = None
    for name, one in named.items():
        chosen = [(quoted(m) if m in one.columns else F.lit("N/A")).alias(m.title()) for m in wanted]
        row = one.select(F.lit(name).alias("Model"), *chosen, F.col("sample_count").alias("Sample_Count"))
        rows = row if rows is None else rows.unionByName(row)
    if rows is None:
        raise ValueError("no model results to compare")
    return rows.orderBy(quoted(wanted[0].title()).desc(), "Model") if wanted else rows


def top_features(importances: dict[str, float], df: DataFrame, n: int = TOP_FEATURES) -> DataFrame:
    """Rows ``rank, feature, importance`` of the ``n`` most important features."""
    best = sorted(importances.items(), key=lambda kv: -kv[1])[:n]
    rows = [(i + 1, name, float(value)) for i, (name, value) in enumerate(best)]
    return df.sparkSession.createDataFrame(rows, "rank int, feature string, importance double")
