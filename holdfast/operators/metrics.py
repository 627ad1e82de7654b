"""Exact classification metrics from a score column, per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.amounts import ratio
from holdfast.operators.ordered import prefix


def score_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Churned and retained customers at each distinct score and below it."""
    sums = {"churned": F.sum(label), "retained": F.sum(1 - F.col(label))}
    return prefix(df, score, by, sums=sums)


def _wide(count: Column) -> Column:
    return count.cast("decimal(19,0)")  # products of counts outgrow BIGINT


def _auc() -> Column:
    """Pairs ordered rightly, ties half, over all pairs; NULL if a class is absent."""
    pairs = _wide(F.col("churned")) * _wide(F.col("before_retained") * 2 + F.col("retained"))
    possible = F.max(_wide(F.col("total_churned")) * _wide(F.col("total_retained"))) * 2
    return ratio(F.sum(pairs), possible)


def _precision_of_retained() -> Column:
    """Recall steps times precision; retained customers rank by ``1 - score``."""
    precision = ratio(F.col("before_retained") + F.col("retained"), F.col("before_n") + F.col("n"))
    return ratio(F.sum(F.col("retained") * precision), F.max("total_retained"))


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve, ties counted half; NULL where only one class is present."""
    curve = score_curve(df, label, score, by)
    return curve.groupBy(*by).agg(F.sum("n").alias("n_rows"), _auc().alias("roc_auc"))


def average_precision_retained(
    df: DataFrame, label: str, score: str, by: Sequence[str] = ()
) -> DataFrame:
    """Step-wise average precision with the retained class (label 0) as positive."""
    curve = score_curve(df, label, score, by)
    return curve.groupBy(*by).agg(_precision_of_retained().alias("pr_auc_retained"))


def confusion(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), threshold: float = 0.5
) -> DataFrame:
    """The four cells of the confusion matrix, one row per group."""
    predicted = F.col(score) > threshold
    actual = F.col(label) == 1
    return df.groupBy(*by).agg(
        F.count_if(~actual & ~predicted).alias("tn"),
        F.count_if(~actual & predicted).alias("fp"),
        F.count_if(actual & ~predicted).alias("fn"),
        F.count_if(actual & predicted).alias("tp"),
    )


def classification_report(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), threshold: float = 0.5
) -> DataFrame:
    """Precision, recall, F1 and support per class with macro and weighted means; 0 on 0/0."""
    by = list(by)
    cells = confusion(df, label, score, by, threshold)

    def part(a, b):
        return F.coalesce(ratio(a, b), F.lit(0.0))

    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    cells = (
        cells.withColumn("p0", part(tn, tn + fn))
        .withColumn("r0", part(tn, tn + fp))
        .withColumn("p1", part(tp, tp + fp))
        .withColumn("r1", part(tp, tp + fn))
        .withColumn("s0", tn + fp)
        .withColumn("s1", tp + fn)
        .withColumn("f0", part(F.col("p0") * F.col("r0") * 2, F.col("p0") + F.col("r0")))
        .withColumn("f1", part(F.col("p1") * F.col("r1") * 2, F.col("p1") + F.col("r1")))
        .withColumn("s", F.col("s0") + F.col("s1"))
        .withColumn("acc", part(tn + tp, F.col("s")))
    )

    def macro(m):
        return (F.col(f"{m}0") + F.col(f"{m}1")) / 2

    def weighted(m):
        return part(F.col(f"{m}0") * F.col("s0") + F.col(f"{m}1") * F.col("s1"), F.col("s"))

    def row(name, precision, recall, f1, support):
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1_score"),
            support.alias("support"),
        )

    rows = F.explode(
        F.array(
            row("0", F.col("p0"), F.col("r0"), F.col("f0"), F.col("s0")),
            row("1", F.col("p1"), F.col("r1"), F.col("f1"), F.col("s1")),
            row("accuracy", F.col("acc"), F.col("acc"), F.col("acc"), F.col("s")),
            row("macro avg", macro("p"), macro("r"), macro("f"), F.col("s")),
            row("weighted avg", weighted("p"), weighted("r"), weighted("f"), F.col("s")),
        )
    ).alias("_r")
    return cells.select(*by, rows).select(*by, "_r.*")


def evaluate(
    df: DataFrame, label: str, score: str, by: Sequence[str] = ("split",), threshold: float = 0.5
) -> DataFrame:
    """All headline metrics of a scored table, one row per split, from one score curve."""
    above = F.col(score) > threshold

    def cell(count: str, where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col(count))), F.lit(0))

    return (
        score_curve(df, label, score, by)
        .groupBy(*by)
        .agg(
            F.sum("n").alias("n_rows"),
            _auc().alias("roc_auc"),
            _precision_of_retained().alias("pr_auc_retained"),
            cell("retained", ~above).alias("tn"),
            cell("retained", above).alias("fp"),
            cell("churned", ~above).alias("fn"),
            cell("churned", above).alias("tp"),
        )
    )
