"""Classification metrics per group of predictions, and reports on them.

Prediction tables hold y_test (0/1), y_prob and y_pred; all groups (folds,
symbols) are measured in one plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barsignal.functions.rolling import div
from barsignal.functions.scalars import percent, threshold

# The names under which metrics are reported.
METRICS = {
    "auc": "AUC", "accuracy": "Accuracy", "precision": "Precision",
    "recall": "Recall", "f1": "F1 Score", "log_loss": "Log Loss",
}

LOG_LOSS_EPSILON = 2.220446049250313e-16  # spacing of doubles at 1
SCORE_BUCKETS = 65_536


def with_prediction(df: DataFrame) -> DataFrame:
    return df.withColumn("y_pred", threshold(F.col("y_prob")))


def _cells() -> dict[str, Column]:
    actual, predicted = F.col("y_test") == 1, F.col("y_pred") == 1

    def count(cell: Column) -> Column:
        return F.coalesce(F.sum(cell.cast("long")), F.lit(0))

    return {
        "tn": count(~actual & ~predicted),
        "fp": count(~actual & predicted),
        "fn": count(actual & ~predicted),
        "tp": count(actual & predicted),
    }


def confusion_matrix(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """tn, fp, fn and tp; all four exist even if a class never occurs."""
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in _cells().items()])


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(div(part, whole), F.lit(0.0))


def confusion_rates(df: DataFrame) -> DataFrame:
    """Share of each cell in percent, with specificity and sensitivity beside."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    total = tn + fp + fn + tp
    cells = [("True Positives", tp), ("True Negatives", tn), ("False Positives", fp), ("False Negatives", fn)]
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("Metric"), c.alias("Count"), F.coalesce(percent(c, total), F.lit(0.0)).alias("Percentage")
        )
        for name, c in cells
    ])
    return confusion_matrix(df).select(
        F.explode(rows).alias("r"),
        _share(tn, tn + fp).alias("specificity"),
        _share(tp, tp + fn).alias("sensitivity"),
    ).select("r.*", "specificity", "sensitivity")


def _rates() -> list[Column]:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return [
        _share(tp + tn, tn + fp + fn + tp).alias("accuracy"),
        _share(tp, tp + fp).alias("precision"),
        _share(tp, tp + fn).alias("recall"),
        _share(2 * tp, 2 * tp + fp + fn).alias("f1"),
    ]


def classification_metrics(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Accuracy, precision, recall and F1; a zero denominator gives 0."""
    return confusion_matrix(df, by).select(*by, *_rates())


def log_loss(df: DataFrame, by: Sequence[str]) -> DataFrame:
    p = F.greatest(F.least(F.col("y_prob"), F.lit(1 - LOG_LOSS_EPSILON)), F.lit(LOG_LOSS_EPSILON))
    return df.groupBy(*by).agg(F.avg(-F.ln(F.when(F.col("y_test") == 1, p).otherwise(1 - p))).alias("log_loss"))


def _scored(df: DataFrame, by: Sequence[str], cells: dict[str, Column]) -> DataFrame:
    """Per group: wins, positives, negatives, summed loss and ``cells``.

    The rows are shuffled once, into counts per group and distinct score;
    everything else follows from these. A rank over a whole group would sort
    the group in one task: the negatives below a score are those below it in
    its own score bucket plus those of lower buckets, a running sum over
    buckets. Rows without a score or a label count in ``cells`` alone.
    """
    by, names = list(by), list(cells)
    known = F.col("y_prob").isNotNull()
    positive = F.when(known, (F.col("y_test") == 1).cast("double"))
    counts = df.groupBy(*by, "y_prob").agg(
        F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg"), *[c.alias(n) for n, c in cells.items()]
    )
    p = F.greatest(F.least(F.col("y_prob"), F.lit(1 - LOG_LOSS_EPSILON)), F.lit(LOG_LOSS_EPSILON))
    earlier = (Window.unboundedPreceding, -1)

    def below(w) -> Column:
        return F.coalesce(F.sum("neg").over(w.rowsBetween(*earlier)), F.lit(0.0))

    sums = [F.sum(c).alias(c) for c in ("wins", "pos", "neg", "loss", *names)]
    buckets = (
        counts.withColumn("bucket", F.floor(F.col("y_prob") * SCORE_BUCKETS))
        .withColumn("wins", F.col("pos") * (below(Window.partitionBy(*by, "bucket").orderBy("y_prob")) + F.col("neg") / 2))
        .withColumn("loss", -(F.col("pos") * F.ln(p) + F.col("neg") * F.ln(1 - p)))
        .groupBy(*by, "bucket").agg(*sums)
    )
    lower = below(Window.partitionBy(*by).orderBy("bucket"))
    return buckets.withColumn("wins", F.col("wins") + F.col("pos") * lower).groupBy(*by).agg(*sums)


def _auc() -> Column:
    return div(F.col("wins"), F.col("pos") * F.col("neg")).alias("auc")


def auc(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Exact area under the ROC curve, ties counting half; NULL with one class."""
    return _scored(df, by, {}).select(*by, _auc())


def all_metrics(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """The six metrics of every group, from one table of counts per score."""
    loss = div(F.col("loss"), F.col("pos") + F.col("neg")).alias("log_loss")
    return _scored(df, by, _cells()).select(*by, _auc(), *_rates(), loss)


def fold_results(predictions: DataFrame, folds: DataFrame, counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per fold: its dates, six metrics, n_train and n_test."""
    by = list(by)
    return folds.join(all_metrics(predictions, by), by).join(counts, by).select(
        *by, "train_start", "train_end", "test_start", "test_end", *METRICS, "n_train", "n_test"
    )


def metrics_overall(results: DataFrame) -> DataFrame:
    return results.agg(*[F.avg(m).alias(m) for m in METRICS])


def metrics_summary(results: DataFrame) -> DataFrame:
    """Mean, Std, Min and Max per metric, one row each."""
    return (
        results.select(*[F.col(m).cast("double").alias(name) for m, name in METRICS.items()])
        .unpivot([], list(METRICS.values()), "Metric", "x")
        .groupBy("Metric")
        .agg(
            F.avg("x").alias("Mean"),
            F.stddev_samp("x").alias("Std"),
            F.min("x").alias("Min"),
            F.max("x").alias("Max"),
        )
    )


def metrics_by_year(results: DataFrame) -> DataFrame:
    return (
        results.groupBy(F.year("test_start").alias("year"))
        .agg(*[F.avg(m).alias(m) for m in METRICS])
        .orderBy("year")
    )


def metrics_timeline(results: DataFrame) -> DataFrame:
    return results.select("test_start", *[m for m in METRICS if m != "log_loss"]).orderBy("test_start")


def daily_labels(predictions: DataFrame) -> DataFrame:
    """Average actual and predicted label per date."""
    return (
        predictions.groupBy("Date")
        .agg(F.avg("y_test").alias("y_test"), F.avg("y_pred").alias("y_pred"))
        .orderBy("Date")
    )


def symbol_metrics(predictions: DataFrame) -> DataFrame:
    return classification_metrics(predictions, ["Stock_symbol"])


def symbol_leaders(predictions: DataFrame, rows: int = 10) -> DataFrame:
    return symbol_metrics(predictions).orderBy(F.desc("accuracy"), "Stock_symbol").limit(rows)


def symbol_laggards(predictions: DataFrame, rows: int = 10) -> DataFrame:
    """The end of the accuracy ranking, in ranking order."""
    last = symbol_metrics(predictions).orderBy("accuracy", F.desc("Stock_symbol")).limit(rows)
    return last.orderBy(F.desc("accuracy"), "Stock_symbol")
