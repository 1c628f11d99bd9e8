"""Metrics against brute force, ties and empty cells included."""

import math
import random
from itertools import product

import pytest

from barsignal.operators import eda, metrics


def brute_auc(rows):
    pairs = [(p, n) for (y, p), (z, n) in product(rows, rows) if y == 1 and z == 0]
    return sum(1 if p > n else 0.5 if p == n else 0 for p, n in pairs) / len(pairs) if pairs else None


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(2)
    rows = [(k, rng.randint(0, 1), rng.choice([rng.random(), 0.5, 0.25, 0.0, 1.0, 0.500001])) for k in range(3) for _ in range(80)]
    rows += [(3, 1, 0.2), (3, 1, 0.9), (4, 0, 0.1)]
    return rows, metrics.with_prediction(spark.createDataFrame(rows, "fold int, y_test int, y_prob double"))


def test_auc(scored):
    rows, df = scored
    got = {r.fold: r.auc for r in metrics.auc(df, ["fold"]).collect()}
    for k in range(5):
        assert got[k] == pytest.approx(brute_auc([(y, p) for f, y, p in rows if f == k])), k
    assert got[3] is None and got[4] is None
    assert metrics.auc(df, []).first().auc == pytest.approx(brute_auc([(y, p) for _, y, p in rows]))


def test_other_metrics(scored):
    rows, df = scored
    got = {r.fold: r for r in metrics.all_metrics(df, ["fold"]).collect()}
    for k in range(5):
        part = [(y, p, int(p > 0.5)) for f, y, p in rows if f == k]
        tp = sum(y and q for y, _, q in part)
        precision = tp / max(sum(q for *_, q in part), 1)
        recall = tp / max(sum(y for y, *_ in part), 1)
        assert got[k].accuracy == pytest.approx(sum(y == q for y, _, q in part) / len(part))
        assert got[k].precision == pytest.approx(precision)
        assert got[k].recall == pytest.approx(recall)
        assert got[k].f1 == pytest.approx(2 * precision * recall / (precision + recall) if precision + recall else 0)
        e = metrics.LOG_LOSS_EPSILON
        losses = [-math.log(min(max(p if y else 1 - p, e), 1 - e)) for y, p, _ in part]
        assert got[k].log_loss == pytest.approx(sum(losses) / len(losses), rel=1e-6)


def test_rows_are_scanned_and_shuffled_once(spark, scored, tmp_path):
    scored[1].write.parquet(str(tmp_path / "scored"))
    plan = metrics.all_metrics(spark.read.parquet(str(tmp_path / "scored")), ["fold"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan
    by_score = [x for x in plan.split("\n") if "Exchange" in x and "y_prob" in x]
    assert len(by_score) == 1


def test_rows_without_score_or_label_count_where_they_can(spark):
    df = spark.createDataFrame([(1, 0.9, 1), (0, 0.2, 0), (1, None, 1), (None, 0.4, 0)], "y_test int, y_prob double, y_pred int")
    row = metrics.all_metrics(df, []).first()
    assert (row.auc, row.recall, row.accuracy) == (1.0, 1.0, 1.0)
    assert row.log_loss == pytest.approx(-(math.log(0.9) + math.log(0.8)) / 2)


def test_half_is_not_above_the_cut(spark):
    df = spark.createDataFrame([(0.5,), (0.5000001,)], "y_prob double")
    assert [r.y_pred for r in metrics.with_prediction(df).collect()] == [0, 1]


def test_confusion_with_one_class_and_with_no_rows(spark):
    df = spark.createDataFrame([(1, 1), (1, 0)], "y_test int, y_pred int")
    assert tuple(metrics.confusion_matrix(df).first()) == (0, 0, 1, 1)
    rates = {r.Metric: r for r in metrics.confusion_rates(df).collect()}
    assert rates["True Positives"].Percentage == 50.0 and rates["False Positives"].Count == 0
    assert (rates["True Positives"].specificity, rates["True Positives"].sensitivity) == (0.0, 0.5)
    assert tuple(metrics.confusion_matrix(df.limit(0)).first()) == (0, 0, 0, 0)


def test_leaders_and_laggards(spark):
    rows = [(f"S{i:02d}", 1, int(j < i)) for i in range(12) for j in range(12)]
    df = spark.createDataFrame(rows, "Stock_symbol string, y_test int, y_pred int")
    assert [r.Stock_symbol for r in metrics.symbol_leaders(df).collect()] == [f"S{i:02d}" for i in range(11, 1, -1)]
    assert [r.Stock_symbol for r in metrics.symbol_laggards(df).collect()] == [f"S{i:02d}" for i in range(9, -1, -1)]


def test_results_tables(spark):
    df = spark.sql("""select * from values (date'2020-02-01', 0.5D, 0.6D, 0.1D, 0.2D, 0.3D, 1D), (date'2020-05-01', 0.7D, 0.8D, 0.1D, 0.2D, 0.3D, 1D),
        (date'2021-02-01', NULL, 0.4D, 0.1D, 0.2D, 0.3D, 1D) as t(test_start, auc, accuracy, precision, recall, f1, log_loss)""")
    assert metrics.metrics_overall(df).first().auc == pytest.approx(0.6)
    summary = {r.Metric: r for r in metrics.metrics_summary(df).collect()}
    assert set(summary) == {"AUC", "Accuracy", "Precision", "Recall", "F1 Score", "Log Loss"}
    assert summary["Accuracy"].Std == pytest.approx(0.2) and summary["AUC"].Min == 0.5
    years = metrics.metrics_by_year(df).collect()
    assert [(r.year, r.auc) for r in years] == [(2020, pytest.approx(0.6)), (2021, None)]


def test_nth_frequent_symbol(spark):
    df = spark.createDataFrame([(f"S{i}",) for i in range(4) for _ in range(i + 1)], "Stock_symbol string")
    assert {r.Stock_symbol for r in eda.nth_frequent_symbol(df, 1).collect()} == {"S2"}
    assert eda.nth_frequent_symbol(df, 1).count() == 3
    assert eda.nth_frequent_symbol(df, 10).count() == 0
