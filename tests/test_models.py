"""Walk-forward training, the saved models and their reuse."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barsignal.operators import folds, models
from barsignal.plans.flows import fold_report
from barsignal.session import materialize

COLUMNS = ("a_z", "b_z", "c_z")
SPAN = {"train_days": 30, "test_days": 20}
TREES = {"rounds": 3, "depth": 2, "rate": 0.3}


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(9)
    frames = []
    for category, n in (("A", 60), ("B", 45), ("Real Estate", 20)):
        rows = n * 4
        x = rng.normal(0, 1, (rows, 3))
        frames.append(pd.DataFrame({
            "category": category,
            "Stock_symbol": [f"{category}{i % 4}" for i in range(rows)],
            "Date": np.repeat(pd.date_range("2021-01-01", periods=n).date, 4),
            "Label": (x[:, 0] + rng.normal(0, 0.3, rows) > 0).astype("int32"),
            **{c: x[:, i] for i, c in enumerate(COLUMNS)},
        }))
    df = spark.createDataFrame(pd.concat(frames)).withColumn("Label", F.col("Label").cast("int"))
    return materialize(df, "model_table")


@pytest.fixture(scope="module")
def run(spark, table, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("models"))
    predictions, status = models.walk_forward(table, COLUMNS, models_dir=folder, **SPAN, **TREES)
    return folder, predictions, status


def test_every_test_date_is_predicted_once(table, run):
    _, predictions, status = run
    assert {(r.category, r.fold, r.status) for r in status.collect()} == {("A", 0, "done"), ("A", 1, "done"), ("B", 0, "done")}
    tests = folds.assign_folds(table, role="test", **SPAN).select("category", "fold", "Date", "Stock_symbol")
    assert tests.count() == predictions.count() == (30 + 15) * 4
    assert tests.exceptAll(predictions.select(*tests.columns)).count() == 0
    assert predictions.where("y_pred <> int(y_prob > 0.5) or y_test <> Label").count() == 0


def test_the_signal_is_found(table, run):
    report = fold_report(table, run[1], **SPAN).collect()
    assert len(report) == 3
    assert all(r.auc > 0.85 and r.n_train == 120 for r in report)


def test_registry_and_saved_models(spark, table, run, tmp_path):
    folder, predictions, _ = run
    registry = models.model_registry(spark, folder)
    assert registry.count() == 3
    again, status = models.evaluate_saved(table, registry, **SPAN)
    assert {r.status for r in status.collect()} == {"done"}
    assert again.exceptAll(predictions).count() == 0 and again.count() == predictions.count()
    models.save_registry(registry, fold_report(table, predictions, **SPAN), str(tmp_path / "r"), COLUMNS)
    saved = spark.read.parquet(str(tmp_path / "r")).collect()
    assert len(saved) == 3 and all(r.features == list(COLUMNS) and r.auc > 0.85 for r in saved)
    assert [r.category for r in models.sorted_models(registry).collect()] == ["A", "A", "B"]


def test_folds_without_a_model_are_skipped(spark, table, run):
    registry = models.model_registry(spark, run[0]).where("category = 'A'")
    _, status = models.evaluate_saved(table, registry, **SPAN)
    assert {(r.category, r.status) for r in status.collect()} == {("A", "done"), ("B", "skipped")}


def test_a_failing_sector_does_not_stop_the_others(table):
    broken = table.withColumn("Label", F.when(F.col("category") == "B", F.col("Label") + 5).otherwise(F.col("Label")))
    predictions, status = models.walk_forward(broken, COLUMNS, on_error="skip", **SPAN, **TREES)
    assert {(r.category, r.status) for r in status.collect()} == {("A", "done"), ("B", "failed")}
    assert {r.category for r in predictions.select("category").distinct().collect()} == {"A"}


def test_a_failing_fold_raises_by_default(table):
    broken = table.where("category = 'B'").withColumn("Label", F.col("Label") + 5)
    with pytest.raises(Exception):
        models.walk_forward(broken, COLUMNS, **SPAN, **TREES)


def test_saved_models_of_any_category_are_loaded(spark, table, tmp_path):
    names = ["Real Estate", "Real_Estate", "a+b", "50% off", "x/y"]
    parts = [table.where("category = 'B'").withColumn("category", F.lit(n)) for n in names]
    both = materialize(models.union_predictions(*parts), "named")
    folder = str(tmp_path / "models of all")
    predictions, _ = models.walk_forward(both, COLUMNS, models_dir=folder, **SPAN, **TREES)
    registry = models.model_registry(spark, folder)
    assert sorted(r.category for r in registry.collect()) == sorted(names)
    again, status = models.evaluate_saved(both, registry, **SPAN)
    assert {r.status for r in status.collect()} == {"done"}
    assert again.exceptAll(predictions).count() == 0 and again.count() == predictions.count() > 0


def test_a_run_that_was_ended_goes_on(spark, table, run, tmp_path, monkeypatch):
    folder, fits = str(tmp_path / "ended"), []
    make = models.make_pipeline

    def counted(*args, **kwargs):
        if len(fits) == 2:
            raise KeyboardInterrupt
        fits.append(1)
        return make(*args, **kwargs)

    monkeypatch.setattr(models, "make_pipeline", counted)
    with pytest.raises(KeyboardInterrupt):
        models.walk_forward(table, COLUMNS, models_dir=folder, parallelism=1, **SPAN, **TREES)
    assert models.model_registry(spark, folder).count() == 2
    monkeypatch.setattr(models, "make_pipeline", lambda *a, **k: fits.append(1) or make(*a, **k))
    predictions, status = models.walk_forward(table, COLUMNS, models_dir=folder, resume=True, **SPAN, **TREES)
    assert len(fits) == 3 and {r.status for r in status.collect()} == {"done"}
    assert predictions.exceptAll(run[1]).count() == 0 and predictions.count() == run[1].count()
    models.walk_forward(table, COLUMNS, models_dir=folder, resume=True, **SPAN, **TREES)
    assert len(fits) == 3
    models.walk_forward(table, COLUMNS, models_dir=folder, resume=True, **SPAN, **{**TREES, "rate": 0.5})  # other settings
    assert len(fits) == 6


def test_jobs_do_not_follow_the_folds(spark, table, run):
    registry = models.model_registry(spark, run[0])
    jobs, numbers = [], []
    for k, days in enumerate((SPAN["test_days"], 3)):
        spark.sparkContext.setJobGroup(f"scored-{k}", "saved models")
        predictions, status = models.evaluate_saved(table, registry, SPAN["train_days"], days)
        predictions.write.format("noop").mode("overwrite").save()
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"scored-{k}")))
        numbers.append(status.count())
    spark.sparkContext.setJobGroup("rest", "")
    assert numbers[1] >= 4 * numbers[0] and jobs[1] <= jobs[0] + 3


def test_a_model_is_applied_in_parts(spark, table, run, monkeypatch):
    monkeypatch.setattr(models, "SCORED_ROWS", 7)
    again, _ = models.evaluate_saved(table, models.model_registry(spark, run[0]), **SPAN)
    assert again.exceptAll(run[1]).count() == 0 and again.count() == run[1].count()


def test_a_model_that_is_gone(spark, table, run):
    registry = models.model_registry(spark, run[0]).withColumn(
        "model_path", F.when(F.col("category") == "B", F.lit("/nowhere/at/all")).otherwise(F.col("model_path"))
    )
    with pytest.raises(FileNotFoundError):
        models.evaluate_saved(table, registry, **SPAN)
    _, status = models.evaluate_saved(table, registry, on_error="skip", **SPAN)
    assert {(r.category, r.status) for r in status.collect()} == {("A", "done"), ("B", "failed")}


def test_no_saved_model(spark, tmp_path):
    assert models.model_registry(spark, str(tmp_path / "nothing")).count() == 0


def test_no_folds(table):
    predictions, status = models.walk_forward(table, COLUMNS, train_days=500)
    assert predictions.count() == status.count() == 0


def test_same_seed_same_model(table):
    train = table.where("category = 'A'").select("Label", *COLUMNS)
    fits = [models.make_pipeline(COLUMNS, **TREES).fit(train).stages[-1].toDebugString for _ in range(2)]
    assert fits[0].split("\n", 1)[1] == fits[1].split("\n", 1)[1]  # the first line names the object


def test_default_parameters():
    trees = models.make_pipeline().getStages()[1]
    got = [trees.getOrDefault(p) for p in ("maxIter", "maxDepth", "stepSize", "subsamplingRate", "featureSubsetStrategy", "seed")]
    assert got == [400, 5, 0.03, 0.8, "0.8", 42]
    assert len(models.MODEL_FEATURES) == 23
    assert models.z_columns(type("T", (), {"columns": ["a", "a_z", "zz"]})) == ["a_z"]


def test_a_small_fold_is_one_task(spark, table, run, monkeypatch):
    """Files that hold none of its rows add no tasks to a fold's jobs; larger folds keep theirs."""
    many = materialize(table.repartition(24), "many_files")
    seen = []
    make = models.make_pipeline

    class Seen:
        def __init__(self, *args, **kwargs):
            self.pipeline = make(*args, **kwargs)

        def fit(self, train):
            seen.append((train.rdd.getNumPartitions(), train.count()))
            return self.pipeline.fit(train)

    monkeypatch.setattr(models, "make_pipeline", Seen)
    for rows, tasks in ((models.TASK_ROWS, 1), (119, None)):
        monkeypatch.setattr(models, "TASK_ROWS", rows)
        seen.clear()
        predictions, status = models.walk_forward(many, COLUMNS, **SPAN, **TREES)
        assert [n for _, n in seen] == [120, 120, 120] and all(n == tasks if tasks else n > 1 for n, _ in seen)
        assert {r.status for r in status.collect()} == {"done"} and status.count() == 3
        keys = ["category", "fold", "Date", "Stock_symbol", "Label"]
        assert predictions.select(*keys).exceptAll(run[1].select(*keys)).count() == 0 and predictions.count() == run[1].count()
