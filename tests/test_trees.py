"""Trees grown in a task beside Spark's own, and the whole walk-forward run of the checked query."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

import __spark_entry__ as entry
from barsignal.operators import models, trees
from barsignal.operators.features import FEATURES
from barsignal.plans import queries
from barsignal.session import materialize

COLUMNS = ["a", "b", "c", "d", "e"]


def rows(n, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, 5))
    x[:, 1] = rng.integers(0, 4, n)  # ties, and zeros
    x[:, 2] = np.where(rng.random(n) < 0.5, 0.0, x[:, 2])
    x[:, 3] = 7.5
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(0, 1, n) > 0.8).astype("int32")
    return pd.DataFrame(x, columns=COLUMNS).assign(Label=y)


def fitted(spark, data, **given):
    """The same rows of one partition, grown in their task and by Spark's trainer."""
    df = spark.createDataFrame(data).coalesce(1)
    local = models.make_pipeline(COLUMNS, **given).fit(df)
    pipeline = models.make_pipeline(COLUMNS, **given)
    theirs = GBTClassifier()
    pipeline.getStages()[1]._copyValues(theirs, {p: v for p, v in pipeline.getStages()[1].extractParamMap().items() if pipeline.getStages()[1].isSet(p)})
    pipeline.setStages([pipeline.getStages()[0], theirs])
    return df, local, pipeline.fit(df)


@pytest.mark.parametrize("n, given", [
    (400, {"rounds": 6, "depth": 3}),
    (40, {"rounds": 4, "depth": 5, "rate": 0.3, "row_sample": 0.5, "column_sample": 0.4}),
    (300, {"rounds": 3, "depth": 2, "row_sample": 1.0, "column_sample": 1.0, "seed": -5}),
])
def test_trees_equal_those_of_spark(spark, tmp_path, n, given):
    df, local, theirs = fitted(spark, rows(n), **given)
    assert isinstance(local.stages[-1], trees.GrownTrees) and not isinstance(theirs.stages[-1], trees.GrownTrees)
    local.write().overwrite().save(f"{tmp_path}/local")
    theirs.write().overwrite().save(f"{tmp_path}/theirs")
    nodes = [
        models.model_nodes(spark, [f"{tmp_path}/{name}"]).drop("model").orderBy("tree", "id").toPandas() for name in ("local", "theirs")
    ]
    pd.testing.assert_frame_equal(*nodes, rtol=1e-9, atol=1e-9)
    assert nodes[0]["tree"].nunique() == given["rounds"] and len(nodes[0]) > 3 * given["rounds"]
    # Saved, they are a model of Spark's, with equal scores; so are the columns of the model itself.
    loaded = PipelineModel.load(f"{tmp_path}/local")
    kept = ["rawPrediction", "probability", "prediction"]
    scored = [m.transform(df).select(*kept).collect() for m in (local, loaded, theirs)]
    for other in scored[1:]:  # Spark adds the trees' votes in another order
        for c in kept[:2]:
            assert np.allclose([r[c].toArray() for r in scored[0]], [r[c].toArray() for r in other], rtol=1e-9)
        assert [r.prediction for r in scored[0]] == [r.prediction for r in other]
    assert type(loaded.stages[-1]).__name__ == "GBTClassificationModel" and loaded.stages[-1].getNumTrees == given["rounds"]


def test_rows_that_are_not_grown_in_a_task(spark, monkeypatch):
    """Too many for a task, in several partitions, or with labels that are none."""
    data = rows(60)
    few = {"rounds": 2, "depth": 2}
    assert not isinstance(models.make_pipeline(COLUMNS, **few).fit(spark.createDataFrame(data).repartition(2)).stages[-1], trees.GrownTrees)
    monkeypatch.setattr(trees, "TASK_ROWS", 59)
    df = spark.createDataFrame(data).coalesce(1)
    # The bound is read in the task, whose modules are not patched: ask the trainer for none.
    monkeypatch.setattr(trees.FoldTrees, "_grown", lambda self, dataset: None)
    assert not isinstance(models.make_pipeline(COLUMNS, **few).fit(df).stages[-1], trees.GrownTrees)
    monkeypatch.undo()
    with pytest.raises(Exception, match="labels are 0 and 1"):
        models.make_pipeline(COLUMNS, **few).fit(df.withColumn("Label", F.col("Label") + 5))


def test_one_label_and_one_row(spark):
    for data in (rows(30).assign(Label=1), rows(1)):
        df, local, theirs = fitted(spark, data, rounds=2, depth=2)
        want = theirs.transform(df).collect()
        assert [r.prediction for r in local.transform(df).collect()] == [r.prediction for r in want]


def test_the_status_query_runs_the_whole_job(spark, monkeypatch):
    """All rounds of the reference on each of its 21-day tests: none of them is left out."""
    days, names = pd.bdate_range("1996-01-01", periods=252 + 2 * 21 + 4).date, ["x", "y", "z"]
    rng = np.random.default_rng(4)
    data = pd.DataFrame({"category": "S", "Stock_symbol": np.tile(names, len(days)), "Date": np.repeat(days, 3)})
    data["Label"] = rng.integers(0, 2, len(data)).astype("int32")
    data = pd.concat([data, pd.DataFrame(rng.normal(0, 1, (len(data), 23)), columns=[f"{f}_z" for f in FEATURES])], axis=1)
    table = materialize(spark.createDataFrame(data).withColumn("Label", F.col("Label").cast("int")), "model_set_of_test")
    monkeypatch.setitem(queries._WRITTEN, (spark.sparkContext.applicationId, "nowhere", "model_set"), table)
    rounds = []
    grown = trees.FoldTrees._fit
    monkeypatch.setattr(trees.FoldTrees, "_fit", lambda self, df: rounds.append((self.getMaxIter(), self.getMaxDepth())) or grown(self, df))
    got = entry.queries()["walk_forward_status"](spark, "nowhere").collect()
    assert sorted(map(tuple, got)) == [("S", 0, "done"), ("S", 1, "done"), ("S", 2, "done")]
    assert rounds == [(400, 5)] * 3
    folder, predictions, _ = queries._trial(spark, "nowhere", train_days=252, test_days=21)
    assert predictions.count() == (2 * 21 + 4) * 3
    nodes = models.model_nodes(spark, [r.model_path for r in models.model_registry(spark, folder).collect()])
    assert {r["count"] for r in nodes.select("model", "tree").distinct().groupBy("model").count().collect()} == {400}
    again, _ = models.evaluate_saved(table, models.model_registry(spark, folder))
    assert again.exceptAll(predictions).count() == 0 and again.count() == predictions.count()
    # The query's SQL names the same folds.
    sql = entry.oracle_sql()["walk_forward_status"]
    assert "252" in sql and "21" in sql and "504" not in sql
