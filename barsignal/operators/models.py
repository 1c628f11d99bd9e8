"""Boosted trees trained and scored fold by fold.

Folds are independent, so some run at a time from a small pool of driver
threads, each in a scheduler pool of its own. A small fold is trained in one
task; the fit of a larger one is distributed.
A finished fold commits its model and its predictions to a ledger, so a run
that was ended goes on where it stopped. Saved models are tables of nodes:
all folds are scored by them in one job. The driver sees fold dates and model
paths only.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsignal.functions.scalars import format_model_name, sector_key, threshold
from barsignal.operators.features import FEATURES
from barsignal.operators.folds import TEST_DAYS, TRAIN_DAYS, assign_folds, fold_counts, fold_slice, fold_table, match_model
from barsignal.operators.metrics import METRICS
from barsignal.operators.trees import TASK_ROWS, FoldPipeline, FoldTrees, all_margins, probability_of_one, write_table
from barsignal.session import work_dir

MODEL_FEATURES = tuple(f"{f}_z" for f in FEATURES)

# The model's parameters.
ROUNDS = 400
DEPTH = 5
RATE = 0.03
ROW_SAMPLE = 0.8
COLUMN_SAMPLE = 0.8
SEED = 42

PREDICTION_SCHEMA = T.StructType([
    T.StructField("category", T.StringType()),
    T.StructField("fold", T.IntegerType()),
    T.StructField("Date", T.DateType()),
    T.StructField("Stock_symbol", T.StringType()),
    T.StructField("Label", T.IntegerType()),
    T.StructField("y_test", T.IntegerType()),
    T.StructField("y_prob", T.DoubleType()),
    T.StructField("y_pred", T.IntegerType()),
])
STATUS_SCHEMA = "category string, fold int, status string, message string"
REGISTRY_SCHEMA = "category string, model_path string, train_start date, train_end date, test_start date, test_end date"
# Table of the finished folds inside the models' folder, and their predictions.
LEDGER, PREDICTIONS = "_ledger", "_predictions"
LEDGER_SCHEMA = f"{REGISTRY_SCHEMA}, fold int, predictions_path string, settings string"
LEDGER_TYPES = pa.schema([
    *[(c, pa.string()) for c in ("category", "model_path")],
    *[(c, pa.date32()) for c in ("train_start", "train_end", "test_start", "test_end")],
    ("fold", pa.int32()), ("predictions_path", pa.string()), ("settings", pa.string()),
])
FOLD_KEYS = ("category", "train_start", "train_end", "test_start", "test_end")
# Rows that a task scores with one saved model.
SCORED_ROWS = 50_000


def z_columns(df: DataFrame) -> list[str]:
    """The normalised features of a table, by their suffix."""
    return [c for c in df.columns if c.endswith("_z")]


def model_matrix(df: DataFrame, features: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Rows with their features assembled into one vector."""
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(df)


def make_pipeline(
    features: Sequence[str] = MODEL_FEATURES,
    rounds: int = ROUNDS,
    depth: int = DEPTH,
    rate: float = RATE,
    row_sample: float = ROW_SAMPLE,
    column_sample: float = COLUMN_SAMPLE,
    seed: int = SEED,
) -> Pipeline:
    return FoldPipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features"),
        FoldTrees(
            labelCol="Label",
            featuresCol="features",
            maxIter=rounds,
            maxDepth=depth,
            stepSize=rate,
            subsamplingRate=row_sample,
            featureSubsetStrategy=str(column_sample),
            seed=seed,
        ),
    ])


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """y_prob, the probability of class 1, and y_pred at the 0.5 cut."""
    scored = model.transform(df).withColumn("y_prob", vector_to_array("probability")[1])
    return scored.drop("features", "rawPrediction", "probability", "prediction").withColumns({
        "y_pred": threshold(F.col("y_prob")),
        "y_test": F.col("Label"),
    })


def _ensure_checkpoints(spark: SparkSession) -> None:
    """Boosting checkpoints its row weights every few rounds if it can."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_dir(spark, "checkpoints"))


def _packed(df: DataFrame, rows: int | None) -> DataFrame:
    """A small fold in one task, which grows its trees there. Its rows lie in some
    of the table's files, and every job has a task for each of the others too."""
    return df.coalesce(1) if rows is not None and rows <= TASK_ROWS else df


def _each(spark: SparkSession, work: Callable, items: list, parallelism: int | None, small: bool = False) -> list:
    """Runs ``work`` over the items in threads: by default one per four cores of
    the cluster; small items, which are one task at a time, one per core up to 16."""
    cores = spark.sparkContext.defaultParallelism
    parallelism = parallelism or max(4, cores // 4, min(cores, 16) if small else 0)
    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), items))


def walk_forward(
    model_set: DataFrame,
    features: Sequence[str] = MODEL_FEATURES,
    train_days: int = TRAIN_DAYS,
    test_days: int = TEST_DAYS,
    models_dir: str | None = None,
    parallelism: int | None = None,
    on_error: str = "raise",
    resume: bool = False,
    **pipeline,
) -> tuple[DataFrame, DataFrame]:
    """Train on each fold's dates, score its test dates: (predictions, status).

    ``model_set`` should be a written table: every fold filters it by sector
    and date, which then prunes files. ``models_dir`` saves each fold's model
    under ``<sector>/<model name>`` and its predictions beside, and commits
    both to the ledger there. With ``resume`` the folds that the ledger holds
    with the same settings are taken from it and only the others are fitted;
    their status is "done" as well. The table must be the one the ledger was
    begun with. A failing fold raises, or with ``on_error="skip"`` is reported
    in the status table while the others go on.
    """
    if on_error not in ("raise", "skip"):
        raise ValueError("on_error is 'raise' or 'skip'")
    spark = model_set.sparkSession
    _ensure_checkpoints(spark)
    name = format_model_name(*[F.col(c) for c in FOLD_KEYS[1:]])
    # One small row per sector and fold: the driver starts the fits from these.
    named = fold_table(model_set, train_days, test_days).withColumns({"name": name, "folder": _folder(F.col("category"))})
    counts = fold_counts(model_set, train_days, test_days)
    folds = named.join(counts, ["category", "fold"], "left").orderBy("category", "fold").collect()
    settings = json.dumps({"features": list(features), "train_days": train_days, "test_days": test_days, **pipeline}, sort_keys=True)
    finished = {}
    if models_dir and resume:
        held = _ledger(spark, models_dir).where(F.col("settings") == settings)
        finished = {tuple(r[k] for k in FOLD_KEYS): r["predictions_path"] for r in held.collect()}
    root = f"{models_dir}/{PREDICTIONS}" if models_dir else work_dir(spark, "predictions")
    columns = [f.name for f in PREDICTION_SCHEMA]

    def run(item: tuple) -> tuple:
        number, fold = item
        key = tuple(fold[k] for k in FOLD_KEYS)
        if key in finished:
            return fold.category, fold.fold, "done", "", finished[key]
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fold-{number}")
        try:
            in_sector = model_set.where(F.col("category") == fold.category)
            train = _packed(fold_slice(in_sector, fold.train_start, fold.train_end), fold.n_train)
            model = make_pipeline(features, **pipeline).fit(train.select("Label", *features))
            path = f"{root}/{fold.folder}/{fold.name}"
            test = _packed(fold_slice(in_sector, fold.test_start, fold.test_end), fold.n_test)
            rows = predict(model, test).withColumn("fold", F.lit(fold.fold)).select(*columns)
            rows.write.mode("overwrite").parquet(path)
            if models_dir:
                saved = f"{models_dir}/{fold.folder}/{fold.name}"
                model.write().overwrite().save(saved)
                # The fold counts from here on: whatever ends before is fitted again.
                entry = dict(zip(LEDGER_TYPES.names, (fold.category, saved, *key[1:], fold.fold, path, settings), strict=True))
                # A folder a fold: folds commit side by side, and a later run's entry takes the place of an earlier one's.
                write_table(spark, f"{models_dir}/{LEDGER}/of-{fold.folder}-{fold.name}", pa.Table.from_pylist([entry], LEDGER_TYPES))
            return fold.category, fold.fold, "done", "", path
        except Exception as error:
            if on_error == "raise":
                raise
            return fold.category, fold.fold, "failed", f"{type(error).__name__}: {error}", None
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    small = all(fold.n_train is not None and fold.n_train <= TASK_ROWS for fold in folds)
    done = _each(spark, run, list(enumerate(folds)), parallelism, small)
    paths = [path for *_, path in done if path]
    if paths:
        predictions = spark.read.schema(PREDICTION_SCHEMA).parquet(*paths)
    else:
        predictions = spark.createDataFrame([], PREDICTION_SCHEMA)
    return predictions, spark.createDataFrame([row[:4] for row in done], STATUS_SCHEMA)


def _folder(category: Column) -> Column:
    """Sector key as a folder name; names that it changes are told apart by a checksum."""
    key = F.regexp_replace(sector_key(category), r"[^\w.-]", "_")
    return F.when(key == category, key).otherwise(F.concat(key, F.lit("-"), F.hex(F.crc32(category.cast("binary")))))


def _ledger(spark: SparkSession, models_dir: str) -> DataFrame:
    """The finished folds; none if nothing was saved."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).option("recursiveFileLookup", True).parquet(f"{models_dir}/{LEDGER}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def model_registry(spark: SparkSession, models_dir: str) -> DataFrame:
    """(category, model_path and four dates) of every saved model; none if nothing was saved.

    Paths and categories are those written when the models were saved.
    """
    return _ledger(spark, models_dir).select("category", "model_path", *FOLD_KEYS[1:])


def sorted_models(registry: DataFrame) -> DataFrame:
    return registry.orderBy("category", "test_start", "test_end")


def save_registry(registry: DataFrame, results: DataFrame, path: str, features: Sequence[str] = MODEL_FEATURES) -> None:
    """Write the models' dates, metrics, counts and features as one table."""
    keys = ["category", "train_start", "train_end", "test_start", "test_end"]
    facts = results.select(*keys, *METRICS, "n_train", "n_test")
    registry.join(facts, keys, "left").withColumn("features", F.array(*[F.lit(f) for f in features])).write.mode(
        "overwrite"
    ).parquet(path)


_NODES = "model string, tree int, id int, prediction double, left int, right int, feature int, threshold double, weight double"
_STAGE = r"^(?:[A-Za-z0-9+.-]+:)?/*(.*)/stages/"


def _plain(path: Column) -> Column:
    """A path without scheme and leading slashes: what file metadata and registries agree on."""
    return F.regexp_replace(path, r"^(?:[A-Za-z0-9+.-]+:)?/*", "")


def model_nodes(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The saved models at ``paths`` as one table of nodes, with each tree's weight.

    ``model`` is the path without its scheme. The files of all models are read
    by one scan. A split sends values up to ``threshold`` to the left; leaves
    have feature -1.
    """
    def scan(part: str, schema: str) -> DataFrame:
        rows = spark.read.schema(schema).parquet(*[f"{p}/stages/1_*/{part}" for p in paths])
        file = F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B"))
        return rows.withColumn("model", F.regexp_extract(file, _STAGE, 1))

    node = scan("data", """treeID int, nodeData struct<id:int, prediction:double, leftChild:int, rightChild:int,
        split:struct<featureIndex:int, leftCategoriesOrThreshold:array<double>, numCategories:int>>""")
    weights = scan("treesMetadata", "_1 int, _3 double").select("model", F.col("_1").alias("tree"), F.col("_3").alias("weight"))
    split = F.col("nodeData.split")
    sure = F.when(split["numCategories"] >= 0, F.raise_error(F.lit("a split by categories"))).cast("double")
    nodes = node.select(
        "model", F.col("treeID").alias("tree"), "nodeData.id", "nodeData.prediction",
        F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"),
        F.coalesce(split["featureIndex"], F.lit(-1)).alias("feature"),
        F.coalesce(sure, F.get(split["leftCategoriesOrThreshold"], 0), F.lit(0.0)).alias("threshold"),
    )
    return nodes.join(weights, ["model", "tree"])


def _inputs(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(model, inputs): the features of each saved model, in the order of its vector."""
    text = spark.read.text([f"{p}/stages/0_*/metadata" for p in paths], wholetext=True)
    file = F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B"))
    inputs = F.from_json("value", "paramMap struct<inputCols:array<string>>")["paramMap"]["inputCols"]
    found = text.select(F.regexp_extract(file, _STAGE, 1).alias("model"), inputs.alias("inputs"))
    return found.where("inputs IS NOT NULL")


def _score_group(rows: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
    out = rows[["category", "fold", "Date", "Stock_symbol", "Label"]].assign(margin=np.nan)
    if len(rows) and len(nodes):
        out["margin"] = all_margins(rows["_x"], nodes)
    return out


def evaluate_saved(
    model_set: DataFrame,
    registry: DataFrame,
    train_days: int = TRAIN_DAYS,
    test_days: int = TEST_DAYS,
    on_error: str = "raise",
) -> tuple[DataFrame, DataFrame]:
    """Score every fold's test dates with the saved model that fits its period
    best: (predictions, status). Folds without such a model are skipped.

    One plan whatever the number of folds: rows get their fold by sector and
    date, folds their model, and rows and nodes meet per model, at most
    ``SCORED_ROWS`` rows at a time. A model that is gone raises, or with
    ``on_error="skip"`` its folds have failed.
    """
    if on_error not in ("raise", "skip"):
        raise ValueError("on_error is 'raise' or 'skip'")
    spark = model_set.sparkSession
    matched = match_model(fold_table(model_set, train_days, test_days), registry).select("category", "fold", "model_path").collect()
    there = {p: _exists(spark, p) for p in {r.model_path for r in matched if r.model_path}}
    if on_error == "raise" and not all(there.values()):
        raise FileNotFoundError(", ".join(sorted(p for p, found in there.items() if not found)))

    def status(path: str | None) -> tuple[str, str]:
        if path is None:
            return "skipped", "no matching model"
        return ("done", "") if there[path] else ("failed", f"no model at {path}")

    told = spark.createDataFrame([(r.category, r.fold, *status(r.model_path)) for r in matched], STATUS_SCHEMA)
    paths = sorted(p for p, found in there.items() if found)
    if not paths:
        return spark.createDataFrame([], PREDICTION_SCHEMA), told
    used = spark.createDataFrame([(r.category, r.fold, r.model_path) for r in matched if there.get(r.model_path)], "category string, fold int, path string")
    rows = assign_folds(model_set, train_days, test_days, role="test").join(
        used.select("category", "fold", _plain(F.col("path")).alias("model")), ["category", "fold"]
    )
    columns = z_columns(model_set)
    value = F.map_from_arrays(F.array(*[F.lit(c) for c in columns]), F.array(*[F.col(f"`{c}`").cast("double") for c in columns]))
    inputs = _inputs(spark, paths)
    parts = rows.groupBy("model").agg(F.ceil(F.count("*") / SCORED_ROWS).cast("int").alias("_parts")).join(inputs, "model")
    ready = rows.join(parts, "model").select(
        "model", F.pmod(F.xxhash64("Date", "Stock_symbol"), F.col("_parts")).cast("int").alias("_part"),
        "category", "fold", "Date", "Stock_symbol", "Label", F.transform("inputs", lambda c: F.element_at(value, c)).alias("_x"),
    )
    nodes = model_nodes(spark, paths).join(parts.select("model", "_parts"), "model")
    nodes = nodes.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    scored = ready.groupBy("model", "_part").cogroup(nodes.groupBy("model", "_part")).applyInPandas(
        _score_group, "category string, fold int, Date date, Stock_symbol string, Label int, margin double"
    )
    named = scored.withColumn("y_prob", probability_of_one(F.col("margin"))).withColumns({"y_pred": threshold(F.col("y_prob")), "y_test": F.col("Label")})
    return named.select(*[f.name for f in PREDICTION_SCHEMA]), told


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def union_predictions(*tables: DataFrame) -> DataFrame:
    """Prediction tables of several runs stacked by column name."""
    first, *rest = tables
    for table in rest:
        first = first.unionByName(table)
    return first
