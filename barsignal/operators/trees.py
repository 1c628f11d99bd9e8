"""Boosted trees of a small training set, grown in one task.

The distributed trainer runs some jobs per tree and level, which take longer
than the work where a fold has some thousand rows. ``grow`` does the same steps
on arrays: the same thresholds, row and column samples, gains, ties and pruned
nodes as Spark's trainer on the same rows in one partition. It finds thresholds
from all rows, where Spark samples sets of more than 10,000.
"""

from __future__ import annotations

import io
import json
import math
import time
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Params
from pyspark.ml.util import MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A training set of at most so many rows, in one partition, is grown in its task.
TASK_ROWS = 20_000
# Arrays have a place for every node of a full tree.
TASK_DEPTH = 8
EPSILON = 2.0**-52
# Rows that are scored at a time.
MARGIN_ROWS = 2_048
# Of these alone the growth in a task knows the meaning.
KNOWN = {"labelCol", "featuresCol", "maxIter", "maxDepth", "stepSize", "subsamplingRate", "featureSubsetStrategy", "seed"}
# Parameters that no single tree has.
OF_ALL_TREES = (
    "featureSubsetStrategy", "lossType", "maxIter", "probabilityCol", "rawPredictionCol", "stepSize", "subsamplingRate", "validationTol",
)

NODE_SCHEMA = """treeID int, nodeData struct<id:int, prediction:double, impurity:double, impurityStats:array<double>,
    rawCount:bigint, gain:double, leftChild:int, rightChild:int,
    split:struct<featureIndex:int, leftCategoriesOrThreshold:array<double>, numCategories:int>>"""


# Random numbers of Spark's trainer -----------------------------------------

def _hashed(seeds: np.ndarray) -> np.ndarray:
    """States of Spark's XORShiftRandom for these seeds: MurmurHash3 of their eight bytes, twice."""
    words = np.ascontiguousarray(seeds, np.int64).astype(">i8").view("<u4").reshape(-1, 2).astype(np.uint32)

    def rotated(x: np.ndarray, by: int) -> np.ndarray:
        return (x << np.uint32(by)) | (x >> np.uint32(32 - by))

    def murmur(h: np.ndarray) -> np.ndarray:
        for k in (words[:, 0], words[:, 1]):
            h = h ^ (rotated(k * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593))
            h = rotated(h, 13) * np.uint32(5) + np.uint32(0xE6546B64)
        h = h ^ np.uint32(8)
        h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
        h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
        return h ^ (h >> np.uint32(16))

    low = murmur(np.full(len(words), 0x3C074A61, np.uint32))
    return (murmur(low).astype(np.uint64) << np.uint64(32)) | low.astype(np.uint64)


def _uniform(seeds: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """The first ``n`` doubles of XORShiftRandom, for all seeds side by side."""
    state = _hashed(seeds)

    def bits(number: int) -> np.ndarray:
        nonlocal state
        state = state ^ (state << np.uint64(21))
        state = state ^ (state >> np.uint64(35))
        state = state ^ (state << np.uint64(4))
        return state & np.uint64((1 << number) - 1)

    for _ in range(n):
        high = bits(26) << np.uint64(27)
        yield (high + bits(27)).astype(np.float64) * 2.0**-53


@lru_cache(maxsize=4)
def _row_samples(seed: int, rounds: int, rows: int, rate: float) -> np.ndarray:
    """(round, row): whether the round's tree is grown on the row."""
    if rate == 1:
        return np.ones((rounds, rows), bool)
    drawn = np.empty((rounds, rows), bool)
    for i, u in enumerate(_uniform(seed + 1 + np.arange(rounds, dtype=np.int64), rows)):
        drawn[:, i] = u < rate
    return drawn


def row_samples(seed: int, rounds: int, rows: int, rate: float) -> np.ndarray:
    # Fewer rows get the same numbers: folds of about a size share them.
    return _row_samples(seed, rounds, 1 << max(rows - 1, 1).bit_length(), rate)[:, :rows]


@lru_cache(maxsize=4)
def column_samples(seed: int, rounds: int, nodes: int, columns: int, chosen: int) -> np.ndarray:
    """(round, node): the columns that the round's n-th node may split by, in the order that decides ties."""
    taken = np.tile(np.arange(chosen, dtype=np.int16), (rounds, nodes, 1))
    if chosen == columns:
        return taken
    mask = np.uint64((1 << 48) - 1)
    state = ((seed + np.arange(rounds, dtype=np.int64)).astype(np.uint64) ^ np.uint64(0x5DEECE66D)) & mask
    longs = np.empty((rounds, nodes), np.int64)
    for k in range(nodes):  # java.util.Random.nextLong
        words = []
        for _ in range(2):
            state = (state * np.uint64(0x5DEECE66D) + np.uint64(0xB)) & mask
            words.append((state >> np.uint64(16)).astype(np.uint32).view(np.int32).astype(np.int64))
        longs[:, k] = (words[0] << np.int64(32)) + words[1]
    flat = taken.reshape(-1, chosen)
    for column, u in zip(range(chosen, columns), _uniform(longs.reshape(-1), columns - chosen), strict=True):
        place = (u * (column + 1)).astype(np.int64)
        hit = np.flatnonzero(place < chosen)
        flat[hit, place[hit]] = column
    return taken


def columns_per_node(strategy: str, columns: int) -> int | None:
    """Number of columns that a node may split by; None for a strategy that is no fraction."""
    try:
        share = float(strategy)
    except ValueError:
        return None
    whole = strategy.isdigit()
    if whole and share >= 1:
        return min(int(strategy), columns)
    return math.ceil(share * columns) if not whole and 0 < share <= 1 else None


# Growth --------------------------------------------------------------------

def column_thresholds(values: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins`` - 1 thresholds: between all distinct values, or at even steps of the row counts."""
    distinct, counts = np.unique(values, return_counts=True)
    middles = (distinct[:-1] + distinct[1:]) / 2.0
    if len(middles) <= bins - 1:
        return middles
    stride = len(values) / bins
    sums = np.cumsum(counts).tolist()
    target, at = stride, []
    for i in range(1, len(sums)):
        if abs(sums[i - 1] - target) < abs(sums[i] - target):
            at.append(i - 1)
            target += stride
    return middles[at]


def _spread(count: np.ndarray, total: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Variance from sums; no number where there are no rows."""
    found = total * total
    found /= count
    np.subtract(squares, found, out=found)
    found /= count
    return found


class _Trees:
    """Nodes of full trees by round and heap index (the root is 1, children 2i and 2i + 1)."""

    def __init__(self, rounds: int, depth: int) -> None:
        shape = (rounds, 2 << depth)
        self.depth = depth
        self.there, self.inner = np.zeros(shape, bool), np.zeros(shape, bool)
        self.count, self.total, self.squares, self.impurity, self.gain, self.prediction, self.threshold = np.zeros((7, *shape))
        self.feature = np.full(shape, -1, np.int32)

    def put(self, m: int, at: np.ndarray, stats: np.ndarray) -> None:
        """Nodes as leaves with their (count, sum, sum of squares)."""
        self.there[m, at] = True
        self.count[m, at], self.total[m, at], self.squares[m, at] = stats
        # A tree's bag may be empty.
        some = np.maximum(stats[0], 1.0)
        self.prediction[m, at] = stats[1] / some
        self.impurity[m, at] = _spread(some, *stats[1:])

    def prune(self) -> None:
        """Splits whose two leaves predict the same become leaves."""
        for level in range(self.depth - 1, -1, -1):
            at = np.arange(1 << level, 2 << level)
            left, right = 2 * at, 2 * at + 1
            same = self.inner[:, at] & ~self.inner[:, left] & ~self.inner[:, right]
            same &= self.prediction[:, left] == self.prediction[:, right]
            m, k = np.nonzero(same)
            self.prediction[m, at[k]] = self.prediction[m, left[k]]
            self.inner[m, at[k]] = False
            self.there[m, left[k]] = self.there[m, right[k]] = False

    def table(self) -> pa.Table:
        """All nodes as rows of a saved model: numbered in pre-order, leaves without a split."""
        self.prune()
        size, number = self.there.astype(np.int32), np.zeros(self.there.shape, np.int32)
        for level in range(self.depth - 1, -1, -1):
            at = np.arange(1 << level, 2 << level)
            size[:, at] += np.where(self.inner[:, at], size[:, 2 * at] + size[:, 2 * at + 1], 0)
        for level in range(self.depth):
            at = np.arange(1 << level, 2 << level)
            number[:, 2 * at] = number[:, at] + 1
            number[:, 2 * at + 1] = number[:, at] + 1 + size[:, 2 * at]
        m, at = np.nonzero(self.there)
        order = np.lexsort((number[m, at], m))
        m, at = m[order], at[order]
        inner = self.inner[m, at]
        child = np.where(inner, 2 * at, 0)
        stats = np.stack([self.count[m, at], self.total[m, at], self.squares[m, at]], 1)
        ends = np.cumsum(np.r_[0, inner]).astype(np.int32)
        split = pa.StructArray.from_arrays([
            pa.array(np.where(inner, self.feature[m, at], -1).astype(np.int32)),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(self.threshold[m, at][inner])),
            pa.array(np.full(len(m), -1, np.int32)),
        ], ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
        node = pa.StructArray.from_arrays([
            pa.array(number[m, at]),
            pa.array(self.prediction[m, at]),
            pa.array(self.impurity[m, at]),
            pa.ListArray.from_arrays(pa.array(np.arange(0, 3 * len(m) + 1, 3, dtype=np.int32)), pa.array(stats.reshape(-1))),
            pa.array(self.count[m, at].astype(np.int64)),
            pa.array(np.where(inner, self.gain[m, at], -1.0)),
            pa.array(np.where(inner, number[m, child], -1).astype(np.int32)),
            pa.array(np.where(inner, number[m, child + 1], -1).astype(np.int32)),
            split,
        ], ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"])
        return pa.table({"treeID": pa.array(m.astype(np.int32)), "nodeData": node})


def grow(
    x: np.ndarray, label: np.ndarray, rounds: int, depth: int, rate: float, row_sample: float, chosen: int, seed: int, bins: int = 32
) -> pa.Table:
    """Nodes of ``rounds`` trees boosted for the logistic loss on rows ``x`` with labels 0 and 1.

    The first tree has weight one, the others ``rate``. Every node may split by
    ``chosen`` of the columns.
    """
    rows, columns = x.shape
    cuts = [column_thresholds(x[:, f], min(bins, rows)) for f in range(columns)]
    number = np.array([len(c) for c in cuts])
    binned = np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)], 1)
    usable = np.arange(number.max(initial=0))[:, None, None] < number
    in_bag = row_samples(seed, rounds, rows, row_sample)
    samples = column_samples(seed, rounds, min((1 << depth) - 1, 2 * rows), columns, chosen)
    trees = _Trees(rounds, depth)
    sign = 2.0 * label - 1.0
    target, margin = sign, np.zeros(rows)
    for m in range(rounds):
        margin += _grow_tree(trees, m, binned, cuts, usable, target, in_bag[m], samples[m]) * (rate if m else 1.0)
        target = 4.0 * sign / (1.0 + np.exp(2.0 * sign * margin))
    return trees.table()


def _grow_tree(
    trees: _Trees, m: int, binned: np.ndarray, cuts: list[np.ndarray], usable: np.ndarray, target: np.ndarray,
    in_bag: np.ndarray, samples: np.ndarray,
) -> np.ndarray:
    """One tree into ``trees``; the prediction of every row."""
    rows, columns = binned.shape
    width = len(usable) + 1
    heap = np.ones(rows, np.int64)  # the node of each row
    slot = np.zeros(rows, np.int64)  # its place among the nodes to split, -1 at a leaf
    nodes, used = np.array([1]), 0
    bagged = target[in_bag]
    trees.put(m, nodes, np.array([[float(len(bagged))], [bagged.sum()], [(bagged * bagged).sum()]]))
    for level in range(trees.depth if width > 1 else 0):
        k = len(nodes)
        here = np.flatnonzero(in_bag & (slot >= 0))
        if not len(here):
            break
        # Bins come first: sums over them are sums of whole arrays.
        cell = (binned[here] * (k * columns) + (slot[here] * columns)[:, None] + np.arange(columns)).reshape(-1)
        weight = np.repeat(target[here], columns)
        sums = np.empty((3, width, k, columns))
        for part, w in zip(sums, (None, weight, weight * weight), strict=True):
            part[:] = np.bincount(cell, w, width * k * columns).reshape(part.shape)
        np.cumsum(sums, axis=1, out=sums)
        left = sums[:, :-1]
        right = sums[:, -1:] - left
        order = samples[used : used + k].astype(np.int64)
        used += k
        if level == 0:
            first = next((f for f in order[0] if len(cuts[f])), None)
            if first is None:
                break
            # The root's sums are those of its first split's two sides.
            trees.put(m, nodes, (left[:, 0, 0, first] + right[:, 0, 0, first])[:, None])
        count = left[0] + right[0]
        with np.errstate(invalid="ignore", divide="ignore"):
            gain = trees.impurity[m, nodes][:, None] - left[0] / count * _spread(*left)
            gain -= right[0] / count * _spread(*right)
            # No number where a side is empty, which is no split.
            gain[~((gain >= 0) & usable)] = -np.inf
        at = np.arange(k)
        column = order[at, gain.max(axis=0)[at[:, None], order].argmax(axis=1)]
        cut = gain[:, at, column].argmax(axis=0)
        best = gain[cut, at, column]
        splits = best > 0
        trees.impurity[m, nodes[best < 0]] = -1.0  # no split was valid
        done = nodes[splits]
        trees.inner[m, done], trees.gain[m, done], trees.feature[m, done] = True, best[splits], column[splits]
        trees.threshold[m, done] = [cuts[f][c] for f, c in zip(column[splits], cut[splits], strict=True)]
        children = np.concatenate([2 * done, 2 * done + 1])
        trees.put(m, children, np.concatenate([side[:, cut, at, column][:, splits] for side in (left, right)], axis=1))
        moved = np.flatnonzero(slot >= 0)
        moved = moved[splits[slot[moved]]]
        of = slot[moved]
        heap[moved] = 2 * heap[moved] + (binned[moved, column[of]] > cut[of])
        # Children go on a stack: the last is split first. Pure ones stay leaves.
        children = children.reshape(2, -1).T.reshape(-1)
        nodes = children[np.abs(trees.impurity[m, children]) >= EPSILON][::-1]
        if level + 1 == trees.depth or not len(nodes):
            break
        place = np.full(2 << trees.depth, -1)
        place[nodes] = np.arange(len(nodes))
        slot[:] = -1
        slot[moved] = place[heap[moved]]
    return trees.prediction[m, heap]


# Scores --------------------------------------------------------------------

def boosted_margins(x: np.ndarray, nodes: pd.DataFrame) -> np.ndarray:
    """Weighted votes of the trees of one model on every row of ``x``."""
    nodes = nodes.sort_values(["tree", "id"])
    tree = nodes["tree"].to_numpy()
    first = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]])
    base = np.repeat(first, np.diff(np.r_[first, len(tree)]))
    feature, threshold = nodes["feature"].to_numpy(), nodes["threshold"].to_numpy()
    inner = feature >= 0
    left, right = (np.where(inner, base + nodes[c].to_numpy(), np.arange(len(tree))) for c in ("left", "right"))
    at = np.broadcast_to(first, (len(x), len(first))).copy()
    rows = np.arange(len(x))[:, None]
    while inner[at].any():
        at = np.where(x[rows, np.maximum(feature[at], 0)] <= threshold[at], left[at], right[at])
    votes = nodes["prediction"].to_numpy()[at] * nodes["weight"].to_numpy()[first]
    return np.add.accumulate(votes, axis=1)[:, -1]  # in the trees' order


def all_margins(vectors: pd.Series, nodes: pd.DataFrame) -> np.ndarray:
    """``boosted_margins`` of any number of rows, ``MARGIN_ROWS`` at a time."""
    parts = range(0, len(vectors), MARGIN_ROWS)
    return np.concatenate([boosted_margins(np.array(vectors.iloc[k : k + MARGIN_ROWS].tolist(), float), nodes) for k in parts])


def probability_of_one(margin: Column) -> Column:
    # The exponential of Spark's models, so that scores equal theirs to the last bit.
    exp = F.java_method(F.lit("java.lang.Math"), F.lit("exp"), 2 * margin).cast("double")
    return 1 - 1 / (1 + exp)


# The estimator -------------------------------------------------------------

class FoldTrees(GBTClassifier):
    """Spark's boosted trees; a small training set of one partition is grown in its task."""

    def _fit(self, dataset: DataFrame) -> Model:
        return (self._grown(dataset) if self._in_one_task(dataset) else None) or super()._fit(dataset)

    def _in_one_task(self, dataset: DataFrame) -> bool:
        given = {p.name for p in self.params if self.isSet(p)}
        if not given <= KNOWN or self.getMaxDepth() > TASK_DEPTH or columns_per_node(self.getFeatureSubsetStrategy(), 1) is None:
            return False
        # Known from the plan: counting the partitions of the rows would compile the whole query.
        return dataset._jdf.queryExecution().executedPlan().outputPartitioning().numPartitions() == 1

    def _grown(self, dataset: DataFrame) -> GrownTrees | None:
        """None if there are no rows, or too many: then Spark's trainer has the say."""
        strategy = self.getFeatureSubsetStrategy()
        settings = (self.getMaxIter(), self.getMaxDepth(), self.getStepSize(), self.getSubsamplingRate())
        seed, bins = self.getSeed(), self.getMaxBins()

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, rows = [], 0
            for batch in batches:
                held.append(batch)
                rows += batch.num_rows
                if rows > TASK_ROWS:
                    return
            if not rows:
                return
            table = pa.Table.from_batches(held)
            label = table["label"].to_numpy()
            if not np.isin(label, (0.0, 1.0)).all():
                raise ValueError("labels are 0 and 1")
            x = table["x"].combine_chunks().flatten().to_numpy().reshape(rows, -1)
            yield from grow(x, label, *settings, columns_per_node(strategy, x.shape[1]), seed, bins).to_batches()

        columns = dataset.schema[self.getFeaturesCol()].metadata.get("ml_attr", {}).get("num_attrs")
        rows = dataset.select(F.col(self.getLabelCol()).cast("double").alias("label"), vector_to_array(self.getFeaturesCol()).alias("x"))
        nodes = rows.mapInArrow(task, NODE_SCHEMA).toArrow()
        if nodes.num_rows:
            return GrownTrees(self, nodes, columns or dataset.first()[self.getFeaturesCol()].size)
        return None


class GrownTrees(Model, MLWritable):
    """Trees that were grown in a task. Saved, they are a model of Spark's."""

    def __init__(self, trainer: FoldTrees, nodes: pa.Table, columns: int) -> None:
        super().__init__()
        self._resetUid(trainer.uid)
        self.trainer, self.saved_nodes, self.columns = trainer, nodes, columns

    def weight(self, tree: int) -> float:
        return self.trainer.getStepSize() if tree else 1.0

    def nodes(self) -> pd.DataFrame:
        """What ``boosted_margins`` takes."""
        node = self.saved_nodes["nodeData"].combine_chunks()
        split = node.field("split")
        held = split.field("leftCategoriesOrThreshold")
        feature = split.field("featureIndex").to_numpy()
        threshold = np.zeros(len(feature))
        threshold[feature >= 0] = held.flatten().to_numpy()
        names = {"id": "id", "prediction": "prediction", "left": "leftChild", "right": "rightChild"}
        found = pd.DataFrame({"tree": self.saved_nodes["treeID"].to_numpy(), **{k: node.field(v).to_numpy() for k, v in names.items()}})
        weight = np.where(found["tree"] == 0, self.weight(0), self.weight(1))
        return found.assign(feature=feature, threshold=threshold, weight=weight)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        nodes, trainer = self.nodes(), self.trainer

        @F.pandas_udf("double")
        def margin(x: pd.Series) -> pd.Series:
            return pd.Series(all_margins(x, nodes) if len(x) else [], dtype=float)

        def pair(first: Column, second: Column) -> Column:
            return array_to_vector(F.array(first, second))

        found = dataset.withColumn("_margin", margin(vector_to_array(trainer.getFeaturesCol())))
        one = probability_of_one(F.col("_margin"))
        return found.withColumns({
            trainer.getRawPredictionCol(): pair(-F.col("_margin"), F.col("_margin")),
            trainer.getProbabilityCol(): pair(1 - one, one),
            trainer.getPredictionCol(): (F.col("_margin") > 0).cast("double"),
        }).drop("_margin")

    def write(self) -> MLWriter:
        return _TreesWriter(self)

    @property
    def toDebugString(self) -> str:
        return "\n".join([self.uid, *map(str, self.saved_nodes.to_pylist())])


class GrownPipeline(PipelineModel):
    """A pipeline of grown trees, saved as one of Spark's."""

    def write(self) -> MLWriter:
        return _PipelineWriter(self)


class FoldPipeline(Pipeline):
    def _fit(self, dataset: DataFrame) -> PipelineModel:
        model = super()._fit(dataset)
        if isinstance(model.stages[-1], GrownTrees):
            return GrownPipeline(model.stages)._resetUid(model.uid)
        return model


def write_file(spark: SparkSession, path: str, data: bytes) -> None:
    """One small file, without a job; it is there as a whole or not at all."""
    paths = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    target = paths(path)
    begun = paths(target.getParent(), f"_begun-{uuid.uuid4().hex}")  # readers pass over such names
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(begun, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    if not fs.rename(begun, target):
        raise OSError(f"{path} was not written")


def write_table(spark: SparkSession, path: str, table: pa.Table) -> None:
    """A small table in the place of what the folder held."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    out = io.BytesIO()
    pq.write_table(table, out, compression="snappy")
    write_file(spark, f"{path}/part-00000.snappy.parquet", out.getvalue())


def _entry(spark: SparkSession, name: str, uid: str, given: dict, default: dict, **more) -> str:
    """Saved parameters as Spark's models have them."""
    facts = {"class": f"org.apache.spark.ml.{name}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid}
    return json.dumps({**facts, "paramMap": given, "defaultParamMap": default, **more})


def _given(stage: Params) -> tuple[dict, dict]:
    """Parameters that were set, and the defaults."""
    return {p.name: stage.getOrDefault(p) for p in stage.params if stage.isSet(p)}, {p.name: v for p, v in stage._defaultParamMap.items()}


class _TreesWriter(MLWriter):
    """The folder of a saved model of Spark's: nodes, weights and parameters."""

    def __init__(self, model: GrownTrees) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark, model, rounds = self.sparkSession, self.model, self.model.trainer.getMaxIter()
        maps = _given(model.trainer)
        of_tree = [{k: v for k, v in values.items() if k not in OF_ALL_TREES} for values in maps]
        facts = _entry(spark, "classification.GBTClassificationModel", model.uid, *maps, numFeatures=model.columns, numTrees=rounds)
        write_file(spark, f"{path}/metadata/part-00000", facts.encode())
        told = [_entry(spark, "regression.DecisionTreeRegressionModel", f"dtr_{model.uid}_{m}", *of_tree) for m in range(rounds)]
        weights = pa.table({"_1": pa.array(range(rounds), pa.int32()), "_2": told, "_3": [model.weight(m) for m in range(rounds)]})
        write_table(spark, f"{path}/treesMetadata", weights)
        write_table(spark, f"{path}/data", model.saved_nodes)


class _PipelineWriter(MLWriter):
    def __init__(self, model: GrownPipeline) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark, (vectors, trees) = self.sparkSession, self.model.stages
        uids = {"stageUids": [vectors.uid, trees.uid]}
        write_file(spark, f"{path}/metadata/part-00000", _entry(spark, "PipelineModel", self.model.uid, uids, {}).encode())
        facts = _entry(spark, "feature.VectorAssembler", vectors.uid, *_given(vectors))
        write_file(spark, f"{path}/stages/0_{vectors.uid}/metadata/part-00000", facts.encode())
        trees.write().session(spark).save(f"{path}/stages/1_{trees.uid}")
