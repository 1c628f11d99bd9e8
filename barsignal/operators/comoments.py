"""Counts, means and co-moments of column pairs, in blocks that merge.

A block of rows is a matrix: products of its deviations and of its masks give
the sums of all pairs at once, each over the rows where both columns hold a
value. Blocks of a partition merge by the difference of their means, and so do
partitions, in Spark, which shuffles one row per pair and partition.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Of a pair, over the rows where both hold a value.
MOMENTS = ("n", "mx", "my", "cxx", "cyy", "cxy")
SCHEMA = "i int, j int, n double, mx double, my double, cxx double, cyy double, cxy double"
# Sums that cancel below this share are taken again from the pair's own means.
CANCELLED = 1e-6


def pair_moments(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Moments of two full columns in two passes; zero for a constant one."""
    mx, my = x[0] + (x - x[0]).mean(), y[0] + (y - y[0]).mean()
    dx, dy = x - mx, y - my
    return len(x), mx, my, dx @ dx, dy @ dy, dx @ dy


def block_moments(x: np.ndarray, has_x: np.ndarray, y: np.ndarray, has_y: np.ndarray) -> np.ndarray:
    """MOMENTS of every column of ``x`` with every one of ``y``: an array (6, columns of x, columns of y).

    A pair that meets a value that is not finite has NaN moments.
    """

    def deviations(values: np.ndarray, has: np.ndarray):
        good = has & np.isfinite(values)
        clean = np.where(good, values, 0.0)
        shift = clean.sum(0) / np.maximum(good.sum(0), 1)
        return shift, np.where(good, clean - shift, 0.0), has.astype(float), (has & ~good).astype(float)

    shift_x, dx, in_x, odd_x = deviations(x, has_x)
    shift_y, dy, in_y, odd_y = deviations(y, has_y)
    n = in_x.T @ in_y
    sx, sy = dx.T @ in_y, in_x.T @ dy
    sxx, syy, sxy = (dx * dx).T @ in_y, in_x.T @ (dy * dy), dx.T @ dy
    rows = np.maximum(n, 1)
    out = np.stack([
        n, np.where(n > 0, shift_x[:, None] + sx / rows, 0), np.where(n > 0, shift_y + sy / rows, 0),
        sxx - sx * sx / rows, syy - sy * sy / rows, sxy - sx * sy / rows,
    ])
    odd = (odd_x.T @ in_y + in_x.T @ odd_y) > 0
    doubt = ((out[3] <= CANCELLED * sxx) & (sxx > 0)) | ((out[4] <= CANCELLED * syy) & (syy > 0))
    for i, j in zip(*np.nonzero(doubt & ~odd), strict=True):
        both = has_x[:, i] & has_y[:, j]
        out[:, i, j] = pair_moments(x[both, i], y[both, j])
    out[1:, odd] = np.nan
    return out


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moments of two blocks' rows together."""
    n = a[0] + b[0]
    share = b[0] / np.maximum(n, 1)
    dx, dy, weight = b[1] - a[1], b[2] - a[2], a[0] * share
    return np.stack([
        n, a[1] + dx * share, a[2] + dy * share,
        a[3] + b[3] + dx * dx * weight, a[4] + b[4] + dy * dy * weight, a[5] + b[5] + dx * dy * weight,
    ])


def _partition_moments(left: Sequence[int], right: Sequence[int], half: bool):
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            held = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns])
            with np.errstate(over="ignore", invalid="ignore"):
                block = block_moments(values[:, left], held[:, left], values[:, right], held[:, right])
                total = block if total is None else merged(total, block)
        if total is not None:
            keep = total[0] > 0
            i, j = np.nonzero(np.triu(keep) if half else keep)
            columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), *(pa.array(m[i, j]) for m in total)]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "j", *MOMENTS])

    return moments


def co_moments(df: DataFrame, left: Sequence[str], right: Sequence[str], half: bool = False) -> DataFrame:
    """(i, j, n, cxx, cyy, cxy): rows in common and centred sums of each pair.

    i and j are places in ``left`` and ``right``; ``half`` keeps i <= j. Pairs
    without a row in common are absent. A column constant over the pair's rows
    has a sum of exactly zero.
    """
    columns = list(dict.fromkeys([*left, *right]))
    places = [[columns.index(c) for c in side] for side in (left, right)]
    parts = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns]).mapInArrow(
        _partition_moments(*places, half), SCHEMA
    )
    pair = Window.partitionBy("i", "j")  # one row per partition of the input
    n, dx, dy = F.col("n"), F.col("dx"), F.col("dy")
    sums = (
        parts.withColumns({"dx": F.col("mx") - F.min("mx").over(pair), "dy": F.col("my") - F.min("my").over(pair)})
        .groupBy("i", "j")
        .agg(
            F.sum("n").alias("n"), F.sum(n * dx).alias("sx"), F.sum(n * dy).alias("sy"),
            F.sum(F.col("cxx") + n * dx * dx).alias("cxx"), F.sum(F.col("cyy") + n * dy * dy).alias("cyy"),
            F.sum(F.col("cxy") + n * dx * dy).alias("cxy"),
        )
    )
    sx, sy = F.col("sx"), F.col("sy")
    return sums.select(
        "i", "j", n.cast("long").alias("n"), F.greatest(F.col("cxx") - sx * sx / n, F.lit(0.0)).alias("cxx"),
        F.greatest(F.col("cyy") - sy * sy / n, F.lit(0.0)).alias("cyy"), (F.col("cxy") - sx * sy / n).alias("cxy"),
    )
