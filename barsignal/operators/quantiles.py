"""Exact quantiles without gathering a column in one task.

Spark's exact ``percentile`` holds every distinct value of a column in one
buffer. Here mergeable sketches of all columns, in one wide aggregate, narrow
the range that must hold the wanted order statistics; a second aggregate counts
what lies below and inside each range; then only the values inside are exploded,
counted and ranked. Ranges that still hold too much are narrowed again, so the
number of passes follows from the number of rows. Rows are never multiplied by
the columns.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

ACCURACY = 10_000  # a sketch's rank error is at most rows / ACCURACY
# Shares of the rows on either side of a quantile, narrowest first.
MARGINS = (0.0005, 0.005, 0.05)
# Values of one range that are ranked in one task.
INSIDE = 100_000


@dataclass
class Range:
    """Where the order statistics around one quantile lie: ranks first and last of the column's n values."""

    name: str
    prob: float
    n: int
    first: int
    last: int
    low: float
    high: float
    below: int = 0
    inside: int = 0

    @property
    def share(self) -> float:
        return (self.n - 1) * self.prob - self.first


def _value(name: str) -> Column:
    return F.col(f"`{name}`").cast("double")


def _within(r: Range) -> Column:
    return _value(r.name).between(r.low, r.high)


def column_summaries(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> tuple[list[Row], list[Range]]:
    """(column, count, mean, std, min, max) of every column and the first ranges, from one scan."""
    points = sorted({min(1.0, max(0.0, p + s * m)) for p in probs for m in MARGINS for s in (-1, 1)})
    cells = [
        F.struct(
            F.lit(c).alias("column"), F.count(_value(c)).alias("count"), F.avg(_value(c)).alias("mean"),
            F.stddev_samp(_value(c)).alias("std"), F.min(_value(c)).alias("min"), F.max(_value(c)).alias("max"),
            F.percentile_approx(_value(c), points, ACCURACY).alias("grid"),
        )
        for c in columns
    ]
    # One row per column reaches the driver.
    rows = df.agg(F.array(*cells).alias("s")).select(F.inline("s")).collect()
    ranges = []
    for row in rows:
        n = row["count"]
        for p in probs if n else ():
            first = math.floor((n - 1) * p)
            # Room for the sketch's error and for the ranks on either side.
            margin = next((m for m in MARGINS if m >= 2 / ACCURACY + 2 / n), 1.0)
            low = row["grid"][points.index(p - margin)] if p - margin > 0 else row["min"]
            high = row["grid"][points.index(p + margin)] if p + margin < 1 else row["max"]
            ranges.append(Range(row["column"], float(p), n, first, min(first + 1, n - 1), low, high))
    return rows, ranges


def _count(df: DataFrame, ranges: list[Range]) -> None:
    """Fills in what lies below and inside the ranges, from one scan."""
    below = F.array(*[F.count(F.when(_value(r.name) < r.low, 1)) for r in ranges])
    inside = F.array(*[F.count(F.when(_within(r), 1)) for r in ranges])
    row = df.agg(below.alias("below"), inside.alias("inside")).first()
    for r, b, m in zip(ranges, row["below"], row["inside"], strict=True):
        r.below, r.inside = b, m
        if not b <= r.first <= r.last < b + m:
            raise ValueError(f"a quantile of {r.name} lies outside its range")


def _narrow(df: DataFrame, ranges: list[Range]) -> None:
    """Sketches what is inside the ranges and moves their ends towards the ranks, from one scan."""
    ends = [
        ((r.first - r.below) / r.inside - 2 / ACCURACY, (r.last - r.below + 1) / r.inside + 2 / ACCURACY) for r in ranges
    ]
    sketches = [
        F.percentile_approx(F.when(_within(r), _value(r.name)), [max(0.0, a), min(1.0, b)], ACCURACY)
        for r, (a, b) in zip(ranges, ends, strict=True)
    ]
    row = df.agg(F.array(*sketches).alias("s")).first()
    for r, (a, b), (low, high) in zip(ranges, ends, row["s"], strict=True):
        r.low, r.high = low if a > 0 else r.low, high if b < 1 else r.high


def ranked_quantiles(df: DataFrame, ranges: list[Range], rounds: int | None = None) -> DataFrame:
    """(name, prob, n, quantile) of the ranges' quantiles; ``rounds`` forces a number of sketches."""
    spark = df.sparkSession
    schema = "id int, name string, prob double, n bigint, a bigint, b bigint, share double"
    if not ranges:
        return spark.createDataFrame([], schema).select("name", "prob", "n", F.col("share").alias("quantile"))
    _count(df, ranges)
    done = 1
    while done < rounds if rounds else max(r.inside for r in ranges) > INSIDE:
        before = sum(r.inside for r in ranges)
        _narrow(df, ranges)
        _count(df, ranges)
        done += 1
        if not rounds and sum(r.inside for r in ranges) == before:
            break  # what is left are equal values, which are counted as one
    wanted = spark.createDataFrame(
        [(i, r.name, r.prob, r.n, r.first - r.below, r.last - r.below, r.share) for i, r in enumerate(ranges)], schema
    )
    hits = F.array_compact(F.array(*[
        F.when(_within(r), F.struct(F.lit(i).alias("id"), _value(r.name).alias("x"))) for i, r in enumerate(ranges)
    ]))
    values = df.select(F.inline(hits)).groupBy("id", "x").agg(F.count(F.lit(1)).alias("c"))
    order = Window.partitionBy("id").orderBy("x")
    upto = values.withColumn("_to", F.sum("c").over(order.rowsBetween(Window.unboundedPreceding, 0)))

    def at(rank: str) -> Column:
        return F.max(F.when((F.col("_to") > F.col(rank)) & (F.col("_to") - F.col("c") <= F.col(rank)), F.col("x")))

    # One row per column and quantile: broadcast.
    picked = upto.join(F.broadcast(wanted), "id").groupBy("id", "name", "prob", "n", "share").agg(at("a").alias("a"), at("b").alias("b"))
    return picked.select("name", "prob", "n", (F.col("a") + F.col("share") * (F.col("b") - F.col("a"))).alias("quantile"))


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], rounds: int | None = None) -> DataFrame:
    """(name, prob, n, quantile), interpolated linearly between neighbours; columns without a value have no row.

    Three scans up to about 10^8 rows, two more for every further factor of
    some thousands. The driver holds a few numbers per column and quantile.
    """
    return ranked_quantiles(df, column_summaries(df, columns, probs)[1], rounds)
