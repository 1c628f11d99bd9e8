"""Majority-of-up-days labels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from barsignal.functions.rolling import change
from barsignal.operators.panel import BLOCK_ROWS, drop_filled, filled_columns, over_blocks, raw

LABEL_DAYS = 5
LABEL_VOTES = 3


def labels_on(
    df: DataFrame,
    w: WindowSpec,
    price_col: str = "Close",
    mode: str = "compat",
    past: Callable[[str], Column] = raw,
) -> DataFrame:
    """Daily_Return, Up_Day, Up_Count_5d and Label.

    ``compat`` counts the up days of rows t-3 .. t+1, so four of the five are
    already known at t, and gives rows without a full count the label 0: its
    scores are no evidence of forecasting skill. Its count also needs row t-4.
    ``forward`` counts rows t+1 .. t+5 and leaves the label NULL where they are
    not all there.
    """
    if mode not in ("compat", "forward"):
        raise ValueError(f"unknown label mode {mode!r}")
    counted, needed = ((-3, 1), (-4, 1)) if mode == "compat" else ((1, LABEL_DAYS), (1, LABEL_DAYS))
    rows_needed = needed[1] - needed[0] + 1
    complete = F.count("Up_Day").over(w.rowsBetween(*needed)) == rows_needed
    df = (
        df.withColumn("Daily_Return", change(past(price_col), 1, w))
        .withColumn("Up_Day", F.when(F.col("Daily_Return") > 0, 1).otherwise(0))
        .withColumn("Up_Count_5d", F.when(complete, F.sum("Up_Day").over(w.rowsBetween(*counted))))
    )
    up = (F.col("Up_Count_5d") >= LABEL_VOTES).cast("int")
    return df.withColumn("Label", up if mode == "forward" else F.coalesce(up, F.lit(0)))


def create_labels(
    df: DataFrame,
    price_col: str = "Close",
    mode: str = "compat",
    block_rows: int | None = BLOCK_ROWS,
    fill: str = "none",
) -> DataFrame:
    df, past = filled_columns(df, (price_col,), fill)
    labelled = over_blocks(
        df,
        lambda d, w: labels_on(d, w, price_col, mode, past),
        back=LABEL_DAYS,
        ahead=LABEL_DAYS,
        block_rows=block_rows,
    )
    return drop_filled(labelled)
