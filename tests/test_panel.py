"""Blocked windows equal per-symbol windows."""

import pandas as pd
import pytest
from panels import as_spark, assert_close, edge_panel, in_order
from pyspark.sql import functions as F

from barsignal.functions.rolling import roll
from barsignal.operators.panel import forward_fill, over_blocks, panel_sort


def sums(df, w):
    return df.withColumns({
        "past": F.sum("Volume").over(w.rowsBetween(-7, 0)),
        "future": F.sum("Volume").over(w.rowsBetween(0, 3)),
        "full": roll(F.sum, F.col("Volume"), 8, w),
    })


@pytest.mark.parametrize("block_rows", [1, 5, 8, 30, 100, 10_000])
def test_blocks_equal_whole_windows(spark, block_rows):
    panel = as_spark(spark, edge_panel((1, 4, 7, 8, 9, 60, 300)))
    blocked = in_order(over_blocks(panel, sums, back=7, ahead=3, block_rows=block_rows))
    whole = in_order(over_blocks(panel, sums, back=7, ahead=3, block_rows=None))
    assert_close(blocked, whole, ["past", "future", "full"])
    assert list(blocked.columns) == list(whole.columns)


def test_one_hot_symbol_is_spread_over_blocks(spark):
    """A symbol with most of the rows; no block may hold more than its share."""
    panel = as_spark(spark, edge_panel((3000, 20, 20)))

    def sized(df, w):
        return sums(df, w).withColumn("_size", F.count(F.lit(1)).over(w.rowsBetween(-10**9, 10**9)))

    out = in_order(over_blocks(panel, sized, back=7, ahead=3, block_rows=200))
    assert out["_size"].max() < 300
    assert_close(out, in_order(over_blocks(panel, sums, 7, 3, None)), ["past", "future", "full"])


def test_many_rows_in_one_month(spark):
    """Months longer than a block, sparse months and repeated dates."""
    days = ["2020-01-01"] * 40 + ["2020-01-02"] * 35 + [f"2020-{m:02d}-03" for m in range(2, 12)] + ["2021-05-01"] * 30
    frame = pd.DataFrame({
        "Stock_symbol": "X", "Date": pd.to_datetime(days).date, "Close": range(len(days)), "Volume": range(1, len(days) + 1),
    })
    panel = as_spark(spark, frame)
    blocked = over_blocks(panel, sums, back=7, ahead=3, block_rows=10).toPandas().sort_values("Volume").reset_index(drop=True)
    whole = over_blocks(panel, sums, back=7, ahead=3, block_rows=None).toPandas().sort_values("Volume").reset_index(drop=True)
    assert_close(blocked, whole, ["past", "future", "full"])


def test_undated_rows_and_missing_symbols_are_kept(spark):
    panel = spark.sql("""
        select * from values ('A', date'2020-01-01', 1), ('A', cast(null as date), 2), (null, date'2020-01-01', 3)
        as t(Stock_symbol, Date, Volume)""")
    assert over_blocks(panel, sums, back=7, ahead=3).count() == 3


def test_forward_fill_crosses_blocks_and_months(spark):
    frame = edge_panel((300, 40))
    frame.loc[frame["Date"].map(lambda d: d.month % 3 != 1 or d.day % 2 == 0), "Close"] = None
    filled = in_order(forward_fill(as_spark(spark, frame), {"Close": "filled"}))
    want = frame.sort_values(["Stock_symbol", "Date"]).reset_index(drop=True)
    want["filled"] = want.groupby("Stock_symbol")["Close"].ffill()
    assert_close(filled, want, ["filled"])
    assert filled["filled"].isna().sum() < filled["Close"].isna().sum()


def test_panel_sort(spark):
    rows = panel_sort(as_spark(spark, edge_panel((5, 9)))).select("Stock_symbol", "Date").collect()
    assert rows == sorted(rows)


def test_features_shuffle_the_panel_once(spark, tmp_path):
    from barsignal.plans.flows import model_set

    path = str(tmp_path / "panel")
    as_spark(spark, edge_panel((300,))).write.parquet(path)
    plan = model_set(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # Two exchanges of the month counts, one of the panel.
    assert len(wide) == 3, wide
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
