"""Features, labels and z-scores against their pandas definitions."""

import numpy as np
import pandas as pd
import pytest
from panels import as_spark, assert_close, edge_panel, in_order, pandas_features, pandas_labels, pandas_zscores
from pyspark.sql import functions as F

from barsignal.operators.features import FEATURES, engineer_all_features
from barsignal.operators.labels import create_labels
from barsignal.operators.zscore import normalize_features
from barsignal.plans.flows import labelled_features, model_set


@pytest.fixture(scope="module")
def frame():
    return edge_panel()


@pytest.fixture(scope="module")
def panel(spark, frame):
    return as_spark(spark, frame).cache()


@pytest.mark.parametrize("block_rows", [60, None])
def test_all_features(panel, frame, block_rows):
    assert_close(in_order(engineer_all_features(panel, block_rows)), pandas_features(frame), FEATURES)


def test_forward_filled_changes(spark, frame):
    gaps = frame.copy()
    gaps.loc[gaps.index % 7 == 0, "Adj Close"] = np.nan
    got = in_order(engineer_all_features(as_spark(spark, gaps), block_rows=60, fill="ffill"))
    want = gaps.sort_values(["Stock_symbol", "Date"]).reset_index(drop=True)
    price = want.groupby("Stock_symbol")["Adj Close"].ffill()
    for k in (1, 5, 20):
        want[f"Return_{k}d"] = price / price.groupby(want["Stock_symbol"]).shift(k) - 1
    assert_close(got, want, ["Return_1d", "Return_5d", "Return_20d"])


@pytest.mark.parametrize("block_rows", [60, None])
def test_compat_labels(panel, frame, block_rows):
    got = in_order(create_labels(panel, block_rows=block_rows))
    assert_close(got, pandas_labels(frame), ["Up_Count_5d", "Label"])
    assert got["Label"].notna().all()


def test_compat_window_is_three_back_one_ahead(spark):
    """Row 4 counts rows 1 .. 5; only rows 4 .. n-2 are complete."""
    closes = [10, 11, 12, 11, 12, 13, 12, 13]
    frame = pd.DataFrame({"Stock_symbol": "A", "Date": pd.date_range("2020-01-01", periods=8).date, "Close": closes})
    got = in_order(create_labels(spark.createDataFrame(frame)))
    assert got["Up_Day"].tolist() == [0, 1, 1, 0, 1, 1, 0, 1]
    assert got["Up_Count_5d"].isna().tolist() == [True] * 4 + [False] * 3 + [True]
    assert got["Up_Count_5d"].dropna().tolist() == [4, 3, 3]
    assert got["Label"].tolist() == [0, 0, 0, 0, 1, 1, 1, 0]


def test_forward_labels(spark):
    closes = [10, 11, 12, 13, 12, 11, 12, 13]
    frame = pd.DataFrame({"Stock_symbol": "A", "Date": pd.date_range("2020-01-01", periods=8).date, "Adj Close": closes})
    got = in_order(create_labels(spark.createDataFrame(frame), price_col="Adj Close", mode="forward", block_rows=2))
    assert got["Up_Count_5d"].dropna().tolist() == [3, 3, 3]
    assert got["Label"].isna().tolist() == [False] * 3 + [True] * 5


@pytest.mark.parametrize("block_rows", [60, 500, None])
@pytest.mark.parametrize("method", ["chunked", "sliding"])
def test_zscores(panel, frame, block_rows, method):
    if method == "sliding" and block_rows == 500:
        pytest.skip("one blocked run of the sliding form is enough")
    features = ("Return_1d", "Vol_Change", "Vol_20d", "Sent_Net", "Gap")
    got = in_order(normalize_features(engineer_all_features(panel, block_rows), features, 50, method, block_rows))
    want = pandas_zscores(pandas_features(frame), features, 50)
    assert_close(got, want, want.columns, 1e-7)


def test_zscores_survive_spikes_and_constants(spark):
    """A value a billion times the others must leave no trace after its window."""
    n = 400
    x = np.round(np.random.default_rng(3).normal(0, 1e-3, n), 6)
    x[100] = 1e9
    frame = pd.DataFrame({
        "Stock_symbol": "A", "Date": pd.date_range("2020-01-01", periods=n).date, "spiky": x, "flat": 0.1,
    })
    got = in_order(normalize_features(spark.createDataFrame(frame), ["spiky", "flat"], 50, block_rows=120))
    after = np.arange(160, n)
    for i in after:
        part = x[i - 49:i + 1]
        assert got["spiky_z"][i] == pytest.approx((x[i] - part.mean()) / (part.std(ddof=1) + 1e-8), rel=1e-9)
    assert (got["flat_z"].dropna().abs() < 1e-6).all()


def test_zscore_ignores_scale_and_origin(panel):
    features = engineer_all_features(panel, 200)
    moved = features.withColumn("moved", F.col("Return_20d") * 250 + 3)
    z = in_order(normalize_features(moved, ["Return_20d", "moved"], 60)).dropna(subset=["moved_z"])
    np.testing.assert_allclose(z["Return_20d_z"], z["moved_z"], atol=1e-4)


def test_features_do_not_look_ahead(panel):
    """Cutting later rows changes no feature; it may change a compat label."""
    cut = panel.where("Date < date'2020-06-01'")
    whole = in_order(engineer_all_features(panel, 60).where("Date < date'2020-06-01'"))
    assert_close(in_order(engineer_all_features(cut, 60)), whole, FEATURES)


def test_model_set_equals_its_steps(panel):
    panel = panel.withColumn("Open", F.coalesce("Open", "Close"))
    steps = normalize_features(labelled_features(panel, block_rows=None), FEATURES, 60, "sliding", None)
    want = in_order(steps.dropna(subset=[f"{f}_z" for f in FEATURES]))
    got = in_order(model_set(panel, window=60, block_rows=90))
    assert len(got) > 100
    assert_close(got, want, [*FEATURES, "Label", *[f"{f}_z" for f in FEATURES]], 1e-7)


def test_model_set_starts_at_row_272(spark):
    n = 300
    rng = np.random.default_rng(1)
    frame = edge_panel((n,), seed=11)
    frame["Open"] = frame["Close"] + rng.normal(0, 1, n)
    frame["Volume"], frame["article_count"] = rng.integers(1, 99, n), rng.integers(1, 9, n)
    got = in_order(model_set(as_spark(spark, frame)))
    assert len(got) == n - 271
    forward = in_order(model_set(as_spark(spark, frame), label_mode="forward"))
    assert len(forward) == n - 271 - 5


def test_unknown_modes_are_refused(panel):
    with pytest.raises(ValueError):
        create_labels(panel, mode="sideways")
    with pytest.raises(ValueError):
        engineer_all_features(panel, fill="bfill")
