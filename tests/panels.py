"""Hand-made panels and a pandas statement of the feature definitions."""

from __future__ import annotations

import numpy as np
import pandas as pd

EDGE_LENGTHS = (1, 4, 5, 6, 19, 20, 21, 251, 252, 271, 272, 273, 700)


def edge_panel(lengths=EDGE_LENGTHS, seed=7) -> pd.DataFrame:
    """Symbols of the given lengths; one constant, one with zero volumes, one
    without news for a while, one with missing opens, all with date gaps."""
    rng = np.random.default_rng(seed)
    frames = []
    for k, n in enumerate(lengths):
        dates = pd.Timestamp("2019-01-02") + pd.to_timedelta(np.cumsum(rng.integers(1, 4, n)), "D")
        close = np.round(50 + np.cumsum(rng.normal(0, 1, n)), 2)
        if k == 6:
            close[:] = 25.0
        volume = rng.integers(0 if k == 7 else 100, 10_000, n)
        if k == 8:
            volume[::17] = 0
        articles = rng.integers(0, 4, n)
        if n > 60:
            articles[20:48] = 0
        frames.append(pd.DataFrame({
            "Stock_symbol": f"S{n}",
            "Date": dates.date,
            "Open": np.where(rng.random(n) < 0.05, np.nan, close + rng.normal(0, 0.5, n)),
            "High": close + rng.random(n),
            "Low": close - rng.random(n),
            "Close": close,
            "Adj Close": close * 0.97,
            "Volume": volume,
            "positive": rng.random(n) / 2,
            "negative": rng.random(n) / 2,
            "neutral": 0.0,
            "article_count": articles,
            "category": "A" if k % 2 else "B",
        }))
    return pd.concat(frames).sample(frac=1, random_state=seed).reset_index(drop=True)


def as_spark(spark, frame: pd.DataFrame):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(frame)
    doubles = [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(f"`{c}`")) for c in doubles})


def pandas_features(frame: pd.DataFrame) -> pd.DataFrame:
    d = frame.sort_values(["Stock_symbol", "Date"]).reset_index(drop=True)
    by = d["Stock_symbol"]

    def rolled(x, n, how):
        return x.groupby(by).transform(lambda s: getattr(s.rolling(n), how)())

    def before(x, k):
        return x.groupby(by).shift(k)

    price, shares = d["Adj Close"], d["Volume"].astype(float)
    for k in (1, 5, 20):
        d[f"Return_{k}d"] = price / before(price, k) - 1
    for n in (5, 20):
        d[f"MA{n}"] = rolled(price, n, "mean")
        d[f"MA{n}_Ratio"] = price / d[f"MA{n}"]
        d[f"Vol_{n}d"] = rolled(d["Return_1d"], n, "std")
        d[f"Vol_MA{n}"] = rolled(shares, n, "mean")
    d["Trend_5_20"] = (d["MA5"] - d["MA20"]) / d["MA20"]
    top, low = rolled(d["High"], 20, "max"), rolled(d["Low"], 20, "min")
    d["Dist_20High"], d["Dist_20Low"] = (price - top) / top, (price - low) / low
    d["Vol_Ratio"] = d["Vol_5d"] / d["Vol_20d"]
    d["Gap"] = d["Open"] / before(price, 1) - 1
    d["Vol_Change"] = shares / before(shares, 1) - 1
    d["Vol_Ratio_20"] = shares / d["Vol_MA20"]
    d["PV_Score"] = d["Return_1d"] * d["Vol_Ratio_20"]
    d["Vol_Trend"] = d["Vol_MA5"] / d["Vol_MA20"]
    d["Sent_Net"] = d["positive"] - d["negative"]
    d["Sent_MA5"] = rolled(d["Sent_Net"], 5, "mean")
    d["Sent_Mom5"] = d["Sent_Net"] - before(d["Sent_Net"], 5)
    d["News_Intensity"] = d["article_count"] / rolled(d["article_count"].astype(float), 20, "mean")
    d["Ret_Lag1"], d["Ret_Lag5"] = before(d["Return_1d"], 1), before(d["Return_5d"], 5)
    d["Sent_Lag3"] = before(d["Sent_Net"], 3)
    return d.replace([np.inf, -np.inf], np.nan)


def pandas_zscores(d: pd.DataFrame, features, window: int) -> pd.DataFrame:
    by = d["Stock_symbol"]
    return pd.DataFrame({
        f"{f}_z": d[f].groupby(by).transform(lambda s: (s - s.rolling(window).mean()) / (s.rolling(window).std() + 1e-8))
        for f in features
    })


def pandas_labels(frame: pd.DataFrame) -> pd.DataFrame:
    d = frame.sort_values(["Stock_symbol", "Date"]).reset_index(drop=True)
    up = (d["Close"].groupby(d["Stock_symbol"]).pct_change(fill_method=None) > 0).astype(int)
    d["Up_Count_5d"] = up.groupby(d["Stock_symbol"]).transform(lambda s: s.shift(-1).rolling(5).sum())
    d["Label"] = (d["Up_Count_5d"] >= 3).astype(int)
    return d


def in_order(df) -> pd.DataFrame:
    return df.toPandas().sort_values(["Stock_symbol", "Date"]).reset_index(drop=True)


def assert_close(got: pd.DataFrame, want: pd.DataFrame, columns, tolerance=1e-9) -> None:
    assert len(got) == len(want)
    for c in columns:
        a, b = got[c].astype(float).to_numpy(), want[c].astype(float).to_numpy()
        assert (np.isnan(a) == np.isnan(b)).all(), c
        np.testing.assert_allclose(a, b, rtol=tolerance, atol=tolerance, err_msg=c)
