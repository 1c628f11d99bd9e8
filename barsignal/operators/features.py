"""Per-symbol return, trend, volatility, volume, sentiment and lag features."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from barsignal.functions.rolling import div, roll
from barsignal.operators.panel import BLOCK_ROWS, drop_filled, filled_columns, over_blocks, raw

# The model's feature names, in the order the model expects.
FEATURES = (
    "Return_1d", "Return_5d", "Return_20d", "MA5_Ratio", "MA20_Ratio", "Trend_5_20",
    "Dist_20High", "Dist_20Low",
    "Vol_5d", "Vol_20d", "Vol_Ratio", "Gap",
    "Vol_Change", "Vol_Ratio_20", "PV_Score", "Vol_Trend",
    "Sent_Net", "Sent_MA5", "Sent_Mom5", "News_Intensity",
    "Ret_Lag1", "Ret_Lag5", "Sent_Lag3",
)
FEATURE_GROUPS = {
    "momentum": ("Return_1d", "Return_5d", "Return_20d", "MA5_Ratio", "MA20_Ratio", "Trend_5_20"),
    "volatility": ("Vol_5d", "Vol_20d", "Vol_Ratio", "Gap"),
    "volume": ("Vol_Change", "Vol_Ratio_20", "PV_Score", "Vol_Trend"),
    "sentiment": ("Sent_Net", "Sent_MA5", "Sent_Mom5", "News_Intensity"),
    "lag": ("Ret_Lag1", "Ret_Lag5", "Sent_Lag3"),
}
MODEL_GROUPS = {**FEATURE_GROUPS, "momentum": (*FEATURE_GROUPS["momentum"], "Dist_20High", "Dist_20Low")}

# Rows before the current one that any feature reads.
FEATURE_DEPTH = 20

# A family lists its columns in up to four phases: windows over the panel's
# own columns, arithmetic on them, windows over returns, arithmetic again.
# Families are combined phase by phase, so any number of them costs two
# window passes over one sorted partitioning. Columns starting with "_" are
# intermediate.
#
# ``past`` gives the column that fractional changes are taken of: the column
# itself, or its forward-filled copy.
Phase = dict[str, Column]
Family = Callable[[WindowSpec, Callable[[str], Column]], list[Phase]]


def _adj() -> Column:
    return F.col("`Adj Close`")


def _net() -> Column:
    return F.col("positive") - F.col("negative")


def returns(w: WindowSpec, past: Callable[[str], Column]) -> list[Phase]:
    spans, price = (1, 5, 20), past("Adj Close")
    return [
        {f"_past_{k}": F.lag(price, k).over(w) for k in spans},
        {f"Return_{k}d": div(price, F.col(f"_past_{k}")) - 1 for k in spans},
    ]


def moving_averages(w: WindowSpec, past: Callable[[str], Column]) -> list[Phase]:
    ma5, ma20 = F.col("MA5"), F.col("MA20")
    return [
        {f"MA{n}": roll(F.avg, _adj(), n, w) for n in (5, 20)},
        {"MA5_Ratio": div(_adj(), ma5), "MA20_Ratio": div(_adj(), ma20), "Trend_5_20": div(ma5 - ma20, ma20)},
    ]


def extrema(w: WindowSpec, past: Callable[[str], Column]) -> list[Phase]:
    def distance(level: str) -> Column:
        return div(_adj() - F.col(level), F.col(level))

    return [
        {"High_20": roll(F.max, F.col("High"), 20, w), "Low_20": roll(F.min, F.col("Low"), 20, w)},
        {"Dist_20High": distance("High_20"), "Dist_20Low": distance("Low_20")},
    ]


def volatility(w: WindowSpec, past: Callable[[str], Column]) -> list[Phase]:
    """The gap sets the raw open against the adjusted previous close."""
    previous = F.col("_previous")
    return [
        {"_previous": F.lag(_adj(), 1).over(w)},
        {"Gap": div(F.col("Open") - previous, previous)},
        {f"Vol_{n}d": roll(F.stddev_samp, F.col("Return_1d"), n, w) for n in (5, 20)},
        {"Vol_Ratio": div(F.col("Vol_5d"), F.col("Vol_20d"))},
    ]


def volume(w: WindowSpec, past: Callable[[str], Column]) -> list[Phase]:
    shares, traded, ma20 = F.col("Volume"), past("Volume"), F.col("Vol_MA20")
    return [
        {
            "_traded_1": F.lag(traded, 1).over(w),
            "Vol_MA20": roll(F.avg, shares, 20, w),
            "Vol_MA5": roll(F.avg, shares, 5, w),
        },
        {
            "Vol_Change": div(traded, F.col("_traded_1")) - 1,
            "Vol_Ratio_20": div(shares, ma20),
            "Vol_Trend": div(F.col("Vol_MA5"), ma20),
        },
        {},
        {"PV_Score": F.col("Return_1d") * F.col("Vol_Ratio_20")},
    ]


def sentiment(w: WindowSpec, past: Callable[[str], Column]) -> list[Phase]:
    return [
        {"Sent_MA5": roll(F.avg, _net(), 5, w), "_net_5": F.lag(_net(), 5).over(w)},
        {"Sent_Net": _net(), "Sent_Mom5": _net() - F.col("_net_5")},
    ]


def news(w: WindowSpec, past: Callable[[str], Column]) -> list[Phase]:
    count = F.col("article_count")
    return [
        {"Art_MA20": roll(F.avg, count, 20, w)},
        {"News_Intensity": div(count, F.col("Art_MA20"))},
    ]


def return_lags(w: WindowSpec, past: Callable[[str], Column]) -> list[Phase]:
    return [
        {"Sent_Lag3": F.lag(_net(), 3).over(w)},
        {},
        {"Ret_Lag1": F.lag("Return_1d", 1).over(w), "Ret_Lag5": F.lag("Return_5d", 5).over(w)},
    ]


ALL_FAMILIES = (returns, moving_averages, extrema, volatility, volume, sentiment, news, return_lags)


def families_on(
    df: DataFrame, w: WindowSpec, families: Iterable[Family], past: Callable[[str], Column] = raw
) -> DataFrame:
    """Add the families' columns to a panel whose windows follow ``w``."""
    built = [family(w, past) for family in families]
    for i in range(max(len(phases) for phases in built)):
        columns = {name: c for phases in built if i < len(phases) for name, c in phases[i].items()}
        df = df.withColumns(columns) if columns else df
    return df.drop(*[c for phases in built for phase in phases for c in phase if c.startswith("_")])


def all_features_on(df: DataFrame, w: WindowSpec, past: Callable[[str], Column] = raw) -> DataFrame:
    return families_on(df, w, ALL_FAMILIES, past)


def _engineer(df: DataFrame, block_rows: int | None, *families: Family, fill: str = "none") -> DataFrame:
    df, past = filled_columns(df, ("Adj Close", "Volume"), fill)
    out = over_blocks(df, lambda d, w: families_on(d, w, families, past), FEATURE_DEPTH, block_rows=block_rows)
    return drop_filled(out)


def engineer_return_features(df: DataFrame, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    return _engineer(df, block_rows, returns)


def engineer_moving_average_features(df: DataFrame, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    return _engineer(df, block_rows, moving_averages)


def engineer_extrema_features(df: DataFrame, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    return _engineer(df, block_rows, extrema)


def engineer_volatility_features(df: DataFrame, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Adds Return_1d, Return_5d and Return_20d as well."""
    return _engineer(df, block_rows, returns, volatility)


def engineer_volume_features(df: DataFrame, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Adds Return_1d, Return_5d and Return_20d as well."""
    return _engineer(df, block_rows, returns, volume)


def engineer_sentiment_features(df: DataFrame, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    return _engineer(df, block_rows, sentiment)


def engineer_news_features(df: DataFrame, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    return _engineer(df, block_rows, news)


def engineer_lag_features(df: DataFrame, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Adds the returns and the net sentiment that are lagged as well."""
    return _engineer(df, block_rows, returns, sentiment, return_lags)


def engineer_all_features(df: DataFrame, block_rows: int | None = BLOCK_ROWS, fill: str = "none") -> DataFrame:
    """Every feature of ``FEATURES`` plus the averages and extrema behind them.

    ``fill="ffill"`` takes changes of prices and volumes over missing values,
    from the last known one.
    """
    return _engineer(df, block_rows, *ALL_FAMILIES, fill=fill)
