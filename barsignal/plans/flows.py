"""The stages composed: clean, merge, model set, backtest report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsignal.operators import clean, merge, metrics
from barsignal.operators.features import FEATURE_DEPTH, FEATURES, all_features_on
from barsignal.operators.folds import TEST_DAYS, TRAIN_DAYS, fold_counts, fold_table
from barsignal.operators.labels import LABEL_DAYS, labels_on
from barsignal.operators.panel import BLOCK_ROWS, drop_filled, filled_columns, over_blocks
from barsignal.operators.sentiment import daily_sentiment
from barsignal.operators.zscore import METHODS, WINDOW_DAYS
from barsignal.sources.files import NEWS_COLUMNS, strings
from barsignal.sources.quoted_csv import read_quoted_csv

# Columns whose fractional changes are taken.
CHANGED = ("Close", "Adj Close", "Volume")


def clean_news(raw: DataFrame, universe: DataFrame) -> DataFrame:
    """Articles of the universe, typed, without any row that lacks a value."""
    wanted = clean.semi_universe(clean.drop_columns(raw), universe)
    return clean.drop_any_null(clean.typed_news(wanted))


def ingest_news(spark: SparkSession, path: str, universe: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(articles, refused) of raw news files: the clean articles, and where the files could not be read."""
    raw, refused = read_quoted_csv(spark, path, strings(NEWS_COLUMNS))
    return clean_news(raw, universe), refused


def clean_prices(raw: DataFrame) -> DataFrame:
    return clean.typed_prices(raw)


def article_panel(news: DataFrame, scores: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    return clean.date_range(merge.news_x_sentiment(news, scores), start, end)


def sector_panel(
    prices: DataFrame,
    news: DataFrame,
    scores: DataFrame,
    sectors: DataFrame,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Bars with the day's sentiment and their sector, as one lazy plan."""
    # The join needs an article's number, day and symbol only: texts stay
    # out of the shuffle.
    articles = article_panel(news.select("No", "Date", "Stock_symbol"), scores, start, end)
    joined = merge.price_x_sentiment(clean.date_range(prices, start, end), daily_sentiment(articles))
    filled = merge.fill_neutral(merge.has_news(joined))
    return merge.fill_misc(merge.with_sector(filled, sectors))


def labelled_features(
    panel: DataFrame,
    price_col: str = "Close",
    label_mode: str = "compat",
    block_rows: int | None = BLOCK_ROWS,
    fill: str = "none",
) -> DataFrame:
    """All features and the label, from one shuffle of the panel."""
    panel, past = filled_columns(panel, CHANGED, fill)

    def steps(df, w):
        return all_features_on(labels_on(df, w, price_col, label_mode, past), w, past)

    return drop_filled(over_blocks(panel, steps, back=FEATURE_DEPTH, ahead=LABEL_DAYS, block_rows=block_rows))


def model_set(
    panel: DataFrame,
    features: Sequence[str] = FEATURES,
    window: int = WINDOW_DAYS,
    price_col: str = "Close",
    label_mode: str = "compat",
    method: str = "chunked",
    block_rows: int | None = BLOCK_ROWS,
    fill: str = "none",
) -> DataFrame:
    """Features, labels and z-scores of all sectors; rows lacking one dropped.

    Everything is computed from one shuffle of the panel: a block's halo
    covers the z-score window and, before it, the depth of the features.
    """
    panel, past = filled_columns(panel, CHANGED, fill)

    def steps(df, w):
        df = all_features_on(labels_on(df, w, price_col, label_mode, past), w, past)
        return METHODS[method](df, w, features, window)

    scored = over_blocks(
        panel, steps, back=FEATURE_DEPTH + window - 1, ahead=LABEL_DAYS, block_rows=block_rows
    )
    return drop_filled(clean.drop_null_subset(scored, [*[f"{f}_z" for f in features], "Label"]))


def fold_report(
    model_set: DataFrame, predictions: DataFrame, train_days: int = TRAIN_DAYS, test_days: int = TEST_DAYS,
    registry: DataFrame | None = None,
) -> DataFrame:
    """Dates, metrics and counts of every fold; with a registry also the ``model_path`` of its saved model."""
    by = ["category", "fold"]
    report = metrics.fold_results(
        predictions, fold_table(model_set, train_days, test_days), fold_counts(model_set, train_days, test_days), by
    )
    if registry is None:
        return report
    keys = ["category", "train_start", "train_end", "test_start", "test_end"]
    return report.join(registry.select(*keys, "model_path"), keys, "left")


def backtest_report(results: DataFrame, predictions: DataFrame) -> dict[str, DataFrame]:
    """Every table of the backtest report, by name."""
    return {
        "metrics_overall": metrics.metrics_overall(results),
        "metrics_summary": metrics.metrics_summary(results),
        "metrics_by_year": metrics.metrics_by_year(results),
        "metrics_timeline": metrics.metrics_timeline(results),
        "confusion_matrix": metrics.confusion_matrix(predictions),
        "confusion_rates": metrics.confusion_rates(predictions),
        "daily_labels": metrics.daily_labels(predictions),
        "symbol_metrics": metrics.symbol_metrics(predictions),
        "symbol_leaders": metrics.symbol_leaders(predictions),
        "symbol_laggards": metrics.symbol_laggards(predictions),
    }


def report_values(tables: dict[str, DataFrame]) -> DataFrame:
    """Any set of report tables in one long form: (table, key, metric, value).

    The key joins a row's texts, dates and whole years by "|"; every other
    number is a value.
    """
    parts = []
    for name, table in tables.items():
        keys = [c for c, t in table.dtypes if t in ("string", "date", "timestamp") or c == "year"]
        values = [c for c in table.columns if c not in keys]
        key = F.concat_ws("|", *[F.col(c).cast("string") for c in keys])
        wide = table.select(key.alias("key"), *[F.col(c).cast("double").alias(c) for c in values])
        parts.append(wide.unpivot(["key"], values, "metric", "value").select(F.lit(name).alias("table"), "key", "metric", "value"))
    return reduce(DataFrame.unionByName, parts)
