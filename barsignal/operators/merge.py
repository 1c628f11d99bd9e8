"""Joins of news, scores, bars and sectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What a day without news and a symbol without sector get.
NEUTRAL_FILL = {
    "negative": 0.0, "positive": 0.0, "neutral": 1.0, "article_count": 0, "predicted_sentiment": "neutral",
}
OTHER_SECTOR = "Miscellaneous"


def news_x_sentiment(news: DataFrame, scores: DataFrame) -> DataFrame:
    """Articles with their scores. A repeated ``No`` multiplies rows: see
    ``duplicate_articles``. Scores, a row per article, are hashed: neither side
    is sorted."""
    return news.join(scores.hint("shuffle_hash"), "No", "inner")


def duplicate_articles(df: DataFrame) -> DataFrame:
    """Article numbers that occur more than once, with their counts."""
    return df.groupBy("No").count().where("count > 1")


def price_x_sentiment(prices: DataFrame, daily: DataFrame) -> DataFrame:
    """Every bar, with the day's sentiment where there is any. Articles of days
    without a bar are left out; they do not roll forward."""
    return prices.join(daily, ["Date", "Stock_symbol"], "left")


def has_news(df: DataFrame) -> DataFrame:
    return df.withColumn("has_news", F.col("article_count").isNotNull())


def fill_neutral(df: DataFrame) -> DataFrame:
    return df.fillna(NEUTRAL_FILL)


def with_sector(df: DataFrame, sectors: DataFrame) -> DataFrame:
    """Bars with their sector. Spark broadcasts the dimension when its size is
    below the broadcast threshold, and shuffles both sides otherwise."""
    return df.join(sectors.select("Stock_symbol", "category"), "Stock_symbol", "left")


def fill_misc(df: DataFrame) -> DataFrame:
    return df.fillna(OTHER_SECTOR, subset=["category"])
