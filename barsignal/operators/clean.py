"""Typing and filtering of raw news and price rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsignal.functions.rolling import nan_to_null
from barsignal.functions.scalars import to_date_or_null, to_double_or_null, to_int_or_null

# Columns and formats of the raw files.
UNUSED_NEWS_COLUMNS = ("Publisher", "Author", "Luhn_summary", "Textrank_summary", "Lexrank_summary")
NEWS_DATE_FORMAT = "yyyy-MM-dd HH:mm:ss z"
PRICE_DATE_FORMAT = "yyyy-MM-dd"


def drop_columns(news: DataFrame) -> DataFrame:
    return news.drop(*UNUSED_NEWS_COLUMNS)


def select_columns(news: DataFrame) -> DataFrame:
    """The scorer's input."""
    return news.select("No", "Lsa_summary")


def typed_prices(raw: DataFrame) -> DataFrame:
    """Dates, doubles and share counts; text that does not parse becomes NULL."""
    money = [nan_to_null(to_double_or_null(F.col(f"`{c}`"))).alias(c) for c in ("Open", "High", "Low", "Close", "Adj Close")]
    return raw.select(
        to_date_or_null(F.col("Date"), PRICE_DATE_FORMAT).alias("Date"),
        *money,
        to_int_or_null(F.col("Volume"), "bigint").alias("Volume"),
        *[c for c in ("Stock_symbol",) if c in raw.columns],
    )


def typed_news(raw: DataFrame) -> DataFrame:
    """Article number and day. The day is that of UTC, whatever the session's zone."""
    seconds = F.unix_seconds(F.try_to_timestamp(F.col("Date"), F.lit(NEWS_DATE_FORMAT)))
    return raw.withColumns({
        "No": to_int_or_null(F.col("No"), "bigint"),
        "Date": F.date_from_unix_date(F.floor(seconds / 86400).cast("int")),
    })


def in_universe(df: DataFrame, symbols: list[str]) -> DataFrame:
    return df.where(F.col("Stock_symbol").isin(symbols))


def semi_universe(df: DataFrame, universe: DataFrame) -> DataFrame:
    """Same filter for a universe held as a table of any size."""
    return df.join(universe.select("Stock_symbol"), "Stock_symbol", "left_semi")


def drop_any_null(df: DataFrame) -> DataFrame:
    return df.dropna()


def drop_null_subset(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)


def date_range(df: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Rows dated start .. end, both included; a missing bound is open."""
    if start is not None:
        df = df.where(F.col("Date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col("Date") <= F.lit(end).cast("date"))
    return df


def eq_filter(df: DataFrame, **values) -> DataFrame:
    for name, value in values.items():
        df = df.where(F.col(f"`{name}`") == value)
    return df
