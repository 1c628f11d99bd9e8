"""Prices, news, sectors and predictions derived from the driver's tables."""

from __future__ import annotations

import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsignal.functions.scalars import argmax_article


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts are the small side of a partition: hashed, the lines need no sort."""
    return table(spark, sf_dir, "part").hint("shuffle_hash")


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per part brand: first, highest, lowest and last line price."""
    items = table(spark, sf_dir, "lineitem").join(_parts(spark, sf_dir), F.col("l_partkey") == F.col("p_partkey"))
    line = F.struct("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_quantity")
    return (
        items.groupBy(F.col("l_shipdate").cast("date").alias("Date"), F.col("p_brand").alias("Stock_symbol"))
        .agg(
            F.min(line).alias("first"),
            F.max("l_extendedprice").alias("High"),
            F.min("l_extendedprice").alias("Low"),
            F.max(line).alias("last"),
            F.sum("l_quantity").cast("bigint").alias("Volume"),
        )
        .select(
            "Date",
            F.col("first.l_extendedprice").alias("Open"),
            "High",
            "Low",
            F.col("last.l_extendedprice").alias("Close"),
            (F.col("last.l_extendedprice") * (1 - F.col("last.l_discount"))).alias("Adj Close"),
            "Volume",
            "Stock_symbol",
        )
    )


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One article per order, order day and brand."""
    lines = table(spark, sf_dir, "lineitem").join(_parts(spark, sf_dir), F.col("l_partkey") == F.col("p_partkey"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("No"), F.col("o_orderdate").cast("date").alias("Date"))
    # Orders are hashed as well, and joined last: the distinct rows of an order
    # are found where it was joined, without a third shuffle of the lines.
    return (
        orders.hint("shuffle_hash")
        .join(lines.select("l_orderkey", F.col("p_brand").alias("Stock_symbol")), F.col("No") == F.col("l_orderkey"))
        .select("No", "Date", "Stock_symbol")
        .distinct()
    )


def article_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three probabilities per article number, in exact 128ths."""
    a = ((F.col("No") * 37 + 11) % 65).cast("double")
    b = ((F.col("No") * 53 + 7) % 64).cast("double")
    # The keys of the lines are hashed, each once however often it comes.
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey").hint("shuffle_hash")
    scored = (
        table(spark, sf_dir, "orders")
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
        .select(F.col("o_orderkey").alias("No"))
        .distinct()
    )
    return scored.select(
        "No", (b / 128).alias("negative"), ((128 - a - b) / 128).alias("neutral"), (a / 128).alias("positive")
    ).withColumn("predicted_sentiment", argmax_article([F.col("negative"), F.col("neutral"), F.col("positive")]))


def sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sector of 21 of the 25 brands; the others have none."""
    digit = F.substring("p_brand", 7, 8).cast("int") % 6
    return (
        table(spark, sf_dir, "part")
        .where(digit != 5)
        .select(F.col("p_brand").alias("Stock_symbol"), F.concat(F.lit("Sector_"), digit.cast("string")).alias("category"))
        .distinct()
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tied synthetic scores per event, in eight folds."""
    return table(spark, sf_dir, "events").select(
        (F.col("event_id") % 8).cast("int").alias("fold"),
        F.col("ts").cast("date").alias("Date"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("Stock_symbol"),
        F.col("event_type").isin("purchase", "signup").cast("int").alias("y_test"),
        (((F.col("event_id") * 29) % 97 + 1).cast("double") / 98).alias("y_prob"),
    )


def raw_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as raw articles: strings only, with some values that do not
    parse and some that are missing."""
    no = F.col("doc_id").cast("string")
    day = F.date_format(F.date_add(F.lit("1995-01-01").cast("date"), (F.col("doc_id") % 2000).cast("int")), "yyyy-MM-dd")
    symbol = F.concat(
        F.lit("Brand#"), (F.col("doc_id") % 6 + 1).cast("string"), (F.floor(F.col("doc_id") / 6) % 6 + 1).cast("string")
    )
    return table(spark, sf_dir, "documents").select(
        F.when(F.col("doc_id") % 11 == 0, F.concat(no, F.lit(".0"))).when(F.col("doc_id") % 13 == 0, "n/a").otherwise(no).alias("No"),
        F.when(F.col("doc_id") % 17 == 0, "yesterday").otherwise(F.concat(day, F.lit(" 23:30:00 UTC"))).alias("Date"),
        F.concat(F.lit('Note "'), no, F.lit('", '), F.col("lang")).alias("Article_title"),
        symbol.alias("Stock_symbol"),
        F.when(F.col("doc_id") % 7 != 0, F.concat(F.lit("https://news.example/"), no)).alias("Url"),
        F.col("source").alias("Publisher"),
        F.col("lang").alias("Author"),
        F.col("text").alias("Article"),
        F.col("text").alias("Lsa_summary"),
        F.col("lang").alias("Luhn_summary"),
        F.col("lang").alias("Textrank_summary"),
        F.col("lang").alias("Lexrank_summary"),
    )


def stray_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as CSV records, one string each, that carry quotes of every kind; some lines end in CRLF."""
    kind = F.col("doc_id") % 4
    field = (
        F.when(kind == 0, F.lit('plain "stray" quote')).when(kind == 1, F.lit('"closed"tail'))
        .when(kind == 2, F.lit('odd " one')).otherwise(F.lit('"a ""b"", c"'))
    )
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    end = F.when(kind == 2, F.lit("\r")).otherwise(F.lit(""))
    return table(spark, sf_dir, "documents").where("text IS NOT NULL").select(
        F.concat(F.col("doc_id").cast("string"), F.lit(","), field, F.lit(","), quoted, F.lit(","), F.col("source"), end).alias("value")
    )


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars as strings; the open of some is no number."""
    bars = prices(spark, sf_dir)
    text = bars.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in bars.columns])
    return text.withColumn("Open", F.when(F.dayofmonth("Date") == 13, "null").otherwise(F.col("Open")))


def write_price_archives(bars: DataFrame, folder: str) -> None:
    """Bars as CSV members of ZIP archives, one archive per batch of rows."""
    columns = [c for c in bars.columns if c != "Stock_symbol"]

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = pyarrow.fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        for batch in batches:
            with fs.open_output_stream(f"{root}/{uuid.uuid4().hex}.zip") as out, zipfile.ZipFile(out, "w") as z:
                for symbol, rows in batch.groupby("Stock_symbol"):
                    z.writestr(f"history/{symbol.lower()}.csv", rows[columns].to_csv(index=False))
                    z.writestr(f"__MACOSX/history/{symbol.lower()}.csv", "junk")
                z.writestr("history/readme.txt", "junk")
            yield pd.DataFrame({"rows": [len(batch)]})

    fs, root = pyarrow.fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
    fs.create_dir(root, recursive=True)
    bars.mapInPandas(write, "rows long").agg(F.sum("rows")).collect()
