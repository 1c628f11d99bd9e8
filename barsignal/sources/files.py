"""CSV and Parquet scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsignal.functions.scalars import drop_name_suffix, symbol_from_path
from barsignal.sources.quoted_csv import scan_quoted_csv

# The columns of the raw files, in file order.
NEWS_COLUMNS = (
    "No", "Date", "Article_title", "Stock_symbol", "Url", "Publisher", "Author", "Article",
    "Lsa_summary", "Luhn_summary", "Textrank_summary", "Lexrank_summary",
)
PRICE_COLUMNS = ("Date", "Open", "High", "Low", "Close", "Adj Close", "Volume")

CSV_OPTIONS = {"escape": '"'}


def strings(names) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def file_name() -> Column:
    return F.col("_metadata.file_name")


def scan_news_csv(spark: SparkSession, path: str, split: bool = True) -> DataFrame:
    """News articles as twelve strings; quotes are doubled, texts span lines.

    Files are read in splits, one of any size by many tasks. ``split=False``
    is Spark's own multi-line scan, one task a file, with the same result.
    """
    if split:
        return scan_quoted_csv(spark, path, strings(NEWS_COLUMNS))
    return (
        spark.read.schema(strings(NEWS_COLUMNS))
        .options(header=True, multiLine=True, **CSV_OPTIONS)
        .csv(path)
    )


def scan_price_csv(spark: SparkSession, path: str) -> DataFrame:
    """One CSV per symbol, as strings, with the symbol from the file's name.

    The columns bind by position, because headers differ in case and spacing
    from file to file.
    """
    return (
        spark.read.schema(strings(PRICE_COLUMNS))
        .options(header=True, enforceSchema=True)
        .csv(path)
        .withColumn("Stock_symbol", symbol_from_path(file_name()))
    )


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan; partition folders become columns and prune the scan.

    Partition values such as ``1`` stay strings in a session set up by
    ``session.configure``, or with an explicit schema in any session.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def scan_sector_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All sector files of a folder at once; the sector is a column of each."""
    return spark.read.schema(schema).options(header=True, **CSV_OPTIONS).csv(path)


def sector_of_file(name: Column) -> Column:
    """Sector named by a file such as ``Technology_stocks_data.csv``."""
    return drop_name_suffix(name)


def strip_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])
