"""Dimension tables that the user supplies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECTOR_SCHEMA = T.StructType([
    T.StructField("Stock_symbol", T.StringType(), False),
    T.StructField("category", T.StringType(), False),
])


def sector_dim(spark: SparkSession, sectors: Mapping[str, Sequence[str]]) -> DataFrame:
    """(symbol, category) rows of a mapping from sector to its symbols."""
    pairs = [(symbol, category) for category, symbols in sectors.items() for symbol in symbols]
    return spark.createDataFrame(pairs, SECTOR_SCHEMA)


def scan_sector_dim(spark: SparkSession, path: str) -> DataFrame:
    """(symbol, category) rows of a CSV with these two columns."""
    return spark.read.schema(SECTOR_SCHEMA).option("header", True).csv(path)


def universe_dim(df: DataFrame, symbol_col: str = "Stock_symbol") -> DataFrame:
    """Distinct non-empty symbols of any table that lists index members."""
    symbol = F.trim(F.col(symbol_col))
    return df.select(symbol.alias("Stock_symbol")).where(F.length("Stock_symbol") > 0).distinct()
