"""Parquet and CSV writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsignal.session import materialize, remove



def _together(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of a key in as few tasks as their size allows.

    Rebalancing lets adaptive execution split a key that is too large for one
    task and merge small ones, so a partition's folder gets few files but no
    task gets a whole hot key.
    """
    return df.hint("rebalance", *keys)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_partitioned(df: DataFrame, path: str, key: str) -> None:
    """One folder per key."""
    _together(df, key).write.mode("overwrite").option("compression", "snappy").partitionBy(key).parquet(path)


def write_by_symbol(df: DataFrame, path: str) -> None:
    write_partitioned(df, path, "Stock_symbol")


def write_by_sector(df: DataFrame, path: str) -> None:
    write_partitioned(df, path, "category")


def write_model_set(df: DataFrame, path: str) -> None:
    """The model set in (sector, date) order over all files, so that a fold's
    sector and date range skips most files and row groups.

    Range partitioning samples its input first; the rows are written before
    it, so that their windows are computed once.
    """
    keys = ["category", "Date", "Stock_symbol"]
    staged = materialize(df, "model_set_staged")
    ordered = staged.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered.write.mode("overwrite").option("compression", "snappy").parquet(path)
    remove(staged)


def export_sector_csv(df: DataFrame, path: str) -> None:
    """One folder of CSV per sector in a single pass; ``category`` stays a column."""
    copied = _together(df, "category").withColumn("sector", F.col("category"))
    copied.write.mode("overwrite").option("header", True).option("escape", '"').partitionBy("sector").csv(path)


def export_results_csv(results: DataFrame, path: str) -> None:
    """Fold results as a single CSV with ISO dates: one row per sector and fold."""
    dates = [c for c, t in results.dtypes if t == "date"]
    text = results.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in dates})
    text.repartition(1).write.mode("overwrite").option("header", True).csv(path)
