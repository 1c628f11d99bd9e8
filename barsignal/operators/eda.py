"""Exploratory tables: counts, balance, correlation, histograms, quality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barsignal.functions.rolling import div
from barsignal.functions.scalars import percent
from barsignal.operators.comoments import co_moments
from barsignal.operators.features import FEATURE_GROUPS, FEATURES, MODEL_GROUPS
from barsignal.operators.quantiles import column_summaries, ranked_quantiles

NUMERIC = ("int", "bigint", "double", "float", "smallint", "tinyint")
QUARTILES = (0.25, 0.5, 0.75)
HISTOGRAM_BINS = 30
TOP_FEATURES = 6


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def sector_counts(df: DataFrame) -> DataFrame:
    """Rows per category, with the number of categories beside."""
    counts = df.groupBy("category").agg(F.count(F.lit(1)).alias("rows"))
    return counts.withColumn("categories", df.agg(F.countDistinct("category")).scalar())


def distinct_symbols(df: DataFrame) -> DataFrame:
    return df.agg(F.countDistinct("Stock_symbol").alias("symbols"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value and their share in percent, most frequent first."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = df.agg(F.count(F.lit(1))).scalar()  # a scalar of its own: the values never meet in one task
    return counts.withColumn("percent", div(F.col("count"), total) * 100).orderBy(F.desc("count"), column)


def label_by_symbol(df: DataFrame) -> DataFrame:
    """Share of each label within each symbol."""
    shares = [
        F.avg(F.when(F.col("Label").isNotNull(), (F.col("Label") == v).cast("double"))).alias(f"label_{v}")
        for v in (0, 1)
    ]
    return df.groupBy("Stock_symbol").agg(*shares)


def class_balance(df: DataFrame) -> DataFrame:
    """Rows, rows with a full label window, and the labels among those."""
    full = F.col("Up_Count_5d").isNotNull()
    label = F.col("Label")

    def count(cond: Column) -> Column:
        return F.coalesce(F.sum(cond.cast("long")), F.lit(0))

    return df.agg(
        F.count(F.lit(1)).alias("original_samples"),
        count(full).alias("after_filtering"),
        count(full & (label == 1)).alias("label_1"),
        count(full & (label == 0)).alias("label_0"),
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in NUMERIC]


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std, min, quartiles and max, one row per column."""
    columns = list(columns or numeric_columns(df))
    summaries, ranges = column_summaries(df, columns, QUARTILES)
    stats = ("column", "count", "mean", "std", "min", "max")
    base = df.sparkSession.createDataFrame(
        [tuple(row[c] for c in stats) for row in summaries], "column string, count bigint, mean double, std double, min double, max double"
    )
    quartiles = (
        ranked_quantiles(df, ranges)
        .groupBy(F.col("name").alias("column"))
        .agg(*[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(f"p{int(p * 100)}") for p in QUARTILES])
    )
    return base.join(quartiles, "column", "left").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def missing_values(df: DataFrame) -> DataFrame:
    """NULL count and percentage of every column."""
    cells = [
        F.struct(F.lit(c).alias("column"), F.sum(F.col(f"`{c}`").isNull().cast("long")).alias("missing"))
        for c in df.columns
    ]
    counts = df.agg(F.count(F.lit(1)).alias("n"), F.array(*cells).alias("s"))
    return counts.select("n", F.explode("s").alias("r")).select(
        "r.column", F.coalesce("r.missing", F.lit(0)).alias("missing"), percent(F.col("r.missing"), F.col("n")).alias("percent")
    )


def correlations(df: DataFrame, left: Sequence[str], right: Sequence[str], half: bool = False) -> DataFrame:
    """(x, y, corr) of every column of ``left`` with every one of ``right``.

    Pearson over the rows where both hold a value; NULL where there are none
    or either is constant there. ``half`` keeps the pairs on and above the
    diagonal.
    """
    names = [(i, j, x, y) for i, x in enumerate(left) for j, y in enumerate(right) if i <= j or not half]
    pairs = df.sparkSession.createDataFrame(names, "i int, j int, x string, y string")
    pearson = div(F.col("cxy"), F.sqrt("cxx") * F.sqrt("cyy"))
    return pairs.join(co_moments(df, left, right, half), ["i", "j"], "left").select("x", "y", pearson.alias("corr"))


def corr_matrix(df: DataFrame, columns: Sequence[str] = (*FEATURES, "Label")) -> DataFrame:
    """(x, y, corr) of the full matrix: each pair once, mirrored, and exactly 1
    with itself, NULL for a constant or empty column."""
    mirrored = F.array(F.struct("x", "y", "corr"), F.struct(F.col("y").alias("x"), F.col("x").alias("y"), "corr"))
    itself = F.array(F.struct("x", "y", F.when(F.col("corr").isNotNull(), 1.0).alias("corr")))
    half = correlations(df, columns, columns, half=True)
    return half.select(F.inline(F.when(F.col("x") == F.col("y"), itself).otherwise(mirrored)))


def corr_group(df: DataFrame, group: str) -> DataFrame:
    return corr_matrix(df, FEATURE_GROUPS[group])


def corr_with_label(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """(feature, corr), largest first, undefined ones last."""
    return (
        correlations(df.dropna(subset=["Label"]), features, ["Label"])
        .select(F.col("x").alias("feature"), "corr")
        .orderBy(F.desc_nulls_last("corr"), "feature")
    )


def corr_with_label_by_group(df: DataFrame) -> DataFrame:
    group = F.create_map(*[F.lit(v) for name, fs in MODEL_GROUPS.items() for f in fs for v in (f, name)])
    return corr_with_label(df).select(group[F.col("feature")].alias("feature_group"), "feature", "corr").orderBy(
        "feature_group", F.asc_nulls_last("corr"), "feature"
    )


def corr_top(df: DataFrame, rows: int = 10) -> DataFrame:
    return corr_with_label(df).limit(rows)


def corr_bottom(df: DataFrame, rows: int = 10) -> DataFrame:
    """The end of the descending list, in its order."""
    ranked = corr_with_label(df)
    last = ranked.orderBy(F.asc_nulls_first("corr"), F.desc("feature")).limit(rows)
    return last.orderBy(F.desc_nulls_last("corr"), "feature")


def top_abs_corr(df: DataFrame, rows: int = TOP_FEATURES) -> DataFrame:
    return corr_with_label(df).orderBy(F.desc_nulls_last(F.abs("corr")), "feature").limit(rows)


def histogram_by_label(df: DataFrame, features: Sequence[str] | None = None, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Rows in each of ``bins`` equal bins between a feature's own extremes
    under each label; the last bin is closed. A constant gets unit width.
    Without ``features`` the six of largest absolute correlation with the
    label are taken, found in the same plan."""
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("x")) for f in features or FEATURES])
    rows = df.select("Label", F.explode(cells).alias("c")).select("Label", "c.*").where("x IS NOT NULL AND Label IS NOT NULL")
    if features is None:
        rows = rows.join(F.broadcast(top_abs_corr(df).select("feature")), "feature", "left_semi")  # six rows
    keys = ["feature", "Label"]
    low, high = F.min("x"), F.max("x")
    edges = rows.groupBy(*keys).agg(
        F.when(low == high, low - 0.5).otherwise(low).alias("low"),
        F.when(low == high, high + 0.5).otherwise(high).alias("high"),
    )
    # One row per feature and label: broadcast.
    width = (F.col("high") - F.col("low")) / bins
    slot = F.least(F.floor((F.col("x") - F.col("low")) / width), F.lit(bins - 1)).cast("int")
    counts = (
        rows.join(F.broadcast(edges), keys)
        .groupBy(*keys, slot.alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    frame = edges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return frame.join(counts, [*keys, "bin"], "left").select(
        *keys, "bin", (F.col("low") + F.col("bin") * width).alias("bin_start"), F.coalesce("count", F.lit(0)).alias("count")
    )


def quality_summary(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    complete = F.lit(True)
    for f in features:
        complete = complete & F.col(f).isNotNull()
    labelled = F.col("Label").isNotNull()

    def count(cond: Column) -> Column:
        return F.coalesce(F.sum(cond.cast("long")), F.lit(0))

    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("Date").alias("first_date"),
        F.max("Date").alias("last_date"),
        F.countDistinct("Stock_symbol").alias("symbols"),
        count(complete).alias("complete_rows"),
        count(labelled).alias("labelled_rows"),
        count(complete & labelled).alias("model_ready_rows"),
    ).withColumns({
        "features": F.lit(len(features)),
        "completeness": percent(F.col("complete_rows"), F.col("rows")),
        "model_ready": percent(F.col("model_ready_rows"), F.col("rows")),
    })


def nth_frequent_symbol(df: DataFrame, position: int = 10) -> DataFrame:
    """All rows of the symbol at a 0-based place in the frequency ranking."""
    ranked = df.groupBy("Stock_symbol").count().orderBy(F.desc("count"), "Stock_symbol").limit(position + 1)
    place = F.row_number().over(Window.orderBy(F.desc("count"), "Stock_symbol"))  # of position + 1 rows
    chosen = ranked.withColumn("_place", place).where(F.col("_place") == position + 1).select("Stock_symbol")
    return df.join(chosen, "Stock_symbol", "left_semi")


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)
