"""Walk-forward folds over the distinct dates of each sector."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRAIN_DAYS = 252
TEST_DAYS = 21
BY = ("category",)


def sorted_dates(df: DataFrame) -> DataFrame:
    return df.select("Date").distinct().orderBy("Date")


def date_index(df: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Position ``i`` of each date among the ``n`` distinct dates of its sector.

    The window runs over distinct dates, so its size is bounded by the length
    of the calendar and not by the rows of a sector.
    """
    by_group = Window.partitionBy(*by)
    return (
        df.select(*by, "Date")
        .distinct()
        .withColumn("i", F.row_number().over(by_group.orderBy("Date")) - 1)
        .withColumn("n", F.count(F.lit(1)).over(by_group))
    )


def _fold_roles(train_days: int, test_days: int) -> Column:
    """All (fold, role) pairs of date ``i`` of ``n``, from arithmetic alone."""
    i, last = F.col("i"), F.ceil((F.col("n") - train_days) / test_days) - 1
    first_train = F.greatest(F.lit(0), F.ceil((i - train_days + 1) / test_days))
    last_train = F.least(F.floor(i / test_days), last)
    trains = F.when(
        first_train <= last_train,
        F.transform(
            F.sequence(first_train, last_train),
            lambda k: F.struct(k.cast("int").alias("fold"), F.lit("train").alias("role")),
        ),
    )
    test = F.struct(F.floor((i - train_days) / test_days).cast("int").alias("fold"), F.lit("test").alias("role"))
    tests = F.when(i >= train_days, F.array(test))
    nothing = F.array().cast("array<struct<fold:int,role:string>>")
    return F.concat(F.coalesce(trains, nothing), F.coalesce(tests, nothing))


def date_roles(
    df: DataFrame, train_days: int = TRAIN_DAYS, test_days: int = TEST_DAYS, by: Sequence[str] = BY
) -> DataFrame:
    """(sector, date, fold, role): which folds train or test on which date."""
    return (
        date_index(df, by)
        .select(*by, "Date", F.explode(_fold_roles(train_days, test_days)).alias("_f"))
        .select(*by, "Date", "_f.fold", "_f.role")
    )


def fold_table(
    df: DataFrame, train_days: int = TRAIN_DAYS, test_days: int = TEST_DAYS, by: Sequence[str] = BY
) -> DataFrame:
    """First and last train and test date of every fold."""
    roles = date_roles(df, train_days, test_days, by)

    def edge(fn, role: str) -> Column:
        return fn(F.when(F.col("role") == role, F.col("Date"))).alias(f"{role}_{'start' if fn is F.min else 'end'}")

    return roles.groupBy(*by, "fold").agg(*[edge(fn, role) for role in ("train", "test") for fn in (F.min, F.max)])


def assign_folds(
    df: DataFrame,
    train_days: int = TRAIN_DAYS,
    test_days: int = TEST_DAYS,
    by: Sequence[str] = BY,
    role: str | None = None,
) -> DataFrame:
    """Rows with each fold and role of their date, by an equality join.

    With the default lengths a row trains up to twelve folds and tests one;
    ask for ``role="test"`` where only the tests are needed.
    """
    roles = date_roles(df, train_days, test_days, by)
    if role is not None:
        roles = roles.where(F.col("role") == role)
    return df.join(roles, [*by, "Date"])


def fold_slice(df: DataFrame, start, end) -> DataFrame:
    """Rows dated start .. end, both included."""
    return df.where(F.col("Date").between(F.lit(start), F.lit(end)))


def fold_counts(
    df: DataFrame, train_days: int = TRAIN_DAYS, test_days: int = TEST_DAYS, by: Sequence[str] = BY
) -> DataFrame:
    """n_train and n_test per fold, from row counts per date: the rows
    themselves are never repeated."""
    per_date = df.groupBy(*by, "Date").agg(F.count(F.lit(1)).alias("_n"))
    roles = date_roles(df, train_days, test_days, by)
    return (
        roles.join(per_date, [*by, "Date"])
        .groupBy(*by, "fold")
        .agg(*[F.sum(F.when(F.col("role") == r, F.col("_n")).otherwise(0)).alias(f"n_{r}") for r in ("train", "test")])
    )


def match_model(periods: DataFrame, registry: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """The saved model for each test period, NULL where there is none.

    A model of exactly the same test period wins, then the one sharing most
    days; periods that share a single day share no time. Equal overlaps go to
    the earlier period. Periods meet on the months they cover, so the join is
    an equality join and compares neighbours only.
    """
    keys = [*by, "test_start", "test_end"]

    def months(df: DataFrame) -> DataFrame:
        first, last = F.trunc("test_start", "month"), F.trunc("test_end", "month")
        return df.withColumn("_month", F.explode(F.sequence(first, last, F.expr("interval 1 month"))))

    models = months(registry).withColumnsRenamed({"test_start": "model_test_start", "test_end": "model_test_end"})
    days = F.datediff(
        F.least("test_end", "model_test_end"), F.greatest("test_start", "model_test_start")
    )
    exact = (F.col("test_start") == F.col("model_test_start")) & (F.col("test_end") == F.col("model_test_end"))
    candidate = F.struct(
        (~exact).alias("inexact"),
        (-days).alias("minus_days"),
        F.col("model_test_start"),
        F.col("model_test_end"),
        F.col("model_path"),
    )
    best = (
        months(periods.select(*keys).distinct())
        .join(models.select(*by, "_month", "model_test_start", "model_test_end", "model_path"), [*by, "_month"])
        .where(exact | (days > 0))
        .groupBy(*keys)
        .agg(F.min(candidate).alias("_m"))
        .select(
            *keys,
            F.col("_m.model_path").alias("model_path"),
            F.col("_m.model_test_start").alias("model_test_start"),
            F.col("_m.model_test_end").alias("model_test_end"),
            (~F.col("_m.inexact")).alias("exact_match"),
        )
    )
    return periods.join(best, keys, "left")


def distinct_months(df: DataFrame) -> DataFrame:
    return df.select(F.trunc("Date", "month").alias("month")).distinct().orderBy("month")


def sector_skip(df: DataFrame, train_days: int = TRAIN_DAYS, test_days: int = TEST_DAYS) -> DataFrame:
    """Folds of every sector, and whether it is kept or skipped for having none."""
    per_sector = fold_table(df, train_days, test_days).groupBy("category").agg(F.count(F.lit(1)).alias("folds"))
    return df.select("category").distinct().join(per_sector, "category", "left").select(
        "category",
        F.coalesce("folds", F.lit(0)).alias("folds"),
        F.when(F.col("folds").isNull(), "skipped").otherwise("kept").alias("status"),
    )
