"""Windows over a (symbol, date) panel in blocks of bounded size.

A window partitioned by symbol puts a symbol's whole history in one task, and
no more tasks can run than there are symbols. ``over_blocks`` cuts every
history into blocks of about ``block_rows`` rows and hands each block the rows
just before it (and after it) that its frames reach, so the result is the one
of the plain per-symbol window while the largest task stays small.

Blocks are unions of calendar months. Which months a block needs follows from
the number of rows per symbol and month, a small aggregate of two columns, so
the panel itself is shuffled once, on (symbol, block).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

SYMBOL = "Stock_symbol"
DATE = "Date"
TIE_COLUMNS = ("Open", "High", "Low", "Close", "Adj Close", "Volume")

# Block plus halo stay below the 4,096 rows that Spark's window operator keeps
# in memory before it spills (spark.sql.windowExec.buffer.in.memory.threshold).
BLOCK_ROWS = 2520

PanelFn = Callable[[DataFrame, WindowSpec], DataFrame]


def panel_order(df: DataFrame) -> list[Column]:
    """Date order, undated rows last; equal dates are ordered by their values."""
    ties = [c for c in TIE_COLUMNS if c in df.columns]
    return [F.col(DATE).asc_nulls_last(), *[F.col(f"`{c}`") for c in ties]]


def symbol_window(df: DataFrame, *extra: str) -> WindowSpec:
    return Window.partitionBy(SYMBOL, *extra).orderBy(*panel_order(df))


def _month() -> Column:
    return F.coalesce(F.trunc(F.col(DATE), "month"), F.lit("9999-12-01").cast("date"))


def _block_spans(df: DataFrame, back: int, ahead: int, block_rows: int) -> DataFrame:
    """Per (symbol, month): the block that owns it and all blocks that read it."""
    by_symbol = Window.partitionBy("_sym").orderBy("_month")
    months = (
        df.groupBy(F.col(SYMBOL).alias("_sym"), _month().alias("_month"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_end", F.sum("_n").over(by_symbol.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_home", F.floor((F.col("_end") - F.col("_n")) / block_rows))
    )
    readers = [F.array("_home")]
    if back:
        first, last = F.floor(F.col("_end") / block_rows), F.floor((F.col("_end") + (back - 1)) / block_rows)
        readers.append(F.sequence(first, last))
    if ahead:
        readers.append(F.collect_set("_home").over(by_symbol.rowsBetween(-ahead, -1)))
    last_block = F.max("_home").over(Window.partitionBy("_sym"))
    return months.select(
        "_sym",
        "_month",
        "_home",
        F.array_distinct(F.concat(*readers)).alias("_readers"),
        last_block.alias("_last"),
    )


def over_blocks(
    df: DataFrame,
    fn: PanelFn,
    back: int,
    ahead: int = 0,
    block_rows: int | None = BLOCK_ROWS,
) -> DataFrame:
    """Apply ``fn(df, w)``, whose frames reach ``back`` rows into the past and
    ``ahead`` into the future, block by block.

    ``w`` orders each window by date. ``block_rows=None`` keeps one window per
    symbol: one aggregate less, for panels of many short, even histories.
    """
    if block_rows is None:
        return fn(df, symbol_window(df))
    spans = _block_spans(df, back, ahead, block_rows)
    tagged = (
        df.withColumn("_m", _month())
        .join(spans, F.col(SYMBOL).eqNullSafe(F.col("_sym")) & (F.col("_m") == F.col("_month")))
        .withColumn("_block", F.explode("_readers"))
        .where(F.col("_block") <= F.col("_last"))
        .withColumn("_own", F.col("_block") == F.col("_home"))
        .drop("_sym", "_m", "_month", "_home", "_readers", "_last")
    )
    return fn(tagged, symbol_window(df, "_block")).where("_own").drop("_block", "_own")


def raw(name: str) -> Column:
    return F.col(f"`{name}`")


FILLED = "_filled_"


def filled_columns(df: DataFrame, columns: Sequence[str], fill: str) -> tuple[DataFrame, Callable[[str], Column]]:
    """A panel and the function that names the columns to take changes of.

    ``fill="none"`` gives the columns themselves; ``"ffill"`` adds copies in
    which a missing value is the symbol's last known one.
    """
    if fill == "none":
        return df, raw
    if fill != "ffill":
        raise ValueError(f"unknown fill {fill!r}")
    return forward_fill(df, {c: FILLED + c for c in columns}), lambda name: raw(FILLED + name)


def drop_filled(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(FILLED)])


def forward_fill(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Copies, named by the mapping's values, with gaps filled per symbol.

    A gap may be of any length, so no halo covers it: each month's last known
    values are carried over the months, and the rows of a month, which are one
    window, fall back on what was carried into it.
    """
    place = F.struct(DATE, *[raw(c) for c in TIE_COLUMNS if c in df.columns])
    by_symbol = Window.partitionBy("_sym").orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    months = df.groupBy(F.col(SYMBOL).alias("_sym"), _month().alias("_month")).agg(
        *[F.max_by(raw(c), F.when(raw(c).isNotNull(), place)).alias(f"_last_{c}") for c in columns]
    )
    carried = months.select(
        "_sym", "_month", *[F.last(f"_last_{c}", ignorenulls=True).over(by_symbol).alias(f"_carry_{c}") for c in columns]
    )
    in_month = (
        Window.partitionBy(SYMBOL, "_m").orderBy(*panel_order(df)).rowsBetween(Window.unboundedPreceding, 0)
    )
    joined = df.withColumn("_m", _month()).join(
        carried, F.col(SYMBOL).eqNullSafe(F.col("_sym")) & (F.col("_m") == F.col("_month"))
    )
    filled = joined.withColumns({
        target: F.coalesce(F.last(raw(c), ignorenulls=True).over(in_month), F.col(f"`_carry_{c}`"))
        for c, target in columns.items()
    })
    return filled.drop("_m", "_sym", "_month", *[f"_carry_{c}" for c in columns])


def panel_sort(df: DataFrame) -> DataFrame:
    """The panel in (symbol, date) order, for output only."""
    return df.orderBy(SYMBOL, *panel_order(df))
