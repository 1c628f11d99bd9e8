"""Rolling z-scores at constant cost per row.

Spark evaluates a sliding frame row by row, so a 252-row frame costs 252
updates per row and column. Here every run of ``window`` rows is cut into
chunks of the same length; a frame is then the tail of one chunk plus the head
of the next. Heads and tails are running aggregates, and their counts, means
and variances merge exactly, with no subtraction that could lose digits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from barsignal.functions.rolling import roll
from barsignal.operators.features import FEATURES
from barsignal.operators.panel import BLOCK_ROWS, SYMBOL, over_blocks

EPSILON = 1e-8  # added to the deviation, so a constant window scores 0
WINDOW_DAYS = 252


def zscores_on(df: DataFrame, w: WindowSpec, features: Sequence[str], window: int) -> DataFrame:
    keys = [c for c in (SYMBOL, "_block") if c in df.columns]
    rest = [c for c in df.columns if c not in (*keys, *features)]
    by = ", ".join(keys)
    heads = f"OVER (PARTITION BY {by}, _chunk ORDER BY _pos ROWS UNBOUNDED PRECEDING)"
    tails = f"OVER (PARTITION BY {by}, _chunk ORDER BY _pos DESC ROWS UNBOUNDED PRECEDING)"
    # Same order as by _pos alone, and the one that the heads are sorted in.
    in_order = f"OVER (PARTITION BY {by} ORDER BY _chunk, _pos)"

    def moments(f: str, over: str, rows: str) -> list[str]:
        # The mean is NULL unless every row so far holds a value.
        return [f"CASE WHEN count({f}) {over} = {rows} THEN avg({f}) {over} END AS _mean_{f}", f"var_pop({f}) {over} AS _var_{f}"]

    def all_moments(over: str, rows: str) -> list[str]:
        return [e for f in features for e in moments(f, over, rows)]

    def score(f: str) -> str:
        n, m, tail = "_head", f"({window} - _head)", f"_tail._mean_{f}"
        mean = f"IF(_head = {window}, _mean_{f}, ({n} * _mean_{f} + {m} * {tail}) / {window})"
        step = f"(_mean_{f} - {tail})"
        m2 = f"IF(_head = {window}, 0, {m} * _tail._var_{f} + {step} * {step} * {n} * {m} / {window}) + {n} * _var_{f}"
        return f"({f} - {mean}) / (sqrt(({m2}) / {window - 1}) + {EPSILON}D) AS {f}_z"

    # The columns that only pass through, and the tails' moments, travel as
    # one struct each: every window copies its rows column by column.
    carried = [*keys, "_rest", *features, "_pos", "_chunk", "_head"]
    tail = ", ".join(f"_mean_{f}, _var_{f}" for f in features)
    whole_row = [f"_rest.`{c}`" if c in rest else c for c in df.columns]
    return (
        df.withColumn("_pos", F.row_number().over(w) - 1)
        .withColumn("_rest", F.struct(*[f"`{c}`" for c in rest]))
        .selectExpr(*keys, "_rest", *features, "_pos", f"_pos div {window} AS _chunk", f"_pos % {window} + 1 AS _head")
        .selectExpr(*carried, *all_moments(tails, f"({window + 1} - _head)"))
        .selectExpr(*carried, f"struct({tail}) AS _tail")
        .selectExpr(*carried, f"lag(_tail, {window - 1}) {in_order} AS _tail")
        .selectExpr(*carried, "_tail", *all_moments(heads, "_head"))
        .selectExpr(*whole_row, *[score(f) for f in features])
    )


def zscores_sliding_on(df: DataFrame, w: WindowSpec, features: Sequence[str], window: int) -> DataFrame:
    """The definition itself; the cost per row grows with the window."""
    return df.withColumns({
        f"{f}_z": (F.col(f) - roll(F.avg, F.col(f), window, w))
        / (roll(F.stddev_samp, F.col(f), window, w) + EPSILON)
        for f in features
    })


METHODS = {"chunked": zscores_on, "sliding": zscores_sliding_on}


def normalize_features(
    df: DataFrame,
    features: Sequence[str] = FEATURES,
    window: int = WINDOW_DAYS,
    method: str = "chunked",
    block_rows: int | None = BLOCK_ROWS,
) -> DataFrame:
    """Add ``<feature>_z`` for each feature; NULL until ``window`` values exist."""
    return over_blocks(
        df,
        lambda d, w: METHODS[method](d, w, features, window),
        back=window - 1,
        block_rows=block_rows,
    )
