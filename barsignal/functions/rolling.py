"""Column helpers for per-symbol series: safe division, changes, full windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def div(num: Column, den: Column) -> Column:
    """Quotient that is NULL, never an error or an infinity, on a zero divisor."""
    return F.try_divide(num, den)


def nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def change(x: Column, rows: int, w: WindowSpec) -> Column:
    """Fractional change against the value ``rows`` rows earlier."""
    return div(x, F.lag(x, rows).over(w)) - 1


def roll(fn: Callable[[Column], Column], x: Column, rows: int, w: WindowSpec) -> Column:
    """``fn`` over the last ``rows`` rows, NULL unless all of them hold a value."""
    frame = w.rowsBetween(1 - rows, 0)
    return F.when(F.count(x).over(frame) == rows, fn(x).over(frame))
