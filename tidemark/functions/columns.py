"""Column expressions. All stay inside generated code; none needs Python at run time."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: str | Column) -> Column:
    """A two-decimal amount as whole cents, so that sums are exact in any order."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return F.round(amount * 100).cast("long")


def square(number: str | Column) -> Column:
    """Widened first: the square of an INT need not fit an INT."""
    number = F.col(number) if isinstance(number, str) else number
    return number.cast("long") * number.cast("long")


def is_even(number: str | Column) -> Column:
    number = F.col(number) if isinstance(number, str) else number
    return number % 2 == 0


def window_start(ts: str | Column, size: int) -> Column:
    """Start of the epoch-aligned window of ``size`` that holds ``ts`` (whole numbers, any unit)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return ts - F.pmod(ts, F.lit(size).cast("long"))


def window_end(ts: str | Column, size: int) -> Column:
    return window_start(ts, size) + F.lit(size).cast("long")


def words(text: str | Column, separator: str = " ") -> Column:
    """Split on a literal separator; empty strings between separators are kept."""
    return F.split(text, re.escape(separator) if separator != " " else separator)


def order_key(order: Sequence[str]) -> Column:
    """One comparable value for an arrival order of one or more columns."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*[F.col(c) for c in order])
