"""Row filters and predicates.

All predicates are Catalyst expressions, so on Parquet input the simple ones
(ranges, null checks, membership) are pushed into the scan.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordersmith.functions import scalars as X


def _col(c):
    return F.col(c) if isinstance(c, str) else c


# ------------------------------------------------------------------------ F1
def member_of(c, values: Iterable[str]) -> Column:
    """Membership that is never null: a null value is simply not a member."""
    return F.coalesce(_col(c).isin(list(values)), F.lit(False))


def split_by_membership(df: DataFrame, column: str, values: Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """(members, the rest).  The two halves partition the input; rows with a
    null value go to the rest (a bare ``~isin`` would drop them)."""
    vals = list(values)
    inside = member_of(column, vals)
    return df.filter(inside), df.filter(~inside)


# ------------------------------------------------------------------ F2 / F3
def non_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """rows where every listed column is not null."""
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def non_blank(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """rows where every listed column is neither null nor empty text."""
    cond = F.lit(True)
    for c in columns:
        cond = cond & (F.coalesce(F.col(c).cast("string"), F.lit("")) != "")
    return df.filter(cond)


# ------------------------------------------------------------------ F4 / F5
def in_date_range(c, start, end) -> Column:
    """inclusive range on a date; null dates are outside."""
    return _col(c).between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def last_n_days(c, as_of, days: int = 30) -> Column:
    """``as_of - (days-1) <= c <= as_of``: the last ``days`` days including ``as_of``."""
    end = F.lit(as_of).cast("date") if not isinstance(as_of, Column) else as_of.cast("date")
    return _col(c).between(F.date_sub(end, days - 1), end)


# ------------------------------------------------------------------------ F6
def unparsable_dates(df: DataFrame, column: str, keep: Sequence[str] = ("order_sn",)) -> DataFrame:
    """rows whose date text does not parse (null included), with the raw value."""
    return (df.filter(X.to_date_tolerant(column).isNull())
              .select(*keep, F.col(column).cast("string").alias(column)))
