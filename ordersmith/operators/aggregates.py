"""Aggregations (A1-A20) that are not tied to one job.

All of them are ``groupBy``/``agg`` plans whose functions Spark combines
map-side (count, sum, min, max, count_if, min_by/max_by), so a hot group costs
one partial row per task before the shuffle.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# ------------------------------------------------------------------------ A1
def latest_per_group(df: DataFrame, group: str, value: str, alias: str = "latest") -> DataFrame:
    """A1: maximum of ``value`` per group (null groups and values ignored)."""
    return (df.filter(F.col(group).isNotNull() & F.col(value).isNotNull())
              .groupBy(group).agg(F.max(value).alias(alias)))


# ------------------------------------------------------------------------ A3
def key_statistics(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A3: rows, distinct keys, extra lines (rows - keys) and mean lines per key.

    Null key parts count as their own value (as the NO_* placeholders do)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    agg = per_key.agg(F.sum("__n").cast("bigint").alias("rows"),
                      F.count(F.lit(1)).cast("bigint").alias("orders"))
    return agg.select(
        F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"),
        F.col("orders"),
        (F.coalesce("rows", F.lit(0)) - F.col("orders")).cast("bigint").alias("extra_lines"),
        F.round(F.col("rows") / F.col("orders"), 4).alias("lines_per_order"),
    )


# ------------------------------------------------------------------------ A5
def date_extent(df: DataFrame, date_col: str) -> DataFrame:
    """A5: one row ``(min_date, max_date, dated_rows)`` over valid dates."""
    d = F.col(date_col)
    return df.agg(F.min(d).alias("min_date"), F.max(d).alias("max_date"),
                  F.count(d).cast("bigint").alias("dated_rows"))


# ------------------------------------------------------------------------ A8
def bin_label(x: Column, edges: Sequence[float]) -> Column:
    """Half-open bin ``[lo, hi)`` label as text ``'lo-hi'`` (``'lo+'`` for the
    open last bin); values outside all bins get null."""
    expr = None
    for lo, hi in zip(edges[:-1], edges[1:]):
        lo_t = f"{lo:g}"
        label = f"{lo_t}+" if hi == float("inf") else f"{lo_t}-{hi:g}"
        cond = (x >= F.lit(lo)) if hi == float("inf") else ((x >= F.lit(lo)) & (x < F.lit(hi)))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def bin_lower(x: Column, edges: Sequence[float]) -> Column:
    expr = None
    for lo, hi in zip(edges[:-1], edges[1:]):
        cond = (x >= F.lit(lo)) if hi == float("inf") else ((x >= F.lit(lo)) & (x < F.lit(hi)))
        expr = F.when(cond, F.lit(float(lo))) if expr is None else expr.when(cond, F.lit(float(lo)))
    return expr


# ------------------------------------------------------------------------ A10
def null_counts(df: DataFrame) -> DataFrame:
    """A10: ``(position, column_name, nulls)`` with one aggregation pass."""
    cols = df.columns
    # non-null counts are the cheapest per-column aggregate; nulls = rows - count
    agg = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(c)).alias(f"__c{i}") for i, c in enumerate(cols)])
    agg = agg.select(*[(F.col("__rows") - F.col(f"__c{i}")).alias(f"__n{i}") for i in range(len(cols))])
    stack = ", ".join(f"{i}, '{c}', __n{i}" for i, c in enumerate(cols))
    return agg.selectExpr(f"stack({len(cols)}, {stack}) as (position, column_name, nulls)") \
              .select(F.col("position").cast("int"), "column_name", F.col("nulls").cast("bigint"))


# ------------------------------------------------------------------------ A20
def value_class(c: Column | str) -> Column:
    """Class of a text value: blank, integer, decimal or text."""
    x = F.trim((F.col(c) if isinstance(c, str) else c).cast("string"))
    return (F.when(x.isNull() | (x == ""), "blank")
             .when(x.rlike(r"^-?[0-9]+$"), "integer")
             .when(x.rlike(r"^-?([0-9]+\.[0-9]*|\.[0-9]+)$"), "decimal")
             .otherwise("text"))


def value_class_frequency(df: DataFrame, column: str) -> DataFrame:
    """How many values of each class a column holds."""
    return df.groupBy(value_class(column).alias("value_class")).agg(F.count(F.lit(1)).alias("rows"))
