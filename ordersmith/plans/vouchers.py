"""Voucher usage analysis (Q13).

Steps, in the reference's order: keep the first line of each order number,
then keep orders dated in ``[start, end]``, then analyse each voucher column.
The columns are unpivoted into one long table so every statistic is one
aggregation grouped by the column name.
"""

from __future__ import annotations

from functools import cached_property
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordersmith.functions import scalars as X
from ordersmith.operators.aggregates import bin_label, bin_lower
from ordersmith.operators.filters import in_date_range
from ordersmith.operators.windows import first_per_key
from ordersmith.plans.marts import numbered
from ordersmith.schema import VOUCHER_BIN_EDGES
from ordersmith.session import checkpoint_dir

VOUCHER_COLUMNS = ["seller_voucher", "voucher"]


def voucher_orders(df: DataFrame, start: str, end: str, order_col: str = "row_no") -> DataFrame:
    """W1 then F4: first line per order number, then the date range."""
    firsts = first_per_key(numbered(df), ["order_sn"], [order_col])
    return firsts.filter(in_date_range("order_date", start, end))


def voucher_long(orders: DataFrame, columns: Sequence[str] = VOUCHER_COLUMNS) -> DataFrame:
    """One row per (order, voucher column): raw text (blank / null tokens as
    null) and its numeric value."""
    long = orders.select("order_sn", *columns).unpivot(
        ["order_sn"], list(columns), "voucher_column", "raw")
    raw = X.blank_to_null(X.null_tokens_to(F.col("raw").cast("string"), None))
    return long.withColumn("raw", raw).withColumn("amount", X.to_number("raw"))


class VoucherUsage:
    """Q13 outputs, each built on first access (A6 classes, A7 used_stats,
    A8 histogram, L4 top_values, F8 invalid_values, A9 summary, A17 steps)."""

    def __init__(self, df: DataFrame, start: str, end: str, columns: Sequence[str] = VOUCHER_COLUMNS,
                 order_col: str = "row_no"):
        self.df, self.start, self.end, self.columns, self.order_col = df, start, end, list(columns), order_col

    @cached_property
    def long(self) -> DataFrame:
        return voucher_long(voucher_orders(self.df, self.start, self.end, self.order_col), self.columns)

    @cached_property
    def classes(self) -> DataFrame:
        amt, total = F.col("amount"), F.count(F.lit(1))
        c = self.long.groupBy("voucher_column").agg(
            total.cast("bigint").alias("orders"),
            F.count_if(amt > 0).cast("bigint").alias("used"),
            F.count_if(amt == 0).cast("bigint").alias("unused"),
            F.count_if(amt.isNull()).cast("bigint").alias("null_or_invalid"))
        return c.select("*", *[X.pct(k, "orders", 4).alias(f"{k}_pct") for k in ["used", "unused", "null_or_invalid"]])

    @cached_property
    def used_stats(self) -> DataFrame:
        amt = F.col("amount")
        used = self.long.filter(amt > 0)
        stats = used.groupBy("voucher_column").agg(
            F.min(amt).alias("min_amount"), F.max(amt).alias("max_amount"),
            F.round(F.avg(amt), 4).alias("mean_amount"), F.round(F.sum(amt), 4).alias("total_amount"))
        return stats.join(grouped_median(used, "voucher_column", "amount", "m"), "voucher_column").select(
            "voucher_column", "min_amount", "max_amount", "mean_amount", F.round("m", 4).alias("median_amount"),
            "total_amount")

    @cached_property
    def histogram(self) -> DataFrame:
        amt, total = F.col("amount"), F.count(F.lit(1))
        used = self.long.filter(amt > 0)
        per_bin = used.groupBy("voucher_column", bin_lower(amt, VOUCHER_BIN_EDGES).alias("bin_lower"),
                               bin_label(amt, VOUCHER_BIN_EDGES).alias("bin")).agg(total.cast("bigint").alias("orders"))
        w = Window.partitionBy("voucher_column")
        return per_bin.select("voucher_column", "bin", "bin_lower", "orders",
                              X.pct("orders", F.sum("orders").over(w), 4).alias("pct"))

    @cached_property
    def value_counts(self) -> DataFrame:
        return (self.long.filter(F.col("raw").isNotNull()).groupBy("voucher_column", "raw")
                .agg(F.count(F.lit(1)).cast("bigint").alias("orders")))

    @cached_property
    def top_values(self) -> DataFrame:
        return top_per_column(self.value_counts, 10)

    @cached_property
    def invalid_values(self) -> DataFrame:
        return (self.long.filter(F.col("raw").isNotNull() & F.col("amount").isNull())
                .groupBy("voucher_column", "raw").agg(F.count(F.lit(1)).cast("bigint").alias("orders")))

    @cached_property
    def summary(self) -> DataFrame:
        amt, total = F.col("amount"), F.count(F.lit(1))
        return self.long.groupBy("voucher_column").agg(
            F.count_if(amt > 0).cast("bigint").alias("used"),
            X.pct(F.count_if(amt > 0), total, 4).alias("usage_rate_pct"),
            F.round(F.avg(F.when(amt > 0, amt)), 2).alias("mean_used_amount"))

    @cached_property
    def steps(self) -> DataFrame:
        return step_counts(self.df, self.start, self.end, self.order_col)


#: Rows between the bounds of a median that are ordered; while there are more, the bounds are drawn closer.
MEDIAN_ROWS = 100_000
_STEPS, _ACCURACY = 200, 2000       # splitters of a sketch, and its accuracy: ranks are off by 1 / 2000 at most


def median_bounds(rows: DataFrame, group: str, value: str, most: int = MEDIAN_ROWS) -> DataFrame:
    """Per group: ``lo`` and ``hi`` around its middle ranks, rows ``below`` lo, ``inside`` and ``total``.

    A quantile sketch, which tasks make and merge, gives splitters; the rows
    between the two around the middle are counted exactly and become the next
    sketch's input until at most ``most`` are left or all are equal. So each
    pass leaves about a hundredth of the rows, however they are spread. One
    number a round comes to the driver."""
    state = rows.groupBy(group).agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.lit(0).cast("long").alias("below"),
                                    F.count(F.lit(1)).alias("inside"), F.count(F.lit(1)).alias("total")).checkpoint()
    steps = F.lit([i / _STEPS for i in range(_STEPS + 1)])
    inside = F.col(value).between(F.col("lo"), F.col("hi"))
    slack = F.lit(2.0 / _ACCURACY)
    while True:
        wide = state.filter((F.col("inside") > most) & (F.col("lo") < F.col("hi")))
        if wide.isEmpty():
            return state
        sketch = rows.join(wide, group).filter(inside).groupBy(group).agg(F.percentile_approx(value, steps, _ACCURACY).alias("s"))
        place = lambda rank: (rank - F.col("below")) / F.col("inside")
        first = F.greatest(F.floor((place(F.floor((F.col("total") + 1) / 2)) - slack) * _STEPS), F.lit(0)).cast("int")
        last = F.least(F.ceil((place(F.floor(F.col("total") / 2) + 1) + slack) * _STEPS), F.lit(_STEPS)).cast("int")
        closer = wide.join(sketch, group).select(
            group, F.col("lo").alias("lo0"), F.col("hi").alias("hi0"), "below", "total",
            F.when(first > 0, F.element_at("s", first + 1)).otherwise(F.col("lo")).alias("lo"),
            F.when(last < _STEPS, F.element_at("s", last + 1)).otherwise(F.col("hi")).alias("hi")).checkpoint()
        counts = rows.join(closer.select(group, "lo", "hi", "lo0", "hi0"), group).filter(
            F.col(value).between(F.col("lo0"), F.col("hi0"))).groupBy(group).agg(
            F.count_if(F.col(value) < F.col("lo")).alias("more"), F.count_if(inside).alias("inside"))
        drawn = closer.join(counts, group).select(group, "lo", "hi", (F.col("below") + F.col("more")).alias("below"), "inside",
                                                  "total", ((F.col("lo") > F.col("lo0")) | (F.col("hi") < F.col("hi0"))).alias("moved"))
        drawn = drawn.checkpoint()
        if drawn.filter("moved").isEmpty():
            return state                                  # few values, each on very many rows
        state = state.join(drawn.select(group), group, "left_anti").unionByName(drawn.drop("moved")).checkpoint()


def grouped_median(df: DataFrame, group: str, value: str, alias: str, most: int = MEDIAN_ROWS) -> DataFrame:
    """Exact median of ``value`` per group (null groups and values ignored) without ordering a group in one task.

    The rows are written to the checkpoint folder once; only those between the
    bounds of ``median_bounds`` are ordered, equal ones as one."""
    checkpoint_dir(df.sparkSession)
    rows = df.filter(F.col(value).isNotNull() & F.col(group).isNotNull()).select(group, value).checkpoint()
    bounds = median_bounds(rows, group, value, most)
    counts = (rows.join(bounds, group).filter(F.col(value).between(F.col("lo"), F.col("hi")))
              .groupBy(group, value, "below", "total").agg(F.count(F.lit(1)).alias("__n")))
    w = Window.partitionBy(group).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = counts.withColumn("__upto", F.col("below") + F.sum("__n").over(w))
    rank = F.explode(F.array_distinct(F.array(F.floor((F.col("total") + 1) / 2), F.floor(F.col("total") / 2) + 1)))
    at = upto.withColumn("__rank", rank).filter(
        (F.col("__rank") <= F.col("__upto")) & (F.col("__rank") > F.col("__upto") - F.col("__n")))
    return at.groupBy(group).agg(F.avg(value).alias(alias))


def voucher_usage(df: DataFrame, start: str, end: str, columns: Sequence[str] = VOUCHER_COLUMNS,
                  order_col: str = "row_no") -> VoucherUsage:
    """Q13: voucher analysis of the orders dated in ``[start, end]``."""
    return VoucherUsage(df, start, end, columns, order_col)


def step_counts(df: DataFrame, start: str, end: str, order_col: str = "row_no") -> DataFrame:
    """Rows at each step (input lines, first lines per order, in range), all counted in one pass over the lines:
    an order adds its lines, itself and, by its first line's day, its place in the range."""
    per_order = numbered(df).groupBy("order_sn").agg(F.count(F.lit(1)).alias("__lines"),
                                                     F.min_by("order_date", order_col).alias("order_date"))
    counts = per_order.agg(F.coalesce(F.sum("__lines"), F.lit(0)).cast("bigint").alias("input_lines"),
                           F.count(F.lit(1)).cast("bigint").alias("orders"),
                           F.count_if(in_date_range("order_date", start, end)).cast("bigint").alias("orders_in_range"))
    return counts.unpivot([], ["input_lines", "orders", "orders_in_range"], "step", "rows")


def top_per_column(counts: DataFrame, n: int) -> DataFrame:
    """L4 per voucher column: the ``n`` most frequent raw values (ties: value)."""
    w = Window.partitionBy("voucher_column").orderBy(F.col("orders").desc(), F.col("raw"))
    return counts.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= n)
