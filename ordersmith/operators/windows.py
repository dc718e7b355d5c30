"""Window, dedup, ordering, limit and set operators.

Input order has no meaning in Spark, so every "first" takes an explicit
ordering.  "First row per key" is written as ``row_number() = 1``: Spark plans
it with a partial ``WindowGroupLimit`` before the shuffle, so a key holding a
large share of the rows sends one row per map task, not all of them.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordersmith.functions import scalars as X


def _cols(cols):
    return [F.col(c) if isinstance(c, str) else c for c in cols]


# ------------------------------------------------------------------------ W1
def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key by ``order`` (null keys form one group)."""
    w = Window.partitionBy(*keys).orderBy(*_cols(order))
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


# ------------------------------------------------------------------------ W2
def date_gaps(df: DataFrame, group: str, date_col: str, max_gap_days: int = 3) -> DataFrame:
    """Per group, consecutive distinct days more than ``max_gap_days`` apart.

    Rows with a null group or an unparsable day are ignored.  The window runs
    over distinct (group, day) pairs, so its size per group is bounded by the
    calendar, not by the number of rows.
    Output: group, last_order_date, next_order_date, gap_days, missing_days.
    """
    is_text = isinstance(df.schema[date_col].dataType, T.StringType)
    day = X.to_date_tolerant(date_col) if is_text else F.col(date_col).cast("date")
    days = (df.select(F.col(group).alias(group), day.alias("__d"))
              .filter(F.col(group).isNotNull() & F.col("__d").isNotNull())
              .distinct())
    w = Window.partitionBy(group).orderBy("__d")
    prev = F.lag("__d").over(w)
    gaps = (days.withColumn("last_order_date", prev)
                .withColumn("gap_days", F.datediff("__d", "last_order_date"))
                .filter(F.col("gap_days") > max_gap_days))
    return gaps.select(group, "last_order_date", F.col("__d").alias("next_order_date"),
                       F.col("gap_days").cast("bigint").alias("gap_days"),
                       (F.col("gap_days") - 1).cast("bigint").alias("missing_days"))


# ------------------------------------------------------------------------ W3
def duplicated_key_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose key occurs more than once (null-safe keys).

    Counts come from a partial aggregation and are semi-joined back, so a hot
    key is never gathered into one window partition."""
    dup = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
             .filter(F.col("__n") > 1).drop("__n"))
    cond = reduce(lambda a, b: a & b, [df[k].eqNullSafe(dup[k]) for k in keys])
    return df.join(dup, cond, "left_semi")


# ------------------------------------------------------------------ L1-L6
def first_n(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    """L1 / L3 / L4: top ``n`` by a total order (planned as a per-partition
    top-n followed by one merge of at most n rows per partition)."""
    return df.orderBy(*_cols(order)).limit(n)


def sample_n(df: DataFrame, n: int, seed: int = 0, columns: Sequence[str] | None = None) -> DataFrame:
    """L2: ``n`` rows chosen at random (all rows if fewer).  Deterministic: the
    rank is a seeded hash of the row (or of ``columns``), not input order."""
    cols = columns or df.columns
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]).cast("binary"))
    return df.withColumn("__h", h).orderBy("__h", *cols).limit(n).drop("__h")


# ------------------------------------------------------------------ U1-U5
def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate by column name; absent columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
