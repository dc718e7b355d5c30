"""Rolling recent-orders extract (Q14)."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordersmith.functions import scalars as X
from ordersmith.operators.filters import last_n_days


def recent_orders(df: DataFrame, as_of: str, days: int = 30, date_col: str = "order_date") -> DataFrame:
    """Q14: rows dated in the last ``days`` days up to and including ``as_of``;
    a text date column is parsed tolerantly first (X6 + F5)."""
    if isinstance(df.schema[date_col].dataType, T.StringType):
        df = df.withColumn(date_col, X.to_date_tolerant(date_col))
    return df.filter(last_n_days(date_col, as_of, days))


def recent_tables(tables: Mapping[str, DataFrame], as_of: str, days: int = 30) -> dict[str, DataFrame]:
    """Q14 over several tables: tables without an ``order_date`` are skipped."""
    return {name: recent_orders(df, as_of, days) for name, df in tables.items() if "order_date" in df.columns}
