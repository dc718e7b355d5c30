"""Column-level operators.

Header work touches only the schema (driver-side metadata); the data itself
is projected with one ``select`` so Catalyst can prune and fuse it.
"""

from __future__ import annotations

from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordersmith.schema import (LONG_HEADER_SUBSTRINGS, SHEET_HEADER_ALIASES, SHEET_HELPER_COLUMNS,
                               column_type)


class MissingColumnsError(ValueError):
    pass


# ------------------------------------------------------------------ P1 / P2
def clean_header(name: str, substrings: Sequence[tuple[str, str]] = LONG_HEADER_SUBSTRINGS) -> str:
    """Drop CR/LF, trim, and collapse the long export headers by substring."""
    cleaned = name.replace("\n", "").replace("\r", "").strip()
    for needle, short in substrings:
        if needle in cleaned:
            return short
    return cleaned


def clean_headers(df: DataFrame) -> DataFrame:
    """Order-export header cleaning (schema only)."""
    return df.toDF(*[clean_header(c) for c in df.columns])


def clean_sheet_headers(df: DataFrame, aliases: Mapping[str, str] = SHEET_HEADER_ALIASES,
                        helpers: Iterable[str] = SHEET_HELPER_COLUMNS) -> DataFrame:
    """Sheet header cleaning: CR/LF and trim, one header alias, helper columns dropped."""
    names = []
    for c in df.columns:
        cleaned = c.replace("\n", "").replace("\r", "").strip()
        names.append(aliases.get(cleaned, cleaned))
    out = df.toDF(*names)
    drop = [h for h in helpers if h in out.columns]
    return out.drop(*drop) if drop else out


# ------------------------------------------------------------------------ P6
def keep_first_duplicate_columns(df: DataFrame) -> DataFrame:
    """Where several columns share a name, keep the leftmost one."""
    seen: set[str] = set()
    tmp = [f"__c{i}" for i in range(len(df.columns))]
    keep = []
    for i, c in enumerate(df.columns):
        if c not in seen:
            seen.add(c)
            keep.append(F.col(tmp[i]).alias(c))
    return df.toDF(*tmp).select(*keep)


# ------------------------------------------------------------------------ P3
def rename_columns(df: DataFrame, mapping: Mapping[str, str], prefer: str = "first") -> DataFrame:
    """Rename by dictionary.  Columns absent from the mapping keep their name.

    When two source columns map to one target (old and new layout of the same
    field), the target is ``coalesce`` of them, in column order (``prefer='first'``)
    or reversed (``'last'``).  Duplicate names from the input are renamed too.
    """
    tmp = [f"__c{i}" for i in range(len(df.columns))]
    base = df.toDF(*tmp)
    targets: dict[str, list[str]] = {}
    order: list[str] = []
    for t, c in zip(tmp, df.columns):
        new = mapping.get(c, c)
        if new not in targets:
            targets[new] = []
            order.append(new)
        targets[new].append(t)
    cols = []
    for new in order:
        srcs = targets[new] if prefer == "first" else list(reversed(targets[new]))
        expr = F.col(srcs[0]) if len(srcs) == 1 else F.coalesce(*[F.col(s) for s in srcs])
        cols.append(expr.alias(new))
    return base.select(*cols)


# ------------------------------------------------------------------------ P4
def unmapped_columns(spark: SparkSession, df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Report of columns the mapping does not know (schema-sized result)."""
    rows = [(i, c) for i, c in enumerate(df.columns) if c not in mapping]
    return spark.createDataFrame(rows, "position int, column_name string")


# ------------------------------------------------------------------------ P5
def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """P5: fail with one error naming every missing column."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"missing required columns: {missing}")
    return df


# ------------------------------------------------------------------------ P8
def conform(df: DataFrame, columns: Sequence[str], fill: str | None = None,
            keep: Sequence[str] = (), cast: bool = True) -> DataFrame:
    """Select ``columns`` in order; absent ones are added as typed nulls (or
    ``fill`` for text columns); extra columns are dropped except ``keep``.
    With ``cast`` present columns are cast to their declared master type."""
    present = set(df.columns)
    out: list[Column] = []
    for c in columns:
        dtype = column_type(c)
        if c in present:
            expr = F.col(c)
            if cast and df.schema[c].dataType != dtype:
                expr = expr.cast(dtype)
        elif fill is not None and isinstance(dtype, T.StringType):
            expr = F.lit(fill)
        else:
            expr = F.lit(None).cast(dtype)
        out.append(expr.alias(c))
    out += [F.col(k) for k in keep if k in present and k not in columns]
    return df.select(*out)


# ----------------------------------------------------------------------- A11 / S5
def column_types(df: DataFrame) -> DataFrame:
    """Position, name and Spark type of each column, with its number of values (one pass)."""
    fields = df.schema.fields
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"__n{i}") for i, f in enumerate(fields)])
    parts = ", ".join(f"{i}, '{f.name}', '{f.dataType.simpleString()}', __n{i}" for i, f in enumerate(fields))
    return counts.selectExpr(f"stack({len(fields)}, {parts}) as (position, column_name, data_type, non_nulls)")
