"""Whole-order upsert of a new export batch into the master.

Semantics
---------
An order is identified by ``(order_date, order_sn, buyer_username)`` with
trimmed text and the null tokens treated as null; keys compare null-safely.
Let ``[lo, hi]`` be the span of valid order dates in the new batch.

* replaced: old orders dated in ``[lo, hi]``, or undated, whose key is in the
  new batch; all their lines are dropped and the new lines take their place;
* orphaned: old orders dated in ``[lo, hi]`` absent from the new batch; they
  are logged and, by default, kept in the master (``drop_orphans`` removes them);
* kept: all other old orders;
* every new line is inserted; nothing is de-duplicated inside the batch.

A batch without rows changes nothing. If a batch has rows but no valid date,
the span is "everything" (global mode).

Plan
----
The span is one tiny aggregate read back as literals, so the old side is
filtered by ``order_date BETWEEN lo AND hi`` in the scan (partition pruning on
a date-partitioned master). Old lines that may be touched get their outcome by
one left join against the *distinct* new keys: a shuffle (or bounded broadcast)
join whose right side has one row per key; AQE splits a hot key on the old
side. Master, orphans and statistics all derive from that one result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordersmith.functions import scalars as X
from ordersmith.operators.joins import key_condition
from ordersmith.operators.windows import union_all
from ordersmith.schema import ORDER_KEY
from ordersmith.session import checkpoint_dir

_K = ["__k_date", "__k_sn", "__k_buyer"]


@dataclass
class NewSpan:
    lo: object
    hi: object
    rows: int = 1
    undated: int = 0

    @property
    def empty(self) -> bool:
        """The batch has no rows at all."""
        return self.rows == 0

    @property
    def global_mode(self) -> bool:
        """The batch has rows, but none with a valid date."""
        return not self.empty and self.lo is None


def new_date_span(new: DataFrame, date_col: str = "order_date") -> NewSpan:
    """A5 on the batch: min and max of valid order dates, rows and undated rows; one row to the driver."""
    r = new.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"), F.count(F.lit(1)).alias("n"),
                F.count_if(F.col(date_col).isNull()).alias("undated")).first()
    return NewSpan(r["lo"], r["hi"], r["n"], r["undated"])


def with_order_key(df: DataFrame, keys: Sequence[str] = ORDER_KEY) -> DataFrame:
    """Normalised key columns (date as is, text trimmed, null tokens -> null)."""
    d, sn, buyer = keys
    return df.withColumns({"__k_date": F.col(d), "__k_sn": X.key_part(sn), "__k_buyer": X.key_part(buyer)})


def in_span(span: NewSpan, date_col: str) -> Column:
    """Whether the order is dated within the batch's span (never null)."""
    if span.empty:
        return F.lit(False)
    if span.global_mode:
        return F.lit(True)
    return F.coalesce(F.col(date_col).between(F.lit(span.lo), F.lit(span.hi)), F.lit(False))


def may_change(span: NewSpan, date_col: str) -> Column:
    """Filter for old lines that can be replaced or orphaned: dated in the span, or undated if the batch has undated
    lines (a plain range, so that it prunes partitions; null where it doesn't hold for want of a date)."""
    dated = in_span(span, date_col) if span.empty or span.global_mode else F.col(date_col).between(
        F.lit(span.lo), F.lit(span.hi))
    return dated | F.col(date_col).isNull() if span.undated else dated


def _new_keys(new: DataFrame, keys: Sequence[str]) -> DataFrame:
    return with_order_key(new, keys).select(*_K).distinct()


OUTCOME = "__outcome"


def with_outcome(old: DataFrame, new: DataFrame, keys: Sequence[str] = ORDER_KEY,
                 span: NewSpan | None = None, affected_only: bool = False) -> DataFrame:
    """Old lines with ``__outcome``: kept_outside_span, replaced or orphaned.

    Lines that cannot change take no part in the join; with ``affected_only``
    they are left out, so the old side is read once."""
    span = span or new_date_span(new, keys[0])
    touched = may_change(span, keys[0])
    nk = _new_keys(new, keys).withColumn("__hit", F.lit(True))
    inside = with_order_key(old.filter(touched), keys)
    outcome = (F.when(F.col("__hit").isNotNull(), "replaced")
                .when(in_span(span, keys[0]), "orphaned").otherwise("kept_outside_span"))
    joined = inside.join(nk, key_condition(inside, nk, _K), "left").select(
        *[inside[c] for c in old.columns], outcome.alias(OUTCOME))
    if affected_only:
        return joined
    return union_all([old.filter(~F.coalesce(touched, F.lit(False))).withColumn(OUTCOME, F.lit("kept_outside_span")), joined])


def upsert_orders(old: DataFrame, new: DataFrame, keys: Sequence[str] = ORDER_KEY,
                  drop_orphans: bool = False, span: NewSpan | None = None) -> DataFrame:
    """Q1: the master after the batch (columns of ``old`` and ``new`` by name)."""
    gone = ["replaced", "orphaned"] if drop_orphans else ["replaced"]
    kept = with_outcome(old, new, keys, span).filter(~F.col(OUTCOME).isin(gone)).drop(OUTCOME)
    return union_all([kept, new])


def orphan_rows(outcomes: DataFrame, run_ts: str | None = None) -> DataFrame:
    """The orphaned lines of ``with_outcome`` with the run time as ``orphaned_timestamp``."""
    ts = F.lit(run_ts).cast("timestamp_ntz") if run_ts else F.localtimestamp()
    return outcomes.filter(F.col(OUTCOME) == "orphaned").drop(OUTCOME).withColumn("orphaned_timestamp", ts)


def find_orphans(old: DataFrame, new: DataFrame, keys: Sequence[str] = ORDER_KEY,
                 span: NewSpan | None = None, run_ts: str | None = None) -> DataFrame:
    """Q2: old lines of in-span orders that the batch no longer has, with the
    run time as ``orphaned_timestamp``."""
    return orphan_rows(with_outcome(old, new, keys, span), run_ts)


def outcome_statistics(outcomes: DataFrame, new: DataFrame, keys: Sequence[str] = ORDER_KEY) -> DataFrame:
    """A16 from the lines of ``with_outcome`` and the batch."""
    both = union_all([with_order_key(outcomes, keys).select(F.col(OUTCOME).alias("action"), *_K),
                      with_order_key(new, keys).select(F.lit("inserted").alias("action"), *_K)])
    per_order = both.groupBy("action", *_K).agg(F.count(F.lit(1)).alias("__n"))
    return per_order.groupBy("action").agg(F.count(F.lit(1)).cast("bigint").alias("orders"),
                                           F.sum("__n").cast("bigint").alias("lines"))


def upsert_statistics(old: DataFrame, new: DataFrame, keys: Sequence[str] = ORDER_KEY,
                      span: NewSpan | None = None) -> DataFrame:
    """Orders and lines per outcome: ``kept_outside_span``, ``replaced``,
    ``orphaned`` (old side) and ``inserted`` (new side)."""
    return outcome_statistics(with_outcome(old, new, keys, span), new, keys)


class OrderUpsert:
    """Q1, Q2 and A16 of one batch from one join: span, marked old lines, ``master``, ``orphans`` and ``statistics``.

    The batch and the marked old lines are written to the shared checkpoint
    folder on first use, so that a job that needs several of these results reads
    each side once; give it only the columns that the results need.
    """

    def __init__(self, old: DataFrame, new: DataFrame, keys: Sequence[str] = ORDER_KEY, drop_orphans: bool = False,
                 run_ts: str | None = None):
        self.old, self.new, self.keys = old, new, list(keys)
        self.drop_orphans, self.run_ts = drop_orphans, run_ts
        checkpoint_dir(old.sparkSession)

    @cached_property
    def batch(self) -> DataFrame:
        return self.new.checkpoint()

    @cached_property
    def span(self) -> NewSpan:
        return new_date_span(self.batch, self.keys[0])

    @cached_property
    def outcomes(self) -> DataFrame:
        old = with_order_key(self.old, self.keys).withColumn("__may", F.coalesce(may_change(self.span, self.keys[0]), F.lit(False)))
        nk = _new_keys(self.batch, self.keys).select(*[F.col(c).alias(f"__new{c}") for c in _K], F.lit(True).alias("__hit"))
        same = key_condition(old, nk, _K, [f"__new{c}" for c in _K])
        outcome = (F.when(F.col("__hit").isNotNull(), "replaced")
                    .when(F.col("__may") & in_span(self.span, self.keys[0]), "orphaned").otherwise("kept_outside_span"))
        return old.join(nk, same & F.col("__may"), "left").select(*self.old.columns, outcome.alias(OUTCOME)).checkpoint()

    @property
    def master(self) -> DataFrame:
        gone = ["replaced", "orphaned"] if self.drop_orphans else ["replaced"]
        return union_all([self.outcomes.filter(~F.col(OUTCOME).isin(gone)).drop(OUTCOME), self.batch])

    @property
    def orphans(self) -> DataFrame:
        return orphan_rows(self.outcomes, self.run_ts)

    @property
    def statistics(self) -> DataFrame:
        return outcome_statistics(self.outcomes, self.batch, self.keys)
