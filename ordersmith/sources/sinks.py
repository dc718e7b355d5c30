"""Sinks (S9-S16): staged master upsert, orphan log, processed-file ledger.

The master lives as Parquet partitioned by ``order_date``. A batch rewrites only
the days it has orders on (plus the undated partition when it has undated
rows): a replaced order has its day in the batch, so no other day can change.
The old lines of these days are found by dynamic partition pruning with the
batch's own days and staged once with their outcome. Days of the batch's span
on which it has no order hold nothing but orphans; they are read for the orphan
log alone, without a join on order keys, and are not written. With
``drop_orphans`` these days become empty and their partitions are removed.

The write is a dynamic partition overwrite and never a static one. The batch is
staged in the shared checkpoint folder, which also cuts the lineage to the files
about to be replaced; staged tables are deleted after the commit. The overwrite
goes through Spark's commit protocol, so a lost executor only re-runs tasks and
a failed job leaves the old partitions intact. So does a write of very many
lines, whose days are written aside in turns and then moved.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordersmith.operators.joins import key_condition
from ordersmith.operators.projections import conform
from ordersmith.operators.windows import union_all
from ordersmith.plans.upsert import (OUTCOME, NewSpan, new_date_span, orphan_rows, outcome_statistics,
                                     with_order_key, with_outcome)
from ordersmith.schema import COLUMN_DESCRIPTIONS, MASTER_COLUMNS, MASTER_SCHEMA
from ordersmith.session import freed_shuffles, move_partitions, path_exists, remove_path, shared_path, staged as stage

#: CSV writer options: quotes are doubled, blanks around a cell stay.
CSV_CELLS = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
#: Lines that a stored write brings together by day at a time; more are written aside in turns and moved in one commit.
TURN_LINES = 20_000_000
STORED_SCHEMA = T.StructType(MASTER_SCHEMA.fields + [T.StructField("row_no", T.LongType())])


def read_master(spark: SparkSession, path: str, keep=("row_no",)) -> DataFrame:
    """The stored master by its declared schema (no file is opened to infer one)."""
    return conform(spark.read.schema(STORED_SCHEMA).parquet(path), MASTER_COLUMNS, keep=list(keep))


def write_overwrite(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = None,
                    header: bool = True) -> None:
    """Replace the data at ``path`` (CSV gets a header row, and cells as they are)."""
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.options(header=header, **CSV_CELLS)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.save(path)


def with_comments(df: DataFrame) -> DataFrame:
    """The master's columns with their descriptions, which stored tables then carry."""
    return df.select(*[F.col(c).alias(c, metadata={"comment": COLUMN_DESCRIPTIONS[c]}) if c in COLUMN_DESCRIPTIONS else F.col(c)
                       for c in df.columns])


def write_csv_with_mark(df: DataFrame, path: str) -> None:
    """CSV files that each begin with a byte-order mark and the header, as spreadsheet programs expect UTF-8.

    The mark is the first character of the first header cell, so Spark's own
    writer and commit protocol make the files. That cell can't be one that has
    to be quoted."""
    first = df.columns[0]
    if not first or first != first.strip() or any(c in first for c in ',"\r\n\\'):
        raise ValueError(f"the first column's name {first!r} would be quoted behind the mark")
    (df.withColumnRenamed(first, f"\ufeff{first}").write.mode("overwrite").options(header=True, **CSV_CELLS).csv(path))


def append_orphans(orphans: DataFrame, path: str, run_id: str) -> None:
    """The orphan log, one partition per run; re-running a run replaces
    its own partition only (so a retried batch is not logged twice)."""
    with freed_shuffles(orphans.sparkSession):
        (orphans.withColumn("run_id", F.lit(run_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
         .partitionBy("run_id").parquet(path))


def _days_of_turn(rows: DataFrame, date_col: str, i: int, turns: int) -> DataFrame:
    return rows.filter(F.pmod(F.hash(date_col), F.lit(turns)) == i) if turns > 1 else rows


def _stage_outcomes(old: DataFrame, batch: DataFrame, span: NewSpan, date_col: str, folder: str) -> DataFrame:
    """The old lines of ``changed_days`` with their outcome, staged; for a large batch in turns of whole days, as no
    order has two days."""
    turns, changed = max(1, -(-span.rows // TURN_LINES)), changed_days(old, batch, span, date_col)
    for i in range(turns):
        part = stage(with_outcome(_days_of_turn(changed, date_col, i, turns), _days_of_turn(batch, date_col, i, turns),
                                  span=span, affected_only=True), f"{folder}/{i}")
    return part.sparkSession.read.schema(part.schema).parquet(*[f"{folder}/{i}" for i in range(turns)])


def _replace_days(rows: DataFrame, lines: int, path: str, date_col: str) -> None:
    """Replace the day partitions that ``rows`` has, all at the end.

    Rows of about more than ``TURN_LINES`` lines are written in turns of whole days, each of which frees its shuffle,
    to a hidden folder beside the days; these are moved once all are written."""
    turns = -(-lines // TURN_LINES)
    if turns < 2:
        return _write_days(rows, path, date_col, "overwrite")
    aside = f"{path.rstrip('/')}/_turns-{uuid.uuid4().hex}"
    for i in range(turns):
        _write_days(_days_of_turn(rows, date_col, i, turns), aside, date_col, "append")
    move_partitions(rows.sparkSession, aside, path)


@dataclass
class UpsertOutcome:
    statistics: list[tuple[str, int, int]]     # action, orders, lines
    orphans: int
    days_removed: int = 0                      # partitions left empty by dropped orphans


def _stored_batch(new: DataFrame) -> DataFrame:
    batch = conform(new, MASTER_COLUMNS, keep=["row_no"])
    return batch if "row_no" in batch.columns else batch.withColumn("row_no", F.lit(None).cast("long"))


def _by_day(rows: DataFrame, date_col: str) -> DataFrame:
    """Lines brought together by day before a partitioned write, else every task writes a file for every day.

    Spark deals parts that come out large over several tasks, each with files of
    its own, by the sizes of the shuffle itself: the lines are made once, not
    counted by day beforehand. The lines of an order lie beside one another, so
    that what they have in common takes little space here and in later shuffles."""
    return rows.hint("rebalance", date_col).sortWithinPartitions(date_col, "order_sn", "row_no")


def _write_days(rows: DataFrame, path: str, date_col: str, mode: str) -> None:
    with freed_shuffles(rows.sparkSession):
        (_by_day(rows, date_col).write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
         .partitionBy(date_col).parquet(path))


def batch_days(batch: DataFrame, span: NewSpan, date_col: str) -> DataFrame:
    """The dated days of a batch, at most one row for every day of its span."""
    return batch.filter(F.col(date_col).between(F.lit(span.lo), F.lit(span.hi))).select(date_col).distinct()


def changed_days(old: DataFrame, batch: DataFrame, span: NewSpan, date_col: str = "order_date") -> DataFrame:
    """Old lines on the batch's days, and undated ones if the batch has such lines.

    The days are broadcast (a calendar's worth), so that a date-partitioned
    master is pruned to them while the query runs."""
    undated = old.filter(F.col(date_col).isNull())
    if span.global_mode:
        return undated
    dated = old.join(F.broadcast(batch_days(batch, span, date_col)), date_col, "left_semi").select(*old.columns)
    return union_all([dated, undated]) if span.undated else dated


def other_days(old: DataFrame, batch: DataFrame, span: NewSpan, date_col: str = "order_date") -> DataFrame:
    """Old lines dated in the span on days that the batch has no order on: all of them are orphans."""
    if span.global_mode:
        return old.filter(F.col(date_col).isNotNull())
    dated = old.filter(F.col(date_col).between(F.lit(span.lo), F.lit(span.hi)))
    return dated.join(F.broadcast(batch_days(batch, span, date_col)), date_col, "left_anti").select(*old.columns)


def _log_orphans(orphans: DataFrame, path: str, run_id: str, staged: str, keep_logged: bool) -> None:
    """Write a run's orphans; with ``keep_logged`` those that an earlier, unfinished attempt logged and dropped stay."""
    spark = orphans.sparkSession
    if keep_logged and path_exists(spark, f"{path}/run_id={run_id}"):
        logged = spark.read.parquet(path).filter(F.col("run_id") == run_id).drop("run_id")
        k = ["__k_date", "__k_sn", "__k_buyer"]
        now = with_order_key(orphans).select(*[F.col(c).alias(f"__now{c}") for c in k]).distinct()
        before = with_order_key(logged)
        gone = before.join(now, key_condition(before, now, k, [f"__now{c}" for c in k]), "left_anti").drop(*k)
        gone.write.parquet(f"{staged}/logged")
        orphans = union_all([orphans, spark.read.schema(gone.schema).parquet(f"{staged}/logged")])
    append_orphans(orphans, path, run_id)


def _upsert(old: DataFrame, new: DataFrame, write, remove_days, orphan_path: str | None, run_id: str, run_ts: str | None,
            date_col: str, drop_orphans: bool) -> UpsertOutcome:
    """One batch against the stored lines ``old``; ``write(rows, lines)`` replaces the partitions that ``rows`` has (at
    most so many lines) and ``remove_days(days)`` removes partitions."""
    spark = old.sparkSession
    staged = shared_path(spark, "ordersmith-upsert", uuid.uuid4().hex)
    batch = stage(_stored_batch(new), f"{staged}/batch")
    span = new_date_span(batch, date_col)
    if span.empty:
        remove_path(spark, staged)
        return UpsertOutcome([], 0)
    old = old.select(*[c for c in STORED_SCHEMA.names if c in old.columns])
    outcomes = _stage_outcomes(old, batch, span, date_col, f"{staged}/old")
    rest = other_days(old, batch, span, date_col).withColumn(OUTCOME, F.lit("orphaned"))
    everything = union_all([outcomes, rest])
    stats = [(r["action"], r["orders"], r["lines"])
             for r in outcome_statistics(everything, batch).orderBy("action").collect()]    # four outcomes
    n_orphans = next((lines for action, _, lines in stats if action == "orphaned"), 0)
    if orphan_path and n_orphans:
        _log_orphans(orphan_rows(everything, run_ts), orphan_path, run_id, staged, drop_orphans)
    gone = ["replaced", "orphaned"] if drop_orphans else ["replaced"]
    emptied = []
    if drop_orphans and n_orphans:
        # one row a day: the calendar of the span
        emptied = [r[0] for r in rest.select(date_col).distinct().orderBy(date_col).toLocalIterator()]
    write(union_all([outcomes.filter(~F.col(OUTCOME).isin(gone)).drop(OUTCOME), batch]), sum(lines for _, _, lines in stats))
    remove_days(emptied)
    remove_path(spark, staged)
    return UpsertOutcome(stats, n_orphans, len(emptied))


def upsert_into(spark: SparkSession, master_path: str, new: DataFrame, orphan_path: str | None = None, *,
                run_id: str, run_ts: str | None = None, date_col: str = "order_date",
                drop_orphans: bool = False) -> UpsertOutcome:
    """Q1+Q2 against a stored master: rewrite only the days the batch has orders on.

    Orphaned orders are logged under ``run_id``, which must tell this run from
    every other one, and stay in the master; ``drop_orphans`` removes them from
    it. Running the same batch again under its own id changes neither master nor
    log. A batch without rows changes nothing. A master that exists but can't be
    read is an error and stays untouched.
    """
    if not path_exists(spark, master_path):
        _write_days(_stored_batch(new), master_path, date_col, "errorifexists")     # fails if one has appeared meanwhile
        return UpsertOutcome([], 0)

    def write(rows: DataFrame, lines: int) -> None:
        _replace_days(rows, lines, master_path, date_col)

    def remove_days(days: list) -> None:
        for day in days:
            remove_path(spark, f"{master_path.rstrip('/')}/{date_col}={day}")
    return _upsert(read_master(spark, master_path), new, write, remove_days, orphan_path, run_id, run_ts, date_col,
                   drop_orphans)


# ------------------------------------------------------------------- S16
def unprocessed_files(files: DataFrame, ledger: DataFrame | None, col: str = "file_name") -> DataFrame:
    """S16 (batch form): files not yet recorded in the processed-file ledger."""
    if ledger is None:
        return files
    return files.join(ledger.select(col).distinct(), col, "left_anti")


def record_processed(spark: SparkSession, file_names: DataFrame, ledger_path: str, run_id: str,
                     col: str = "file_name") -> None:
    """Append this run's files to the ledger (one partition per run)."""
    (file_names.select(col).distinct().withColumn("run_id", F.lit(run_id))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id").parquet(ledger_path))


# ------------------------------------------------------- bucketed master table
def _no_null_numbers(df: DataFrame) -> DataFrame:
    return df.withColumn("order_sn", F.coalesce("order_sn", F.lit("")))


def write_master_table(df: DataFrame, table: str, buckets: int = 64, date_col: str = "order_date") -> None:
    """Store the master as a catalog table partitioned by day and bucketed by
    order number (lines of an order sorted by ``row_no``).

    Jobs grouped by ``order_sn`` (B01 summary, B03/B04 first lines) then read
    each bucket across all days in one task and need no shuffle with
    ``null_numbers=False``: the table layout already satisfies the grouping, and
    missing order numbers are stored as ``''``.  Size ``buckets`` so one bucket of
    one day is a few hundred MB at most.
    """
    (_no_null_numbers(conform(df, MASTER_COLUMNS, keep=["row_no"])).write.mode("overwrite")
     .partitionBy(date_col).bucketBy(buckets, "order_sn").sortBy("order_sn", "row_no")
     .saveAsTable(table))


def upsert_into_table(spark: SparkSession, table: str, new: DataFrame, orphan_path: str | None = None, *,
                      run_id: str, run_ts: str | None = None, date_col: str = "order_date",
                      drop_orphans: bool = False) -> UpsertOutcome:
    """``upsert_into`` for a bucketed master table: the same staged rewrite of
    the batch's day partitions, written with ``INSERT OVERWRITE`` (dynamic
    partitions) so the table keeps its bucketing."""
    old = spark.table(table)

    def write(rows: DataFrame, lines: int) -> None:
        # INSERT OVERWRITE takes the overwrite mode from the session: dynamic for
        # this statement only, so untouched day partitions stay as they are
        key = "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(key, "static")
        spark.conf.set(key, "dynamic")
        try:
            _no_null_numbers(rows).select(*old.columns).write.insertInto(table, overwrite=True)
        finally:
            spark.conf.set(key, before)

    def remove_days(days: list) -> None:
        for day in days:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({date_col} = DATE '{day}')")
    return _upsert(old, new, write, remove_days, orphan_path, run_id, run_ts, date_col, drop_orphans)
