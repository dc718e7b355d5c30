"""Publishing tables to a catalog with a load manifest."""

from __future__ import annotations

import uuid
from typing import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ordersmith.session import path_size, remove_path

MANIFEST_SCHEMA = "table string, status string, rows bigint, bytes bigint, error string"


def create_database(spark: SparkSession, database: str, comment: str | None = None) -> None:
    """Create the target namespace if it does not exist."""
    c = f" COMMENT '{comment}'" if comment else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{c}")


def _location(spark: SparkSession, target: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {target}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def _replace(df: DataFrame, database: str, name: str, fmt: str) -> tuple[int, int]:
    """Write ``df`` aside and point the table to it; (rows, bytes) as stored.

    The files lie in a fresh folder of the database, so a folder left by an
    earlier session is no obstacle, and the table keeps its old content until
    the new one has been written; its rows are counted while they are written."""
    spark, target = df.sparkSession, f"`{database}`.`{name}`"
    base = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex}"
    written = Observation()                      # counted in the writing tasks, once for each that succeeds
    df.observe(written, F.count(F.lit(1)).alias("rows")).write.format(fmt).save(path)
    stored = spark.read.format(fmt).load(path)
    rows, size = written.get["rows"], path_size(spark, path)
    before = _location(spark, target) if spark.catalog.tableExists(f"{database}.{name}") else None
    if before and spark.table(target).schema == stored.schema:
        spark.sql(f"ALTER TABLE {target} SET LOCATION '{path}'")
        spark.catalog.refreshTable(target)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {target}")
        spark.catalog.createTable(f"{database}.{name}", path=path, source=fmt, schema=stored.schema)
    if before:
        remove_path(spark, before)
    return rows, size


def publish(spark: SparkSession, tables: Mapping[str, DataFrame | None], database: str,
            fmt: str = "parquet") -> DataFrame:
    """Replace each table (write aside, count, swap) and return the manifest.

    A table given as ``None`` (its source is missing) is ``skipped``; a failed
    write is ``failed`` with the error, leaves the table as it was and does not
    stop the others.  Each write is a distributed job; the loop runs once per
    table, not per row.
    """
    rows = []
    try:
        create_database(spark, database)
        namespace_error = None
    except Exception as e:  # noqa: BLE001 - every table is then reported as failed
        namespace_error = f"{type(e).__name__}: {e}"
    for name, df in tables.items():
        if df is None:
            rows.append((name, "skipped", 0, 0, "source missing"))
        elif namespace_error:
            rows.append((name, "failed", 0, 0, namespace_error))
        else:
            try:
                rows.append((name, "success", *_replace(df, database, name, fmt), None))
            except Exception as e:  # noqa: BLE001 - reported in the manifest
                rows.append((name, "failed", 0, 0, f"{type(e).__name__}: {e}"))
    return spark.createDataFrame(rows, MANIFEST_SCHEMA)


def manifest_summary(manifest: DataFrame) -> DataFrame:
    """Counts per status (success / skipped / failed) and rows written."""
    return manifest.groupBy("status").agg(F.count(F.lit(1)).alias("tables"), F.sum("rows").alias("rows"))
