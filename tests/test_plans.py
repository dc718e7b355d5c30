"""Plan properties that matter at scale, checked on the physical plans."""

import pytest

from conftest import SF_SMALL
from ordersmith import registry as R
from ordersmith.plans import marts

# queries whose construction writes data (a catalog table, a stream's output)
SIDE_EFFECTS = {"publish_marts", "dropfolder_ingest", "upsert_stored", "upsert_empty_batch", "upsert_undated_rerun",
                "orphan_log_two_runs", "upsert_stored_sparse", "upsert_stored_drop_orphans", "orphan_log_dropped", "csv_ingest_mixed_layouts", "csv_ingest_files",
                "csv_ingest_headers", "csv_ingest_headers_files", "drop_ingest_ledger", "csv_with_mark", "published_summary", "csv_inferred_types",
                "csv_read_inferred", "csv_header_columns", "csv_keep_empty", "csv_plain", "report_written", "stored_comments"}


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def no_aqe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("name", sorted(set(R.QUERIES) - SIDE_EFFECTS))
def test_no_cross_join(no_aqe, name):
    plan = physical(R.QUERIES[name](no_aqe, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_first_line_is_limited_before_the_shuffle(no_aqe):
    plan = physical(marts.order_headers(R.master(no_aqe, SF_SMALL)))
    lines = [ln for ln in plan.splitlines() if "WindowGroupLimit" in ln or "Exchange hashpartitioning(order_sn" in ln]
    kinds = ["Partial" if "Partial" in ln else "Final" if "Final" in ln else "Exchange" for ln in lines]
    assert kinds == ["Final", "Exchange", "Partial"], lines   # printed top-down: final above the shuffle


def test_stored_upsert_reads_only_the_batch_days(no_aqe, tmp_path):
    from pyspark.sql import functions as F
    from ordersmith.plans import upsert as U
    from ordersmith.sources import sinks
    path = str(tmp_path / "master")
    sinks.upsert_into(no_aqe, path, R.upsert_old(no_aqe, SF_SMALL), run_id="r0")
    new = R.upsert_new(no_aqe, SF_SMALL)
    span = U.new_date_span(new)
    old = sinks.read_master(no_aqe, path)
    affected = old.filter(F.col("order_date").between(F.lit(span.lo), F.lit(span.hi)))
    plan = physical(U.upsert_orders(affected, new, span=span))
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "order_date" in ln]
    assert scan and all("PartitionFilters: [isnotnull(order_date" in ln for ln in scan), scan


def test_stored_upsert_reads_and_shuffles_each_side_once(no_aqe, tmp_path):
    from ordersmith.plans import upsert as U
    from ordersmith.sources import sinks
    master, batch = str(tmp_path / "master"), str(tmp_path / "batch")
    sinks.upsert_into(no_aqe, master, R.upsert_old(no_aqe, SF_SMALL), run_id="load")
    sinks.upsert_into(no_aqe, batch, R.upsert_new(no_aqe, SF_SMALL), run_id="load")
    new = sinks.read_master(no_aqe, batch)
    limit = no_aqe.conf.get("spark.sql.autoBroadcastJoinThreshold")
    no_aqe.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(U.with_outcome(sinks.read_master(no_aqe, master), new, span=U.new_date_span(new), affected_only=True))
    finally:
        no_aqe.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln]
    # old lines move once; of the batch only its keys move, to be made distinct and then to the null-safe join
    assert len(scans) == 2 and plan.count("Exchange hashpartitioning") == 3, plan
    assert sum("PartitionFilters: [isnotnull(order_date" in ln for ln in scans) == 1, scans


def test_stored_upsert_prunes_the_old_side_to_the_days_of_the_batch(no_aqe, tmp_path):
    from ordersmith.plans import upsert as U
    from ordersmith.sources import sinks
    path = str(tmp_path / "master")
    sinks.upsert_into(no_aqe, path, R.upsert_old(no_aqe, SF_SMALL), run_id="load")
    new = R._sparse_batch(no_aqe, SF_SMALL)
    new.write.parquet(str(tmp_path / "batch"))
    batch = no_aqe.read.parquet(str(tmp_path / "batch"))
    old, span = sinks.read_master(no_aqe, path), U.new_date_span(batch)
    plan = physical(sinks.changed_days(old, batch, span))
    assert "SubqueryBroadcast dynamicpruning" in plan and "ReusedExchange" in plan, plan
    rest = physical(sinks.other_days(old, batch, span))
    assert "Exchange hashpartitioning(order_sn" not in rest and "PartitionFilters: [isnotnull(order_date" in rest, rest


def test_step_counts_and_publish_read_their_input_once(no_aqe, tmp_path):
    from ordersmith.plans import publish as P
    from ordersmith.plans import vouchers as V
    path = str(tmp_path / "m")
    R.master(no_aqe, SF_SMALL).select("order_sn", "order_date", "row_no").write.parquet(path)
    m = no_aqe.read.parquet(path)
    plan = physical(V.step_counts(m, "1998-01-01", "1999-12-31"))
    assert plan.count("FileScan parquet") == 1 and "Window" not in plan, plan
    reads = no_aqe.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b
    counted = m.mapInArrow(seen, m.schema)
    assert P.publish(no_aqe, {"counted": counted}, "ordersmith_once").first().rows == m.count() == reads.value
