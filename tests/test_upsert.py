"""Whole-order upsert on hand-made snapshots, plus properties on the driver data."""

import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ordersmith import registry as R
from ordersmith.plans import upsert as U
from ordersmith.sources import sinks

SCHEMA = "order_date date, order_sn string, buyer_username string, product_name string, row_no bigint"
d = dt.date


def rows(df, cols=("order_date", "order_sn", "buyer_username", "product_name")):
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


def test_edge_cases(spark):
    old = spark.createDataFrame([
        (d(2025, 1, 1), "A", "u", "old-a", 1),      # outside span: kept
        (d(2025, 2, 1), "B", "u", "old-b1", 1),     # replaced (2 lines -> 1)
        (d(2025, 2, 1), "B", "u", "old-b2", 2),
        (d(2025, 2, 2), "C", "u", "old-c", 1),      # orphan: kept and logged
        (None, "D", "u", "old-d", 1),               # undated old: outside span
        (d(2025, 2, 3), "E", None, "old-e", 1),     # null buyer, replaced null-safely
    ], SCHEMA)
    new = spark.createDataFrame([
        (d(2025, 2, 1), "B", "u", "new-b", 1),
        (d(2025, 2, 3), "E", "nan", "new-e", 1),    # 'nan' buyer is null
        (d(2025, 2, 5), "F", "u", "new-f", 1),      # new order
        (None, "G", "u", "new-g", 1),               # undated new
    ], SCHEMA)
    master = U.upsert_orders(old, new)
    got = {r.product_name for r in master.collect()}
    assert got == {"old-a", "old-c", "old-d", "new-b", "new-e", "new-f", "new-g"}
    orphans = U.find_orphans(old, new, run_ts="2025-03-01 00:00:00")
    assert [r.product_name for r in orphans.collect()] == ["old-c"]
    stats = {r.action: (r.orders, r.lines) for r in U.upsert_statistics(old, new).collect()}
    assert stats == {"kept_outside_span": (2, 2), "replaced": (2, 3), "orphaned": (1, 1), "inserted": (4, 4)}
    assert {r.product_name for r in U.upsert_orders(old, new, drop_orphans=True).collect()} == got - {"old-c"}


def test_global_mode_and_empty_old(spark):
    old = spark.createDataFrame([(None, "A", "u", "old", 1), (d(2025, 1, 1), "B", "u", "keep?", 1)], SCHEMA)
    new = spark.createDataFrame([(None, "A", "u", "new", 1)], SCHEMA)
    # no valid date in the batch: every old order is compared (null-safe keys)
    assert {r.product_name for r in U.upsert_orders(old, new).collect()} == {"new", "keep?"}
    assert {r.product_name for r in U.find_orphans(old, new).collect()} == {"keep?"}
    empty = old.limit(0)
    assert rows(U.upsert_orders(empty, new)) == rows(new)


def test_properties_on_driver_data(spark):
    old, new = R.upsert_old(spark, SF_SMALL), R.upsert_new(spark, SF_SMALL)
    master = U.upsert_orders(old, new)
    orphans = U.find_orphans(old, new, run_ts="1999-01-01 00:00:00")
    stats = {r.action: (r.orders, r.lines) for r in U.upsert_statistics(old, new).collect()}
    # rows(master) = kept outside span + orphans + new
    assert master.count() == stats["kept_outside_span"][1] + stats["orphaned"][1] + new.count()
    # orphans are old rows
    cols = ["order_sn", "row_no"]
    assert orphans.select(*cols).subtract(old.select(*cols)).count() == 0
    # idempotent: applying the same batch twice changes nothing
    again = U.upsert_orders(master, new)
    k = ["order_sn", "row_no", "quantity"]
    assert rows(again, k) == rows(master, k)


def day_files(path):
    """Files of every day partition."""
    return {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in path.iterdir() if p.is_dir()}


def small_master(spark, path):
    old = spark.createDataFrame([
        (d(2025, 1, 1), "A", "u", "outside", 1),
        (d(2025, 2, 1), "B", "u", "replaced", 1), (d(2025, 2, 1), "C", "u", "orphan beside B", 1),
        (d(2025, 2, 2), "D", "u", "orphan on a day without batch orders", 1),
        (d(2025, 2, 3), "E", "u", "replaced too", 1), (None, "F", "u", "undated", 1)], SCHEMA)
    sinks.upsert_into(spark, str(path), old, run_id="load")
    return spark.createDataFrame([(d(2025, 2, 1), "B", "u", "new", 1), (d(2025, 2, 3), "E", "u", "new", 1),
                                  (d(2025, 2, 4), "G", "u", "new", 1)], SCHEMA)


def test_stored_upsert_leaves_other_days_alone(spark, tmp_path):
    path, log = tmp_path / "master", str(tmp_path / "log")
    batch = small_master(spark, path)
    before = day_files(path)
    out = sinks.upsert_into(spark, str(path), batch, log, run_id="r1")
    after = day_files(path)
    same = {k for k in before if after.get(k) == before[k]}
    assert same == {"order_date=2025-01-01", "order_date=2025-02-02", "order_date=__HIVE_DEFAULT_PARTITION__"}
    assert out.orphans == 2 and out.days_removed == 0
    assert {r.order_sn for r in spark.read.parquet(log).collect()} == {"C", "D"}
    got = rows(sinks.read_master(spark, str(path)), ("order_sn", "product_name"))
    assert got == Counter({("A", "outside"): 1, ("B", "new"): 1, ("C", "orphan beside B"): 1, ("E", "new"): 1, ("G", "new"): 1,
                           ("D", "orphan on a day without batch orders"): 1, ("F", "undated"): 1})


def test_stored_upsert_drops_orphans_and_keeps_their_log(spark, tmp_path, monkeypatch):
    path, log = tmp_path / "master", str(tmp_path / "log")
    batch = small_master(spark, path)
    remove = sinks.remove_path

    def fail(spark, p):                                        # the run ends before the emptied day is removed
        if "order_date=" in p:
            raise RuntimeError("stopped")
        remove(spark, p)
    monkeypatch.setattr(sinks, "remove_path", fail)
    try:
        sinks.upsert_into(spark, str(path), batch, log, run_id="r1", drop_orphans=True)
    except RuntimeError:
        pass
    monkeypatch.undo()
    out = sinks.upsert_into(spark, str(path), batch, log, run_id="r1", drop_orphans=True)
    assert out.days_removed == 1 and "order_date=2025-02-02" not in day_files(path)
    assert Counter(r.order_sn for r in spark.read.parquet(log).collect()) == Counter("CD")
    assert sorted(r.order_sn for r in sinks.read_master(spark, str(path)).collect()) == list("ABEFG")
    sinks.upsert_into(spark, str(path), batch, log, run_id="r1", drop_orphans=True)
    assert Counter(r.order_sn for r in spark.read.parquet(log).collect()) == Counter("CD")


def test_undated_batch_with_dropped_orphans_equals_the_dataframe_upsert(spark, tmp_path):
    path = tmp_path / "master"
    small_master(spark, path)
    batch = spark.createDataFrame([(None, "F", "u", "new", 1)], SCHEMA)
    old = sinks.read_master(spark, str(path)).select(*batch.columns)
    expected = rows(U.upsert_orders(old, batch, drop_orphans=True))
    sinks.upsert_into(spark, str(path), batch, run_id="r1", drop_orphans=True)
    assert rows(sinks.read_master(spark, str(path))) == expected


def test_bucketed_table_drops_orphans(spark):
    import uuid
    spark.sql("CREATE DATABASE IF NOT EXISTS ordersmith_test")
    t = f"ordersmith_test.drop_{uuid.uuid4().hex[:12]}"
    from ordersmith.operators.projections import conform
    from ordersmith.schema import MASTER_COLUMNS
    old = spark.createDataFrame([(d(2025, 2, 1), "B", "u", "old", 1), (d(2025, 2, 2), "D", "u", "orphan", 1)], SCHEMA)
    sinks.write_master_table(conform(old, MASTER_COLUMNS, keep=["row_no"]), t, buckets=2)
    batch = spark.createDataFrame([(d(2025, 2, 1), "B", "u", "new", 1), (d(2025, 2, 3), "E", "u", "new", 1)], SCHEMA)
    out = sinks.upsert_into_table(spark, t, batch, run_id="r1", drop_orphans=True)
    assert out.days_removed == 1
    assert sorted(r.order_sn for r in spark.table(t).collect()) == ["B", "E"]


def test_one_pass_upsert_equals_the_functions(spark):
    old = spark.createDataFrame([
        (d(2025, 1, 1), "A", "u", "outside", 1), (d(2025, 2, 1), "B", "u", "replaced", 1), (d(2025, 2, 2), "C", "u", "orphan", 1),
        (None, "D", "u", "undated", 1), (None, "G", "u", "undated, in the batch", 1), (d(2025, 2, 3), "E", None, "null buyer", 1)], SCHEMA)
    batches = [[(d(2025, 2, 1), "B", "u", "new", 1), (d(2025, 2, 3), "E", "nan", "new", 1), (None, "G", "u", "new", 1)],
               [(None, "G", "u", "new", 1)], [], [(d(2025, 2, 1), "B", "u", "new", 1)]]
    for batch in batches:
        new = spark.createDataFrame(batch, SCHEMA)
        for drop in (False, True):
            one = U.OrderUpsert(old, new, drop_orphans=drop, run_ts="2025-03-01 00:00:00")
            assert rows(one.master) == rows(U.upsert_orders(old, new, drop_orphans=drop))
            assert rows(one.orphans) == rows(U.find_orphans(old, new))
            assert rows(one.statistics, ("action", "orders", "lines")) == rows(U.upsert_statistics(old, new), ("action", "orders", "lines"))
