"""Sinks and the streaming drop-folder ingest on files written from the driver data."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ordersmith import registry as R
from ordersmith.sources import readers, sinks
from ordersmith.sources import testdata as td
from ordersmith.streaming.dropfolder import start_dropfolder_ingest


def test_upsert_into_path_matches_dataframe_upsert(spark, tmp_path):
    path, orphan_path = str(tmp_path / "master"), str(tmp_path / "orphans")
    old, new = R.upsert_old(spark, SF_SMALL), R.upsert_new(spark, SF_SMALL)
    sinks.upsert_into(spark, path, old, run_id="r0")                       # first load
    out = sinks.upsert_into(spark, path, new, orphan_path, run_id="r1", run_ts="1999-01-01 00:00:00")
    stored = sinks.read_master(spark, path)
    expected = R.QUERIES["upsert_orders"](spark, SF_SMALL)
    k = ["order_sn", "row_no", "quantity", "processing_date"]
    assert sorted(map(tuple, stored.select(*k).collect())) == sorted(map(tuple, expected.select(*k).collect()))
    assert out.orphans == spark.read.parquet(orphan_path).count() > 0
    n_stored = stored.count()
    # re-running the same batch leaves the master and the orphan log as they are
    sinks.upsert_into(spark, path, new, orphan_path, run_id="r1", run_ts="1999-01-01 00:00:00")
    assert sinks.read_master(spark, path).count() == n_stored
    assert spark.read.parquet(orphan_path).count() == out.orphans


def _write_exports(spark, folder):
    raw = td.raw_order_exports(spark, SF_SMALL).drop("row_no")
    shops = [r[0] for r in raw.select("file_name").distinct().orderBy("file_name").limit(3).collect()]
    for f in shops:
        part = raw.filter(F.col("file_name") == f).drop("file_name")
        tmp = os.path.join(str(folder) + "_tmp", f)
        part.coalesce(1).write.mode("overwrite").option("header", True).csv(tmp)
        [csv] = [x for x in os.listdir(tmp) if x.endswith(".csv")]
        os.makedirs(folder, exist_ok=True)
        os.replace(os.path.join(tmp, csv), os.path.join(folder, f.replace(".xlsx", ".csv")))
    return shops, [c for c in raw.columns if c != "file_name"]


def test_csv_reader_and_dropfolder_stream(spark, tmp_path):
    inbox, archive = str(tmp_path / "inbox"), str(tmp_path / "archive")
    shops, headers = _write_exports(spark, inbox)
    df = readers.read_order_exports(spark, inbox)
    assert df.select("file_name").distinct().count() == 3
    assert readers.header_columns(spark, inbox).count() == len(headers)
    q = start_dropfolder_ingest(spark, inbox, headers, str(tmp_path / "master"), str(tmp_path / "orphans"),
                                archive, checkpoint_location=str(tmp_path / "ckpt"), as_of="2001-12-31")
    q.awaitTermination(300)
    master = sinks.read_master(spark, str(tmp_path / "master"))
    assert master.count() == df.count()
    assert master.filter(F.col("order_date").isNull() | F.col("shop_name").isNull()).count() == 0


def test_keep_empty_cells(spark, tmp_path):
    p = tmp_path / "x_acc_Order.all.1.csv"
    p.write_text("a,b,c\n,nan,1\n", encoding="utf-8")
    default = readers.read_order_exports(spark, str(tmp_path)).first()
    kept = readers.read_order_exports(spark, str(tmp_path), keep_empty=True).first()
    assert (default["a"], default["b"]) == (None, None)
    assert (kept["a"], kept["b"]) == ("", "nan")
    assert kept["file_name"] == "x_acc_Order.all.1.csv"


def test_bucketed_master_table_needs_no_shuffle_for_marts(spark):
    from ordersmith.plans import marts
    import uuid
    spark.sql("CREATE DATABASE IF NOT EXISTS ordersmith_test")
    t = f"ordersmith_test.master_{uuid.uuid4().hex[:12]}"   # fresh table each run
    old, new = R.upsert_old(spark, SF_SMALL), R.upsert_new(spark, SF_SMALL)
    sinks.write_master_table(old, t, buckets=4)
    sinks.upsert_into_table(spark, t, new, run_id="r1", run_ts="1999-01-01 00:00:00")
    stored = spark.table(t)
    expected = R.QUERIES["upsert_orders"](spark, SF_SMALL)
    k = ["order_sn", "row_no", "quantity", "processing_date"]
    assert sorted(map(tuple, stored.select(*k).collect())) == sorted(map(tuple, expected.select(*k).collect()))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (marts.order_summary(stored, null_numbers=False), marts.order_headers(stored, null_numbers=False)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan, plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    a = sorted(map(tuple, marts.order_summary(stored).select("order_sn", "product_name_list").collect()))
    b = sorted(map(tuple, marts.order_summary(expected).select("order_sn", "product_name_list").collect()))
    assert a == b


def test_csv_sink_typed_read_and_ledger(spark, tmp_path):
    m = R.master(spark, SF_SMALL).select("order_sn", "order_date", "quantity").limit(50)
    out = str(tmp_path / "csv")
    sinks.write_overwrite(m, out, fmt="csv")
    back = readers.read_csv_typed(spark, out, "order_sn string, order_date date, quantity bigint")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, m.collect()))
    sinks.write_overwrite(m.limit(5), out, fmt="csv")          # overwrite replaces
    assert readers.read_csv_typed(spark, out, "order_sn string, order_date date, quantity bigint").count() == 5
    ledger = str(tmp_path / "ledger")
    files = spark.createDataFrame([("a.csv",), ("b.csv",)], "file_name string")
    assert sinks.unprocessed_files(files, None).count() == 2
    sinks.record_processed(spark, files.filter("file_name = 'a.csv'"), ledger, "r1")
    todo = sinks.unprocessed_files(files, spark.read.parquet(ledger))
    assert [r.file_name for r in todo.collect()] == ["b.csv"]
    sinks.record_processed(spark, files.filter("file_name = 'a.csv'"), ledger, "r1")   # re-run: no duplicate
    assert spark.read.parquet(ledger).count() == 1


def test_unreadable_master_raises_and_stays(spark, tmp_path):
    import pytest
    path = tmp_path / "master"
    old = R.upsert_old(spark, SF_SMALL)
    sinks.upsert_into(spark, str(path), old, run_id="load")
    files = sorted(path.rglob("*.parquet"))
    for f in files:
        f.write_bytes(b"not a table")
    with pytest.raises(Exception):
        sinks.upsert_into(spark, str(path), R.upsert_new(spark, SF_SMALL), run_id="r1")
    assert sorted(path.rglob("*.parquet")) == files


def test_failed_publish_keeps_the_table(spark):
    import uuid
    from ordersmith.plans.publish import publish
    db = f"ordersmith_{uuid.uuid4().hex[:10]}"
    good = spark.range(5).toDF("x")
    assert publish(spark, {"t": good}, db).first().rows == 5
    bad = spark.range(3).select(F.raise_error(F.lit("no")).cast("bigint").alias("x"))
    r = publish(spark, {"t": bad}, db).first()
    assert r.status == "failed" and "no" in r.error
    assert spark.table(f"{db}.t").count() == 5
    assert publish(spark, {"t": spark.range(7).toDF("x")}, db).first().bytes > 0
    assert spark.table(f"{db}.t").count() == 7


def test_cluster_without_checkpoint_folder_is_an_error():
    import pytest
    from types import SimpleNamespace
    from ordersmith.session import checkpoint_dir
    no_dir = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: d),
                             sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"))
    with pytest.raises(RuntimeError):
        checkpoint_dir(no_dir)


def test_default_null_cells(spark, tmp_path):
    p = tmp_path / "x_acc_Order.all.1.csv"
    p.write_text("a,b,c\nN/A,NULL,Nantes\n", encoding="utf-8")
    r = readers.read_order_exports(spark, str(tmp_path)).first()
    assert (r["a"], r["b"], r["c"]) == (None, None, "Nantes")


def test_awkward_headers_never_fail_a_drop(spark, tmp_path):
    sn, n = "訂單編號", "數量"
    files = {"a[1].csv": f"{sn},{n},{n},{n.upper()}\nA,1,2,3\nA,4,5,6\n",
             "b b.csv": f'\ufeff"訂單\r\n編號","{n}\n"\r\nB,"7\n8"\r\n',
             "c+c.csv": f'\n{sn},,{n},file_name,row_no\nC,blank,9,own,10\n',
             "quotes.csv": f'{sn},{n},備註\nD,1,"12"" screen"\n', "short.csv": f"{sn},{n},x\nE,1\nE,1,2,3,4\n",
             "no_number.csv": f"{n}\n1\n", "empty.csv": "", "open.csv": f'"{sn},{n}\nF,1\n'}
    for name, text in files.items():
        (tmp_path / name).write_bytes(text.encode())
    drop = readers.scan_order_exports(spark, str(tmp_path))
    report = {r.file_name: (r.status, r.columns, r.missing, r.repeated, r.unmapped) for r in drop.files.collect()}
    assert report == {
        "a[1].csv": ("accepted", 4, "", n, ""), "b b.csv": ("accepted", 2, "", "", ""),
        "c+c.csv": ("accepted", 5, "", "", "column_2,file_name_,row_no_"), "quotes.csv": ("accepted", 3, "", "", ""),
        "short.csv": ("accepted", 3, "", "", "x"), "no_number.csv": ("rejected", 1, "order_sn", "", ""),
        "empty.csv": ("rejected", 0, "order_sn", "", ""), "open.csv": ("rejected", 0, "order_sn", "", "")}
    rows = {(r[sn], r[n]) for r in drop.rows.collect()}
    assert rows == {("A", "1"), ("A", "4"), ("B", "7\n8"), ("C", "9"), ("D", "1"), ("E", "1")}
    c = drop.rows.filter(F.col(sn) == "C").first()
    assert (c["column_2"], c["file_name_"], c["row_no_"], c["file_name"]) == ("blank", "own", "10", "c+c.csv")
    assert drop.rows.filter(F.col(sn) == "D").first()["備註"] == '12" screen'


def test_header_over_many_lines_has_a_bound(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "HEADER_CHARS", 50)
    (tmp_path / "long.csv").write_text('"訂單編號","' + "x\n" * 100 + '"\nA,1\n')
    (tmp_path / "good.csv").write_text('"訂單\n編號"\nA\n')
    drop = readers.scan_order_exports(spark, str(tmp_path))
    assert {r.file_name: r.status for r in drop.files.collect()} == {"long.csv": "rejected", "good.csv": "accepted"}
    assert drop.rows.count() == 1


def test_place_in_file_rises_over_blocks(spark, tmp_path):
    (tmp_path / "x.csv").write_text("訂單編號\n" + "".join(f"{i:06d}\n" for i in range(5000)))
    (tmp_path / "y.csv").write_text("訂單編號\n" + "".join(f"{i:06d}\n" for i in range(50)))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "4096")
    try:
        got = readers.scan_order_exports(spark, str(tmp_path)).rows.collect()
    finally:
        spark.conf.set(key, before)
    for name, n in (("x.csv", 5000), ("y.csv", 50)):
        own = sorted((r.row_no, r["訂單編號"]) for r in got if r.file_name == name)
        assert [v for _, v in own] == [f"{i:06d}" for i in range(n)] and len({k for k, _ in own}) == n


def test_marked_csv(spark, tmp_path):
    import pytest
    out = str(tmp_path / "marked")
    rows = [(1, 'a "b", c'), (2, "x\ny"), (3, None)]
    df = spark.createDataFrame(rows, "id int, text string")
    sinks.write_csv_with_mark(df.repartition(3), out)
    for f in (tmp_path / "marked").glob("part-*.csv"):
        assert f.read_bytes().startswith(b"\xef\xbb\xbfid,text\n")
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema(df.schema).csv(out)
    assert sorted(map(tuple, back.collect())) == rows
    sinks.write_csv_with_mark(df.limit(0), out)
    assert [f.read_bytes() for f in (tmp_path / "marked").glob("part-*.csv")] == [b"\xef\xbb\xbfid,text\n"]
    with pytest.raises(ValueError):
        sinks.write_csv_with_mark(df.withColumnRenamed("id", "a,b"), out)


def test_ledger_takes_each_file_once_and_after_a_break_again(spark, tmp_path, monkeypatch):
    import pytest
    from ordersmith.plans import drops
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    args = (spark, str(inbox), str(tmp_path / "master"), str(tmp_path / "ledger"))
    head = "訂單編號,數量\n"
    (inbox / "a_x_Order.all.1.csv").write_text(head + "250601A,1\n250601A,2\n")
    (inbox / "bad.csv").write_text("數量\n1\n")

    def broken(*a, **k):
        raise RuntimeError("stopped")
    with monkeypatch.context() as m:
        m.setattr(drops, "upsert_into", broken)
        with pytest.raises(RuntimeError):
            drops.ingest_drop(*args, run_id="r1")
    state = lambda: {(r.file_path.rsplit("/", 1)[1][0], r.run_id, r.state) for r in drops.read_ledger(spark, args[3]).collect()}
    assert state() == {("a", "r1", "claimed"), ("b", "r1", "claimed")}
    run = drops.ingest_drop(*args, run_id="r2")
    assert (run.taken, run.rejected) == (1, 1)
    (inbox / "c_x_Order.all.2.csv").write_text(head + "250602C,5\n")
    run = drops.ingest_drop(*args, run_id="r3")
    assert (run.taken, run.rejected) == (1, 1)                      # the file set aside is looked at again
    (inbox / "a_x_Order.all.1.csv").write_text(head + "250601A,7\n")    # exported again: a new file
    assert drops.ingest_drop(*args, run_id="r4").taken == 1
    assert drops.ingest_drop(*args, run_id="r5").taken == 0
    got = {(r.order_sn, r.quantity) for r in sinks.read_master(spark, args[2]).collect()}
    assert got == {("250601A", 7), ("250602C", 5)}
    assert {(f, r) for f, r, s in state() if s == "committed"} == {("a", "r2"), ("c", "r3"), ("a", "r4")}
