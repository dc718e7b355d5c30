"""What keeps the time a line and the work of a write small: code that the JVM compiles, lines made once, narrow exchanges."""

import contextlib
import io
import re

import pytest
from conftest import SF_SMALL

from ordersmith.plans import clean as C
from ordersmith.sources import readers, sinks
from ordersmith.sources import testdata as td

#: Bytecodes of a method above which HotSpot interprets it.
COMPILED = 8000


def _longest_method(df) -> int:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("codegen")
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue()))


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("raw") / "lines")
    td.raw_order_exports(spark, SF_SMALL).write.parquet(at)
    return spark.read.parquet(at)


def test_cleaning_is_short_enough_to_be_compiled(raw):
    assert _longest_method(C.clean_orders(raw, as_of="2001-12-31").rows) < COMPILED


def test_inferring_types_is_short_enough_to_be_compiled(spark, raw):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert _longest_method(readers.infer_types(raw.drop("row_no"))) < COMPILED
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_orders_get_their_customers_before_their_lines(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    out = io.StringIO()
    try:
        with contextlib.redirect_stdout(out):
            td._order_lines(spark, SF_SMALL).explain("formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    by_customer = [x for x in re.split(r"\n\n+", out.getvalue()) if "hashpartitioning(o_custkey" in x]
    assert by_customer and not any("l_partkey" in x for x in by_customer)


def test_first_load_makes_its_lines_once(spark, tmp_path):
    from pyspark.sql import functions as F
    made = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def seen(sn):
        made.add(1)
        return True
    lines = td.order_master(spark, SF_SMALL, "2001-12-31").filter(F.col("order_date") >= "2001-01-01")
    n = lines.count()
    sinks.upsert_into(spark, str(tmp_path / "master"), lines.localCheckpoint().filter(seen("order_sn")), run_id="load")
    assert made.value == n and sinks.read_master(spark, str(tmp_path / "master")).count() == n


def test_dates_at_the_head_of_order_numbers(spark):
    import datetime as dt
    from ordersmith.functions import scalars as X
    want = {"240230AB": None, "240229AB": dt.date(2024, 2, 29), "690101": dt.date(1969, 1, 1), "680101": dt.date(2068, 1, 1),
            "11-1-1": None, "9901 5": dt.date(1999, 1, 5), "991311": None, "20250604X": dt.date(2025, 6, 4),
            "00009999": None, "00001231": None, " 991231 ": dt.date(1999, 12, 31), "": None, "99123": None, "20101204": dt.date(2020, 10, 12)}
    df = spark.createDataFrame([(k,) for k in [*want, None]], "order_sn string")
    got = {r.order_sn: r.order_date for r in X.with_order_date_from_sn(df).collect()}
    assert got == {**want, None: None}


def test_money_keeps_digits_points_and_signs(spark):
    from ordersmith.functions import scalars as X
    want = {"NT$1,234.5": 1234.5, "(100)": 100.0, "1e3": 13.0, "": None, "-": None, "\U0001d7d9 7 元": 7.0, "12": 12.0}
    df = spark.createDataFrame([(k,) for k in [*want, None]], "c string")
    assert {r.c: r.v for r in df.select("c", X.currency_to_double("c").alias("v")).collect()} == {**want, None: None}


def _counted(spark, df):
    """``df`` and the number of its lines that have been made so far."""
    made = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b
    return df.mapInArrow(seen, df.schema), made


def test_product_lists_make_their_lines_once(spark):
    from ordersmith.plans import marts
    lines = spark.range(3_000).selectExpr("if(id % 3 = 0, '', cast(id div 4 AS string)) AS order_sn", "id AS row_no",
                                          "'p' AS product_name", "'s' AS product_sku_main")
    counted, made = _counted(spark, lines)
    lists = marts.order_product_lists(counted, list_lines=100)
    assert sum(r.lines for r in lists.collect()) == made.value == 3_000


@pytest.mark.parametrize("name", ["order_product_lists_joined", "publish_marts", "unnumbered_lines", "order_summary_blank_numbers"])
def test_queries_make_their_master_once(spark, monkeypatch, name):
    from ordersmith import registry as R
    n = R.master(spark, SF_SMALL).count()
    counted, made = _counted(spark, R.master(spark, SF_SMALL))
    monkeypatch.setattr(R, "master", lambda *_: counted)
    rows = R.QUERIES[name](spark, SF_SMALL).collect()
    assert rows and made.value == n
    if name == "publish_marts":
        assert {r.table: r.rows for r in rows}["b02_order_details"] == n


def test_csv_drop_makes_its_lines_once_and_deals_a_shop_over_tasks(spark, monkeypatch):
    from pyspark.sql import functions as F

    from ordersmith import registry as R
    n = td.raw_order_exports(spark, SF_SMALL).count()
    counted, made = _counted(spark, td.raw_order_exports(spark, SF_SMALL).repartition(3))
    monkeypatch.setattr(R.td, "raw_order_exports", lambda *_: counted)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")            # else files this small are one task
    try:
        drop = R._csv_drop(spark, SF_SMALL)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert made.value == n == drop.rows.count()
    of_shop = drop.files.groupBy(F.regexp_extract("file_path", "^(.*)/", 1)).count()
    assert of_shop.agg(F.max("count")).first()[0] > 1 and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def _shuffle_files(spark):
    import os
    from ordersmith.session import checkpoint_dir
    checkpoint_dir(spark)
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in disk.localDirsString() for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}


def test_staged_and_stored_lines_leave_no_shuffle_files(spark, tmp_path):
    from ordersmith import registry as R
    from ordersmith.session import staged
    before = _shuffle_files(spark)
    lines = staged(R.upsert_old(spark, SF_SMALL).filter("order_date >= '2001-01-01'").repartition(5, "order_sn"), str(tmp_path / "lines"))
    assert not _shuffle_files(spark) - before
    sinks.upsert_into(spark, str(tmp_path / "master"), lines, run_id="load")
    assert not _shuffle_files(spark) - before
    assert sinks.read_master(spark, str(tmp_path / "master")).count() == lines.count() > 0


def test_large_batches_are_stored_in_turns_with_the_same_result(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from ordersmith import registry as R
    first = R.upsert_old(spark, SF_SMALL).filter("order_date >= '1998-04-01' AND order_date < '1998-07-01'").localCheckpoint()
    new = R.upsert_new(spark, SF_SMALL).filter("order_date >= '1998-05-01' AND order_date < '1998-08-01'").withColumn(
        "order_date", F.when(F.col("row_no") != 2, F.col("order_date"))).localCheckpoint()           # some lines undated
    got = []
    for name, lines in (("whole", 20_000_000), ("turns", 50)):
        monkeypatch.setattr(sinks, "TURN_LINES", lines)
        at = str(tmp_path / name)
        sinks.upsert_into(spark, f"{at}/master", first, run_id="load")
        outs = [sinks.upsert_into(spark, f"{at}/master", new, f"{at}/orphans", run_id=f"r{i}", run_ts=R.RUN_TS, drop_orphans=i > 1)
                for i in range(3)]
        assert not [p for p in (tmp_path / name / "master").iterdir() if p.name.startswith("_turns")]
        rows = lambda df: sorted(tuple(map(str, r)) for r in df.collect())
        got.append((rows(sinks.read_master(spark, f"{at}/master")), rows(spark.read.parquet(f"{at}/orphans")),
                    [(o.statistics, o.orphans, o.days_removed) for o in outs]))
    assert got[0] == got[1] and got[0][0] and got[0][1]


def test_lines_made_in_turns_are_all_lines(spark, tmp_path):
    from ordersmith import registry as R
    rows = lambda df: sorted(tuple(map(str, r)) for r in df.collect())
    made = R._made_in_turns(spark, lambda turn: R.upsert_new(spark, SF_SMALL, turn), str(tmp_path / "new"))
    assert rows(made) == rows(R.upsert_new(spark, SF_SMALL))
    headers = R._write_exports(spark, SF_SMALL, str(tmp_path / "inbox"))
    files = [p for d in (tmp_path / "inbox").iterdir() if d.name.startswith("file_name=") for p in d.iterdir() if p.name.startswith("part-")]
    raw = td.raw_order_exports(spark, SF_SMALL)
    assert len(files) == raw.select("file_name").distinct().count() and all(p.name.endswith(".csv.gz") for p in files)
    read = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "inbox"))
    assert headers == [c for c in raw.columns if c not in ("file_name", "row_no")]
    text = lambda df: sorted(tuple((x or "").strip() for x in r) for r in df.select(*headers, "file_name").collect())
    assert text(read) == text(raw)
