"""Marts: one row per order, first values kept even when null, ordered lists."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ordersmith import registry as R
from ordersmith.plans import marts
from ordersmith.operators.projections import conform
from ordersmith.schema import MASTER_COLUMNS


def test_summary_semantics(spark):
    df = spark.createDataFrame([
        ("A", 2, "p2", "s2", 1, None, None), ("A", 1, "p1", "", 2, 1, "note"), ("A", 3, "", "s3", None, 0, "x"),
        (None, 1, "q", "t", 1, 0, "n"), ("", 2, "r", "u", 4, 0, "o"),
    ], "order_sn string, row_no long, product_name string, product_sku_main string, quantity long, "
       "return_quantity long, buyer_note string")
    m = conform(df, MASTER_COLUMNS, keep=["row_no"])
    got = {r.order_sn: r for r in marts.order_summary(m).collect()}
    a = got["A"]
    assert a.product_name_list == "p1;p2" and a.product_sku_main_list == "s2;s3"
    assert a.total_quantity == 3 and a.total_return_quantity == 1 and a.buyer_note == "note"
    # null and empty order numbers are one group, with its lists; its lines are also returned apart
    assert set(got) == {"A", ""}
    assert (got[""].product_name_list, got[""].total_quantity, got[""].buyer_note) == ("q;r", 5, "n")
    assert sorted(r.product_name for r in marts.unnumbered_lines(m).collect()) == ["q", "r"]


def test_one_row_per_order(spark):
    m = R.master(spark, SF_SMALL)
    n = m.select("order_sn").distinct().count()
    for df in (marts.order_summary(m), marts.order_headers(m), marts.order_shipping(m)):
        assert df.count() == n and df.select("order_sn").distinct().count() == n


def test_city_labels_default_map(spark):
    df = spark.createDataFrame([("A", 1, "台北市"), ("B", 1, "Somewhere")], "order_sn string, row_no long, recipient_city string")
    got = {r.order_sn: r.recipient_city for r in marts.order_shipping(conform(df, MASTER_COLUMNS, keep=["row_no"])).collect()}
    assert got == {"A": "Taipei City", "B": "Somewhere"}


def test_lists_of_groups_of_any_size(spark):
    """Groups over the bound leave the mart's lists null and have them in chunks, equal when joined."""
    rows = [("" if i % 3 else None, i % 50, f"p{i % 7}" if i % 5 else "", f"s{i}") for i in range(400)]   # ties in row_no
    rows += [("A", 2, "x", ""), ("A", 1, "y", None), ("B", 1, None, "t")]
    from ordersmith.operators.projections import conform
    from ordersmith.schema import MASTER_COLUMNS
    lines = conform(spark.createDataFrame(rows, "order_sn string, row_no long, product_name string, product_sku_main string"),
                    MASTER_COLUMNS, keep=["row_no"]).withColumn("quantity", F.lit(1).cast("bigint")).repartition(7)
    whole = {r.order_sn: r for r in marts.order_summary(lines).collect()}
    cut = {r.order_sn: r for r in marts.order_summary(lines, list_lines=30).collect()}
    assert whole[""].product_name_list.count(";") == 400 * 4 // 5 - 1 and cut[""].product_name_list is None
    assert [cut[""].total_quantity, cut[""].product_sku_main_list] == [400, None] and cut["A"] == whole["A"]
    assert (whole["A"].product_name_list, whole["A"].product_sku_main_list, whole["B"].product_sku_main_list) == ("y;x", "", "t")
    chunks = marts.order_product_lists(lines, list_lines=30).collect()
    blank = sorted((r for r in chunks if r.order_sn == ""), key=lambda r: r.chunk)
    assert [r.chunk for r in blank] == list(range(14)) and [r.lines for r in blank] == [30] * 13 + [10]
    assert ";".join(r.product_name_list for r in blank) == whole[""].product_name_list
    order = sorted((r for r in rows if not r[0]), key=lambda r: (r[1], r[2], r[3]))
    assert ";".join(r.product_sku_main_list for r in blank) == ";".join(r[3] for r in order)
    assert {(r.order_sn, r.chunk, r.product_name_list) for r in chunks if r.order_sn} == {("A", 0, "y;x"), ("B", 0, "")}
    assert marts.order_product_lists(lines.limit(0)).count() == 0


def test_a_large_group_is_dealt_over_tasks(spark):
    from ordersmith.plans.marts import _ranked
    from ordersmith.session import checkpoint_dir
    checkpoint_dir(spark)
    one = spark.range(20_000).select(F.lit("").alias("order_sn"), F.lit(1).cast("long").alias("row_no"),
                                     F.lit("p").alias("product_name"), F.lit("s").alias("product_sku_main"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")             # else ranges this small are put together
    try:
        ranked = _ranked(one, "row_no")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sorted(r[0] for r in ranked.select("__rank").collect()) == list(range(20_000))
    spread = [r["count"] for r in ranked.groupBy("__part").count().collect()]
    assert len(spread) > 1 and max(spread) < 15_000


def test_summary_has_whole_lists_of_groups_of_any_size(spark, monkeypatch):
    """Groups of more lines than a task gathers have the same row as in one aggregation, ties in row_no included."""
    rows = [("" if i % 3 else None, None if i % 90 == 0 else i % 50, f"p{i % 7}" if i % 5 else "", f"s{i % 11}", i % 4 or None, f"n{i}")
            for i in range(400)]
    rows += [("E", i, "", None, 1, "e") for i in range(40)]                                  # large, with empty lists
    rows += [("T", 1, "same", f"t{i}", 1, "t") for i in range(90)] + [("A", 2, "x", "", 3, "a2"), ("A", 1, "y", None, 4, "a1")]
    lines = conform(spark.createDataFrame(rows, "order_sn string, row_no long, product_name string, product_sku_main string, "
                                                "quantity long, shop_name string"),
                    MASTER_COLUMNS, keep=["row_no"]).repartition(7).localCheckpoint()
    whole = {r.order_sn: r for r in marts.order_summary(lines).collect()}                    # all in one aggregation
    monkeypatch.setattr(marts, "LIST_LINES", 30)
    ranges = marts.order_summary(lines).collect()
    assert len(ranges) == len(whole) == 4
    first = {r.order_sn: r.asDict() for r in ranges}
    lists = ["product_name_list", "product_sku_main_list", "total_quantity", "total_return_quantity", "shop_name"]
    for sn, r in whole.items():
        assert {c: first[sn][c] for c in lists if c != "shop_name" or sn == "A"} == {
            c: r[c] for c in lists if c != "shop_name" or sn == "A"}, sn
    blank = [r for r in rows if not r[0]]
    place = lambda r: (r[1] is not None, r[1] or 0)
    assert first[""]["product_name_list"] == ";".join(r[2] for r in sorted(blank, key=lambda r: (*place(r), r[2])) if r[2])
    assert first[""]["product_sku_main_list"] == ";".join(r[3] for r in sorted(blank, key=lambda r: (*place(r), r[3])))
    assert first["T"]["product_name_list"] == ";".join(["same"] * 90)
    assert [first["E"][c] for c in lists[:3]] == ["", "", 40]


def test_ranges_of_a_large_group_are_dealt_over_tasks(spark):
    from ordersmith.plans.marts import _range_texts
    one = spark.range(20_000).select(F.lit("").alias("order_sn"), F.lit(1).cast("long").alias("row_no"), F.lit("p").alias("product_name"))
    texts = [r["__text"] for r in _range_texts(one, "row_no", "product_name", 8).collect()]
    assert len(texts) == 8 and sum(map(len, texts)) == 2 * 20_000 - 8 and max(map(len, texts)) < 15_000


def test_a_group_of_over_250_000_lines_has_its_whole_lists(spark):
    n = 260_000
    lines = conform(spark.range(n).selectExpr("cast(null AS string) AS order_sn", "id AS row_no", "'p' AS product_name",
                                              "if(id % 2 = 0, 's', '') AS product_sku_main", "1L AS quantity"),
                    MASTER_COLUMNS, keep=["row_no"])
    r = marts.order_summary(lines).select("order_sn", F.length("product_name_list"), F.length("product_sku_main_list"), "total_quantity")
    assert [tuple(x) for x in r.collect()] == [("", 2 * n - 1, n - 1, n)]
