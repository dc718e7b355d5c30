"""Order-line inputs derived from the driver's star-schema tables.

The reference works on marketplace order exports; the test tables are a
lineitem/orders/customer/nation/part star.  This module maps one onto the
other, in Spark (``order_lines``) and as DuckDB SQL (``ORDER_LINES_SQL``) so a
query and its oracle see the same rows:

* order number = order day as YYMMDD + order key padded to at least 8 digits
* shop         = the customer's nation; buyer = customer name
* product      = part name / brand / type; line order ``row_no`` per order

The upsert's old and new snapshots, and the sheet and its old master, are
split by order date and status; together each two hold every line. Every other
input below reads whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordersmith.functions import scalars as X
from ordersmith.operators.projections import conform
from ordersmith.schema import MASTER_COLUMNS, ORDER_EXPORT_HEADERS, SHEET_EXPORT_HEADERS

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

# Line order inside an order: (l_orderkey, l_linenumber) is not unique in the
# generated data, so the remaining line attributes break ties.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
              "l_extendedprice", "l_shipdate", "l_returnflag"]


def at_least_8(digits: Column) -> Column:
    """Digits padded with zeros to eight places, longer ones unchanged (``lpad`` alone would cut them)."""
    return F.when(F.length(digits) < 8, F.lpad(digits, 8, "0")).otherwise(digits)


# Resolved plans (not data) are reused within a session: resolving a Parquet
# table lists its files and reads its footer, and the base view is the same
# plan for every query.
_PLANS: dict[tuple, DataFrame] = {}


def _memo(spark: SparkSession, key: tuple, build) -> DataFrame:
    k = (id(spark), spark.sparkContext.applicationId) + key
    df = _PLANS.get(k)
    if df is None:
        df = _PLANS[k] = build()
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    return _memo(spark, ("table", path), lambda: spark.read.parquet(path))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line (see module doc); work grows with lineitem."""
    return _memo(spark, ("order_lines", sf_dir), lambda: _order_lines(spark, sf_dir))


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_shipdate", "l_returnflag")
    # numbering is partitioned by order key, the same key as the orders join,
    # so the window and the join share one exchange
    li = li.withColumn("row_no", F.row_number().over(
        Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)))
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")

    # an order gets its customer and nation before it meets its lines, which are several times as many
    o = (o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey)
          .drop("o_custkey", "c_custkey", "c_nationkey", "n_nationkey"))
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, F.col("l_partkey") == p.p_partkey)

    okey = F.col("o_orderkey")
    seller_voucher = (F.when(okey % 11 == 0, F.lit(None).cast("string"))
                       .when(okey % 13 == 0, F.lit("N/A"))
                       .otherwise((okey % 600).cast("string")))
    voucher = (F.when(okey % 3 == 0, F.lit("0"))
                .when(okey % 7 == 0, F.lit(""))
                .otherwise((okey % 90).cast("string")))
    qty = F.col("l_quantity").cast("bigint")
    return j.select(
        F.concat(F.date_format("o_orderdate", "yyMMdd"), at_least_8(okey.cast("string"))).alias("order_sn"),
        F.col("n_name").alias("shop_name"),
        F.lower("n_name").alias("shop_account"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("c_name").alias("buyer_username"),
        F.col("o_orderdate").alias("order_creation_timestamp"),
        F.col("l_shipdate").alias("actual_shipping_timestamp"),
        F.col("o_totalprice").alias("total_amount_paid_by_buyer"),
        F.concat(F.lit("NT$"), F.floor("l_extendedprice").cast("bigint").cast("string"),
                 F.lit(" ")).alias("product_total_price_raw"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("product_sku_main"),
        F.col("p_type").alias("product_sku_variation"),
        qty.alias("quantity"),
        F.when(F.col("l_returnflag") == "R", qty).otherwise(F.lit(0).cast("bigint")).alias("return_quantity"),
        seller_voucher.alias("seller_voucher"),
        voucher.alias("voucher"),
        okey.alias("order_no"),
        F.col("row_no").cast("bigint").alias("row_no"),
    )


def in_turn(lines: DataFrame, turn: tuple[int, int] | None) -> DataFrame:
    """The order lines of one of n parts (i of n; all if None), for callers that make all parts one after another."""
    return lines if turn is None else lines.filter(F.pmod(F.hash("order_no"), F.lit(turn[1])) == turn[0])


def order_master(spark: SparkSession, sf_dir: str, as_of: str, turn: tuple[int, int] | None = None) -> DataFrame:
    """``order_lines`` as a typed master table (all master columns, in order,
    plus ``row_no``).  The buyer's nation stands in for the recipient city."""
    return _memo(spark, ("order_master", sf_dir, as_of, turn), lambda: _order_master(spark, sf_dir, as_of, turn))


def _order_master(spark: SparkSession, sf_dir: str, as_of: str, turn: tuple[int, int] | None = None) -> DataFrame:
    ol = in_turn(order_lines(spark, sf_dir), turn)
    typed = ol.select(
        *[c for c in ol.columns if c not in ("product_total_price_raw", "order_no")],
        X.currency_to_double("product_total_price_raw").alias("product_total_price"),
        F.col("shop_name").alias("recipient_city"),
        F.lit(as_of).cast("date").alias("processing_date"),
    )
    return conform(typed, MASTER_COLUMNS, keep=["row_no"])


# ---------------------------------------------------------------- raw exports
_RAW_SOURCE = {v: k for k, v in ORDER_EXPORT_HEADERS.items() if k != "金流處理費率"}


def raw_source(column: str) -> str:
    """The export header of a master column."""
    return _RAW_SOURCE[column]


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def raw_order_exports(spark: SparkSession, sf_dir: str, turn: tuple[int, int] | None = None) -> DataFrame:
    """The order lines as an untyped export: every cell is text under the
    export's own headers, plus the export file name.

    The file name follows ``<shop>_<account>_Order.all.<from>_<to>.xlsx`` with
    the shop label written without '_' (the shop name ends at the first '_').
    """
    ol = in_turn(order_lines(spark, sf_dir), turn)
    shop = F.regexp_replace("shop_name", "_", "-")
    file_name = F.concat(shop, F.lit("_"), F.col("shop_account"),
                         F.lit("_Order.all.19950101_20011231.xlsx"))
    return ol.select(
        _text("order_sn").alias(_RAW_SOURCE["order_sn"]),
        _text("order_status").alias(_RAW_SOURCE["order_status"]),
        _text("buyer_username").alias(_RAW_SOURCE["buyer_username"]),
        _text("order_creation_timestamp").alias(_RAW_SOURCE["order_creation_timestamp"]),
        _text("actual_shipping_timestamp").alias(_RAW_SOURCE["actual_shipping_timestamp"]),
        F.col("product_total_price_raw").alias(_RAW_SOURCE["product_total_price"]),
        _text("total_amount_paid_by_buyer").alias(_RAW_SOURCE["total_amount_paid_by_buyer"]),
        _text("product_name").alias(_RAW_SOURCE["product_name"]),
        _text("product_sku_main").alias(_RAW_SOURCE["product_sku_main"]),
        _text("product_sku_variation").alias(_RAW_SOURCE["product_sku_variation"]),
        _text("quantity").alias(_RAW_SOURCE["quantity"]),
        _text("return_quantity").alias(_RAW_SOURCE["return_quantity"]),
        _text("seller_voucher").alias(_RAW_SOURCE["seller_voucher"]),
        _text("voucher").alias(_RAW_SOURCE["voucher"]),
        file_name.alias("file_name"),
        F.col("row_no"),
    )


def raw_order_exports_misnamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_order_exports`` where the exports of region-4 shops were saved
    under the marketplace's own name (no ``<shop>_<account>_`` prefix), as
    happens when a file is dropped without renaming: those files are rejects."""
    raw = raw_order_exports(spark, sf_dir)
    n = table(spark, sf_dir, "nation").select(
        F.regexp_replace("n_name", "_", "-").alias("__shop"), "n_regionkey")
    raw = raw.withColumn("__shop", F.substring_index("file_name", "_", 1)).join(n, "__shop", "left")
    bad = F.concat(F.lit("Order.all.19950101_20011231_"), F.col("__shop"), F.lit(".xlsx"))
    return raw.withColumn("file_name", F.when(F.col("n_regionkey") == 4, bad).otherwise(F.col("file_name"))) \
              .drop("__shop", "n_regionkey")


# First order day of the sheet that is merged into the old master of the earlier days.
SHEET_FROM = "1998-01-01"
_SHEET_SOURCE = {"shop_name": "店鋪名稱", "buyer_username": "買家帳號", "order_date": "訂單日期",
                 "order_sn": "訂單編號(從這邊貼上)", "order_status": "訂單狀態",
                 "order_creation_timestamp": "訂單成立日期", "actual_shipping_timestamp": "實際出貨時間"}
assert all(SHEET_EXPORT_HEADERS[v] == k for k, v in _SHEET_SOURCE.items())


def title_first(c: str) -> Column:
    """First character upper case, the rest lower case (``NATION_7`` -> ``Nation_7``)."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(F.col(c), F.lit(2))))


def raw_sheet_export(spark: SparkSession, sf_dir: str, start: str | None = None) -> DataFrame:
    """Orders from the day ``start`` on (all if None) as a spreadsheet export (text cells, sheet headers).

    Shops are written by their alias (``Nation_7`` style) for building-segment
    buyers and by canonical name otherwise; pending orders have ``'-'`` as
    their day; money is plain text and the sheet carries its helper columns.
    """
    ol = order_lines(spark, sf_dir)
    if start is not None:
        ol = ol.filter(F.col("order_date") >= F.lit(start).cast("date"))
    c = table(spark, sf_dir, "customer").select(F.col("c_name").alias("buyer_username"), "c_mktsegment")
    ol = ol.join(c, "buyer_username")
    shop = F.when(F.col("c_mktsegment") == "BUILDING", title_first("shop_name")).otherwise(F.col("shop_name"))
    return ol.select(
        shop.alias(_SHEET_SOURCE["shop_name"]),
        _text("buyer_username").alias(_SHEET_SOURCE["buyer_username"]),
        # pending orders carry a placeholder instead of a day in the sheet
        F.when(F.col("order_status") == "P", F.lit("-")).otherwise(_text("order_date"))
         .alias(_SHEET_SOURCE["order_date"]),
        _text("order_sn").alias(_SHEET_SOURCE["order_sn"]),
        _text("order_status").alias(_SHEET_SOURCE["order_status"]),
        F.date_format("order_creation_timestamp", "yyyy/MM/dd HH:mm").alias(_SHEET_SOURCE["order_creation_timestamp"]),
        _text("actual_shipping_timestamp").alias(_SHEET_SOURCE["actual_shipping_timestamp"]),
        F.regexp_replace("product_total_price_raw", "[^0-9]", "").alias("商品 總價"),
        _text("total_amount_paid_by_buyer").alias("買家總支付金額"),
        _text("seller_voucher").alias("賣場優惠券"),
        _text("voucher").alias("優惠券"),
        _text("product_name").alias("商品名稱"),
        _text("product_sku_main").alias("主商品貨號"),
        _text("product_sku_variation").alias("商品選項貨號"),
        _text("quantity").alias("數量"),
        _text("return_quantity").alias("退貨數量"),
        F.concat(F.lit("T"), _text("order_no"))
         .alias("收件者電話 (若您是自行配送請使用後方蝦皮專線和包裹查詢碼聯繫買家)"),
        _text("shop_name").alias("城市"),
        _text("buyer_username").alias("收件者姓名"),
        _text("order_sn").alias("訂單編號2"),
        _text("row_no").alias("排行"),
        F.col("row_no"),
    )


def shop_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shop dimension ``shop_name, shop_account, keywords`` from ``nation``:
    the keyword list holds the title-case spelling (the alias used in sheets)."""
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_name").alias("shop_name"),
        F.lower("n_name").alias("shop_account"),
        F.concat_ws(",", F.col("n_name"), title_first("n_name")).alias("keywords"),
    )


# ----------------------------------------------------------------- DuckDB SQL
ORDER_LINES_SQL = """
SELECT strftime(o.o_orderdate,'%y%m%d') || repeat('0', 8 - length(CAST(o.o_orderkey AS VARCHAR)))
         || CAST(o.o_orderkey AS VARCHAR) AS order_sn,
       n.n_name AS shop_name, lower(n.n_name) AS shop_account,
       CAST(o.o_orderdate AS DATE) AS order_date, o.o_orderstatus AS order_status,
       c.c_name AS buyer_username, o.o_orderdate AS order_creation_timestamp,
       l.l_shipdate AS actual_shipping_timestamp,
       o.o_totalprice AS total_amount_paid_by_buyer,
       'NT$' || CAST(CAST(floor(l.l_extendedprice) AS BIGINT) AS VARCHAR) || ' ' AS product_total_price_raw,
       p.p_name AS product_name, p.p_brand AS product_sku_main, p.p_type AS product_sku_variation,
       CAST(l.l_quantity AS BIGINT) AS quantity,
       CASE WHEN l.l_returnflag='R' THEN CAST(l.l_quantity AS BIGINT) ELSE 0 END AS return_quantity,
       CASE WHEN o.o_orderkey%11=0 THEN NULL WHEN o.o_orderkey%13=0 THEN 'N/A'
            ELSE CAST(o.o_orderkey%600 AS VARCHAR) END AS seller_voucher,
       CASE WHEN o.o_orderkey%3=0 THEN '0' WHEN o.o_orderkey%7=0 THEN ''
            ELSE CAST(o.o_orderkey%90 AS VARCHAR) END AS voucher,
       o.o_orderkey AS order_no,
       row_number() OVER (PARTITION BY o.o_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey,
           l.l_quantity, l.l_extendedprice, l.l_shipdate, l.l_returnflag) AS row_no
FROM lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey
JOIN customer c ON o.o_custkey=c.c_custkey JOIN nation n ON c.c_nationkey=n.n_nationkey
JOIN part p ON l.l_partkey=p.p_partkey
"""
