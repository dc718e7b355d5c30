"""Registered queries over the driver's tables and their DuckDB oracles.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``ORACLES[name]`` is SQL
that DuckDB runs on the same parquet tables (registered as views) and must
give the same rows.  Every query reads whole tables through
``sources.testdata``; fixed parameters (run date, thresholds) are stated below.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordersmith.plans import marts
from ordersmith.schema import COLUMN_DESCRIPTIONS, MASTER_COLUMNS, column_type
from ordersmith.sources import testdata as td
from pyspark.sql import types as T

# Fixed parameters of the registered queries.
AS_OF = "2001-12-31"          # run (processing) date of the master

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# --------------------------------------------------------------- SQL helpers
def duck_type(dt: T.DataType) -> str:
    if isinstance(dt, T.StringType):
        return "VARCHAR"
    if isinstance(dt, T.DateType):
        return "DATE"
    if isinstance(dt, (T.TimestampNTZType, T.TimestampType)):
        return "TIMESTAMP"
    if isinstance(dt, T.DoubleType):
        return "DOUBLE"
    if isinstance(dt, T.LongType):
        return "BIGINT"
    raise TypeError(dt)


_OL_COLUMNS = {"order_sn", "shop_name", "shop_account", "order_date", "order_status", "buyer_username",
               "order_creation_timestamp", "actual_shipping_timestamp", "total_amount_paid_by_buyer",
               "product_name", "product_sku_main", "product_sku_variation", "quantity",
               "return_quantity", "seller_voucher", "voucher"}


def master_select_sql(as_of: str, source: str = "ol") -> str:
    """DuckDB twin of ``testdata.order_master``."""
    parts = []
    for c in MASTER_COLUMNS:
        if c in _OL_COLUMNS:
            parts.append(c)
        elif c == "product_total_price":
            parts.append("TRY_CAST(regexp_replace(product_total_price_raw, '[^0-9.\\-]', '', 'g') AS DOUBLE)"
                         " AS product_total_price")
        elif c == "recipient_city":
            parts.append("shop_name AS recipient_city")
        elif c == "processing_date":
            parts.append(f"DATE '{as_of}' AS processing_date")
        else:
            parts.append(f"CAST(NULL AS {duck_type(column_type(c))}) AS {c}")
    return "SELECT " + ", ".join(parts) + f", row_no FROM {source}"


def with_master(body: str, as_of: str = AS_OF) -> str:
    return (f"WITH ol AS ({td.ORDER_LINES_SQL}),\nmaster AS ({master_select_sql(as_of)})\n{body}")


def master(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    return td.order_master(spark, sf_dir, as_of)


# ============================================================ marts (Q5-Q9)
_FIRSTS_SQL = ",\n  ".join(f"first({c} ORDER BY row_no) AS {c}" for c in
                           ["shop_name", "shop_account", "processing_date", "order_date",
                            "order_status", "cancellation_reason", "return_refund_status",
                            "buyer_username", "order_creation_timestamp",
                            "total_amount_paid_by_buyer", "voucher", "buyer_note", "seller_note"])


def _ordered_join_sql(c: str) -> str:
    return (f"coalesce(string_agg(CASE WHEN {c} <> '' THEN {c} END, ';' ORDER BY row_no, {c}), '')")


@register("order_summary", with_master(f"""
SELECT order_sn,
  {_FIRSTS_SQL},
  {_ordered_join_sql('product_name')} AS product_name_list,
  {_ordered_join_sql('product_sku_main')} AS product_sku_main_list,
  CAST(sum(coalesce(quantity, 0)) AS BIGINT) AS total_quantity,
  CAST(sum(coalesce(return_quantity, 0)) AS BIGINT) AS total_return_quantity
FROM master GROUP BY order_sn"""))
def q_order_summary(spark, sf_dir):
    return marts.order_summary(master(spark, sf_dir))


def _cols(cols) -> str:
    return ", ".join(cols)


def _first_rows_sql(cols, source="master", key="order_sn") -> str:
    return (f"SELECT {_cols(cols)} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY row_no) AS __rn "
            f"FROM {source}) WHERE __rn = 1")


from ordersmith.schema import (DETAIL_COLUMNS, HEADER_COLUMNS, SHIPPING_COLUMNS,  # noqa: E402
                               SUMMARY_FIRST_COLUMNS)  # noqa: E402


@register("order_details", with_master(f"SELECT {_cols(DETAIL_COLUMNS)} FROM master"))
def q_order_details(spark, sf_dir):
    return marts.order_details(master(spark, sf_dir))


@register("order_headers", with_master(_first_rows_sql(HEADER_COLUMNS)))
def q_order_headers(spark, sf_dir):
    return marts.order_headers(master(spark, sf_dir))


# A reporting map over the shop nations (the shipped default maps city spellings).
TEST_CITY_LABELS = {"NATION_1": "Label One", "NATION_2": "Label Two", "NATION_3": "Label Three"}
_CITY_CASE = ("CASE recipient_city " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TEST_CITY_LABELS.items())
              + " ELSE recipient_city END AS recipient_city")


@register("order_shipping", with_master(
    _first_rows_sql([(_CITY_CASE if c == "recipient_city" else c) for c in SHIPPING_COLUMNS])))
def q_order_shipping(spark, sf_dir):
    return marts.order_shipping(master(spark, sf_dir), TEST_CITY_LABELS)


TEST_PLATFORMS = ["NATION_3", "NATION_7"]
_PLAT_IN = ", ".join(f"'{p}'" for p in TEST_PLATFORMS)


@register("platform_split", with_master(f"""
SELECT order_sn, row_no, shop_name,
       CASE WHEN shop_name IN ({_PLAT_IN}) THEN 'special' ELSE 'normal' END AS side
FROM master"""))
def q_platform_split(spark, sf_dir):
    special, normal = marts.split_platforms(master(spark, sf_dir), TEST_PLATFORMS)
    cols = ["order_sn", "row_no", "shop_name"]
    return special.select(*cols, F.lit("special").alias("side")).unionByName(
        normal.select(*cols, F.lit("normal").alias("side")))


@register("amount_check", with_master("""
SELECT round(sum(lines), 2) AS amount_over_lines, round(sum(firsts), 2) AS amount_over_orders FROM (
  SELECT order_sn, sum(total_amount_paid_by_buyer) AS lines,
         first(total_amount_paid_by_buyer ORDER BY row_no) AS firsts
  FROM master GROUP BY order_sn)"""))
def q_amount_check(spark, sf_dir):
    return marts.amount_check(master(spark, sf_dir))


# ============================================================ upsert
from ordersmith.plans import upsert as U  # noqa: E402

# Snapshots: the old master holds orders before 1998-07 and all pending ones
# (quantities edited so a replacement is visible); the new export holds orders
# from 1998 on, where pending orders ('P') are no longer exported. Together
# they hold every line.
OLD_AS_OF, NEW_AS_OF, RUN_TS = "1998-07-01", "1999-01-01", "1999-01-01 06:00:00"


def upsert_old(spark, sf_dir, turn=None):
    m = td.order_master(spark, sf_dir, OLD_AS_OF, turn)
    return (m.filter((F.col("order_date") < F.lit("1998-07-01").cast("date")) | (F.col("order_status") == "P"))
             .withColumn("quantity", F.col("quantity") + 1))


def upsert_new(spark, sf_dir, turn=None):
    m = td.order_master(spark, sf_dir, NEW_AS_OF, turn)
    return m.filter((F.col("order_date") >= F.lit("1998-01-01").cast("date")) & (F.col("order_status") != "P"))


def _kp(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL OR trim({x}) IN ('nan','NaN','<NA>','None','') THEN NULL ELSE trim({x}) END)"


_ALL = _cols(MASTER_COLUMNS + ["row_no"])
_UPSERT_CTE = f"""WITH ol AS ({td.ORDER_LINES_SQL}),
m_old AS ({master_select_sql(OLD_AS_OF)}),
m_new AS ({master_select_sql(NEW_AS_OF)}),
old AS (SELECT * REPLACE (quantity + 1 AS quantity) FROM m_old WHERE order_date < DATE '1998-07-01'
        OR order_status = 'P'),
new AS (SELECT * FROM m_new WHERE order_date >= DATE '1998-01-01' AND order_status <> 'P'),
span AS (SELECT min(order_date) AS lo, max(order_date) AS hi FROM new),
nk AS (SELECT DISTINCT order_date AS kd, {_kp('order_sn')} AS ks, {_kp('buyer_username')} AS kb FROM new),
old_c AS (SELECT o.*, coalesce(o.order_date BETWEEN (SELECT lo FROM span) AND (SELECT hi FROM span), false) AS in_span,
                 EXISTS (SELECT 1 FROM nk WHERE nk.kd IS NOT DISTINCT FROM o.order_date
                         AND nk.ks IS NOT DISTINCT FROM {_kp('o.order_sn')}
                         AND nk.kb IS NOT DISTINCT FROM {_kp('o.buyer_username')}) AS hit
          FROM old o)
"""


@register("upsert_orders", _UPSERT_CTE + f"""
SELECT {_ALL} FROM old_c WHERE NOT (in_span AND hit)
UNION ALL SELECT {_ALL} FROM new""")
def q_upsert_orders(spark, sf_dir):
    return U.upsert_orders(upsert_old(spark, sf_dir), upsert_new(spark, sf_dir))


@register("find_orphans", _UPSERT_CTE + f"""
SELECT {_ALL}, TIMESTAMP '{RUN_TS}' AS orphaned_timestamp FROM old_c WHERE in_span AND NOT hit""")
def q_find_orphans(spark, sf_dir):
    return U.find_orphans(upsert_old(spark, sf_dir), upsert_new(spark, sf_dir), run_ts=RUN_TS)


@register("upsert_statistics", _UPSERT_CTE + f"""
SELECT action, CAST(count(*) AS BIGINT) AS orders, CAST(sum(n) AS BIGINT) AS lines FROM (
  SELECT CASE WHEN NOT in_span THEN 'kept_outside_span' WHEN hit THEN 'replaced' ELSE 'orphaned' END AS action,
         order_date, {_kp('order_sn')}, {_kp('buyer_username')}, count(*) AS n
  FROM old_c GROUP BY ALL
  UNION ALL
  SELECT 'inserted', order_date, {_kp('order_sn')}, {_kp('buyer_username')}, count(*) FROM new GROUP BY ALL
) GROUP BY action""")
def q_upsert_statistics(spark, sf_dir):
    return U.upsert_statistics(upsert_old(spark, sf_dir), upsert_new(spark, sf_dir))


@register("key_statistics", with_master("""
SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS orders,
       CAST(sum(n) - count(*) AS BIGINT) AS extra_lines, round(sum(n) / count(*), 4) AS lines_per_order
FROM (SELECT order_date, order_sn, buyer_username, count(*) AS n FROM master GROUP BY ALL)"""))
def q_key_statistics(spark, sf_dir):
    from ordersmith.operators.aggregates import key_statistics
    return key_statistics(master(spark, sf_dir), ["order_date", "order_sn", "buyer_username"])


@register("new_batch_span", _UPSERT_CTE + """
SELECT min(order_date) AS min_date, max(order_date) AS max_date, CAST(count(order_date) AS BIGINT) AS dated_rows
FROM new""")
def q_new_batch_span(spark, sf_dir):
    from ordersmith.operators.aggregates import date_extent
    return date_extent(upsert_new(spark, sf_dir), "order_date")


@register("duplicated_order_lines", with_master("""
SELECT order_sn, row_no FROM master m WHERE (SELECT count(*) FROM master x
  WHERE x.order_date IS NOT DISTINCT FROM m.order_date AND x.order_sn IS NOT DISTINCT FROM m.order_sn
    AND x.buyer_username IS NOT DISTINCT FROM m.buyer_username) > 1"""))
def q_duplicated_order_lines(spark, sf_dir):
    from ordersmith.operators.windows import duplicated_key_rows
    return duplicated_key_rows(master(spark, sf_dir), ["order_date", "order_sn", "buyer_username"]) \
        .select("order_sn", "row_no")


# ============================================================ cleaning (Q3, Q4, Q18)
from ordersmith.operators.joins import shop_alias_table  # noqa: E402
from ordersmith.plans import clean as C  # noqa: E402

_NL = "chr(10) || chr(13)"
_YYMMDD_RE = r"^(\d\d)(1[0-2]|0[1-9]|[1-9])(3[01]|[12]\d|0[1-9]|[1-9]| [1-9])"


def _tr(x: str) -> str:
    return f"translate({x}, {_NL}, ' ')"


def _money(x: str) -> str:
    return f"TRY_CAST(regexp_replace({x}, '[^0-9.\\-]', '', 'g') AS DOUBLE)"


def _ts(x: str, tokens=("-", "", "nan", "NaN")) -> str:
    tok = ", ".join(f"'{t}'" for t in tokens)
    cond = f"trim({x}) IN ({tok}) OR " if tokens else ""
    return f"(CASE WHEN {cond}{x} IS NULL THEN NULL ELSE TRY_CAST(replace(trim({x}), '/', '-') AS TIMESTAMP) END)"


def _long(x: str) -> str:
    d = f"(CASE WHEN isnan(TRY_CAST({x} AS DOUBLE)) THEN NULL ELSE TRY_CAST({x} AS DOUBLE) END)"
    return f"(CASE WHEN {d} = floor({d}) THEN CAST({d} AS BIGINT) END)"


def _date_from_sn_sql(s: str) -> str:
    h = f"substr({s}, 1, 6)"
    g = lambda i: f"regexp_extract({h}, '{_YYMMDD_RE}', {i})"
    six = (f"CASE WHEN length({s}) >= 6 AND length({g(0)}) = 6 THEN CAST(try_strptime("
           f"(CASE WHEN CAST({g(1)} AS INT) >= 69 THEN '19' ELSE '20' END) || {g(1)} || lpad({g(2)}, 2, '0')"
           f" || lpad(trim({g(3)}), 2, '0'), '%Y%m%d') AS DATE) END")
    eight = (f"CASE WHEN length({s}) >= 8 AND regexp_matches(substr({s}, 1, 8), '^[0-9]{{8}}$') "
             f"THEN CAST(try_strptime(substr({s}, 1, 8), '%Y%m%d') AS DATE) END")
    return f"(CASE WHEN {s} IS NULL OR {s} = '' THEN NULL ELSE coalesce({six}, {eight}) END)"


def _conform_sql(present: dict[str, str], extra: str = ", row_no") -> str:
    parts = []
    for c in MASTER_COLUMNS:
        parts.append(f"{present[c]} AS {c}" if c in present else f"CAST(NULL AS {duck_type(column_type(c))}) AS {c}")
    return ", ".join(parts) + extra


_RAW_SQL = """SELECT order_sn AS sn, order_status AS st, buyer_username AS buyer,
  CAST(order_creation_timestamp AS VARCHAR) AS created, CAST(actual_shipping_timestamp AS VARCHAR) AS shipped,
  product_total_price_raw AS price, CAST(total_amount_paid_by_buyer AS VARCHAR) AS paid,
  product_name AS pname, product_sku_main AS sku_main, product_sku_variation AS sku_var,
  CAST(quantity AS VARCHAR) AS qty, CAST(return_quantity AS VARCHAR) AS rqty,
  seller_voucher AS sv, voucher AS v,
  replace(shop_name, '_', '-') || '_' || shop_account || '_Order.all.19950101_20011231.xlsx' AS file_name,
  row_no FROM ol"""

_CLEAN_PRESENT = {
    "shop_name": "CASE WHEN instr(file_name, '_') > 1 AND instr(file_name, '_Order.all.') > instr(file_name, '_') + 1 "
                 "THEN split_part(file_name, '_', 1) END",
    "shop_account": "CASE WHEN instr(file_name, '_') > 1 AND instr(file_name, '_Order.all.') > instr(file_name, '_') + 1 "
                    "THEN substr(file_name, instr(file_name, '_') + 1, instr(file_name, '_Order.all.') - instr(file_name, '_') - 1) END",
    "processing_date": f"DATE '{AS_OF}'",
    "order_date": _date_from_sn_sql("trim(sn)"),
    "order_sn": "sn", "order_status": "st", "buyer_username": "buyer",
    "order_creation_timestamp": _ts("created"), "actual_shipping_timestamp": _ts("shipped"),
    "product_total_price": _money("price"), "total_amount_paid_by_buyer": _money("paid"),
    "product_name": "pname", "product_sku_main": "sku_main", "product_sku_variation": "sku_var",
    "quantity": _long("qty"), "return_quantity": _long("rqty"), "seller_voucher": "sv", "voucher": "v",
}
_RAW_TEXT = ["sn", "st", "buyer", "created", "shipped", "price", "paid", "pname", "sku_main", "sku_var",
             "qty", "rqty", "sv", "v"]


_VALID_FILE = "instr(file_name, '_') > 1 AND instr(file_name, '_Order.all.') > instr(file_name, '_') + 1"


@register("clean_orders", f"""WITH ol AS ({td.ORDER_LINES_SQL}),
raw AS ({_RAW_SQL}),
txt AS (SELECT {", ".join(f"{_tr(c)} AS {c}" for c in _RAW_TEXT)}, file_name, row_no FROM raw)
SELECT {_conform_sql(_CLEAN_PRESENT)} FROM txt WHERE {_VALID_FILE}""")
def q_clean_orders(spark, sf_dir):
    return C.clean_orders(td.raw_order_exports(spark, sf_dir), as_of=AS_OF).rows


_MISNAMED_SQL = _RAW_SQL.replace(
    "replace(shop_name, '_', '-') || '_' || shop_account || '_Order.all.19950101_20011231.xlsx' AS file_name",
    "CASE WHEN (SELECT n_regionkey FROM nation WHERE n_name = ol.shop_name) = 4 "
    "THEN 'Order.all.19950101_20011231_' || replace(shop_name, '_', '-') || '.xlsx' "
    "ELSE replace(shop_name, '_', '-') || '_' || shop_account || '_Order.all.19950101_20011231.xlsx' END AS file_name")
assert _MISNAMED_SQL != _RAW_SQL


@register("clean_rejects", f"""WITH ol AS ({td.ORDER_LINES_SQL}),
raw AS ({_MISNAMED_SQL})
SELECT file_name, row_no, sn AS order_sn,
       'file name does not follow <shop>_<account>_Order.all.*' AS reason
FROM raw WHERE NOT ({_VALID_FILE})""")
def q_clean_rejects(spark, sf_dir):
    """Rejects of a drop where some exports were not renamed (whole files)."""
    return C.clean_orders(td.raw_order_exports_misnamed(spark, sf_dir), as_of=AS_OF).rejects


@register("clean_orders_misnamed", f"""WITH ol AS ({td.ORDER_LINES_SQL}),
raw AS ({_MISNAMED_SQL}),
txt AS (SELECT {", ".join(f"{_tr(c)} AS {c}" for c in _RAW_TEXT)}, file_name, row_no FROM raw)
SELECT {_conform_sql(_CLEAN_PRESENT)} FROM txt WHERE {_VALID_FILE}""")
def q_clean_orders_misnamed(spark, sf_dir):
    """Typed rows of the same drop: the misnamed files are left out whole."""
    return C.clean_orders(td.raw_order_exports_misnamed(spark, sf_dir), as_of=AS_OF).rows


_SHEET_AS_OF = "1999-01-01"
_SHEET_PLATFORMS = TEST_PLATFORMS


def _sheet_inputs(spark, sf_dir):
    raw = td.raw_sheet_export(spark, sf_dir, td.SHEET_FROM)
    aliases = shop_alias_table(td.shop_aliases(spark, sf_dir))
    old = master(spark, sf_dir).filter(F.col("order_date") < F.lit("1998-07-01").cast("date"))
    old_special = old.filter(F.col("shop_name").isin(_SHEET_PLATFORMS))
    return raw, aliases, old, old_special


def _sheet_sql(side: str) -> str:
    plats = ", ".join(f"'{p}'" for p in _SHEET_PLATFORMS)
    present = {
        "shop_name": "shop_name", "shop_account": "shop_account", "processing_date": f"DATE '{_SHEET_AS_OF}'",
        "order_date": "TRY_CAST(d_txt AS DATE)", "order_sn": "order_sn", "order_status": "order_status",
        "buyer_username": "buyer_username", "order_creation_timestamp": _ts("created", ()),
        "actual_shipping_timestamp": _ts("shipped", ()),
        "product_total_price": "TRY_CAST(price AS DOUBLE)", "total_amount_paid_by_buyer": "paid",
        "seller_voucher": "seller_voucher", "voucher": "voucher", "product_name": "product_name",
        "product_sku_main": "product_sku_main", "product_sku_variation": "product_sku_variation",
        "quantity": "quantity", "return_quantity": "return_quantity", "recipient_phone": "phone",
        "recipient_city": "city", "recipient_name": "buyer_username",
    }
    member = f"coalesce(shop_name IN ({plats}), false)"
    pick = member if side == "special" else f"NOT {member}"
    old_pick = member if side == "special" else f"NOT {member}"
    return f"""WITH ol AS ({td.ORDER_LINES_SQL}),
master AS ({master_select_sql(AS_OF)}),
sheet AS (
  SELECT CASE WHEN c.c_mktsegment = 'BUILDING' THEN upper(substr(ol.shop_name, 1, 1)) || lower(substr(ol.shop_name, 2))
              ELSE ol.shop_name END AS shop_raw,
         ol.buyer_username, CASE WHEN ol.order_status = 'P' THEN '-' ELSE CAST(ol.order_date AS VARCHAR) END AS d_txt,
         ol.order_sn, ol.order_status, strftime(ol.order_creation_timestamp, '%Y/%m/%d %H:%M') AS created,
         CAST(ol.actual_shipping_timestamp AS VARCHAR) AS shipped, ol.row_no,
         regexp_replace(ol.product_total_price_raw, '[^0-9]', '', 'g') AS price, ol.total_amount_paid_by_buyer AS paid,
         ol.seller_voucher, ol.voucher, ol.product_name, ol.product_sku_main, ol.product_sku_variation,
         ol.quantity, ol.return_quantity, 'T' || CAST(ol.order_no AS VARCHAR) AS phone, ol.shop_name AS city
  FROM ol JOIN customer c ON c.c_name = ol.buyer_username
  WHERE ol.order_date >= DATE '1998-01-01'),
aliases AS (
  SELECT n_name AS alias, lower(n_name) AS acct, n_name AS canon FROM nation
  UNION ALL
  SELECT upper(substr(n_name, 1, 1)) || lower(substr(n_name, 2)), lower(n_name), n_name FROM nation),
new_all AS (
  SELECT coalesce(a.canon, s.shop_raw) AS shop_name,
         CASE WHEN s.shop_raw IS NULL THEN '' WHEN a.alias IS NOT NULL THEN a.acct ELSE '' END AS shop_account, s.*
  FROM sheet s LEFT JOIN aliases a ON a.alias = s.shop_raw
  WHERE s.order_sn IS NOT NULL),
new AS (SELECT {_conform_sql(present)} FROM new_all WHERE {pick}),
old AS (SELECT * FROM master WHERE order_date < DATE '1998-07-01' AND {old_pick})
SELECT * FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.order_sn IS NOT DISTINCT FROM o.order_sn
   AND n.buyer_username IS NOT DISTINCT FROM o.buyer_username
   AND n.order_creation_timestamp IS NOT DISTINCT FROM o.order_creation_timestamp)
UNION ALL SELECT * FROM new"""


@register("ingest_sheet", _sheet_sql("normal"))
def q_ingest_sheet(spark, sf_dir):
    raw, aliases, old, old_special = _sheet_inputs(spark, sf_dir)
    return C.ingest_sheet(raw, aliases, old, old_special, as_of=_SHEET_AS_OF, special_platforms=_SHEET_PLATFORMS)[0]


@register("ingest_sheet_special", _sheet_sql("special"))
def q_ingest_sheet_special(spark, sf_dir):
    raw, aliases, old, old_special = _sheet_inputs(spark, sf_dir)
    return C.ingest_sheet(raw, aliases, old, old_special, as_of=_SHEET_AS_OF, special_platforms=_SHEET_PLATFORMS)[1]


@register("shop_alias_table", """
SELECT alias, shop_account, canonical_name FROM (
  SELECT n_name AS alias, lower(n_name) AS shop_account, n_name AS canonical_name FROM nation
  UNION ALL
  SELECT upper(substr(n_name, 1, 1)) || lower(substr(n_name, 2)), lower(n_name), n_name FROM nation)""")
def q_shop_alias_table(spark, sf_dir):
    return shop_alias_table(td.shop_aliases(spark, sf_dir))


_TEXT_MASTER = [c for c in MASTER_COLUMNS if duck_type(column_type(c)) == "VARCHAR"]


@register("null_tokens_clean", with_master("SELECT " + ", ".join(
    (f"CASE WHEN {c} IS NULL OR {c} IN ('nan', 'NaN', 'None') THEN '' ELSE {c} END AS {c}" if c in _TEXT_MASTER else c)
    for c in MASTER_COLUMNS) + ", row_no FROM master"))
def q_null_tokens_clean(spark, sf_dir):
    return C.null_tokens_clean(master(spark, sf_dir))


# ============================================================ audits (Q10-Q12, Q15-Q17)
from ordersmith.plans import audits as AU  # noqa: E402

FRESHNESS_THRESHOLD = "2001-07-01 00:00:00"
FUZZY_CUTOFF = 0.7


def expected_shops(spark, sf_dir):
    """Expected shop list with typical spelling slips, derived from ``nation``:
    region 0 drops the last character, region 1 writes a space for '_',
    region 2 is lower case, region 3 is exact; region 4 is not expected."""
    n = td.table(spark, sf_dir, "nation")
    name = (F.when(F.col("n_regionkey") == 0, F.expr("substr(n_name, 1, length(n_name) - 1)"))
             .when(F.col("n_regionkey") == 1, F.regexp_replace("n_name", "_", " "))
             .when(F.col("n_regionkey") == 2, F.lower("n_name"))
             .otherwise(F.col("n_name")))
    return n.filter(F.col("n_regionkey") <= 3).select(name.alias("name"))


def _fresh_sql(body: str) -> str:
    return (
        f"WITH ol AS ({td.ORDER_LINES_SQL}),\nmaster AS ({master_select_sql(AS_OF)}),\n" + f"""
expected AS (SELECT CASE WHEN n_regionkey = 0 THEN substr(n_name, 1, length(n_name) - 1)
                         WHEN n_regionkey = 1 THEN replace(n_name, '_', ' ')
                         WHEN n_regionkey = 2 THEN lower(n_name) ELSE n_name END AS name
             FROM nation WHERE n_regionkey <= 3),
latest AS (SELECT shop_name, max(order_creation_timestamp) AS latest_order_ts FROM master
           WHERE shop_name IS NOT NULL AND order_creation_timestamp IS NOT NULL GROUP BY shop_name),
exp AS (SELECT DISTINCT name FROM expected WHERE name IS NOT NULL),
missing AS (SELECT name FROM exp WHERE name NOT IN (SELECT shop_name FROM latest)),
cand AS (SELECT m.name AS left_name, l.shop_name AS right_name,
                CASE WHEN greatest(length(m.name), length(l.shop_name)) = 0 THEN 1.0
                     ELSE 1.0 - levenshtein(l.shop_name, m.name) / greatest(length(m.name), length(l.shop_name)) END AS score
         FROM missing m, latest l),
fuzzy AS (SELECT left_name, right_name, score FROM (
            SELECT *, row_number() OVER (PARTITION BY left_name ORDER BY score DESC, right_name DESC) AS rn
            FROM cand WHERE score >= {FUZZY_CUTOFF}) WHERE rn = 1),
report AS (
  SELECT f.left_name AS nickname, l.shop_name, 'fuzzy' AS status, round(f.score, 4) AS score, l.latest_order_ts
  FROM fuzzy f JOIN latest l ON l.shop_name = f.right_name
  UNION ALL
  SELECT NULL, shop_name, 'present', NULL, latest_order_ts FROM latest WHERE shop_name NOT IN (SELECT right_name FROM fuzzy)
  UNION ALL
  SELECT name, NULL, 'missing', NULL, NULL FROM missing WHERE name NOT IN (SELECT left_name FROM fuzzy))
{body}""")


@register("shop_freshness", _fresh_sql(f"""
SELECT nickname, shop_name, status, score, latest_order_ts,
       coalesce(latest_order_ts < TIMESTAMP '{FRESHNESS_THRESHOLD}', false) AS outdated FROM report"""))
def q_shop_freshness(spark, sf_dir):
    return AU.shop_freshness(master(spark, sf_dir), expected_shops(spark, sf_dir), FRESHNESS_THRESHOLD,
                             FUZZY_CUTOFF).report


@register("shop_freshness_tallies", _fresh_sql(f"""
SELECT 'known' AS tally, CAST(count(*) AS BIGINT) AS shops FROM exp
UNION ALL SELECT 'present', count(*) FROM latest
UNION ALL SELECT 'matched_exact', count(*) FROM exp WHERE name IN (SELECT shop_name FROM latest)
UNION ALL SELECT 'matched_fuzzy', count(*) FROM fuzzy
UNION ALL SELECT 'missing', count(*) FROM report WHERE status = 'missing'
UNION ALL SELECT 'outdated', count(*) FROM latest WHERE latest_order_ts < TIMESTAMP '{FRESHNESS_THRESHOLD}'"""))
def q_shop_freshness_tallies(spark, sf_dir):
    return AU.shop_freshness(master(spark, sf_dir), expected_shops(spark, sf_dir), FRESHNESS_THRESHOLD,
                             FUZZY_CUTOFF).tallies


@register("shop_freshness_difflib")
def q_shop_freshness_difflib(spark, sf_dir):
    """Same report scored by the matching-blocks ratio (no SQL twin; the tests
    check it against Python's own close-match lookup)."""
    return AU.shop_freshness(master(spark, sf_dir), expected_shops(spark, sf_dir), FRESHNESS_THRESHOLD,
                             FUZZY_CUTOFF, measure="difflib").report


GAP_DAYS = 3


@register("date_gaps", with_master(f"""
SELECT shop_name, last_order_date, next_order_date, CAST(gap AS BIGINT) AS gap_days, CAST(gap - 1 AS BIGINT) AS missing_days
FROM (SELECT shop_name, lag(d) OVER (PARTITION BY shop_name ORDER BY d) AS last_order_date, d AS next_order_date,
             date_diff('day', lag(d) OVER (PARTITION BY shop_name ORDER BY d), d) AS gap
      FROM (SELECT DISTINCT shop_name, order_date AS d FROM master WHERE shop_name IS NOT NULL AND order_date IS NOT NULL))
WHERE gap > {GAP_DAYS}"""))
def q_date_gaps(spark, sf_dir):
    return AU.date_gaps(master(spark, sf_dir), GAP_DAYS)


# Cancellation check inputs: the orphan log of the upsert above, and the master
# after a second batch in which the pending orders come back without their
# returned lines.
def _cancel_inputs(spark, sf_dir):
    cols = ["order_date", "order_sn", "buyer_username", "product_name"]      # what the check looks at
    first = U.OrderUpsert(upsert_old(spark, sf_dir).select(*cols), upsert_new(spark, sf_dir).select(*cols), run_ts=RUN_TS)
    back = td.order_master(spark, sf_dir, NEW_AS_OF).filter(
        (F.col("order_status") == "P") & (F.col("return_quantity") == 0)).select(*cols)
    return U.OrderUpsert(first.master, back).master, first.orphans


_NB = ("coalesce(CAST(order_date AS VARCHAR), '') <> '' AND coalesce(order_sn, '') <> '' "
       "AND coalesce(buyer_username, '') <> ''")
_CANCEL_CTE = _UPSERT_CTE + f""",
m1 AS (SELECT {_ALL} FROM old_c WHERE NOT (in_span AND hit) UNION ALL SELECT {_ALL} FROM new),
back AS (SELECT {_ALL} FROM m_new WHERE order_status = 'P' AND return_quantity = 0),
m2 AS (SELECT {_ALL} FROM m1 WHERE NOT EXISTS (SELECT 1 FROM back b WHERE b.order_date IS NOT DISTINCT FROM m1.order_date
         AND b.order_sn IS NOT DISTINCT FROM m1.order_sn AND b.buyer_username IS NOT DISTINCT FROM m1.buyer_username)
       UNION ALL SELECT * FROM back),
m AS (SELECT * FROM m2 WHERE {_NB}),
o AS (SELECT * FROM old_c WHERE in_span AND NOT hit AND {_NB}),
lm AS (SELECT order_date, order_sn, buyer_username, CAST(count(*) AS BIGINT) AS lines_master,
              list_sort(list_distinct(list(coalesce(product_name, '<unknown product>')))) AS pm FROM m GROUP BY ALL),
lo AS (SELECT order_date, order_sn, buyer_username, CAST(count(*) AS BIGINT) AS lines_orphans,
              list_sort(list_distinct(list(coalesce(product_name, '<unknown product>')))) AS po FROM o GROUP BY ALL),
sn AS (SELECT order_sn, count_master, count_orphans, CAST(abs(count_master - count_orphans) AS BIGINT) AS difference
       FROM (SELECT order_sn, CAST(count(*) AS BIGINT) AS count_master FROM m GROUP BY order_sn)
       JOIN (SELECT order_sn, CAST(count(*) AS BIGINT) AS count_orphans FROM o GROUP BY order_sn) USING (order_sn)
       WHERE count_master <> count_orphans),
orders AS (
  SELECT order_date, order_sn, buyer_username, lines_master, lines_orphans,
         CAST(abs(lines_master - lines_orphans) AS BIGINT) AS difference,
         CASE WHEN lines_master <> lines_orphans THEN 'different' ELSE 'same' END AS status,
         CASE WHEN lines_master <> lines_orphans THEN array_to_string(list_filter(pm, lambda x: NOT list_contains(po, x)), ';') END
           AS products_only_in_master,
         CASE WHEN lines_master <> lines_orphans THEN array_to_string(list_filter(po, lambda x: NOT list_contains(pm, x)), ';') END
           AS products_only_in_orphans
  FROM lm JOIN lo USING (order_date, order_sn, buyer_username))
"""


@register("cancellation_orders", _CANCEL_CTE + "SELECT * FROM orders")
def q_cancellation_orders(spark, sf_dir):
    return AU.cancellation_check(*_cancel_inputs(spark, sf_dir)).orders


@register("cancellation_sn_counts", _CANCEL_CTE + "SELECT * FROM sn")
def q_cancellation_sn_counts(spark, sf_dir):
    return AU.cancellation_check(*_cancel_inputs(spark, sf_dir)).sn_counts


@register("cancellation_top10", _CANCEL_CTE + "SELECT * FROM sn ORDER BY difference DESC, order_sn LIMIT 10")
def q_cancellation_top10(spark, sf_dir):
    return AU.top_differences(AU.cancellation_check(*_cancel_inputs(spark, sf_dir)).sn_counts, 10)


@register("cancellation_summary", _CANCEL_CTE + """
SELECT CAST(count(*) AS BIGINT) AS common_orders,
       CAST(count(*) FILTER (WHERE status = 'different') AS BIGINT) AS orders_with_different_lines,
       CAST(count(*) FILTER (WHERE status = 'same') AS BIGINT) AS orders_with_same_lines FROM orders""")
def q_cancellation_summary(spark, sf_dir):
    return AU.cancellation_check(*_cancel_inputs(spark, sf_dir)).summary


_INVALID_DATES_SQL = f"""WITH ol AS ({td.ORDER_LINES_SQL}),
sheet AS (SELECT ol.order_sn, CASE WHEN ol.order_status = 'P' THEN '-' ELSE CAST(ol.order_date AS VARCHAR) END AS order_date
          FROM ol)
SELECT order_sn, order_date FROM sheet
WHERE TRY_CAST(trim(order_date) AS DATE) IS NULL AND try_strptime(trim(order_date), '%Y/%m/%d') IS NULL
  AND try_strptime(trim(order_date), '%Y%m%d') IS NULL AND try_strptime(trim(order_date), '%m/%d/%Y') IS NULL"""


@register("invalid_dates_all", _INVALID_DATES_SQL)
@register("invalid_dates", _INVALID_DATES_SQL)
def q_invalid_dates(spark, sf_dir):
    """Q15 over the sheet of all orders, whatever their day (under both names that it has had)."""
    return AU.invalid_dates(td.raw_sheet_export(spark, sf_dir).select(
        F.col("訂單編號(從這邊貼上)").alias("order_sn"), F.col("訂單日期").alias("order_date")))


# ------------------------------------------------------------------ profile (Q16)
from ordersmith.operators.aggregates import null_counts  # noqa: E402
from ordersmith.operators.projections import column_types  # noqa: E402
from ordersmith.operators.windows import first_n, sample_n  # noqa: E402

_PROFILE_COLS = MASTER_COLUMNS + ["row_no"]


@register("profile_null_counts", with_master("\nUNION ALL\n".join(
    f"SELECT {i} AS position, '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nulls FROM master"
    for i, c in enumerate(_PROFILE_COLS))))
def q_profile_null_counts(spark, sf_dir):
    return null_counts(master(spark, sf_dir))


@register("profile_head", with_master(f"SELECT {_ALL} FROM master ORDER BY order_sn, row_no LIMIT 5"))
def q_profile_head(spark, sf_dir):
    return first_n(master(spark, sf_dir), 5, ["order_sn", "row_no"])


@register("profile_sample", with_master(f"""
SELECT {_ALL} FROM master ORDER BY md5(concat_ws('|', '7', order_sn, CAST(row_no AS VARCHAR))), order_sn, row_no LIMIT 5"""))
def q_profile_sample(spark, sf_dir):
    return sample_n(master(spark, sf_dir), 5, seed=7, columns=["order_sn", "row_no"])


_SPARK_NAMES = {"VARCHAR": "string", "DATE": "date", "TIMESTAMP": "timestamp_ntz", "DOUBLE": "double", "BIGINT": "bigint"}


@register("profile_column_types", with_master("\nUNION ALL\n".join(
    f"SELECT {i} AS position, '{c}' AS column_name, '{_SPARK_NAMES[duck_type(column_type(c))] if c != 'row_no' else 'bigint'}'"
    f" AS data_type, CAST(count({c}) AS BIGINT) AS non_nulls FROM master" for i, c in enumerate(_PROFILE_COLS))))
def q_profile_column_types(spark, sf_dir):
    return column_types(master(spark, sf_dir))


# --------------------------------------------------------- duplicate keys (Q17)
def _dup_inputs(spark, sf_dir):
    new = upsert_new(spark, sf_dir).withColumn(
        "product_sku_variation",
        F.when(F.col("return_quantity") > 0, F.lower("product_sku_variation")).otherwise(F.col("product_sku_variation")))
    return upsert_old(spark, sf_dir), new


def _vclass(x: str) -> str:
    return (f"CASE WHEN trim({x}) IS NULL OR trim({x}) = '' THEN 'blank' "
            f"WHEN regexp_matches(trim({x}), '^-?[0-9]+$') THEN 'integer' "
            f"WHEN regexp_matches(trim({x}), '^-?([0-9]+\\.[0-9]*|\\.[0-9]+)$') THEN 'decimal' ELSE 'text' END")


_DUP_CTE = _UPSERT_CTE + """,
new2 AS (SELECT * REPLACE (CASE WHEN return_quantity > 0 THEN lower(product_sku_variation)
                                ELSE product_sku_variation END AS product_sku_variation) FROM new),
span2 AS (SELECT min(order_date) AS lo, max(order_date) AS hi FROM new2),
od AS (SELECT * FROM old WHERE order_date BETWEEN (SELECT lo FROM span2) AND (SELECT hi FROM span2)),
ok AS (SELECT *, coalesce(trim(order_sn), '') AS k_sn,
              coalesce(CASE WHEN trim(product_sku_variation) <> '' THEN trim(product_sku_variation) END, 'NULL_SKU') AS k_sku,
              coalesce(trim(product_name), '') AS k_prod FROM od),
nk2 AS (SELECT *, coalesce(trim(order_sn), '') AS k_sn,
              coalesce(CASE WHEN trim(product_sku_variation) <> '' THEN trim(product_sku_variation) END, 'NULL_SKU') AS k_sku,
              coalesce(trim(product_name), '') AS k_prod FROM new2)
"""


@register("dup_key_reconciliation", _DUP_CTE + """
SELECT CASE WHEN o.k_sn IS NOT NULL AND n.k_sn IS NOT NULL THEN 'common'
            WHEN o.k_sn IS NOT NULL THEN 'only_old' ELSE 'only_new' END AS status, count(*) AS keys
FROM (SELECT DISTINCT k_sn, k_sku, k_prod FROM ok) o
FULL OUTER JOIN (SELECT DISTINCT k_sn, k_sku, k_prod FROM nk2) n
  ON o.k_sn = n.k_sn AND o.k_sku = n.k_sku AND o.k_prod = n.k_prod
GROUP BY 1""")
def q_dup_key_reconciliation(spark, sf_dir):
    return AU.duplicate_key_report(*_dup_inputs(spark, sf_dir)).reconciliation


@register("dup_key_disappeared", _DUP_CTE + """,
skus AS (SELECT k_sn, k_prod, list_sort(list_distinct(list(k_sku))) AS s FROM nk2 GROUP BY ALL)
SELECT o.order_sn, o.product_name, o.k_sku AS old_sku,
       array_to_string(list_filter(coalesce(s.s, []), lambda x: x <> o.k_sku), ';') AS new_skus_same_product, o.row_no
FROM ok o LEFT JOIN skus s ON s.k_sn = o.k_sn AND s.k_prod = o.k_prod
WHERE NOT EXISTS (SELECT 1 FROM nk2 n WHERE n.k_sn = o.k_sn AND n.k_sku = o.k_sku AND n.k_prod = o.k_prod)""")
def q_dup_key_disappeared(spark, sf_dir):
    return AU.duplicate_key_report(*_dup_inputs(spark, sf_dir)).disappeared


@register("dup_key_sku_classes", _DUP_CTE + f"""
SELECT 'old' AS side, {_vclass('product_sku_variation')} AS value_class, CAST(count(*) AS BIGINT) AS rows FROM od GROUP BY 1, 2
UNION ALL
SELECT 'new', {_vclass('product_sku_variation')}, CAST(count(*) AS BIGINT) FROM new2 GROUP BY 1, 2""")
def q_dup_key_sku_classes(spark, sf_dir):
    return AU.duplicate_key_report(*_dup_inputs(spark, sf_dir)).sku_classes


# ============================================================ vouchers (Q13)
from ordersmith.plans import vouchers as V  # noqa: E402

VOUCHER_START, VOUCHER_END = "1998-01-01", "1999-12-31"


def _voucher(spark, sf_dir):
    return V.voucher_usage(master(spark, sf_dir), VOUCHER_START, VOUCHER_END)


def _pct_sql(part: str, whole: str) -> str:
    return f"round(CASE WHEN {whole} <> 0 THEN CAST({part} AS DOUBLE) / {whole} * 100.0 END, 4)"


_VOUCHER_CTE = with_master(f""",
firsts AS ({_first_rows_sql(['*'])}),
ord AS (SELECT * FROM firsts WHERE order_date BETWEEN DATE '{VOUCHER_START}' AND DATE '{VOUCHER_END}'),
lng AS (SELECT order_sn, 'seller_voucher' AS voucher_column, seller_voucher AS raw0 FROM ord
        UNION ALL SELECT order_sn, 'voucher', voucher FROM ord),
lv AS (SELECT order_sn, voucher_column,
              CASE WHEN raw0 IS NULL OR raw0 IN ('nan', 'NaN', 'None') OR trim(raw0) = '' THEN NULL ELSE raw0 END AS raw
       FROM lng),
la AS (SELECT *, CASE WHEN isnan(TRY_CAST(raw AS DOUBLE)) THEN NULL ELSE TRY_CAST(raw AS DOUBLE) END AS amount FROM lv)
""".replace("SELECT * FROM (SELECT *, row_number()", "SELECT * EXCLUDE (__rn) FROM (SELECT *, row_number()"))


@register("voucher_classes", _VOUCHER_CTE + f"""
SELECT voucher_column, orders, used, unused, null_or_invalid,
       {_pct_sql('used', 'orders')} AS used_pct, {_pct_sql('unused', 'orders')} AS unused_pct,
       {_pct_sql('null_or_invalid', 'orders')} AS null_or_invalid_pct
FROM (SELECT voucher_column, CAST(count(*) AS BIGINT) AS orders,
             CAST(count(*) FILTER (WHERE amount > 0) AS BIGINT) AS used,
             CAST(count(*) FILTER (WHERE amount = 0) AS BIGINT) AS unused,
             CAST(count(*) FILTER (WHERE amount IS NULL) AS BIGINT) AS null_or_invalid
      FROM la GROUP BY voucher_column)""")
def q_voucher_classes(spark, sf_dir):
    return _voucher(spark, sf_dir).classes


@register("voucher_used_stats", _VOUCHER_CTE + """
SELECT voucher_column, min(amount) AS min_amount, max(amount) AS max_amount, round(avg(amount), 4) AS mean_amount,
       round(median(amount), 4) AS median_amount, round(sum(amount), 4) AS total_amount
FROM la WHERE amount > 0 GROUP BY voucher_column""")
def q_voucher_used_stats(spark, sf_dir):
    return _voucher(spark, sf_dir).used_stats


_BIN_CASE = ("CASE WHEN amount >= 0 AND amount < 10 THEN {a} WHEN amount >= 10 AND amount < 25 THEN {b} "
             "WHEN amount >= 25 AND amount < 50 THEN {c} WHEN amount >= 50 AND amount < 100 THEN {d} "
             "WHEN amount >= 100 AND amount < 200 THEN {e} WHEN amount >= 200 AND amount < 500 THEN {f} "
             "WHEN amount >= 500 THEN {g} END")
_BIN_LABEL = _BIN_CASE.format(a="'0-10'", b="'10-25'", c="'25-50'", d="'50-100'", e="'100-200'", f="'200-500'", g="'500+'")
_BIN_LOWER = "CAST(" + _BIN_CASE.format(a="0", b="10", c="25", d="50", e="100", f="200", g="500") + " AS DOUBLE)"


@register("voucher_histogram", _VOUCHER_CTE + f"""
SELECT h.voucher_column, bin, bin_lower, orders, {_pct_sql('orders', 'u.used')} AS pct
FROM (SELECT voucher_column, {_BIN_LOWER} AS bin_lower, {_BIN_LABEL} AS bin, CAST(count(*) AS BIGINT) AS orders
      FROM la WHERE amount > 0 GROUP BY ALL) h
JOIN (SELECT voucher_column, count(*) AS used FROM la WHERE amount > 0 GROUP BY voucher_column) u USING (voucher_column)""")
def q_voucher_histogram(spark, sf_dir):
    return _voucher(spark, sf_dir).histogram


@register("voucher_top_values", _VOUCHER_CTE + """
SELECT * FROM (SELECT voucher_column, raw, orders,
                      row_number() OVER (PARTITION BY voucher_column ORDER BY orders DESC, raw) AS rank
               FROM (SELECT voucher_column, raw, CAST(count(*) AS BIGINT) AS orders FROM la
                     WHERE raw IS NOT NULL GROUP BY ALL)) WHERE rank <= 10""")
def q_voucher_top_values(spark, sf_dir):
    return _voucher(spark, sf_dir).top_values


@register("voucher_invalid_values", _VOUCHER_CTE + """
SELECT voucher_column, raw, CAST(count(*) AS BIGINT) AS orders FROM la
WHERE raw IS NOT NULL AND amount IS NULL GROUP BY ALL""")
def q_voucher_invalid_values(spark, sf_dir):
    return _voucher(spark, sf_dir).invalid_values


@register("voucher_summary", _VOUCHER_CTE + f"""
SELECT voucher_column, used, {_pct_sql('used', 'n')} AS usage_rate_pct, mean_used_amount
FROM (SELECT voucher_column, CAST(count(*) FILTER (WHERE amount > 0) AS BIGINT) AS used, count(*) AS n,
             round(avg(CASE WHEN amount > 0 THEN amount END), 2) AS mean_used_amount
      FROM la GROUP BY voucher_column)""")
def q_voucher_summary(spark, sf_dir):
    return _voucher(spark, sf_dir).summary


@register("voucher_steps", _VOUCHER_CTE + """
SELECT 'input_lines' AS step, CAST(count(*) AS BIGINT) AS rows FROM master
UNION ALL SELECT 'orders', CAST(count(*) AS BIGINT) FROM firsts
UNION ALL SELECT 'orders_in_range', CAST(count(*) AS BIGINT) FROM ord""")
def q_voucher_steps(spark, sf_dir):
    return _voucher(spark, sf_dir).steps


# ============================================================ recent orders (Q14)
from ordersmith.plans.recent import recent_orders  # noqa: E402

RECENT_AS_OF, RECENT_DAYS = "2001-08-01", 30


@register("recent_orders", with_master(f"""
SELECT {_ALL} FROM master WHERE order_date BETWEEN DATE '{RECENT_AS_OF}' - {RECENT_DAYS - 1} AND DATE '{RECENT_AS_OF}'"""))
def q_recent_orders(spark, sf_dir):
    return recent_orders(master(spark, sf_dir), RECENT_AS_OF, RECENT_DAYS)


@register("recent_order_summary", ORACLES["order_summary"].replace(
    "FROM master GROUP BY order_sn",
    f"FROM master GROUP BY order_sn HAVING first(order_date ORDER BY row_no) BETWEEN DATE '{RECENT_AS_OF}' - {RECENT_DAYS - 1} "
    f"AND DATE '{RECENT_AS_OF}'"))
def q_recent_order_summary(spark, sf_dir):
    return recent_orders(marts.order_summary(master(spark, sf_dir)), RECENT_AS_OF, RECENT_DAYS)


# ============================================================ publish (Q19)
from ordersmith.plans.publish import publish  # noqa: E402

PUBLISH_DATABASE = "ordersmith_marts"


@register("publish_marts", with_master(", o AS (SELECT count(DISTINCT order_sn) AS n FROM master)" + """
SELECT 'b01_orders_concat' AS "table", 'success' AS status, CAST(n AS BIGINT) AS rows, true AS has_bytes FROM o
UNION ALL SELECT 'b02_order_details', 'success', (SELECT count(*) FROM master), true
UNION ALL SELECT 'b03_order_simple_details', 'success', n, true FROM o
UNION ALL SELECT 'b04_order_shipping_info', 'success', n, true FROM o
UNION ALL SELECT 'b05_not_exported', 'skipped', 0, false"""))
def q_publish_marts(spark, sf_dir):
    """Writes the four marts as catalog tables and returns the load manifest. The master is made once for all of them."""
    run = _fresh_folder(spark, "marts")
    m = staged(master(spark, sf_dir), run)
    manifest = publish(spark, {"b01_orders_concat": marts.order_summary(m),
                           "b02_order_details": marts.order_details(m),
                           "b03_order_simple_details": marts.order_headers(m),
                           "b04_order_shipping_info": marts.order_shipping(m),
                           "b05_not_exported": None}, PUBLISH_DATABASE)
    remove_path(spark, run)
    return manifest.select("table", "status", "rows", (F.col("bytes") > 0).alias("has_bytes"))


@register("published_summary", ORACLES["order_summary"])
def q_published_summary(spark, sf_dir):
    """The order summary as the catalog has it after it has been published."""
    publish(spark, {"b01_orders_published": marts.order_summary(master(spark, sf_dir))}, PUBLISH_DATABASE)
    return spark.table(f"{PUBLISH_DATABASE}.b01_orders_published")


# ------------------------------------------------------------ parse statistics
@register("clean_parse_stats", f"""
SELECT shop_name, CAST(count(*) AS BIGINT) AS rows, CAST(count(order_date) AS BIGINT) AS dated_rows,
       CAST(count(order_creation_timestamp) AS BIGINT) AS timestamped_rows
FROM ({ORACLES['clean_orders']}) t GROUP BY shop_name""")
def q_clean_parse_stats(spark, sf_dir):
    """Per shop, rows and how many got a parsed order date / creation time."""
    return C.parse_statistics(C.clean_orders(td.raw_order_exports(spark, sf_dir), as_of=AS_OF).rows)


# ============================================================ streaming ingest (S16 + Q3 + Q1)
# lines of an order in the order of their places in the file
_PLACED = "SELECT * EXCLUDE (row_no) REPLACE (nullif(voucher, '') AS voucher), row_no AS line_no"


def _line_no(df):
    """Stored lines with their number in the order by ``row_no``, which is a place in a file."""
    from pyspark.sql import Window
    return df.withColumn("line_no", F.row_number().over(Window.partitionBy("order_sn").orderBy("row_no")).cast("bigint")).drop("row_no")


TURNS = 4               # in which a query makes lines that it writes aside, each turn freeing its shuffles


def _made_in_turns(spark, lines, folder: str):
    """``lines((i, n))`` of all turns, each written once below ``folder``."""
    from ordersmith.session import staged
    schema = [staged(lines((i, TURNS)), f"{folder}/{i}").schema for i in range(TURNS)][0]
    return spark.read.schema(schema).parquet(*[f"{folder}/{i}" for i in range(TURNS)])


def _write_exports(spark, sf_dir, folder: str) -> list[str]:
    """One packed part an export, its lines by order and line number, in a folder ``file_name=<export>``; the headers."""
    from ordersmith.session import freed_shuffles, remove_path
    sn, lines = F.col(td.raw_source("order_sn")), f"{folder}-lines"
    raw = _made_in_turns(spark, lambda turn: td.raw_order_exports(spark, sf_dir, turn), lines)
    for i in range(TURNS):
        parts = raw.filter(F.pmod(F.hash("file_name"), F.lit(TURNS)) == i).repartition("file_name")
        with freed_shuffles(spark):
            (parts.sortWithinPartitions("file_name", sn, "row_no").drop("row_no").write.mode("append")
             .option("header", True).option("compression", "gzip").partitionBy("file_name").csv(folder))
    remove_path(spark, lines)
    return [c for c in raw.columns if c not in ("file_name", "row_no")]


@register("dropfolder_ingest", f"{_PLACED} FROM ({ORACLES['clean_orders']}) t")
def q_dropfolder_ingest(spark, sf_dir):
    """The export lines land as CSV files in a fresh inbox (one folder per
    export file, named ``file_name=<export name>``); the drop-folder stream
    cleans and upserts them into a stored master; returns that master, its
    lines numbered by their places in the files."""
    import uuid
    from ordersmith.session import shared_path
    from ordersmith.sources.sinks import read_master
    from ordersmith.streaming.dropfolder import start_dropfolder_ingest
    run = shared_path(spark, "dropfolder-query", uuid.uuid4().hex)
    headers = _write_exports(spark, sf_dir, f"{run}/inbox")
    q = start_dropfolder_ingest(spark, f"{run}/inbox", headers, f"{run}/master", f"{run}/orphans",
                                f"{run}/archive", checkpoint_location=f"{run}/stream", as_of=AS_OF)
    q.awaitTermination()
    for done in ("inbox", "archive"):
        remove_path(spark, f"{run}/{done}")
    return _line_no(read_master(spark, f"{run}/master"))


def _named_files(spark, folder: str, to: str, wanted) -> None:
    """Move the one file of every ``file_name=<export>`` folder that is ``wanted`` to ``to``, under the export's name."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(to))
    for d in fs.listStatus(path(folder)):
        name = d.getPath().getName()
        if name.startswith("file_name=") and wanted(name[len("file_name="):]):
            for f in fs.listStatus(d.getPath()):
                if f.getPath().getName().startswith("part-"):
                    fs.rename(f.getPath(), path(f"{to}/{name[len('file_name='):].replace('.xlsx', '.csv.gz')}"))


_LATE_SHOP = "NATION_5"      # its export comes after the first run


@register("drop_ingest_ledger", f"SELECT t.*, CASE WHEN shop_name = '{_LATE_SHOP.replace('_', '-')}' THEN 'r2' ELSE 'r1' END AS run_id "
          f"FROM ({_PLACED.replace('AS voucher)', 'AS voucher, nullif(seller_voucher, ' + chr(39) + 'N/A' + chr(39) + ') AS seller_voucher)')} FROM ({ORACLES['clean_orders']}) c) t")
def q_drop_ingest_ledger(spark, sf_dir):
    """A drop is ingested, a file is added and the drop is ingested again, twice: all stored lines with their
    numbers by place in the file, and the run that the ledger has for their file."""
    import uuid
    from ordersmith.plans.drops import ingest_drop, read_ledger
    from ordersmith.session import shared_path
    from ordersmith.sources.sinks import read_master
    run = shared_path(spark, "drop-query", uuid.uuid4().hex)
    _write_exports(spark, sf_dir, f"{run}/written")
    late = _LATE_SHOP.replace("_", "-") + "_"
    for i, wanted in enumerate((lambda x: not x.startswith(late), lambda x: x.startswith(late), None), 1):
        if wanted is not None:
            _named_files(spark, f"{run}/written", f"{run}/inbox", wanted)
        ingest_drop(spark, f"{run}/inbox", f"{run}/master", f"{run}/ledger", f"{run}/orphans", run_id=f"r{i}", as_of=AS_OF,
                    run_ts=RUN_TS, glob="*.csv.gz")
    for done in ("inbox", "orphans"):
        remove_path(spark, f"{run}/{done}")
    name = F.element_at(F.split("file_path", "/"), -1)
    runs = read_ledger(spark, f"{run}/ledger").filter("state = 'committed'").select(
        F.substring_index(name, "_", 1).alias("shop_name"), "run_id")
    return _line_no(read_master(spark, f"{run}/master")).join(runs, "shop_name", "left")


# ============================================================ stored upsert
import uuid  # noqa: E402

from ordersmith.session import remove_path, shared_path, staged  # noqa: E402
from ordersmith.sources import readers, sinks  # noqa: E402

_UPSERTED_SQL = f"SELECT {_ALL} FROM old_c WHERE NOT (in_span AND hit) UNION ALL SELECT {_ALL} FROM new"


def _fresh_folder(spark, tag: str) -> str:
    return shared_path(spark, "ordersmith-query", f"{tag}-{uuid.uuid4().hex}")


@register("upsert_stored", _UPSERT_CTE + _UPSERTED_SQL)
def q_upsert_stored(spark, sf_dir):
    """The old snapshot stored, the new one upserted into it twice under one run id; the stored master."""
    run = _fresh_folder(spark, "upsert")
    sinks.upsert_into(spark, f"{run}/master", upsert_old(spark, sf_dir), run_id="load")
    for _ in range(2):
        sinks.upsert_into(spark, f"{run}/master", upsert_new(spark, sf_dir), f"{run}/orphans", run_id="r1", run_ts=RUN_TS)
    return sinks.read_master(spark, f"{run}/master")


# A small daily batch: every 50th order number of the new export.
_SPARSE_CTE = _UPSERT_CTE.replace("new AS (SELECT * FROM m_new WHERE",
                                  "new AS (SELECT * FROM m_new WHERE CAST(substr(order_sn, 7) AS BIGINT) % 50 = 0 AND")
assert _SPARSE_CTE != _UPSERT_CTE


def _sparse_batch(spark, sf_dir):
    return upsert_new(spark, sf_dir).filter(F.substr("order_sn", F.lit(7)).cast("bigint") % 50 == 0)


def _upsert_sparse(spark, sf_dir, drop_orphans: bool) -> str:
    run = _fresh_folder(spark, "sparse")
    sinks.upsert_into(spark, f"{run}/master", upsert_old(spark, sf_dir), run_id="load")
    for _ in range(2):
        sinks.upsert_into(spark, f"{run}/master", _sparse_batch(spark, sf_dir), f"{run}/orphans", run_id="r1",
                          run_ts=RUN_TS, drop_orphans=drop_orphans)
    return run


@register("upsert_stored_sparse", _SPARSE_CTE + _UPSERTED_SQL)
def q_upsert_stored_sparse(spark, sf_dir):
    """A small batch upserted twice into the stored old snapshot: only its own days are written; all stored lines."""
    return sinks.read_master(spark, f"{_upsert_sparse(spark, sf_dir, False)}/master")


@register("upsert_stored_drop_orphans", _SPARSE_CTE + f"""
SELECT {_ALL} FROM old_c WHERE NOT in_span UNION ALL SELECT {_ALL} FROM new""")
def q_upsert_stored_drop_orphans(spark, sf_dir):
    """The same batch with ``drop_orphans``: vanished orders leave the stored master, days of nothing else with them."""
    return sinks.read_master(spark, f"{_upsert_sparse(spark, sf_dir, True)}/master")


@register("orphan_log_dropped", _SPARSE_CTE + f"""
SELECT {_ALL}, TIMESTAMP '{RUN_TS}' AS orphaned_timestamp FROM old_c WHERE in_span AND NOT hit""")
def q_orphan_log_dropped(spark, sf_dir):
    """The orphan log of that run: it keeps the lines that the master no longer has, whole."""
    return spark.read.parquet(f"{_upsert_sparse(spark, sf_dir, True)}/orphans").drop("run_id")


@register("upsert_empty_batch", _UPSERT_CTE + f"SELECT {_ALL} FROM old")
def q_upsert_empty_batch(spark, sf_dir):
    """A batch without rows leaves the stored master and its log as they are."""
    run = _fresh_folder(spark, "empty")
    sinks.upsert_into(spark, f"{run}/master", upsert_old(spark, sf_dir), run_id="load")
    sinks.upsert_into(spark, f"{run}/master", upsert_new(spark, sf_dir).filter("order_status = 'no such status'"),
                      f"{run}/orphans", run_id="r1", run_ts=RUN_TS)
    return sinks.read_master(spark, f"{run}/master")


_UNDATED_COLS = ", ".join(f"CASE WHEN order_status = 'P' THEN NULL ELSE order_date END AS {c}" if c == "order_date"
                          else (f"quantity + CASE WHEN order_status = 'P' THEN 0 ELSE 1 END AS {c}" if c == "quantity" else c)
                          for c in MASTER_COLUMNS + ["row_no"])


@register("upsert_undated_rerun", f"""WITH ol AS ({td.ORDER_LINES_SQL}),
master AS ({master_select_sql(OLD_AS_OF)})
SELECT {_UNDATED_COLS} FROM master""")
def q_upsert_undated_rerun(spark, sf_dir):
    """Pending orders have no date; their batch replaces the stored undated lines, and running it again adds none."""
    run = _fresh_folder(spark, "undated")
    m = td.order_master(spark, sf_dir, OLD_AS_OF).withColumn(
        "order_date", F.when(F.col("order_status") != "P", F.col("order_date")))
    sinks.upsert_into(spark, f"{run}/master", m.withColumn("quantity", F.col("quantity") + 1), run_id="load")
    for i in range(2):
        sinks.upsert_into(spark, f"{run}/master", m.filter("order_status = 'P'"), run_id=f"r{i}")
    return sinks.read_master(spark, f"{run}/master")


@register("orphan_log_two_runs", _UPSERT_CTE + f""",
m1 AS ({_UPSERTED_SQL}),
b2 AS (SELECT * FROM new WHERE order_status = 'O'),
s2 AS (SELECT min(order_date) AS lo, max(order_date) AS hi FROM b2)
SELECT 'r1' AS run_id, order_sn, row_no FROM old_c WHERE in_span AND NOT hit
UNION ALL
SELECT 'r2', order_sn, row_no FROM m1 WHERE order_date BETWEEN (SELECT lo FROM s2) AND (SELECT hi FROM s2)
  AND NOT EXISTS (SELECT 1 FROM b2 WHERE b2.order_date = m1.order_date AND b2.order_sn = m1.order_sn
                  AND b2.buyer_username = m1.buyer_username)""")
def q_orphan_log_two_runs(spark, sf_dir):
    """Two batches with run ids of their own: the log keeps both runs."""
    run = _fresh_folder(spark, "orphans")
    old = _made_in_turns(spark, lambda turn: upsert_old(spark, sf_dir, turn), f"{run}/old")
    sinks.upsert_into(spark, f"{run}/master", old, run_id="load")
    remove_path(spark, f"{run}/old")
    new = _made_in_turns(spark, lambda turn: upsert_new(spark, sf_dir, turn), f"{run}/new")
    for run_id, batch in (("r1", new), ("r2", new.filter("order_status = 'O'"))):
        sinks.upsert_into(spark, f"{run}/master", batch, f"{run}/orphans", run_id=run_id, run_ts=RUN_TS)
    for done in ("new", "master"):
        remove_path(spark, f"{run}/{done}")
    return spark.read.parquet(f"{run}/orphans").select("run_id", "order_sn", "row_no")


# ============================================================ semi join (J2, U4), edge rows
@register("returned_orders", with_master(f"""
SELECT {_ALL} FROM master m WHERE EXISTS (SELECT 1 FROM master r WHERE r.return_quantity > 0
  AND r.order_date IS NOT DISTINCT FROM m.order_date AND r.order_sn IS NOT DISTINCT FROM m.order_sn
  AND r.buyer_username IS NOT DISTINCT FROM m.buyer_username)"""))
def q_returned_orders(spark, sf_dir):
    """All lines of orders with a returned line."""
    from ordersmith.operators.joins import semi_join
    m = master(spark, sf_dir)
    return semi_join(m, m.filter("return_quantity > 0"), ["order_date", "order_sn", "buyer_username"])


@register("order_summary_blank_numbers", f"""WITH ol AS ({td.ORDER_LINES_SQL}),
m0 AS ({master_select_sql(AS_OF)}),
master AS (SELECT * REPLACE (CASE WHEN order_status = 'P' THEN '' ELSE order_sn END AS order_sn,
             row_number() OVER (ORDER BY order_sn, row_no) AS row_no) FROM m0)
SELECT order_sn, first(order_date ORDER BY row_no) AS order_date,
  {_ordered_join_sql('product_name')} AS product_name_list,
  CAST(sum(quantity) AS BIGINT) AS total_quantity
FROM master GROUP BY order_sn""")
def q_order_summary_blank_numbers(spark, sf_dir):
    """Pending lines have a null or an empty order number: one group, with its lists."""
    m = _blank_numbers(spark, sf_dir, *SUMMARY_FIRST_COLUMNS, "product_name", "product_sku_main", "quantity")
    return marts.order_summary(m).select("order_sn", "order_date", "product_name_list", "total_quantity")


CHUNK_LINES = 500       # so that the group of pending lines has many chunks


@register("order_product_lists", f"""WITH ol AS ({td.ORDER_LINES_SQL}),
m0 AS ({master_select_sql(AS_OF)}),
master AS (SELECT * REPLACE (CASE WHEN order_status = 'P' THEN '' ELSE order_sn END AS order_sn,
             row_number() OVER (ORDER BY order_sn, row_no) AS row_no) FROM m0),
placed AS (SELECT *, (row_number() OVER (PARTITION BY order_sn ORDER BY row_no) - 1) // {CHUNK_LINES} AS chunk FROM master)
SELECT order_sn, CAST(chunk AS BIGINT) AS chunk, CAST(count(*) AS BIGINT) AS lines,
  {_ordered_join_sql('product_name')} AS product_name_list, {_ordered_join_sql('product_sku_main')} AS product_sku_main_list
FROM placed GROUP BY order_sn, chunk""")
def q_order_product_lists(spark, sf_dir):
    """Lists of all groups, the pending lines' one in many chunks."""
    return marts.order_product_lists(
        _blank_numbers(spark, sf_dir, "product_name", "product_sku_main"), list_lines=CHUNK_LINES)


@register("order_product_lists_joined", f"""WITH ol AS ({td.ORDER_LINES_SQL}),
m0 AS ({master_select_sql(AS_OF)}),
master AS (SELECT * REPLACE (CASE WHEN order_status = 'P' THEN '' ELSE order_sn END AS order_sn,
             row_number() OVER (ORDER BY order_sn, row_no) AS row_no) FROM m0)
SELECT order_sn, {_ordered_join_sql('product_name')} AS product_name_list,
       {_ordered_join_sql('product_sku_main')} AS product_sku_main_list
FROM master GROUP BY order_sn""")
def q_order_product_lists_joined(spark, sf_dir):
    """The chunks put together again (here each group fits): the whole lists of all groups."""
    chunks = marts.order_product_lists(
        _blank_numbers(spark, sf_dir, "product_name", "product_sku_main"), list_lines=CHUNK_LINES)
    return chunks.groupBy("order_sn").agg(*[
        marts.ordered_join(c, "chunk").alias(c) for c in ("product_name_list", "product_sku_main_list")])


def _blank_numbers(spark, sf_dir, *columns):
    """The master's ``columns`` beside number, place and status, numbered over all orders; pending lines have a null or
    an empty number. The lines are made once, for counts and numbering."""
    from pyspark.sql import Window
    m = staged(master(spark, sf_dir).select(*dict.fromkeys(
        ["order_sn", "row_no", "order_status", "return_quantity", *columns])))
    # one numbering over all lines, from per-order counts, so that the first blank line is the same everywhere
    counts = m.groupBy("order_sn").agg(F.count(F.lit(1)).alias("n"))
    base = counts.repartitionByRange("order_sn").select("order_sn", "n", F.spark_partition_id().alias("part"))
    base = base.checkpoint(eager=True)
    parts = base.groupBy("part").agg(F.sum("n").alias("pn"))
    parts = parts.withColumn("before", F.coalesce(F.sum("pn").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("part", "before")
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("part").orderBy("order_sn").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    start = base.withColumn("inside", inside).join(parts, "part").select(
        "order_sn", (F.col("before") + F.col("inside")).alias("start"))
    m = m.join(start, "order_sn").withColumn("row_no", F.col("start") + F.col("row_no")).drop("start")
    blank = F.when(F.col("return_quantity") > 0, F.lit("")).otherwise(F.lit(None).cast("string"))
    return m.withColumn("order_sn", F.when(F.col("order_status") == "P", blank).otherwise(F.col("order_sn")))


@register("unnumbered_lines", f"""WITH ol AS ({td.ORDER_LINES_SQL}),
m0 AS ({master_select_sql(AS_OF)}),
master AS (SELECT * REPLACE (CASE WHEN order_status = 'P' THEN '' ELSE order_sn END AS order_sn,
             row_number() OVER (ORDER BY order_sn, row_no) AS row_no) FROM m0)
SELECT row_no, order_date, shop_name, buyer_username, product_name, product_sku_main, quantity, return_quantity
FROM master WHERE order_sn = '' ORDER BY row_no""")
def q_unnumbered_lines(spark, sf_dir):
    """The lines of the blank group of ``order_summary_blank_numbers``, one a row."""
    columns = ["row_no", "order_date", "shop_name", "buyer_username", "product_name", "product_sku_main", "quantity",
               "return_quantity"]
    return marts.unnumbered_lines(_blank_numbers(spark, sf_dir, *columns)).select(*columns).orderBy("row_no")


@register("date_gaps_text", with_master(f"""
SELECT shop_name, last_order_date, next_order_date, CAST(gap AS BIGINT) AS gap_days, CAST(gap - 1 AS BIGINT) AS missing_days
FROM (SELECT shop_name, lag(d) OVER (PARTITION BY shop_name ORDER BY d) AS last_order_date, d AS next_order_date,
             date_diff('day', lag(d) OVER (PARTITION BY shop_name ORDER BY d), d) AS gap
      FROM (SELECT DISTINCT shop_name, order_date AS d FROM master WHERE order_status <> 'P'))
WHERE gap > {GAP_DAYS}"""))
def q_date_gaps_text(spark, sf_dir):
    """Gaps over a text date column in two layouts, with text that is no date."""
    m = master(spark, sf_dir)
    text = (F.when(F.col("order_status") == "P", "no date").when(F.col("order_status") == "F",
            F.date_format("order_date", "yyyy/MM/dd")).otherwise(F.date_format("order_date", "yyyyMMdd")))
    return AU.date_gaps(m.withColumn("order_date", text), GAP_DAYS)


@register("clean_dirty_cells", f"""WITH ol AS ({td.ORDER_LINES_SQL})
SELECT order_sn, row_no, replace(product_name, ' ', ' ') AS name, CAST(quantity AS DOUBLE) / 100.0 AS rate,
       CASE WHEN order_status = 'P' THEN NULL ELSE quantity END AS whole, CAST(quantity AS DOUBLE) AS money,
       CASE WHEN order_status = 'P' THEN NULL ELSE CAST(order_creation_timestamp AS TIMESTAMP) END AS made,
       -- the first six of 2001MMDD read as 20-01-MM
       CASE WHEN year(order_date) = 2001 THEN make_date(2020, 1, month(order_date)) ELSE order_date END AS day8, CASE WHEN order_status = 'P' THEN NULL ELSE order_status END AS status
FROM ol""")
def q_clean_dirty_cells(spark, sf_dir):
    """X1-X5, X7, X8 on cells made dirty from the tables' own columns."""
    from ordersmith.functions import scalars as X
    ol = td.order_lines(spark, sf_dir)
    q, pending = F.col("quantity").cast("string"), F.col("order_status") == "P"
    raw = ol.select(
        "order_sn", "row_no", F.regexp_replace("product_name", " ", "\n\r").alias("name"),
        F.concat(q, F.lit("%")).alias("rate"), F.when(pending, F.concat(q, F.lit(".5"))).otherwise(F.concat(q, F.lit(".0"))).alias("whole"),
        F.concat(F.lit("NT$"), q, F.lit(" ")).alias("money"),
        F.when(pending, F.date_format("order_creation_timestamp", "yyyy-MM-dd'T'HH:mm:ss'+08:00'"))
         .otherwise(F.date_format("order_creation_timestamp", "yyyy/MM/dd HH:mm:ss")).alias("made"),
        F.concat(F.date_format("order_date", "yyyyMMdd"), F.lit("X")).alias("sn8"),
        F.when(pending, "nan").otherwise(F.col("order_status")).alias("status"))
    typed = raw.select("order_sn", "row_no", X.strip_newlines("name").alias("name"), X.percent_to_fraction("rate").alias("rate"),
                       X.to_nullable_long("whole").alias("whole"), X.currency_to_double("money").alias("money"),
                       X.to_timestamp_tolerant("made").alias("made"), "sn8", X.null_tokens_to("status").alias("status"))
    return X.with_order_date_from_sn(typed, "sn8", "day8").drop("sn8")


# ============================================================ CSV drops of several layouts
def _csv_drop(spark, sf_dir):
    """The export lines as CSV folders, one a shop: pending orders in an older layout (another rate header, no return
    column), open ones with an unknown column, and returned lines a second time in files without order numbers.

    The lines are made once for all layouts, and every task writes its own files of a shop: no line moves for that, and
    a large shop is dealt over the tasks. A task keeps the files of up to 64 shops open, and so needn't sort its lines."""
    run = _fresh_folder(spark, "csv")
    raw = td.raw_order_exports(spark, sf_dir).drop("row_no").withColumnRenamed("file_name", "export")
    lines = _fresh_folder(spark, "csv-lines")
    raw = staged(raw, lines)
    status = F.col(td.raw_source("order_status"))
    sn, back = td.raw_source("order_sn"), td.raw_source("return_quantity")
    rate = F.concat(F.col(td.raw_source("quantity")), F.lit("%"))
    parts = {"old": raw.filter(status == "P").drop(back).withColumn("金流處理費率", rate),
             "open": raw.filter(status == "O").withColumn("店員", F.lit("A")).withColumn("金流與系統處理費率", rate),
             "done": raw.filter(status == "F"), "bad": raw.filter(F.col(back) != "0").drop(sn)}
    writers = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(writers)
    spark.conf.set(writers, "64")
    try:
        for name, df in parts.items():
            df.write.option("header", True).partitionBy("export").csv(f"{run}/{name}")
    finally:
        spark.conf.set(writers, before)
    remove_path(spark, lines)
    return readers.scan_order_exports(spark, f"{run}/*/*", glob="*.csv")


@register("csv_ingest_mixed_layouts", f"""WITH ol AS ({td.ORDER_LINES_SQL})
SELECT order_sn, order_status AS status, CAST(quantity AS VARCHAR) AS quantity,
       CASE WHEN order_status = 'P' THEN NULL ELSE CAST(return_quantity AS VARCHAR) END AS returned,
       CASE WHEN order_status = 'F' THEN NULL ELSE CAST(quantity AS VARCHAR) || '%' END AS rate,
       CASE WHEN seller_voucher = 'N/A' THEN NULL ELSE seller_voucher END AS seller_voucher,
       CASE WHEN voucher = '' THEN NULL ELSE voucher END AS voucher
FROM ol""")
def q_csv_ingest_mixed_layouts(spark, sf_dir):
    from ordersmith.operators.projections import clean_headers, rename_columns
    from ordersmith.schema import ORDER_EXPORT_HEADERS
    rows = rename_columns(clean_headers(_csv_drop(spark, sf_dir).rows), ORDER_EXPORT_HEADERS)
    return rows.select("order_sn", F.col("order_status").alias("status"), "quantity", F.col("return_quantity").alias("returned"),
                       F.col("payment_processing_fee_rate").alias("rate"), "seller_voucher", "voucher")


_EXPORT_NAME = "replace(shop_name, '_', '-') || '_' || shop_account || '_Order.all.19950101_20011231.xlsx'"


@register("csv_ingest_files", f"""WITH ol AS ({td.ORDER_LINES_SQL}),
-- cells of a line: of every export, without the returns, with the clerk and the rate, without the number
l AS (SELECT {_EXPORT_NAME} AS export, order_status, return_quantity, 14 AS cells FROM ol)
SELECT DISTINCT 'old' AS folder, export, 'accepted' AS status, cells AS columns, '' AS missing, '' AS unmapped
FROM l WHERE order_status = 'P'
UNION ALL SELECT DISTINCT 'open', export, 'accepted', cells + 2, '', '店員' FROM l WHERE order_status = 'O'
UNION ALL SELECT DISTINCT 'done', export, 'accepted', cells, '', '' FROM l WHERE order_status = 'F'
UNION ALL SELECT DISTINCT 'bad', export, 'rejected', cells - 1, 'order_sn', '' FROM l WHERE return_quantity <> 0""")
def q_csv_ingest_files(spark, sf_dir):
    """The report of the drop, one row for every export of a layout: state, columns, missing and unknown ones."""
    place = F.split("file_path", "/")
    return _csv_drop(spark, sf_dir).files.select(
        F.element_at(place, -3).alias("folder"), F.regexp_replace(F.element_at(place, -2), "^export=", "").alias("export"),
        "status", "columns", "missing", "unmapped").distinct()


def _with_header(header: str):
    """Every part of a text begins with a header record."""
    import pyarrow as pa

    def run(batches):
        yield pa.record_batch([pa.array([header])], names=["value"])
        yield from batches
    return run


_HEADER_CELLS = ["order_sn", "order_status", "buyer_username", "product_name", "quantity", "return_quantity"]


def _headers_drop(spark, sf_dir):
    """The export lines as text whose headers no writer of tables makes: the quantity twice (pending orders), cells
    with line ends in header and lines (open ones), a plain layout, and a quote that is never closed (pending ones
    again)."""
    run = _fresh_folder(spark, "headers")
    raw = td.raw_order_exports(spark, sf_dir)
    names = [td.raw_source(c) for c in _HEADER_CELLS]
    status, quantity = F.col(names[1]), names[4]
    lines = raw.select(*names).withColumn(names[3], F.when(status == "O", F.regexp_replace(names[3], " ", "\n"))
                                          .otherwise(F.col(names[3])))
    broken = ",".join([f'"{names[0][:2]}\r\n{names[0][2:]}"', *names[1:]])
    parts = {"repeat": (lines.filter(status == "P").withColumn("again", F.lit("x")), ",".join([*names, quantity])),
             "broken": (lines.filter(status == "O"), broken), "plain": (lines.filter(status == "F"), ",".join(names)),
             "unclosed": (lines.filter(status == "P"), '"' + ",".join(names))}
    for name, (df, header) in parts.items():
        text = df.select(F.to_csv(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"escape": '"'}).alias("value"))
        text.mapInArrow(_with_header(header), "value string").write.text(f"{run}/{name}", lineSep="\n")
    return readers.scan_order_exports(spark, f"{run}/*", glob="part-*")


@register("csv_ingest_headers", f"""WITH ol AS ({td.ORDER_LINES_SQL})
SELECT order_sn, order_status, buyer_username,
       CASE WHEN order_status = 'O' THEN replace(product_name, ' ', chr(10)) ELSE product_name END AS product_name,
       CAST(quantity AS VARCHAR) AS quantity, CAST(return_quantity AS VARCHAR) AS return_quantity
FROM ol""")
def q_csv_ingest_headers(spark, sf_dir):
    """All lines of files with repeated and line-broken headers, beside a file whose header can't be read."""
    from ordersmith.operators.projections import rename_columns
    from ordersmith.schema import ORDER_EXPORT_HEADERS
    return rename_columns(_headers_drop(spark, sf_dir).rows, ORDER_EXPORT_HEADERS).select(*_HEADER_CELLS)


@register("csv_ingest_headers_files", f"""WITH ol AS ({td.ORDER_LINES_SQL}), n AS (SELECT DISTINCT order_status FROM ol)
SELECT 'repeat' AS folder, 'accepted' AS status, 7 AS columns, '' AS missing, '{td.raw_source("quantity")}' AS repeated
FROM n WHERE order_status = 'P'
UNION ALL SELECT 'broken', 'accepted', 6, '', '' FROM n WHERE order_status = 'O'
UNION ALL SELECT 'plain', 'accepted', 6, '', '' FROM n WHERE order_status = 'F'
UNION ALL SELECT 'unclosed', 'rejected', 0, 'order_sn', '' FROM n WHERE order_status = 'P'""")
def q_csv_ingest_headers_files(spark, sf_dir):
    """The report of that drop by layout."""
    files = _headers_drop(spark, sf_dir).files
    return files.select(F.element_at(F.split("file_path", "/"), -2).alias("folder"), "status", "columns", "missing",
                        "repeated").distinct()


# ============================================================ CSV with a byte-order mark
_MARKED_COLS = ["order_sn", "shop_name", "order_date", "product_name", "quantity", "total_amount_paid_by_buyer", "row_no"]


@register("csv_with_mark", with_master(f"SELECT {_cols(_MARKED_COLS)}, 'EFBBBF' AS mark FROM master"))
def q_csv_with_mark(spark, sf_dir):
    """The master's lines written as marked CSV files and read again, each with the first three bytes of its file."""
    run = _fresh_folder(spark, "marked")
    m = master(spark, sf_dir).select(*_MARKED_COLS)
    sinks.write_csv_with_mark(m, run)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(run).select(
        F.col("_metadata.file_name").alias("__file"), F.hex(F.substring("content", 1, 3)).alias("mark"))
    back = readers.read_csv_typed(spark, run, m.schema).select("*", F.col("_metadata.file_name").alias("__file"))
    return back.join(files, "__file", "left").drop("__file")


# ============================================================ inferred types, header and plain scans
def _plain_csv(spark, sf_dir) -> str:
    run = _fresh_folder(spark, "plain")
    raw = td.raw_order_exports(spark, sf_dir)
    day = F.col(td.raw_source("order_creation_timestamp")).substr(1, 10)
    status = F.col(td.raw_source("order_status"))
    raw = raw.drop("file_name", "row_no").withColumn("day", F.when(status == "P", F.lit("-")).otherwise(day)).withColumn(
        "day_or_time", F.when(status == "P", F.col(td.raw_source("order_creation_timestamp"))).otherwise(day)).withColumn(
        "count_or_rate", F.when(status == "P", F.lit("0.5")).otherwise(F.col(td.raw_source("quantity"))))
    sinks.write_overwrite(raw, run, "csv")
    return run


# column -> its text in the lines' own terms
_PLAIN_CELLS = {td.raw_source(c): x for c, x in [
    ("order_sn", "order_sn"), ("order_status", "order_status"), ("buyer_username", "buyer_username"),
    ("order_creation_timestamp", "strftime(order_creation_timestamp, '%Y-%m-%d %H:%M:%S')"),
    ("actual_shipping_timestamp", "strftime(actual_shipping_timestamp, '%Y-%m-%d %H:%M:%S')"),
    ("product_total_price", "product_total_price_raw"), ("total_amount_paid_by_buyer", "CAST(total_amount_paid_by_buyer AS VARCHAR)"),
    ("product_name", "product_name"), ("product_sku_main", "product_sku_main"), ("product_sku_variation", "product_sku_variation"),
    ("quantity", "CAST(quantity AS VARCHAR)"), ("return_quantity", "CAST(return_quantity AS VARCHAR)"),
    ("seller_voucher", "seller_voucher"), ("voucher", "voucher")]} | {
    "day": "CASE WHEN order_status = 'P' THEN '-' ELSE strftime(order_creation_timestamp, '%Y-%m-%d') END",
    "day_or_time": "CASE WHEN order_status = 'P' THEN strftime(order_creation_timestamp, '%Y-%m-%d %H:%M:%S') "
                   "ELSE strftime(order_creation_timestamp, '%Y-%m-%d') END",
    "count_or_rate": "CASE WHEN order_status = 'P' THEN '0.5' ELSE CAST(quantity AS VARCHAR) END"}


def _kind_sql(x: str) -> str:
    return (f"CASE WHEN trim({x}) = '' OR {x} IS NULL THEN NULL WHEN regexp_matches(trim({x}), '^[+-]?[0-9]{{1,18}}$') THEN 'integer' "
            f"WHEN TRY_CAST(trim({x}) AS DOUBLE) IS NOT NULL AND regexp_matches(trim({x}), '^[-+0-9.eE]+$') THEN 'decimal' "
            f"WHEN length(trim({x})) = 10 AND TRY_CAST(trim({x}) AS DATE) IS NOT NULL THEN 'date' "
            f"WHEN length(trim({x})) > 10 AND TRY_CAST(trim({x}) AS TIMESTAMP) IS NOT NULL THEN 'timestamp' ELSE 'text' END")


@register("csv_inferred_types", f"""WITH ol AS ({td.ORDER_LINES_SQL}),
cells AS ({" UNION ALL ".join(f"SELECT {i} AS position, '{c}' AS column_name, {_kind_sql(x)} AS kind FROM ol" for i, (c, x) in enumerate(_PLAIN_CELLS.items()))}),
n AS (SELECT position, column_name, count(kind) AS "values", count(*) FILTER (kind = 'integer') AS integers,
             count(*) FILTER (kind = 'decimal') AS decimals, count(*) FILTER (kind = 'date') AS dates,
             count(*) FILTER (kind = 'timestamp') AS timestamps, count(*) FILTER (kind = 'text') AS texts
      FROM cells GROUP BY ALL),
t AS (SELECT *, CASE WHEN texts > 0 OR "values" = 0 OR (integers + decimals > 0 AND dates + timestamps > 0) THEN 'text'
                     WHEN decimals > 0 THEN 'decimal' WHEN integers > 0 THEN 'integer' WHEN timestamps > 0 THEN 'timestamp'
                     ELSE 'date' END AS inferred FROM n)
SELECT *, CASE WHEN inferred = 'text' THEN texts + CASE WHEN integers + decimals > 0 AND dates + timestamps > 0
                 THEN least(integers + decimals, dates + timestamps) ELSE 0 END
               WHEN integers > 0 AND decimals > 0 THEN decimals WHEN dates > 0 AND timestamps > 0 THEN timestamps ELSE 0 END AS forced
FROM t""")
def q_csv_inferred_types(spark, sf_dir):
    """The kinds of all cells of a CSV export and the types that they give its columns."""
    return readers.infer_types(spark.read.option("header", True).csv(_plain_csv(spark, sf_dir)))


@register("csv_read_inferred", f"""WITH ol AS ({td.ORDER_LINES_SQL})
SELECT CAST(order_sn AS BIGINT) AS number, quantity, total_amount_paid_by_buyer AS paid, order_creation_timestamp AS created,
       CASE WHEN order_status = 'P' THEN order_creation_timestamp ELSE date_trunc('day', order_creation_timestamp) END AS day_or_time,
       CASE WHEN order_status = 'P' THEN 0.5 ELSE CAST(quantity AS DOUBLE) END AS rate, product_total_price_raw AS price
FROM ol""")
def q_csv_read_inferred(spark, sf_dir):
    """The lines of that export, read with the inferred types."""
    rows = readers.read_csv_inferred(spark, _plain_csv(spark, sf_dir))
    c = lambda name: F.col(f"`{td.raw_source(name)}`")
    return rows.select(c("order_sn").alias("number"), c("quantity").alias("quantity"), c("total_amount_paid_by_buyer").alias("paid"),
                       c("order_creation_timestamp").alias("created"), "day_or_time", F.col("count_or_rate").alias("rate"),
                       c("product_total_price").alias("price"))


@register("csv_header_columns", "\nUNION ALL\n".join(
    f"SELECT {i} AS position, '{c}' AS column_name" for i, c in enumerate(_PLAIN_CELLS)))
def q_csv_header_columns(spark, sf_dir):
    """The header of that export."""
    return readers.header_columns(spark, _plain_csv(spark, sf_dir))


@register("csv_keep_empty", f"""WITH ol AS ({td.ORDER_LINES_SQL})
SELECT order_sn, product_name, coalesce(seller_voucher, '') AS seller_voucher, voucher FROM ol""")
def q_csv_keep_empty(spark, sf_dir):
    """Empty cells stay empty text and 'N/A' stays as it is."""
    rows = readers.read_order_exports(spark, _plain_csv(spark, sf_dir), keep_empty=True)
    return rows.select(*[F.col(td.raw_source(c)).alias(c) for c in ("order_sn", "product_name", "seller_voucher", "voucher")])


@register("csv_plain", with_master(f"SELECT {_cols(_MARKED_COLS)} FROM master"))
def q_csv_plain(spark, sf_dir):
    """Lines written over an earlier CSV output, without a mark, and read again."""
    run = _fresh_folder(spark, "csv-plain")
    m = master(spark, sf_dir).select(*_MARKED_COLS)
    sinks.write_overwrite(m.limit(10), run, "csv")
    sinks.write_overwrite(m, run, "csv")
    return readers.read_csv_typed(spark, run, m.schema)


@register("report_written", ORACLES["date_gaps"])
def q_report_written(spark, sf_dir):
    """The gap report as its sink has it."""
    run = _fresh_folder(spark, "report")
    sinks.write_overwrite(AU.date_gaps(master(spark, sf_dir), GAP_DAYS), run)
    return spark.read.parquet(run)


# ============================================================ comments, date text, heavy tails
_COMMENTED = [c for c in MASTER_COLUMNS if c in _OL_COLUMNS]


@register("stored_comments", with_master("\nUNION ALL\n".join(
    "SELECT {} AS position, '{}' AS column_name, '{}' AS data_type, '{}' AS comment, CAST(count({}) AS BIGINT) AS non_nulls FROM master".format(
        i, c, _SPARK_NAMES[duck_type(column_type(c))], COLUMN_DESCRIPTIONS[c].replace("'", "''"), c) for i, c in enumerate(_COMMENTED))))
def q_stored_comments(spark, sf_dir):
    """Types, descriptions and number of values of a published table's columns, as the catalog and its data have them."""
    publish(spark, {"b00_commented": sinks.with_comments(master(spark, sf_dir).select(*_COMMENTED))}, PUBLISH_DATABASE)
    stored = spark.table(f"{PUBLISH_DATABASE}.b00_commented")
    named = spark.createDataFrame([(f.name, f.metadata.get("comment")) for f in stored.schema.fields], "column_name string, comment string")
    return column_types(stored).join(named, "column_name").select("position", "column_name", "data_type", "comment", "non_nulls")


@register("date_texts", with_master("""
SELECT order_sn, row_no, strftime(order_date, '%Y-%m-%d') AS day, strftime(actual_shipping_timestamp, '%Y/%m/%d %H:%M') AS shipped
FROM master"""))
def q_date_texts(spark, sf_dir):
    """Dates and times as text."""
    from ordersmith.functions import scalars as X
    return master(spark, sf_dir).select("order_sn", "row_no", X.day_text("order_date").alias("day"),
                                        X.minute_text("actual_shipping_timestamp").alias("shipped"))


@register("median_heavy_tail", with_master("""
SELECT shop_name, median(floor(total_amount_paid_by_buyer) * pow(10, quantity % 10)) AS median_amount
FROM master GROUP BY shop_name"""))
def q_median_heavy_tail(spark, sf_dir):
    """Exact medians of amounts over ten orders of magnitude, with bounds that hold few of each shop's rows."""
    amount = F.floor("total_amount_paid_by_buyer").cast("double") * F.pow(F.lit(10.0), F.col("quantity") % 10)
    lines = master(spark, sf_dir).select("shop_name", amount.alias("amount"))
    return V.grouped_median(lines, "shop_name", "amount", "median_amount", most=200)


@register("fuzzy_matches", """
WITH names AS (SELECT DISTINCT c_name AS r FROM customer),
l AS (SELECT DISTINCT 'Custmer' || substr(c_name, 9) AS l FROM customer WHERE c_custkey % 2 = 0
      UNION SELECT DISTINCT substr(c_name, 1, 9) || substr(c_name, 11) || 'x' FROM customer WHERE c_custkey % 2 = 1),
own AS (SELECT l, r, 1.0 - levenshtein(r, l) / greatest(length(l), length(r)) AS score FROM l JOIN names
        ON levenshtein(r, l) <= 2 OR 1.0 - levenshtein(r, l) / greatest(length(l), length(r)) >= 0.85),
best AS (SELECT *, row_number() OVER (PARTITION BY l ORDER BY score DESC, r DESC) AS n FROM own WHERE score >= 0.85)
SELECT l AS left_name, r AS right_name, round(score, 6) AS score FROM best WHERE n = 1""")
def q_fuzzy_matches(spark, sf_dir):
    """J9 on look-alike names: misspelt customers and the customer that each is closest to, by the segment index."""
    from ordersmith.operators.joins import best_matches
    c = td.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    slip = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("Custmer"), F.substr("c_name", F.lit(9)))).otherwise(
        F.concat(F.substring("c_name", 1, 9), F.substr("c_name", F.lit(11)), F.lit("x")))
    return best_matches(c.select(slip.alias("l")), c.select("c_name"), 0.85, few_pairs=0).withColumn("score", F.round("score", 6))


# ============================================================ five recent tables (Q14)
@register("recent_tables", "\nUNION ALL\n".join(
    f"SELECT '{name}' AS \"table\", CAST(count(*) AS BIGINT) AS rows FROM ({sql}) t{i} "
    f"WHERE order_date BETWEEN DATE '{RECENT_AS_OF}' - {RECENT_DAYS - 1} AND DATE '{RECENT_AS_OF}'"
    for i, (name, sql) in enumerate([("master", with_master(f"SELECT {_ALL} FROM master")), ("b01", ORACLES["order_summary"]),
                                     ("b02", ORACLES["order_details"]), ("b03", ORACLES["order_headers"]),
                                     ("b04", ORACLES["order_shipping"])])))
def q_recent_tables(spark, sf_dir):
    """Q14 over the master and the four marts: recent rows of each."""
    from ordersmith.operators.windows import union_all
    from ordersmith.plans.recent import recent_tables
    m = master(spark, sf_dir)
    tables = {"master": m, "b01": marts.order_summary(m), "b02": marts.order_details(m), "b03": marts.order_headers(m),
              "b04": marts.order_shipping(m, TEST_CITY_LABELS)}
    recent = recent_tables(tables, RECENT_AS_OF, RECENT_DAYS)
    return union_all([df.agg(F.count(F.lit(1)).cast("bigint").alias("rows")).select(F.lit(n).alias("table"), "rows")
                      for n, df in recent.items()])
