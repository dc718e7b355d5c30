"""Reporting marts derived from the master table (Q5-Q9).

* ``order_summary``  (B01): one row per order number, first-line attributes,
  ordered product / SKU lists and quantity totals, in one aggregation.  Totals
  and first lines are combined map-side.  The lists hold all lines of a group,
  whatever its size.  Those of more than ``LIST_LINES`` lines (lines without an
  order number are one group) are sorted and joined in ranges of about so many
  lines, and only the ranges' texts meet in one task.  ``order_product_lists``
  has the same lines in rows of bounded size.
* ``order_details``  (B02): line-level projection.
* ``order_headers``  (B03) / ``order_shipping`` (B04): the first line of each
  order (row_number = 1, pre-limited per task before the shuffle).
* ``split_platforms``: platform shops vs the rest.
"""

from __future__ import annotations

from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordersmith.operators.filters import split_by_membership
from ordersmith.operators.joins import map_values
from ordersmith.operators.projections import conform
from ordersmith.operators.windows import first_per_key
from ordersmith.schema import (CITY_LABELS, DETAIL_COLUMNS, HEADER_COLUMNS, SHIPPING_COLUMNS,
                               SPECIAL_PLATFORMS, SUMMARY_FIRST_COLUMNS)
from ordersmith.session import checkpoint_dir, staged

ROW_ORDER = "row_no"


def numbered(df: DataFrame, null_numbers: bool = True) -> DataFrame:
    """Lines with a missing order number as those with an empty one: one group.

    A table known to hold no null numbers (``write_master_table``) keeps its
    bucketing with ``null_numbers=False``."""
    return df.withColumn("order_sn", F.coalesce("order_sn", F.lit(""))) if null_numbers else df


def unnumbered_lines(master: DataFrame) -> DataFrame:
    """The lines without an order number (null or empty)."""
    return master.filter(F.coalesce("order_sn", F.lit("")) == "")


#: Lines whose names one task gathers and sorts; the lists of larger groups are made range by range.
LIST_LINES = 250_000
_LISTS = {"product_name_list": "product_name", "product_sku_main_list": "product_sku_main"}


def ordered_join(value: str, order: str = ROW_ORDER, sep: str = ";") -> Column:
    """Non-empty values of a group joined by ``sep`` in ``order`` ('' if none)."""
    v = F.col(value).cast("string")
    item = F.when(v.isNotNull() & (v != ""), F.struct(F.col(order).alias("o"), v.alias("v")))
    ordered = F.array_sort(F.collect_list(item))
    return F.coalesce(F.array_join(F.transform(ordered, lambda s: s["v"]), sep), F.lit(""))


def large_groups(lines: DataFrame, most: int = LIST_LINES) -> DataFrame | None:
    """Order numbers of more than ``most`` lines, or None if there are none. Reads one column; the counts are combined
    in the map tasks, and the few numbers that are left are written to the checkpoint folder."""
    large = lines.groupBy("order_sn").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most).select("order_sn")
    checkpoint_dir(lines.sparkSession)
    large = large.checkpoint()
    return None if large.isEmpty() else large


_TOTALS = {"total_quantity": "quantity", "total_return_quantity": "return_quantity"}


def _firsts_and_totals(order: str) -> list[Column]:
    first = F.min_by(F.struct(*[F.col(c) for c in SUMMARY_FIRST_COLUMNS]), F.col(order))
    return [first.alias("__first"),
            *[F.sum(F.coalesce(F.col(c), F.lit(0))).cast("bigint").alias(name) for name, c in _TOTALS.items()]]


def _summary(lines: DataFrame, order: str, lists: bool) -> DataFrame:
    agg = lines.groupBy("order_sn").agg(
        *_firsts_and_totals(order), *([ordered_join(c, order).alias(name) for name, c in _LISTS.items()] if lists else []))
    return agg.select("order_sn", *[F.col(f"__first.{c}").alias(c) for c in SUMMARY_FIRST_COLUMNS],
                      *[F.col(name) if lists else F.lit(None).cast("string").alias(name) for name in _LISTS], *_TOTALS)


def _range_texts(lines: DataFrame, order: str, value: str, ranges: int) -> DataFrame:
    """order_sn, __part, __text: the values of every group joined in order, one text for each sorted range.

    Lines of equal place and value are dealt over ranges too, so that a range has about the same lines as any other."""
    v = F.col(value).cast("string")
    lines = lines.filter(v.isNotNull() & (v != "")).select("order_sn", order, value, F.monotonically_increasing_id().alias("__tie"))
    parts = lines.repartitionByRange(ranges, "order_sn", order, value, "__tie").withColumn("__part", F.spark_partition_id())
    return parts.groupBy("order_sn", "__part").agg(ordered_join(value, order).alias("__text"))


def _large_summary(lines: DataFrame, order: str) -> DataFrame:
    """``_summary`` of large groups. The lines' columns are written once; a group's texts, first line and totals meet in
    one aggregation, so that the row with the whole lists is not joined or moved any more."""
    lines = staged(lines.select(*dict.fromkeys(["order_sn", order, *SUMMARY_FIRST_COLUMNS, *_LISTS.values(), *_TOTALS.values()])))
    ranges = -(-lines.count() // LIST_LINES)
    rows = lines.groupBy("order_sn").agg(*_firsts_and_totals(order))
    for name, c in _LISTS.items():
        texts = _range_texts(lines, order, c, ranges).withColumnsRenamed({"__part": f"__part_{name}", "__text": f"__text_{name}"})
        rows = rows.unionByName(texts, allowMissingColumns=True)
    first = F.first("__first", ignorenulls=True)
    return rows.groupBy("order_sn").agg(           # in the mart's column order: no projection copies the lists again
        *[first[c].alias(c) for c in SUMMARY_FIRST_COLUMNS],
        *[ordered_join(f"__text_{name}", f"__part_{name}").alias(name) for name in _LISTS],
        *[F.max(name).alias(name) for name in _TOTALS])


def order_summary(master: DataFrame, order: str = ROW_ORDER, null_numbers: bool = True,
                  list_lines: int | None = None) -> DataFrame:
    """B01 order summary grouped by ``order_sn``.

    All groups have their whole lists; finding the large ones counts the lines
    of each number when this is called. A caller who names ``list_lines`` gets
    null lists for groups of more lines (see ``order_product_lists``). One list
    is one value of Spark, of up to 2 GB; a longer one is an error."""
    lines = numbered(master, null_numbers)
    large = large_groups(lines, LIST_LINES if list_lines is None else list_lines)
    if large is None:
        return _summary(lines, order, True)
    rest = lines.join(large, "order_sn", "left_semi")
    return _summary(lines.join(large, "order_sn", "left_anti"), order, True).unionByName(
        _large_summary(rest, order) if list_lines is None else _summary(rest, order, False))


def _ranked(lines: DataFrame, order: str) -> DataFrame:
    """Lines of large groups with ``__rank``, their place in the group from 0, in order of ``order``, name and SKU.

    Sorted ranges hold a bounded number of lines, however many a group has; a
    line's rank is the group's lines in the ranges before and its place in its
    own range. The ranges are written once, so that all steps see the same."""
    by = [order, *_LISTS.values()]
    lines = lines.select("order_sn", *by, F.monotonically_increasing_id().alias("__tie"))
    ranges = (lines.repartitionByRange("order_sn", *by, "__tie").withColumn("__part", F.spark_partition_id()).checkpoint())
    parts = ranges.groupBy("order_sn", "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("order_sn").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("order_sn", "__part", F.coalesce(before, F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy("order_sn", "__part").orderBy(*by, "__tie"))
    return (ranges.withColumn("__place", place).join(parts, ["order_sn", "__part"])
            .withColumn("__rank", F.col("__before") + F.col("__place") - 1))


def order_product_lists(master: DataFrame, order: str = ROW_ORDER, null_numbers: bool = True,
                        list_lines: int = LIST_LINES) -> DataFrame:
    """The lists of every group, of whatever size: order_sn, chunk (from 0), lines, product_name_list,
    product_sku_main_list.

    A chunk holds ``list_lines`` lines of its group, the last one the rest; the
    chunks' lists joined by ``;`` in order (but for empty ones) are the whole
    list. A missing order number counts as ''. The lines' four columns are
    written to the checkpoint folder when this is called, so that counts, small
    and large groups don't make them once each."""
    lines = staged(numbered(master, null_numbers).select("order_sn", order, *_LISTS.values()))
    large = large_groups(lines, list_lines)
    columns = ["order_sn", "chunk", F.col("lines").cast("bigint").alias("lines"), *_LISTS]

    def lists(df: DataFrame, keys, by: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("lines"),
                                     *[ordered_join(c, by).alias(name) for name, c in _LISTS.items()])
    small = lines if large is None else lines.join(large, "order_sn", "left_anti")
    whole = lists(small, ["order_sn"], order).withColumn("chunk", F.lit(0).cast("bigint")).select(*columns)
    if large is None:
        return whole
    ranked = _ranked(lines.join(large, "order_sn", "left_semi"), order).withColumn(
        "chunk", F.floor(F.col("__rank") / list_lines).cast("bigint"))
    return whole.unionByName(lists(ranked, ["order_sn", "chunk"], "__rank").select(*columns))


def order_details(master: DataFrame) -> DataFrame:
    """Q6: B02 line details (no dedup)."""
    return conform(master, DETAIL_COLUMNS)


def order_headers(master: DataFrame, order: str = ROW_ORDER, null_numbers: bool = True) -> DataFrame:
    """Q7: B03, first line of each order number."""
    df = numbered(conform(master, HEADER_COLUMNS, keep=[order]), null_numbers)
    return first_per_key(df, ["order_sn"], [order]).drop(order)


def order_shipping(master: DataFrame, city_labels: Mapping[str, str] = CITY_LABELS,
                   order: str = ROW_ORDER, null_numbers: bool = True) -> DataFrame:
    """Q8: B04, first line of each order number with the city label applied
    (unknown spellings are kept as they are)."""
    df = numbered(conform(master, SHIPPING_COLUMNS, keep=[order]), null_numbers)
    df = df.withColumn("recipient_city", map_values("recipient_city", city_labels))
    return first_per_key(df, ["order_sn"], [order]).drop(order)


def split_platforms(master: DataFrame, platforms: Iterable[str] = SPECIAL_PLATFORMS) -> tuple[DataFrame, DataFrame]:
    """Q9: (platform-shop rows, all other rows); null shops go to the others."""
    return split_by_membership(master, "shop_name", platforms)


def amount_check(master: DataFrame, order: str = ROW_ORDER) -> DataFrame:
    """The paid total summed over lines (double counts multi-line orders)
    next to the same total summed once per order."""
    per_order = numbered(master).groupBy("order_sn").agg(
        F.sum("total_amount_paid_by_buyer").alias("__lines"),
        F.min_by("total_amount_paid_by_buyer", F.col(order)).alias("__first"))
    return per_order.agg(F.round(F.sum("__lines"), 2).alias("amount_over_lines"),
                         F.round(F.sum("__first"), 2).alias("amount_over_orders"))
