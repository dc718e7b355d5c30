"""Data-quality audits (Q10-Q12, Q15-Q17).

The reference audits loop over keys on one machine and stop after a few
samples; here every audit is a join / aggregation over all keys and returns
the whole result as a DataFrame (a caller may ``limit`` it for display).
"""

from __future__ import annotations

from functools import cached_property
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordersmith.functions import scalars as X
from ordersmith.operators import aggregates as A
from ordersmith.operators.filters import in_date_range, non_blank, unparsable_dates
from ordersmith.operators.joins import anti_join, best_matches, key_reconciliation
from ordersmith.operators.windows import date_gaps as _date_gaps
from ordersmith.schema import ORDER_KEY
from ordersmith.session import checkpoint_dir


# ----------------------------------------------------------------------- Q10
class Freshness:
    """Q10 outputs, built on first access: ``report`` (J11) and ``tallies``."""

    def __init__(self, master: DataFrame, expected: DataFrame, threshold: str, cutoff: float,
                 measure: str, shop_col: str, ts_col: str):
        self.master, self.expected, self.threshold = master, expected, threshold
        self.cutoff, self.measure, self.shop_col, self.ts_col = cutoff, measure, shop_col, ts_col

    @cached_property
    def latest(self) -> DataFrame:
        latest = A.latest_per_group(self.master, self.shop_col, self.ts_col, "latest_order_ts") \
            .withColumnRenamed(self.shop_col, "shop_name")
        # one row per shop, used by several branches: computed once and cut from
        # the master's lineage in the shared checkpoint folder
        checkpoint_dir(self.master.sparkSession)
        return latest.checkpoint(eager=True)

    @cached_property
    def expected_names(self) -> DataFrame:
        return self.expected.select(F.col("name")).filter(F.col("name").isNotNull()).distinct()

    @cached_property
    def present_names(self) -> DataFrame:
        return self.latest.select(F.col("shop_name").alias("name"))

    @cached_property
    def missing(self) -> DataFrame:
        return self.expected_names.join(self.present_names, "name", "left_anti")

    @cached_property
    def fuzzy(self) -> DataFrame:
        # one row per missing name, used by several branches
        return best_matches(self.missing, self.latest.select("shop_name"), self.cutoff,
                            self.measure).checkpoint(eager=True)

    @property
    def _thr(self) -> Column:
        return F.lit(self.threshold).cast("timestamp_ntz")

    @cached_property
    def report(self) -> DataFrame:
        fuzzy, latest = self.fuzzy, self.latest
        lat = latest.select(F.col("shop_name").alias("right_name"), "latest_order_ts")
        fuzzy_rows = (fuzzy.join(lat, "right_name")
                      .select(F.col("left_name").alias("nickname"), F.col("right_name").alias("shop_name"),
                              F.lit("fuzzy").alias("status"), F.round("score", 4).alias("score"),
                              "latest_order_ts"))
        matched = fuzzy.select(F.col("right_name").alias("shop_name")).distinct()
        present_rows = (latest.join(matched, "shop_name", "left_anti")
                        .select(F.lit(None).cast("string").alias("nickname"), "shop_name",
                                F.lit("present").alias("status"), F.lit(None).cast("double").alias("score"),
                                "latest_order_ts"))
        missing_rows = (self.missing.join(fuzzy.select(F.col("left_name").alias("name")), "name", "left_anti")
                        .select(F.col("name").alias("nickname"), F.lit(None).cast("string").alias("shop_name"),
                                F.lit("missing").alias("status"), F.lit(None).cast("double").alias("score"),
                                F.lit(None).cast("timestamp_ntz").alias("latest_order_ts")))
        report = fuzzy_rows.unionByName(present_rows).unionByName(missing_rows)
        return report.withColumn("outdated", F.coalesce(F.col("latest_order_ts") < self._thr, F.lit(False)))

    @cached_property
    def tallies(self) -> DataFrame:
        def tally(name, df):
            return df.agg(F.count(F.lit(1)).cast("bigint").alias("shops")).select(F.lit(name).alias("tally"), "shops")
        parts = [tally("known", self.expected_names), tally("present", self.latest),
                 tally("matched_exact", self.expected_names.join(self.present_names, "name", "left_semi")),
                 tally("matched_fuzzy", self.fuzzy),
                 tally("missing", self.report.filter(F.col("status") == "missing")),
                 tally("outdated", self.latest.filter(F.col("latest_order_ts") < self._thr))]
        out = parts[0]
        for p_ in parts[1:]:
            out = out.unionByName(p_)
        return out


def shop_freshness(master: DataFrame, expected: DataFrame, threshold: str,
                   cutoff: float = 0.7, measure: str = "levenshtein",
                   shop_col: str = "shop_name", ts_col: str = "order_creation_timestamp") -> Freshness:
    """Q10: latest order time per shop against a threshold, with the expected
    shop list checked exactly and then by similarity for the missing names.

    ``expected`` has one column ``name``.  Report rows (J11):
    ``fuzzy`` (expected nickname -> best present shop), ``present`` (every shop
    in the data that no nickname matched) and ``missing``.  ``outdated`` is
    true when the shop's latest order is before ``threshold``.
    """
    return Freshness(master, expected, threshold, cutoff, measure, shop_col, ts_col)


# ----------------------------------------------------------------------- Q11
def date_gaps(master: DataFrame, max_gap_days: int = 3, shop_col: str = "shop_name",
              date_col: str = "order_date") -> DataFrame:
    """Q11: per shop, runs of more than ``max_gap_days`` days without orders."""
    return _date_gaps(master, shop_col, date_col, max_gap_days)


# ----------------------------------------------------------------------- Q12
def _both_sides(m: DataFrame, o: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lines of master and orphan log as one table, ``__m`` and ``__o`` counting each line for its side."""
    side = lambda df, own: df.select(*columns, F.lit(int(own)).alias("__m"), F.lit(int(not own)).alias("__o"))
    return side(m, True).unionByName(side(o, False))


class Cancellation:
    """Q12 outputs, built on first access: ``orders`` (A13 + A14 per common
    order), ``sn_counts`` (A15) and ``summary``."""

    def __init__(self, master: DataFrame, orphans: DataFrame, keys: Sequence[str], product_col: str):
        self.keys, self.product_col = list(keys), product_col
        self.m = non_blank(master, keys)
        self.o = non_blank(orphans, keys)

    @cached_property
    def orders(self) -> DataFrame:
        # one aggregate over both sides: lines by order and product, then by order
        product = F.coalesce(F.col(self.product_col).cast("string"), F.lit("<unknown product>")).alias("__p")
        lines = _both_sides(self.m.select(*self.keys, product), self.o.select(*self.keys, product), [*self.keys, "__p"])
        per_product = lines.groupBy(*self.keys, "__p").agg(F.sum("__m").alias("__m"), F.sum("__o").alias("__o"))
        only = lambda other: F.array_sort(F.collect_list(F.when(F.col(other) == 0, F.col("__p"))))
        per_order = per_product.groupBy(*self.keys).agg(
            F.sum("__m").cast("bigint").alias("lines_master"), F.sum("__o").cast("bigint").alias("lines_orphans"),
            only("__o").alias("__only_m"), only("__m").alias("__only_o"))
        common = per_order.filter((F.col("lines_master") > 0) & (F.col("lines_orphans") > 0))      # J7
        diff = F.abs(F.col("lines_master") - F.col("lines_orphans"))
        different = F.col("lines_master") != F.col("lines_orphans")
        return common.select(
            *self.keys, "lines_master", "lines_orphans", diff.cast("bigint").alias("difference"),
            F.when(different, "different").otherwise("same").alias("status"),
            F.when(different, F.array_join("__only_m", ";")).alias("products_only_in_master"),
            F.when(different, F.array_join("__only_o", ";")).alias("products_only_in_orphans"))

    @cached_property
    def sn_counts(self) -> DataFrame:
        counts = _both_sides(self.m, self.o, ["order_sn"]).groupBy("order_sn").agg(
            F.sum("__m").cast("bigint").alias("count_master"), F.sum("__o").cast("bigint").alias("count_orphans"))
        return (counts.filter((F.col("count_master") > 0) & (F.col("count_orphans") > 0)
                              & (F.col("count_master") != F.col("count_orphans")))
                .withColumn("difference", F.abs(F.col("count_master") - F.col("count_orphans")).cast("bigint")))

    @cached_property
    def summary(self) -> DataFrame:
        return self.orders.agg(
            F.count(F.lit(1)).cast("bigint").alias("common_orders"),
            F.count_if(F.col("status") == "different").cast("bigint").alias("orders_with_different_lines"),
            F.count_if(F.col("status") == "same").cast("bigint").alias("orders_with_same_lines"))


def cancellation_check(master: DataFrame, orphans: DataFrame, keys: Sequence[str] = ORDER_KEY,
                       product_col: str = "product_name") -> Cancellation:
    """Q12: orders present in both the master and the orphan log (all key
    parts non-blank), their line counts, the absolute difference and the
    products found on one side only; plus order numbers whose occurrence
    counts differ between the two tables."""
    return Cancellation(master, orphans, keys, product_col)


def top_differences(sn_counts: DataFrame, n: int = 10) -> DataFrame:
    """L3: the ``n`` order numbers with the largest count difference."""
    return sn_counts.orderBy(F.col("difference").desc(), F.col("order_sn")).limit(n)


# ----------------------------------------------------------------------- Q15
def invalid_dates(df: DataFrame, date_col: str = "order_date", keep: Sequence[str] = ("order_sn",)) -> DataFrame:
    """Q15: rows whose date text does not parse (null included) with the raw text."""
    return unparsable_dates(df, date_col, keep)


# ----------------------------------------------------------------------- Q17
def line_key(df: DataFrame) -> DataFrame:
    """Line key columns (order number, variation SKU or NULL_SKU, product)."""
    return df.withColumns({"__lk_sn": F.coalesce(F.trim("order_sn"), F.lit("")),
                           "__lk_sku": X.sku_key("product_sku_variation"),
                           "__lk_prod": F.coalesce(F.trim("product_name"), F.lit(""))})


class DuplicateKeys:
    """Q17 outputs, built on first access: ``reconciliation`` (J6),
    ``disappeared`` (J10) and ``sku_classes`` (A20)."""

    _K = ["__lk_sn", "__lk_sku", "__lk_prod"]

    def __init__(self, old: DataFrame, new: DataFrame):
        self.old, self.new = old, new

    @cached_property
    def nd(self) -> DataFrame:
        return X.with_order_date_from_sn(self.new, "order_sn", "__d")

    @cached_property
    def od(self) -> DataFrame:
        span = self.nd.agg(F.min("__d").alias("lo"), F.max("__d").alias("hi")).first()
        return self.old.filter(in_date_range("order_date", span["lo"], span["hi"]))

    @cached_property
    def reconciliation(self) -> DataFrame:
        return key_reconciliation(line_key(self.od), line_key(self.nd), self._K)

    @cached_property
    def disappeared(self) -> DataFrame:
        ok, nk = line_key(self.od), line_key(self.nd)
        gone = anti_join(ok, nk, self._K)
        new_skus = nk.groupBy("__lk_sn", "__lk_prod").agg(F.array_sort(F.collect_set("__lk_sku")).alias("__skus"))
        return (gone.join(new_skus, ["__lk_sn", "__lk_prod"], "left")
                    .select(F.col("order_sn"), F.col("product_name"), F.col("__lk_sku").alias("old_sku"),
                            F.array_join(F.array_remove(F.coalesce("__skus", F.array().cast("array<string>")),
                                                        F.col("__lk_sku")), ";").alias("new_skus_same_product"),
                            F.col("row_no")))

    @cached_property
    def sku_classes(self) -> DataFrame:
        classes = (A.value_class_frequency(self.od, "product_sku_variation").withColumn("side", F.lit("old"))
                   .unionByName(A.value_class_frequency(self.nd, "product_sku_variation").withColumn("side", F.lit("new"))))
        return classes.select("side", "value_class", F.col("rows").cast("bigint"))


def duplicate_key_report(old: DataFrame, new: DataFrame) -> DuplicateKeys:
    """Q17: line-key diagnosis of a new batch against the master.

    The old side is cut to the batch's order-date span (dates of the batch are
    read from its order numbers), then: distinct line keys common / only old /
    only new (J6); for each old line whose key vanished, the new SKUs of the
    same order and product that differ from the old one (J10, as one
    aggregated row per order+product, never a pairwise product); and the
    value classes of the variation SKU on both sides (A20).
    """
    return DuplicateKeys(old, new)
