"""A key holding a third of all rows: results stay exact (brute force in pandas).

Fulfilled ('F') orders lose their order number, so the null order number is
one group with about a third of the lines, as a blank column in a real export
would produce.
"""

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ordersmith import registry as R
from ordersmith.plans import marts, upsert as U
from ordersmith.session import checkpoint_dir


def hot_master(spark):
    checkpoint_dir(spark)
    m = R.master(spark, SF_SMALL)
    m = m.withColumn("line_id", F.monotonically_increasing_id())
    m = m.withColumn("order_sn", F.when(F.col("order_status") == "F", F.lit(None)).otherwise(F.col("order_sn")))
    return m.checkpoint(eager=True)


def test_hot_key_share(spark):
    m = hot_master(spark)
    total, hot = m.count(), m.filter(F.col("order_sn").isNull()).count()
    assert hot * 4 > total  # more than a quarter of all rows in one key


def test_summary_and_headers_exact_under_skew(spark):
    m = hot_master(spark)
    pdf = m.select("order_sn", "line_id", "product_name", "quantity", "shop_name").toPandas()
    hot = pdf[pdf.order_sn.isna()].sort_values("line_id")
    s = {r.order_sn: r for r in marts.order_summary(m, order="line_id").collect()}
    assert s[""].product_name_list == ";".join(hot.product_name)      # lines without a number are one group
    assert marts.unnumbered_lines(m).count() == len(hot)
    assert s[""].total_quantity == int(hot.quantity.fillna(0).sum())
    assert s[""].shop_name == hot.shop_name.iloc[0]
    h = {r.order_sn: r for r in marts.order_headers(m.withColumn("row_no", F.col("line_id"))).collect()}
    assert h[""].product_name == hot.product_name.iloc[0]
    assert len(s) == len(h) == pdf.order_sn.nunique(dropna=False)


def test_upsert_exact_under_skew(spark):
    m = hot_master(spark).drop("line_id")
    old = m.filter(F.col("order_date") < F.lit("1998-07-01").cast("date"))
    new = m.filter(F.year("order_date") == 1998)
    out = U.upsert_orders(old, new)
    po, pn = old.toPandas(), new.toPandas()
    lo, hi = pn.order_date.min(), pn.order_date.max()
    keys = set(zip(pn.order_date, pn.order_sn.fillna("<null>"), pn.buyer_username))
    in_span = (po.order_date >= lo) & (po.order_date <= hi)
    hit = np.array([k in keys for k in zip(po.order_date, po.order_sn.fillna("<null>"), po.buyer_username)])
    kept = po[~(in_span & hit)]
    assert out.count() == len(kept) + len(pn)
