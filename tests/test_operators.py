"""Operators on hand-made rows: splits, headers, first rows, gaps, bins, fuzzy."""

import datetime as dt
import difflib

import pytest

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ordersmith import registry
from ordersmith.operators import aggregates as A
from ordersmith.operators import joins as J
from ordersmith.operators import projections as P
from ordersmith.operators import windows as W
from ordersmith.operators.filters import split_by_membership
from ordersmith.schema import VOUCHER_BIN_EDGES
from ordersmith.sources import testdata as td


def test_split_partitions_input(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "shop string")
    inside, rest = split_by_membership(df, "shop", ["a"])
    assert sorted(r[0] or "" for r in inside.collect()) == ["a"]
    assert sorted(r[0] or "" for r in rest.collect()) == ["", "b"]


def test_header_cleaning_and_rename(spark):
    df = spark.createDataFrame([("1", "2", "3", "4")], "a string, b string, c string, d string")
    df = df.toDF(" 訂單\n編號 ", "金流處理費率", "金流與系統處理費率",
                 "收件者電話(若您是自行配送請使用後方蝦皮專線和包裹查詢碼聯繫買家)")
    cleaned = P.clean_headers(df)
    assert cleaned.columns == ["訂單編號", "金流處理費率", "金流與系統處理費率", "收件者電話"]
    from ordersmith.schema import ORDER_EXPORT_HEADERS
    renamed = P.rename_columns(cleaned, ORDER_EXPORT_HEADERS)
    assert renamed.columns == ["order_sn", "payment_processing_fee_rate", "recipient_phone"]
    assert renamed.first()["payment_processing_fee_rate"] == "2"   # both rate headers: first wins


def test_keep_first_duplicate_columns(spark):
    df = spark.createDataFrame([("1", "2", "3")], "a string, b string, c string").toDF("x", "y", "x")
    out = P.keep_first_duplicate_columns(df)
    assert out.columns == ["x", "y"] and out.first()["x"] == "1"


def test_conform(spark):
    df = spark.createDataFrame([("s", "extra")], "order_sn string, junk string")
    out = P.conform(df, ["order_sn", "quantity", "shop_name"], fill="")
    assert out.columns == ["order_sn", "quantity", "shop_name"]
    assert out.first().asDict() == {"order_sn": "s", "quantity": None, "shop_name": ""}


def test_first_per_key_keeps_null_key_group(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 5, "z"), (None, 3, "w")],
                               "k string, o int, v string")
    got = {r.k: r.v for r in W.first_per_key(df, ["k"], ["o"]).collect()}
    assert got == {"a": "y", None: "w"}


def test_date_gaps_edges(spark):
    d = dt.date
    rows = [("s", d(2025, 1, 1)), ("s", d(2025, 1, 4)), ("s", d(2025, 1, 8)), ("s", d(2025, 1, 8)),
            ("t", d(2025, 1, 1)), (None, d(2025, 1, 1)), (None, d(2025, 3, 1))]
    df = spark.createDataFrame(rows, "shop string, day date")
    got = [tuple(r) for r in W.date_gaps(df, "shop", "day", 3).collect()]
    # delta 3 is not a gap, delta 4 is (3 missing days); single-date shop and null shop: none
    assert got == [("s", d(2025, 1, 4), d(2025, 1, 8), 4, 3)]


def test_histogram_bins(spark):
    df = spark.createDataFrame([(0.5,), (10.0,), (25.0,), (499.99,), (500.0,)], "x double")
    got = [r[0] for r in df.select(A.bin_label(F.col("x"), VOUCHER_BIN_EDGES)).collect()]
    assert got == ["0-10", "10-25", "25-50", "200-500", "500+"]


def test_duplicated_key_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "k string, r int")
    got = sorted(r.r for r in W.duplicated_key_rows(df, ["k"]).collect())
    assert got == [1, 2, 4, 5]


def test_null_counts(spark):
    df = spark.createDataFrame([(None, 1), ("a", None), (None, None)], "a string, b int")
    assert [tuple(r) for r in A.null_counts(df).orderBy("position").collect()] == [(0, "a", 2), (1, "b", 2)]


def test_key_reconciliation(spark):
    old = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    new = spark.createDataFrame([("b",), ("c",), (None,)], "k string")
    got = {r.status: r["keys"] for r in J.key_reconciliation(old, new, ["k"]).collect()}
    assert got == {"common": 2, "only_old": 1, "only_new": 1}


def test_shop_alias_lookup(spark):
    shops = spark.createDataFrame([("A", "acc_a", "A,AA"), ("B", "acc_b", "B,AA"), ("C", None, None)],
                                  "shop_name string, shop_account string, keywords string")
    aliases = J.shop_alias_table(shops)
    df = spark.createDataFrame([("AA",), ("A",), ("zzz",), (None,), ("C",)], "shop_name string")
    got = [tuple(r) for r in J.fill_shop_account(df, aliases).select("shop_name", "shop_account").collect()]
    # a later row wins the alias 'AA'; unknown keeps its name with ''; null stays null with ''
    assert sorted(got, key=str) == sorted([("B", "acc_b"), ("A", "acc_a"), ("zzz", ""), (None, ""), ("C", None)], key=str)


def test_null_account_is_left_alone(spark):
    shops = spark.createDataFrame([("A", "acc_a", None)], "shop_name string, shop_account string, keywords string")
    df = spark.createDataFrame([("A", None), ("A", ""), ("A", "own")], "shop_name string, shop_account string")
    got = [r.shop_account for r in J.fill_shop_account(df, J.shop_alias_table(shops)).collect()]
    assert sorted(got, key=str) == sorted([None, "acc_a", "own"], key=str)


def test_grouped_median_is_exact(spark):
    import random
    import statistics
    from ordersmith.plans.vouchers import grouped_median
    rng = random.Random(0)
    rows = [("a", float(rng.choice([1, 2, 5, 1000, 7.5]))) for _ in range(101)] + [("b", 3.0)] * 4 + \
           [("c", rng.random()) for _ in range(40)] + [("c", None)]
    got = {r.g: r.m for r in grouped_median(spark.createDataFrame(rows, "g string, v double"), "g", "v", "m").collect()}
    assert got == {g: statistics.median(v for x, v in rows if x == g and v is not None) for g in "abc"}


def _brute_lev(left, right, cutoff):
    def lev(a, b):
        prev = list(range(len(b) + 1))
        for i, ca in enumerate(a, 1):
            cur = [i]
            for j, cb in enumerate(b, 1):
                cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
            prev = cur
        return prev[-1]
    out = {}
    for l in left:
        best = None
        for r in right:
            m = max(len(l), len(r))
            s = 1.0 if m == 0 else 1.0 - lev(r, l) / m
            if s >= cutoff and (best is None or (s, r) > best):
                best = (s, r)
        if best:
            out[l] = best[1]
    return out


NAMES_LEFT = ["毛寵星人", "火箭貓狗", "驕傲貓狗", "abcdefghij", "abcdefg", "xyz", "NATION_", "nation 3", "寵物"]
NAMES_RIGHT = ["毛寵星人樂園", "火箭貓狗星際站", "驕傲貓狗王國", "abcdefghiX", "abcdefgXYZ", "abcdefghij",
               "NATION_1", "NATION_2", "NATION_3", "NATION 3", "寵物の達人", "寵物有喵病"]


def test_best_matches_levenshtein_equals_brute_force(spark):
    left = spark.createDataFrame([(n,) for n in NAMES_LEFT], "name string")
    right = spark.createDataFrame([(n,) for n in NAMES_RIGHT], "name string")
    for cutoff in (0.5, 0.7, 0.9):
        got = {r.left_name: r.right_name for r in J.best_matches(left, right, cutoff).collect()}
        assert got == _brute_lev(NAMES_LEFT, NAMES_RIGHT, cutoff), cutoff


def test_best_matches_difflib_equals_close_matches(spark):
    left = spark.createDataFrame([(n,) for n in NAMES_LEFT], "name string")
    right = spark.createDataFrame([(n,) for n in NAMES_RIGHT], "name string")
    for cutoff in (0.5, 0.6, 0.7):
        got = {r.left_name: r.right_name for r in J.best_matches(left, right, cutoff, "difflib").collect()}
        exp = {}
        for l in NAMES_LEFT:
            m = difflib.get_close_matches(l, NAMES_RIGHT, n=1, cutoff=cutoff)
            if m:
                exp[l] = m[0]
        assert got == exp, cutoff


def test_sample_and_first_n(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    assert [r.k for r in W.first_n(df, 3, ["k"]).collect()] == [0, 1, 2]
    a = [r.k for r in W.sample_n(df, 5, seed=1).collect()]
    b = [r.k for r in W.sample_n(df, 5, seed=1).collect()]
    assert a == b and len(set(a)) == 5
    assert W.sample_n(df.limit(3), 5).count() == 3


def test_unmapped_and_required_columns(spark):
    import pytest
    from ordersmith.schema import ORDER_EXPORT_HEADERS
    df = spark.createDataFrame([("1", "2")], "a string, b string").toDF("訂單編號", "未知欄位")
    assert [tuple(r) for r in P.unmapped_columns(spark, df, ORDER_EXPORT_HEADERS).collect()] == [(1, "未知欄位")]
    P.require_columns(df, ["訂單編號"])
    with pytest.raises(P.MissingColumnsError, match="x"):
        P.require_columns(df, ["訂單編號", "x"])


def test_invalid_dates_all_has_every_pending_order(spark):
    found = {r.order_sn for r in registry.QUERIES["invalid_dates_all"](spark, SF_SMALL).collect()}
    pending = td.order_lines(spark, SF_SMALL).filter("order_status = 'P'")
    assert found == {r.order_sn for r in pending.select("order_sn").collect()}
    assert pending.filter("order_date < '1998-01-01'").count() > 0


# ------------------------------------------------------------ J9 by segments, A7 by sketches, S4 by a lattice
def _close_names(n):
    import random
    rng = random.Random(8)
    right = [f"Shop {rng.randrange(10**6):06d} Store" for _ in range(n)] + ["", "a", "ab", "Other place", "Shop"]
    left = []
    for i in range(n):
        s = list(right[rng.randrange(n)])
        for _ in range(rng.choice([1, 1, 1, 2])):
            k, at = rng.randrange(3), rng.randrange(len(s))
            s[at:at + 1] = [[], [rng.choice("0123456789x")], [s[at], rng.choice("0123456789x")]][k]
        left.append("".join(s))
    return left + ["", "b", "ba", "Othr place", "nothing like it", "Shop"], right


@pytest.mark.parametrize("measure", ["levenshtein", "difflib"])
def test_segment_matches_equal_brute_force(spark, measure):
    import difflib
    from ordersmith.operators.joins import best_matches
    left, right = _close_names(60)

    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    def score(a, b):
        if measure == "difflib":
            return difflib.SequenceMatcher(None, b, a).ratio()
        return 1 - lev(a, b) / max(len(a), len(b)) if a or b else 1.0
    want = {}
    for a in set(left):
        s, b = max((score(a, b), b) for b in set(right))
        if s >= 0.7:
            want[a] = (b, round(s, 9))
    frame = lambda names: spark.createDataFrame([(x,) for x in [*names, None]], "name string")
    got = best_matches(frame(left), frame(right), 0.7, measure, few_pairs=0).collect()
    assert {r.left_name: (r.right_name, round(r.score, 9)) for r in got} == want and len(got) == len(want)
    again = best_matches(frame(left), frame(right), 0.7, measure).collect()              # the prefix filter alone
    assert {r.left_name: (r.right_name, round(r.score, 9)) for r in again} == want


def test_segments_leave_few_pairs_of_look_alike_names(spark, monkeypatch):
    from ordersmith.operators import joins as J
    left, right = _close_names(2000)
    left, right = left[:2000], right[:2000]
    pairs = []
    scored = J._scored

    def counted(candidates, cutoff, measure):
        pairs.append(candidates.count())
        return scored(candidates, cutoff, measure)
    monkeypatch.setattr(J, "_scored", counted)
    frame = lambda names: spark.createDataFrame([(x,) for x in names], "name string")
    got = J.best_matches(frame(left), frame(right), 0.7).count()
    assert got == len(set(left)) and sum(pairs) < 0.05 * len(set(left)) * len(set(right)), pairs


def test_cut_names_index_does_not_grow_with_the_pairs(spark, monkeypatch):
    """Numbered names, each of which has hundreds of others two edits away: a few pairs a name are compared."""
    from ordersmith.operators import joins as J
    right = [f"Customer#{i:09d}" for i in range(1500)]
    left = [r[:9] + r[10:] + "x" for r in right]
    pairs = []
    scored = J._scored

    def counted(candidates, cutoff, measure):
        pairs.append(candidates.count())
        return scored(candidates, cutoff, measure)
    monkeypatch.setattr(J, "_scored", counted)
    frame = lambda names: spark.createDataFrame([(x,) for x in names], "name string")
    got = {r.left_name: r for r in J.best_matches(frame(left), frame(right), 0.85).collect()}
    assert len(got) == len(left) and sum(pairs) < 30 * len(left), pairs
    assert got["Customer#00000012x"].right_name == "Customer#000000129"            # one swap, the greatest of ten
    assert got["Customer#00001234x"].right_name == "Customer#000001234"            # two edits: one digit more, the letter dropped


def test_names_around_the_longest_cut_ones(spark):
    from ordersmith.operators import joins as J
    base = "abcdefghijklmnopqrstuvwxyz0123456789"
    left = [base[:n] for n in (30, 31, 32, 33, 34)]
    right = [base[:n][:10] + "_" + base[:n][10:] for n in (30, 31, 32, 33)] + [base[2:34]]
    frame = lambda names: spark.createDataFrame([(x,) for x in names], "name string")
    got = {r.left_name: (r.right_name, round(r.score, 9)) for r in J.best_matches(frame(left), frame(right), 0.85, few_pairs=0).collect()}
    lev = {(a, b): s for a, b, s in frame(left).crossJoin(frame(right).toDF("r")).select(
        "name", "r", J.levenshtein_ratio("r", "name")).collect()}
    want = {a: max((lev[a, b], b) for b in right) for a in left}
    assert got == {a: (b, round(s, 9)) for a, (s, b) in want.items() if s >= 0.85}


def test_segments_cover_every_length():
    from ordersmith.operators.joins import _probes
    segments = {5: [(0, 2), (2, 1), (3, 2)]}
    assert set(_probes(segments, [5])) == {(5, 5, 0, 0, 2), (5, 5, 1, 1, 1), (5, 5, 1, 2, 1), (5, 5, 1, 3, 1), (5, 5, 2, 3, 2)}
    assert _probes(segments, [8]) == []


@pytest.mark.parametrize("most", [5, 100_000])
def test_median_of_any_distribution(spark, most):
    import random
    import statistics
    from ordersmith.plans import vouchers as V
    from ordersmith.session import checkpoint_dir
    rng = random.Random(1)
    groups = {"tail": [rng.expovariate(1) ** 9 for _ in range(3000)] + [1e15], "outlier": [1.0 + i / 7 for i in range(2001)] + [-1e15],
              "equal": [3.0] * 1500, "two": [1.0, 2.0], "one": [-5.0], "hot": [7.0] * 2000 + [rng.random() * 20 for _ in range(999)],
              "halves": [0.0] * 700 + [1.0] * 700}
    data = [(g, v) for g, vs in groups.items() for v in vs] + [("one", None), (None, 1.0)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "g string, v double").repartition(6)
    got = {r.g: r.m for r in V.grouped_median(df, "g", "v", "m", most=most).collect()}
    assert got == {g: statistics.median(vs) for g, vs in groups.items()}
    checkpoint_dir(spark)
    bounds = V.median_bounds(df.filter("g is not null and v is not null").checkpoint(), "g", "v", most=200).collect()
    assert {r.g for r in bounds if r.inside > 200 and r.lo < r.hi} <= {"hot", "halves"}      # few values on many rows
    assert next(r.inside for r in bounds if r.g == "outlier") <= 200 and next(r.inside for r in bounds if r.g == "tail") <= 200


def test_inferred_types(spark, tmp_path):
    from ordersmith.sources import readers
    cells = {"whole": ["1", "-2", "+3", ""], "rate": ["1", ".5", "1e3", None], "day": ["2025-06-01", "1999-12-31", " ", None],
             "time": ["2025-06-01", "2025-06-01 10:00", "2025-06-01T10:00:01.5", ""], "mixed": ["1", "2025-06-01", "2.5", ""],
             "word": ["1", "x", "2025-13-01", "1_0"], "none": [None, "", "  ", None], "long": ["1" * 18, "1" * 19, "", ""]}
    df = spark.createDataFrame(list(zip(*cells.values())), ", ".join(f"`{c}` string" for c in cells))
    got = {r.column_name: (r.inferred, r["values"], r.forced) for r in readers.infer_types(df).collect()}
    assert got == {"whole": ("integer", 3, 0), "rate": ("decimal", 3, 2), "day": ("date", 2, 0), "time": ("timestamp", 3, 2),
                   "mixed": ("text", 3, 1), "word": ("text", 4, 3), "none": ("text", 0, 0), "long": ("decimal", 2, 1)}
    assert readers.infer_types(df.limit(0)).count() == 0
    df.write.option("header", True).csv(str(tmp_path / "c"))
    typed = readers.read_csv_inferred(spark, str(tmp_path / "c"))
    assert dict(typed.dtypes) == {"whole": "bigint", "rate": "double", "day": "date", "time": "timestamp_ntz", "mixed": "string",
                                  "word": "string", "none": "string", "long": "double"}
