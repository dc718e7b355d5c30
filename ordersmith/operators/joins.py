"""Joins (J1-J11).

Key joins are null-safe equi-joins (``<=>``), which Spark plans as hash or
sort-merge joins on the key columns; AQE may split a skewed key on the
streamed side.  No side is broadcast by hint: the planner does it where its
size statistics are below ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

import difflib
from itertools import combinations
from typing import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordersmith.operators.windows import union_all
from ordersmith.session import checkpoint_dir


def key_condition(left: DataFrame, right: DataFrame, keys: Sequence[str],
                  right_keys: Sequence[str] | None = None) -> Column:
    """Null-safe equality on all key columns."""
    rk = right_keys or keys
    cond = None
    for a, b in zip(keys, rk):
        c = left[a].eqNullSafe(right[b])
        cond = c if cond is None else cond & c
    return cond


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct key tuples (partial aggregation before the shuffle)."""
    return df.select(*keys).distinct()


# ------------------------------------------------------------------ J1 / J2
def anti_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``."""
    r = distinct_keys(right, keys)
    return left.join(r, key_condition(left, r, keys), "left_anti")


def semi_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``."""
    r = distinct_keys(right, keys)
    return left.join(r, key_condition(left, r, keys), "left_semi")


# ------------------------------------------------------------------------ J5
def map_values(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """J5 for a fixed dictionary: mapped value, else the original value.

    The dictionary becomes a literal map inside the expression (no join)."""
    col = F.col(c) if isinstance(c, str) else c
    if not mapping:
        return col
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.element_at(m, col), col)


# ------------------------------------------------------------------------ S7
def shop_alias_table(shops: DataFrame, order_col: str | None = None) -> DataFrame:
    """``alias, shop_account, canonical_name`` from ``shop_name,
    shop_account, keywords`` (comma list).  Each shop answers to its own name
    and to every keyword; when two rows claim one alias, the later row by
    ``order_col`` wins (without it the greater name and account)."""
    order = F.col(order_col) if order_col else F.struct("shop_name", "shop_account")
    base = shops.select("shop_name", "shop_account", F.col("keywords"), order.alias("__row"))
    names = base.select(F.col("shop_name").alias("alias"), "shop_name", "shop_account", "__row",
                        F.lit(0).alias("__pos"))
    kws = (base.filter(F.col("keywords").isNotNull())
               .select(F.posexplode(F.split("keywords", ",")).alias("__pos", "__kw"),
                       "shop_name", "shop_account", "__row")
               .select(F.trim("__kw").alias("alias"), "shop_name", "shop_account", "__row",
                       (F.col("__pos") + 1).alias("__pos")))
    allrows = names.unionByName(kws)
    latest = F.max_by(F.struct("shop_account", "shop_name"), F.struct("__row", "__pos"))
    return (allrows.groupBy("alias").agg(latest.alias("__v"))
                   .select("alias", F.col("__v.shop_account").alias("shop_account"),
                           F.col("__v.shop_name").alias("canonical_name")))


# ------------------------------------------------------------------------ J4
def fill_shop_account(df: DataFrame, aliases: DataFrame) -> DataFrame:
    """Where the account column is missing or the account empty, look the shop name up
    among names and aliases: the account is filled (``''`` if unknown) and the
    name becomes the canonical one (kept if unknown).  A null shop stays null
    with an empty account; rows that have an account, or a null one, are untouched."""
    a = aliases.select(F.col("alias").alias("__alias"), F.col("shop_account").alias("__acct"),
                       F.col("canonical_name").alias("__canon"))
    if "shop_account" not in df.columns:
        df = df.withColumn("shop_account", F.lit(""))
    needs = F.coalesce(F.col("shop_account") == "", F.lit(False))
    joined = df.join(a, df["shop_name"] == a["__alias"], "left")
    # both outputs are computed from the input values in one projection
    return joined.withColumns({
        # a known shop whose account is empty keeps a null account; unknown -> ''
        "shop_account": F.when(needs, F.when(F.col("shop_name").isNull(), F.lit(""))
                                        .when(F.col("__alias").isNotNull(), F.col("__acct"))
                                        .otherwise(F.lit("")))
                         .otherwise(F.col("shop_account")),
        "shop_name": F.when(needs, F.coalesce(F.col("__canon"), F.col("shop_name")))
                      .otherwise(F.col("shop_name")),
    }).drop("__alias", "__acct", "__canon")


# ------------------------------------------------------------------------ J6
def key_reconciliation(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many distinct keys are common, only old, only new."""
    o = distinct_keys(old, keys).withColumn("__o", F.lit(True))
    n = distinct_keys(new, keys).withColumn("__n", F.lit(True))
    n = n.select(*[F.col(k).alias(f"__r_{k}") for k in keys], "__n")
    j = o.join(n, key_condition(o, n, keys, [f"__r_{k}" for k in keys]), "full_outer")
    status = (F.when(F.col("__o").isNotNull() & F.col("__n").isNotNull(), "common")
               .when(F.col("__o").isNotNull(), "only_old").otherwise("only_new"))
    return j.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("keys"))


# ------------------------------------------------------------------------ J9
_TOKEN_SEP = "\u0001"


def _name_tokens(names: DataFrame, col: str) -> DataFrame:
    """(name, token) where a token is a character with its occurrence number, so
    the token set of a name is its character multiset."""
    base = names.select(F.col(col).alias("__name")).withColumn("__chars", F.split("__name", ""))
    chars = F.col("__chars")
    toks = F.transform(chars, lambda c, i: F.concat(
        c, F.lit(_TOKEN_SEP),
        F.size(F.filter(F.slice(chars, 1, i + 1), lambda d: d == c)).cast("string")))
    return base.select(F.col("__name").alias("name"), F.explode(toks).alias("token"))


def _prefix_tokens(tokens: DataFrame, freq: DataFrame, share: float) -> DataFrame:
    """Prefix filter: each name keeps its ``len - ceil(share*len) + 1`` rarest
    tokens (global order: frequency, then token)."""
    per = tokens.join(freq, "token").groupBy("name").agg(
        F.array_sort(F.collect_list(F.struct("freq", "token"))).alias("toks"))
    n = F.length("name")
    need = F.greatest(F.ceil(n * F.lit(share) - F.lit(1e-9)), F.lit(1))
    keep = (n - need + 1).cast("int")
    return per.select("name", F.explode(F.slice("toks", 1, keep)).alias("t")) \
              .select("name", F.col("t.token").alias("token"))


def similar_name_candidates(left: DataFrame, right: DataFrame, cutoff: float,
                            measure: str = "levenshtein") -> DataFrame:
    """Exact candidate pairs (left_name, right_name) for a similarity cutoff.

    No pair with score >= ``cutoff`` is missed: a pair can only reach the
    cutoff if its character multisets overlap in at least ``share * len`` of
    each name's characters (``share = cutoff`` for the edit-distance ratio,
    ``cutoff / (2 - cutoff)`` for the matching-blocks ratio), so by the prefix
    filtering lemma the two names share a token among their rarest ones.  Only
    those prefix tokens are joined, never the full cross product.  Names of
    equal text are always candidates.
    """
    if not 0 < cutoff <= 1:
        raise ValueError("cutoff must be in (0, 1]")
    share = cutoff if measure == "levenshtein" else cutoff / (2 - cutoff)
    ln = left.select(F.col(left.columns[0]).alias("name")).filter(F.col("name").isNotNull()).distinct()
    rn = right.select(F.col(right.columns[0]).alias("name")).filter(F.col("name").isNotNull()).distinct()
    lt, rt = _name_tokens(ln, "name"), _name_tokens(rn, "name")
    freq = (lt.select("token").unionByName(rt.select("token"))
              .groupBy("token").agg(F.count(F.lit(1)).alias("freq")))
    lp = _prefix_tokens(lt, freq, share)
    rp = _prefix_tokens(rt, freq, share)
    pairs = (lp.withColumnRenamed("name", "left_name")
               .join(rp.withColumnRenamed("name", "right_name"), "token")
               .select("left_name", "right_name"))
    same = ln.join(rn, "name").select(F.col("name").alias("left_name"), F.col("name").alias("right_name"))
    return pairs.unionByName(same).distinct()


def levenshtein_ratio(a: Column | str, b: Column | str) -> Column:
    """``1 - edit_distance / longer_length`` (1.0 for two empty strings)."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(
        F.lit(1.0) - F.levenshtein(a, b).cast("double") / longest.cast("double"))


@F.pandas_udf(T.DoubleType())
def sequence_ratio(candidate: pd.Series, word: pd.Series) -> pd.Series:
    """Ratcliff/Obershelp ratio as computed by close-match lookup: the candidate
    is the first sequence, the looked-up word the second."""
    out = []
    for c, w in zip(candidate, word):
        if c is None or w is None:
            out.append(None)
        else:
            out.append(difflib.SequenceMatcher(None, c, w).ratio())
    return pd.Series(out, dtype="float64")


#: Lists whose product is at most this many pairs go to the prefix filter at once.
FEW_PAIRS = 100_000
#: Numbers of edits that the indexes are asked for, one after another.
RADII = (1, 2, 4)
#: Names of at most this many characters, and numbers of edits, that the index of cut names takes.
CUT_LENGTH, CUT_EDITS = 32, 2
#: Places at which more characters than this occur are taken to hold any.
ALPHABET = 64


def _boundaries(names: DataFrame, edits: int, most_edits: float) -> dict[int, list[tuple[int, int]]]:
    """Length -> (start, length) of the segments that names of this length are cut into: one more than the edits.

    Positions at which names differ much weigh more (the entropy of their
    characters), so that no segment is mere boilerplate. One row for each
    length and position comes to the driver."""
    n = F.length("name")
    chars = names.select(n.alias("n"), F.posexplode(F.split("name", "")).alias("p", "c")).filter("p < n")
    counts = chars.groupBy("n", "p", "c").agg(F.count(F.lit(1)).alias("k"))
    share = F.col("k") / F.sum("k").over(Window.partitionBy("n", "p"))
    weights = counts.withColumn("q", share).groupBy("n", "p").agg(F.sum(-F.col("q") * F.log2("q")).alias("w")).collect()
    by_length: dict[int, list[float]] = {}
    for r in sorted(weights, key=lambda r: (r["n"], r["p"])):
        by_length.setdefault(r["n"], []).append(r["w"] + 0.01)
    out = {}
    for length, w in by_length.items():
        parts = min(edits, int(length * most_edits + 1e-9), length - 1) + 1
        cuts, total, seen = [0], sum(w), 0.0
        for i, x in enumerate(w):
            seen += x
            left = parts - len(cuts)                       # cuts that are still to be made
            if left and (seen >= total * len(cuts) / parts or length - i - 1 == left) and i + 1 < length:
                cuts.append(i + 1)
        out[length] = [(p, q - p) for p, q in zip(cuts, [*cuts[1:], length])]
    return out


def _probes(boundaries: dict[int, list[tuple[int, int]]], lengths: Sequence[int]) -> list[tuple[int, int, int, int, int]]:
    """(length, other length, segment, start, size): where a name of some length may hold a segment of one of another
    length, if the two are at most as many edits apart as there are segments but one.

    Each segment's shift is bounded by the segments before it and by those behind it."""
    out = []
    for n in lengths:
        for m, segments in boundaries.items():
            edits, more = len(segments) - 1, n - m
            if abs(more) <= edits:
                for j, (p, size) in enumerate(segments):
                    shifts = range(max(-j, more - (edits - j)), min(j, more + (edits - j)) + 1)
                    out += [(n, m, j, p + s, size) for s in shifts if 0 <= p + s <= n - size]
    return out


def segment_candidates(left: DataFrame, right: DataFrame, edits: int, most_edits: float) -> DataFrame:
    """Pairs (left_name, right_name), each once, among them all with at most ``edits`` edits between them and at most
    ``most_edits`` edits for every character of the right name.

    Right names are cut into one segment more than the edits; so at least one
    of them stands unchanged in the left name, near its own place. Segments are
    joined by length, number and text; no other pairs meet."""
    spark = left.sparkSession
    ln, rn = left.toDF("name"), right.toDF("name")
    boundaries = _boundaries(rn, edits, most_edits)
    lengths = [r[0] for r in ln.select(F.length("name")).distinct().collect()]       # one row a length
    cut = spark.createDataFrame([(m, j, p, size) for m, seg in boundaries.items() for j, (p, size) in enumerate(seg)],
                                "m int, j int, p int, size int")
    ask = spark.createDataFrame(_probes(boundaries, lengths), "n int, m int, j int, p int, size int")
    piece = F.substring(F.col("name"), F.col("p") + 1, F.col("size")).alias("piece")
    index = rn.withColumn("m", F.length("name")).join(cut, "m").select("m", "j", piece, F.col("name").alias("right_name"))
    asked = ln.withColumn("n", F.length("name")).join(ask, "n").select("m", "j", piece, F.col("name").alias("left_name"))
    return asked.join(index, ["m", "j", "piece"]).select("left_name", "right_name").distinct()


def _alphabets(names: DataFrame) -> dict[int, list[set | None]]:
    """Length -> the characters at each place of names of this length, None for more than ``ALPHABET``; one row for each
    length and place comes to the driver."""
    n = F.length("name")
    chars = names.filter(n.between(1, CUT_LENGTH)).select(
        n.alias("n"), F.posexplode(F.transform(F.sequence(F.lit(1), n), lambda i: F.substring("name", i, F.lit(1)))).alias(
            "p", "c")).distinct()
    rows = chars.groupBy("n", "p").agg(F.when(F.count(F.lit(1)) <= ALPHABET, F.collect_set("c")).alias("c")).collect()
    out: dict[int, list[set | None]] = {}
    for r in sorted(rows, key=lambda r: (r["n"], r["p"])):
        out.setdefault(r["n"], []).append(None if r["c"] is None else set(r["c"]))
    return out


def _cuts(n: int, drop: int, swap: int) -> list[tuple[tuple[int, ...], tuple[int, ...]]]:
    """(places taken out of a name of n characters, those of the swapped ones among them, as places in the rest)."""
    out = []
    for taken in combinations(range(n), drop + swap):
        for swapped in combinations(taken, swap):
            dropped = [p for p in taken if p not in swapped]
            out.append((taken, tuple(p - sum(d < p for d in dropped) for p in swapped)))
    return out


def _windows(own: list[set | None], other: list[set | None], back: int, ahead: int) -> list[str | None]:
    """For each place the characters that the other names have there or up to ``back`` before and ``ahead`` behind, if the
    own names have others too; else None."""
    out = []
    for p, mine in enumerate(own):
        near = other[max(0, p - back):p + ahead + 1]
        known = None if mine is None or None in near else set().union(*near)
        out.append(None if known is None or mine <= known else "".join(sorted(known)))
    return out


def _cut_names(names: DataFrame, scripts: list[tuple], as_name: str) -> DataFrame:
    """(script, swapped, rest, name): each name without the places that a script takes out, if these hold all characters
    that the other side lacks."""
    spark = names.sparkSession
    windows = spark.createDataFrame([(k, n, w) for k, n, _, w in scripts], "script int, n int, known array<string>")
    cuts = spark.createDataFrame([(k, list(taken), ",".join(map(str, swapped))) for k, n, cut, _ in scripts
                                  for taken, swapped in cut], "script int, taken array<int>, swapped string")
    must = F.filter(F.sequence(F.lit(0), F.size("known") - 1), lambda p: F.coalesce(
        ~F.contains(F.get("known", p), F.substring("name", p + 1, F.lit(1))), F.lit(False)))
    asked = names.withColumn("n", F.length("name")).join(F.broadcast(windows), "n").withColumn("must", must)
    cut = asked.join(F.broadcast(cuts), "script").filter(
        (F.size("must") == 0) | (F.size(F.array_except("must", "taken")) == 0))
    # what is left of a name of which at most two places are taken out
    a, b, more = F.get("taken", F.lit(0)), F.get("taken", F.lit(1)), F.size("taken")
    rest = F.when(more == 0, F.col("name")).when(more == 1, F.concat(
        F.substring("name", F.lit(1), a), F.substring("name", a + 2, F.length("name")))).otherwise(F.concat(
            F.substring("name", F.lit(1), a), F.substring("name", a + 2, b - a - 1), F.substring("name", b + 2, F.length("name"))))
    return cut.select("script", "swapped", rest.alias("rest"), F.col("name").alias(as_name))


def cut_matches(left: DataFrame, right: DataFrame, edits: int, cutoff: float) -> DataFrame:
    """Pairs (left_name, right_name) at most ``edits`` (1 or 2) apart, with all that the best by edit ratio needs: for each
    left name that has no right name fewer edits away, and each length, the greatest right name exactly that many edits away.

    Two names are that many edits apart if they are alike once some of their
    characters are taken out: the dropped ones, and the swapped ones at the same
    places of the rest. All right names with one such rest are as far from a left
    name with the same rest, so the index holds the greatest of them only, one
    for each rest: it grows with the names, not with the pairs. A character that
    the other side never has nearby must be among those taken out. Longer names
    than ``CUT_LENGTH`` are left out."""
    la, ra = _alphabets(left), _alphabets(right)
    ask, index = [], []
    for n, m in ((n, m) for n in la for m in ra):
        if 1 - edits / max(n, m) < cutoff - 1e-9:
            continue
        for drop in range(edits + 1):
            add = m - n + drop
            swap = edits - drop - add
            if add >= 0 and swap >= 0 and drop + swap <= n:
                k = len(ask)
                ask.append((k, n, _cuts(n, drop, swap), _windows(la[n], ra[m], drop, add)))
                index.append((k, m, _cuts(m, add, swap), _windows(ra[m], la[n], add, drop)))
    if not ask:
        return left.sparkSession.createDataFrame([], "left_name string, right_name string")
    greatest = _cut_names(right, index, "right_name").groupBy("script", "swapped", "rest").agg(
        F.max("right_name").alias("right_name"))
    return _cut_names(left, ask, "left_name").join(greatest, ["script", "swapped", "rest"]).select("left_name", "right_name")


def _scored(pairs: DataFrame, cutoff: float, measure: str) -> DataFrame:
    score = levenshtein_ratio("right_name", "left_name") if measure == "levenshtein" else sequence_ratio(
        F.col("right_name"), F.col("left_name"))
    best = pairs.withColumn("score", score).filter(F.col("score") >= F.lit(cutoff)).groupBy("left_name").agg(
        F.max(F.struct("score", "right_name")).alias("b"))
    return best.select("left_name", F.col("b.right_name").alias("right_name"), F.col("b.score").alias("score"))


def best_matches(left: DataFrame, right: DataFrame, cutoff: float = 0.7, measure: str = "levenshtein",
                 few_pairs: int = FEW_PAIRS) -> DataFrame:
    """For each left name, the right name with the best score >= cutoff
    (ties: the greater name).  ``measure`` is ``'levenshtein'`` (native) or
    ``'difflib'`` (matching-blocks ratio, Arrow-batched Python on candidate
    pairs only).  Output: left_name, right_name, score.

    Names are first compared with those at most 1, 2 and 4 edits away, found by
    a segment index; by the edit ratio, names of up to ``CUT_LENGTH`` characters
    with equal ones and those 1 and 2 edits away by ``cut_matches``, which
    doesn't grow with the pairs of look-alike names. A name is settled when its best score is above what any
    name further away can reach: with more edits e than asked for, the edit
    ratio of a name of n characters is at most 1 - e / (n + e) and the
    matching-blocks ratio at most 1 - e / (2 n + e). Names that stay unsettled
    (most of them have no match) go to the prefix filter of
    ``similar_name_candidates``, as do short lists and cutoffs too low for
    segments."""
    if measure not in ("levenshtein", "difflib"):
        raise ValueError(f"unknown measure {measure}")
    if not 0 < cutoff <= 1:
        raise ValueError("cutoff must be in (0, 1]")
    checkpoint_dir(left.sparkSession)
    names = lambda df: df.select(F.col(df.columns[0]).alias("name")).filter(F.col("name").isNotNull()).distinct()
    todo, rn = names(left).checkpoint(), names(right).checkpoint()
    # edits for every character of the shorter-or-equal name that a pair at the cutoff can have
    most_edits = (1 - cutoff) / cutoff if measure == "levenshtein" else 2 * (1 - cutoff) / cutoff
    found = []
    if most_edits < 1 and todo.count() * rn.count() > few_pairs:
        longest = F.length("left_name") * (1 if measure == "levenshtein" else 2)
        cut = measure == "levenshtein"
        short = lambda df: df.filter(F.length("name") <= CUT_LENGTH)
        near = None                                 # the best so far of the names that aren't settled
        for edits in (0, *RADII) if cut else RADII:
            if edits == 0:
                pairs = todo.join(rn, "name").select(F.col("name").alias("left_name"), F.col("name").alias("right_name"))
            elif cut and edits <= CUT_EDITS:
                pairs = cut_matches(short(todo), short(rn), edits, cutoff)
                long = F.length("name") > CUT_LENGTH - edits
                ll, rl = todo.filter(long), rn.filter(long)
                if not ll.isEmpty() and not rl.filter(F.length("name") > CUT_LENGTH).isEmpty() or not ll.filter(
                        F.length("name") > CUT_LENGTH).isEmpty():
                    pairs = pairs.unionByName(segment_candidates(ll, rl, edits, most_edits))
            else:
                pairs = segment_candidates(todo, rn, edits, most_edits)
            if near is not None:
                pairs = pairs.unionByName(near.join(todo.select(F.col("name").alias("left_name")), "left_name", "left_semi"))
            best = _scored(pairs, cutoff, measure).checkpoint()
            beyond = 1 - (edits + 1) / (longest + edits + 1)
            settled = best.filter(F.col("score") > beyond + 1e-12)
            near = best.select("left_name", "right_name") if cut else None
            found.append(settled)
            todo = todo.join(settled.select(F.col("left_name").alias("name")), "name", "left_anti").checkpoint()
            if todo.isEmpty():
                return union_all(found)
    return union_all([*found, _scored(similar_name_candidates(todo, rn, cutoff, measure), cutoff, measure)])
