"""Scalar cleaning functions as Spark Column expressions.

Every function here returns a ``Column`` built from Spark's own expressions,
so it stays inside whole-stage codegen; nothing is evaluated row by row in
Python.  ANSI mode is assumed on: text is only ever converted with ``try_*``.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordersmith.schema import FILE_NAME_ANCHOR, NULL_TOKENS, TIMESTAMP_NULL_TOKENS

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------- X1
def strip_newlines(c: ColumnOrName) -> Column:
    """LF becomes a space, CR is removed (text without either is passed as is,
    without rewriting the value)."""
    return F.replace(F.replace(_col(c), F.lit("\n"), F.lit(" ")), F.lit("\r"), F.lit(""))


# --------------------------------------------------------------------------- X2
def null_tokens_to(c: ColumnOrName, replacement: str | None = None,
                   tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """Map null and the textual null tokens to ``replacement`` (null by default).

    Tokens match the whole value only, so ``'Nantes'`` stays as it is.
    """
    x = _col(c)
    out = F.lit(replacement).cast("string")
    return F.when(x.isNull() | x.isin(list(tokens)), out).otherwise(x)


def blank_to_null(c: ColumnOrName) -> Column:
    x = _col(c)
    return F.when(F.trim(x) == "", F.lit(None).cast("string")).otherwise(x)


# --------------------------------------------------------------------------- X9
def nan_to_null(c: ColumnOrName) -> Column:
    x = _col(c)
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def to_number(c: ColumnOrName) -> Column:
    """Tolerant numeric cast: text that is not a number becomes null (NaN too)."""
    return nan_to_null(_col(c).cast("string").try_cast("double"))


# --------------------------------------------------------------------------- X3
def currency_to_double(c: ColumnOrName) -> Column:
    """Keep only digits, '.' and '-' then cast; anything unparsable is null.

    ``'NT$1,234.5'`` -> 1234.5, ``'(100)'`` -> 100, ``'1e3'`` -> 13 (the letter is
    removed before the cast, as the exports are cleaned).
    """
    x = _col(c).cast("string")
    # the characters that aren't kept are themselves the list of those to remove; none for a plain number
    kept = F.call_function("translate", x, F.translate(x, "0123456789.-", ""), F.lit(""))
    return kept.try_cast("double")        # no letter is left, so never NaN


# --------------------------------------------------------------------------- X4
def fraction_of_percent(number: Column) -> Column:
    """A percentage already read as a number, as a fraction; null counts as 0."""
    return F.coalesce(number, F.lit(0.0)) / F.lit(100.0)


def percent_to_fraction(c: ColumnOrName) -> Column:
    """``'2%'`` -> 0.02; unparsable or null counts as 0; always divides by 100."""
    return fraction_of_percent(currency_to_double(c))


# --------------------------------------------------------------------------- X8
def whole_number(number: Column) -> Column:
    """A double without a fraction as bigint, any other as null (NaN too)."""
    return F.when(~F.isnan(number) & (number == F.floor(number)), number.try_cast("bigint")) \
            .otherwise(F.lit(None).cast("bigint"))


def to_nullable_long(c: ColumnOrName) -> Column:
    """Integer text (``'1'``, ``'1.0'``) to bigint; fractions and text are null."""
    return whole_number(_col(c).cast("string").try_cast("double"))


def is_fractional_integer_text(c: ColumnOrName) -> Column:
    """True where an integer column holds a number with a fraction (reject reason)."""
    d = to_number(c)
    return d.isNotNull() & (d != F.floor(d))


# --------------------------------------------------------------------------- X5
# Six characters read as YYMMDD the way a strptime-style parser does: month and
# day are matched left to right with these alternatives and the match must
# cover all six characters (so '9901 5' is 1999-01-05 but '991311' fails).
_YYMMDD_FULL = r"^(\d\d)(1[0-2]|0[1-9]|[1-9])(3[01]|[12]\d|0[1-9]|[1-9]| [1-9])$"


def with_order_date_from_sn(df: DataFrame, sn_col: str = "order_sn", out_col: str = "order_date") -> DataFrame:
    """Order date encoded at the head of the order number.

    The first six characters are read as YYMMDD (years 69-99 -> 19xx, 00-68 ->
    20xx); if that fails and there are at least eight characters, the first
    eight are read as YYYYMMDD.  Anything else is null.  The six-character
    reading wins, so ``'20101204..'`` is 2020-10-12.

    The head is written as ``yyyy-m-d`` and read by a cast: the few
    expressions of a row keep the generated code of a whole cleaning small
    enough to be compiled (see ``plans.clean.type_order_columns``).
    """
    c = F.col
    d = df.withColumn("__x5_s", F.trim(F.col(sn_col).cast("string")))
    d = d.withColumn("__x5_h", F.substring("__x5_s", 1, 6))
    # six digits are cut at their places, only other heads need the layout's alternatives
    cut = F.when(c("__x5_h").rlike("^[0-9]{6}$"), F.concat(
        F.substring("__x5_h", 1, 2), F.lit("-"), F.substring("__x5_h", 3, 2), F.lit("-"), F.substring("__x5_h", 5, 2))).when(
        (F.length("__x5_h") == 6) & c("__x5_h").rlike(_YYMMDD_FULL), F.replace(F.regexp_replace("__x5_h", _YYMMDD_FULL, "$1-$2-$3"), F.lit(" "), F.lit("")))
    d = d.withColumn("__x5_6", cut)
    d = d.withColumn("__x5_6", F.concat(F.when(c("__x5_6") >= "69", "19").otherwise("20"), c("__x5_6")).try_cast("date"))
    # a year from 1 on
    eight = F.when(c("__x5_6").isNull() & c("__x5_s").rlike("^(?!0000)[0-9]{8}"), F.concat(
        F.substring("__x5_s", 1, 4), F.lit("-"), F.substring("__x5_s", 5, 2), F.lit("-"), F.substring("__x5_s", 7, 2)))
    d = d.withColumn("__x5_8", eight)
    return d.withColumn(out_col, F.coalesce(c("__x5_6"), c("__x5_8").try_cast("date"))).drop("__x5_s", "__x5_h", "__x5_6", "__x5_8")


# --------------------------------------------------------------------------- X6
DATE_FORMATS = ["yyyy-M-d", "yyyy/M/d", "yyyyMMdd", "M/d/yyyy"]


def to_date_tolerant(c: ColumnOrName, formats: Iterable[str] = DATE_FORMATS) -> Column:
    """Date from text in any of the accepted layouts (time of day ignored); else null."""
    x = F.trim(_col(c).cast("string"))
    day = F.regexp_extract(x, r"^([0-9]{1,4}[-/][0-9]{1,2}[-/][0-9]{1,4}|[0-9]{8})(?:$|[ T])", 1)
    # most cells are read by the cast; a layout is only tried on text with its separator
    layouts = list(formats)
    slash, dash = x.contains("/"), x.contains("-")
    readers = []
    for has, of in ((slash, [f for f in layouts if "/" in f]), (~slash & dash, [f for f in layouts if "-" in f]),
                    (~slash & ~dash, [f for f in layouts if "/" not in f and "-" not in f])):
        if of:
            readers.append(F.when(has & (F.length(x) >= 5), F.coalesce(*[F.try_to_date(day, f) for f in of])))
    return F.coalesce(x.try_cast("date"), *readers)


# --------------------------------------------------------------------------- X7
def to_timestamp_tolerant(c: ColumnOrName, null_tokens: Iterable[str] = TIMESTAMP_NULL_TOKENS) -> Column:
    """Wall-clock timestamp (no zone) from ``yyyy-MM-dd[ HH:mm[:ss]]`` or the
    same with '/' separators; placeholders such as ``'-'`` give null.  A value
    with a zone (``Z``, ``+08:00``) is no wall-clock time and gives null too."""
    x = F.trim(_col(c).cast("string"))
    zoned = x.rlike(r":[0-9]{2}(\.[0-9]+)? ?([Zz]|[+-][0-9]{1,2}(:?[0-9]{2})?|UTC|GMT)$")
    return F.when(~(x.isin(list(null_tokens)) | zoned), F.replace(x, F.lit("/"), F.lit("-")).try_cast("timestamp_ntz"))


# --------------------------------------------------------------------------- X15
def day_text(c: ColumnOrName) -> Column:
    """A date or time as ``2025-06-04``."""
    return F.date_format(_col(c), "yyyy-MM-dd")


def minute_text(c: ColumnOrName) -> Column:
    """A time as ``2025/06/04 09:05``."""
    return F.date_format(_col(c), "yyyy/MM/dd HH:mm")


# --------------------------------------------------------------------------- X10-X13
def key_part(c: ColumnOrName) -> Column:
    """Trimmed text with null tokens and blanks as null: one column of a key."""
    x = F.trim(_col(c).cast("string"))
    return F.when(x.isNull() | x.isin(["nan", "NaN", "<NA>", "None", ""]),
                  F.lit(None).cast("string")).otherwise(x)


def display_order_key(date: ColumnOrName, sn: ColumnOrName, buyer: ColumnOrName) -> Column:
    """Human-readable order key ``date|||sn|||buyer`` with NO_* placeholders.

    For display only: joins use the key columns themselves (null-safe).
    """
    return F.concat_ws(
        "|||",
        F.coalesce(_col(date).cast("string"), F.lit("NO_DATE")),
        F.coalesce(key_part(sn), F.lit("NO_ORDER")),
        F.coalesce(key_part(buyer), F.lit("NO_BUYER")),
    )


def sku_key(c: ColumnOrName) -> Column:
    """Variation SKU for the line key: blank or null becomes ``NULL_SKU``."""
    x = F.trim(_col(c).cast("string"))
    return F.coalesce(F.when(x != "", x), F.lit("NULL_SKU"))


# --------------------------------------------------------------------------- S8
def file_shop_name(file_name: ColumnOrName) -> Column:
    """Shop name: text before the first '_' of a well-formed order file name."""
    f = _col(file_name)
    return F.when(file_name_is_valid(f), F.substring_index(f, "_", 1))


def file_shop_account(file_name: ColumnOrName) -> Column:
    """Shop account: text between the first '_' and the order-file anchor."""
    f = _col(file_name)
    u = F.instr(f, "_")
    a = F.instr(f, FILE_NAME_ANCHOR)
    return F.when(file_name_is_valid(f), f.substr(u + 1, a - u - 1))


def file_name_is_valid(file_name: ColumnOrName) -> Column:
    f = _col(file_name)
    u = F.instr(f, "_")
    a = F.instr(f, FILE_NAME_ANCHOR)
    # non-empty shop before the first '_', non-empty account before the anchor
    return f.isNotNull() & (u > 1) & (a > u + 1)


# --------------------------------------------------------------------------- X18
def pct(part: ColumnOrName, whole: ColumnOrName, digits: int = 1) -> Column:
    """Percentage ``part / whole * 100`` rounded; null when ``whole`` is 0."""
    w = _col(whole).cast("double")
    return F.round(F.when(w != 0, _col(part).cast("double") / w * 100.0), digits)
