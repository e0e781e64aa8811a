"""Column-expression helpers for the dialect rules of the migration.

Every helper returns a native Spark ``Column`` (JVM-side, whole-stage codegen);
none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Fixed values that must equal the source system's text formats.
# Unit marks carried by the legacy text columns.
COST_MARK = "$"          # Items.cost, e.g. "$12.50"
TOTAL_MARK = "USD"       # Batches.total_value, e.g. "USD 1234.56"
PERCENT_MARK = "%"       # Transactions.amount, e.g. "40%"
# Country written on every migrated customer and supplier.
DEFAULT_COUNTRY = "USA"
# Customer code: first character of the trimmed name + first 4 hex digits of
# SHA-1 over the name's UTF-16LE bytes (the server's NVARCHAR encoding),
# upper-cased; the whole name counts.
CODE_HASH_CHARSET = "UTF-16LE"
CODE_HASH_DIGITS = 4

MONEY = DecimalType(19, 4)
EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

_MONEY_RE = r"^[+-]?(\d+\.?\d*|\.\d+)$"
_INT_RE = r"^[+-]?\d+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: Column | str) -> Column:
    """``c IS NULL OR trim(c) = ''`` (trim removes blanks only, not tabs)."""
    c = _col(c)
    return c.isNull() | (F.trim(c) == F.lit(""))


def parse_money(c: Column | str, mark: str | None = None) -> Column:
    """Lenient money parse: strip the unit mark, blanks and thousands commas.

    Returns ``decimal(19,4)`` or null. Blank text is null (an error for the
    validation rules); exponent notation is refused; overflow is null.
    """
    s = _col(c)
    if mark:
        s = F.replace(s, F.lit(mark), F.lit(""))
    s = F.regexp_replace(F.trim(s), ",", "")
    return F.when(s.rlike(_MONEY_RE), s.try_cast(MONEY))


def parse_percent_int(c: Column | str, mark: str = PERCENT_MARK) -> Column:
    """``TRY_CAST(REPLACE(c, '%', '') AS INT)``: '33.5%' and 'bad%' are null."""
    s = F.trim(F.replace(_col(c), F.lit(mark), F.lit("")))
    return F.when(s.rlike(_INT_RE), s.try_cast("int"))


def strict_money(c: Column | str, mark: str | None = None) -> Column:
    """``CAST(.. AS MONEY)`` for rows already known to be valid: raises (ANSI) on bad text."""
    s = _col(c)
    if mark:
        s = F.replace(s, F.lit(mark), F.lit(""))
    return F.regexp_replace(F.trim(s), ",", "").cast(MONEY)


def customer_code(c: Column | str) -> Column:
    """Five-character customer code; null for a null or blank name."""
    t = F.trim(F.coalesce(_col(c), F.lit("")))
    digest = F.sha1(F.encode(t, CODE_HASH_CHARSET))
    code = F.upper(F.concat(F.substring(t, 1, 1), F.substring(digest, 1, CODE_HASH_DIGITS)))
    return F.when(F.length(t) > 0, code)


def epoch_digits_to_ts(c: Column | str) -> Column:
    """First 10 digits of an epoch number read as seconds (s and ms both work).

    The int cast is strict (ANSI): more than 2^31 seconds fails the run, as
    the source conversion does.
    """
    secs = F.substring(_col(c).cast("string"), 1, 10).cast("int")
    return F.timestamp_add("SECOND", secs, F.expr(EPOCH_NTZ))


def epoch_millis(c: Column | str) -> Column:
    """Milliseconds since 1970 of a ``timestamp_ntz`` (time-zone free)."""
    return F.timestamp_diff("MILLISECOND", F.expr(EPOCH_NTZ), _col(c))


def epoch_seconds(c: Column | str) -> Column:
    return F.timestamp_diff("SECOND", F.expr(EPOCH_NTZ), _col(c))


def shift_years(c: Column | str, years: int) -> Column:
    """``DATEADD(year, n, c)``: keeps the time of day; 29 Feb becomes 28 Feb."""
    return F.timestamp_add("YEAR", F.lit(years), _col(c))


def int_div(num: Column, den: Column) -> Column:
    """Integer division truncating toward zero (``a div b``)."""
    return F.call_function("div", num, den)


def round_half_up_div(num: Column, den: Column) -> Column:
    """``round(num / den)`` half away from zero, exact on integers of either sign (den not 0)."""
    q = int_div(F.abs(num) * 2 + F.abs(den), F.abs(den) * 2)
    return F.when((num < 0) != (den < 0), -q).otherwise(q)


def json_object(**cols: Column | str) -> Column:
    """``JSON_OBJECT('k': v, ...)`` as compact text, keys in the given order."""
    return F.to_json(F.struct(*[_col(v).alias(k) for k, v in cols.items()]))


def money_to_units(c: Column) -> Column:
    """decimal(19,4) money as an exact long count of ten-thousandths."""
    return (c * 10000).cast("long")


def units_to_double(c: Column, scale: int = 4) -> Column:
    """Exact integer units back to a double (correctly rounded)."""
    return c.cast("double") / F.lit(float(10**scale))


def ntz_lit(value) -> Column:
    """A ``timestamp_ntz`` literal from a datetime/date/ISO text, independent of
    the Python process's and the session's time zone."""
    import datetime as dt

    if isinstance(value, dt.datetime):
        text = value.replace(tzinfo=None).isoformat(sep=" ")
    elif isinstance(value, dt.date):
        text = value.isoformat() + " 00:00:00"
    else:
        text = str(value)
    return F.lit(text).cast("timestamp_ntz")
