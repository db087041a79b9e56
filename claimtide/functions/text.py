"""Text cleaning and safe casts as Column expressions (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimtide.functions.branches import apart
from claimtide.schemas import VALUE_TYPE

#: FIXED VALUES: the Unicode White_Space characters (the Unicode standard's
#: property list).  The warehouse TRIM strips all of them; Spark's one-argument
#: trim only strips the ASCII space.
UNICODE_WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

#: visible ASCII is from the former up to, but without, the latter.
FIRST_VISIBLE, AFTER_VISIBLE = "!", "\u007f"

#: the warehouse's date literal form YYYY-[M]M-[D]D.  Spark's own cast also
#: takes '2024', '2024-06' and trailing time parts; the guard rejects them.
DATE_TEXT = r"^\d{4}-\d{1,2}-\d{1,2}$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: Column | str) -> Column:
    """``trim(cast(c as string))`` with Unicode whitespace stripped
    (``trim(BOTH <white space> FROM c)``: a native string op, no regex).  A
    text that without its ASCII spaces is empty or begins and ends with visible
    ASCII, as nearly all do, or is null is done then: comparing its ends costs
    far less than the search."""
    text = F.trim(_col(c).cast("string"))
    # the last byte: a character beyond ASCII ends in none of these
    last = F.substring(text.cast("binary"), -1, 1)
    odd = (text < FIRST_VISIBLE) | (text >= AFTER_VISIBLE)
    odd = odd | (last < F.lit(FIRST_VISIBLE.encode())) | (last >= F.lit(AFTER_VISIBLE.encode()))
    return F.when((text != "") & odd, apart(text, lambda t: F.trim(t, F.lit(UNICODE_WHITESPACE)))).otherwise(text)


def upper_text(c: Column | str) -> Column:
    """``upper(c)``, which maps ASCII text byte by byte."""
    return F.upper(_col(c))


def blank_to_null(c: Column | str) -> Column:
    """``nullif(c, '')``."""
    return F.nullif(_col(c), F.lit(""))


def safe_date(c: Column | str, data_type: T.DataType | None = None) -> Column:
    """``safe_cast(c as date)``: null instead of an error.

    Dates and timestamps without a zone are converted directly, instants by
    their day in UTC whatever the session's zone; anything else goes through
    its text, which must have the date literal form.
    """
    col = _col(c)
    if isinstance(data_type, T.TimestampType):
        return F.date_from_unix_date(F.floor(F.unix_seconds(col) / 86_400).cast("int"))
    if isinstance(data_type, (T.DateType, T.TimestampNTZType)):
        return col.cast("date")
    text = col.cast("string")
    # of ten characters with both dashes in place and a digit at the end, the
    # cast takes four, two and two digits only; other texts are for the pattern
    full = (F.length(text) == 10) & (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    full = full & F.substring(text, 10, 1).between("0", "9")
    return F.when(text.isNull() | full, text.try_cast("date")).otherwise(apart(text, lambda t: F.when(t.rlike(DATE_TEXT), t.try_cast("date"))))


def safe_decimal(c: Column | str, data_type: T.DataType | None = None, target: T.DecimalType = VALUE_TYPE) -> Column:
    """``safe_cast(c as numeric)``: null on bad text or overflow."""
    col = _col(c)
    if isinstance(data_type, T.NumericType):
        return col.try_cast(target)
    return col.cast("string").try_cast(target)
