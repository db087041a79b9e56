"""Fixed-point money with 29 whole digits and 9 decimals.

Spark's decimals have 38 digits, as many as such a number, but the results of
its arithmetic don't: a product or difference of two ``decimal(38,9)`` is given
fewer decimals.  Here wide numbers are worked on as whole billionths
(``decimal(38,0)``) or cut into two limbs, whose results are exact and are
carried into one number at the end.  Numbers of up to 19 whole digits, nearly
all, take Spark's own arithmetic, which is exact for them; the other branch is
only evaluated for the rest.  A result that no 29 whole digits hold is null.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimtide.functions.branches import apart
from claimtide.schemas import NARROW_TYPE, VALUE_TYPE

#: billionths in one; digits of a limb of a factor, of all digits.
UNITS = Decimal(10**9)
LOW_DIGITS, DIGITS = 18, 38
WHOLE = "decimal(38,0)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whole_part(c: Column | str) -> Column:
    """The number without its decimals, ``decimal(30,0)``."""
    c = _col(c)
    return F.when(c >= 0, F.floor(c)).otherwise(F.ceil(c))


def billionths(c: Column | str) -> Column:
    """The decimals as a long, with the number's sign."""
    return ((_col(c) % F.lit(1)) * F.lit(UNITS)).cast("long")


def _number(units: Column) -> Column:
    """The number of so many billionths (each operand stands here once, which
    keeps the generated code small)."""
    padded = F.regexp_replace(units.cast("string"), "^(-?)", "$1" + "0" * 9)
    return F.regexp_replace(padded, r"(\d{9})$", ".$1").try_cast(VALUE_TYPE)


def _units(c: Column) -> Column:
    """All billionths of a number."""
    return F.replace(c.cast("string"), F.lit("."), F.lit("")).cast(WHOLE)


def _limb(value: Column, first: int, digits: int) -> Column:
    """Some of the 38 digits of a number's billionths, with its sign."""
    sign = F.when(value < 0, "-").otherwise("")
    # as text: abs and negation keep 34 digits only
    every = F.lpad(F.regexp_replace(value.cast("string"), "[-.]", ""), DIGITS, "0")
    return F.concat(sign, F.substring(every, first, digits)).cast(f"decimal({digits},0)")


def _narrow(*columns: Column) -> Column:
    """Whether Spark's own arithmetic is exact."""
    held = F.lit(True)
    for c in columns:
        held = held & c.try_cast(NARROW_TYPE).isNotNull()
    return held


def product(value: Column | str, rate: Column | str) -> Column:
    """``value * rate`` at 9 decimals, halves away from zero; ``rate`` is a
    ``decimal(18,9)``."""
    value, rate = _col(value), _col(rate)
    high_digits = DIGITS - LOW_DIGITS

    def wide(value: Column) -> Column:
        # (20,0) x (18,0) and (18,0) x (18,9) are exact; one of the former is
        # 10^9 billionths, one of the latter a billionth
        high = F.try_multiply(_limb(value, 1, high_digits), (rate * F.lit(UNITS)).cast("decimal(18,0)")).cast(WHOLE)
        low = F.round(_limb(value, high_digits + 1, LOW_DIGITS) * rate, 0).cast(WHOLE)
        return _number(F.try_add(F.try_multiply(high, F.lit(UNITS)).cast(WHOLE), low))

    exact = F.when(_narrow(value), value.try_cast(NARROW_TYPE) * rate).otherwise(apart(value, wide))
    return F.when(rate == 1, value).otherwise(exact)


def difference(a: Column | str, b: Column | str) -> Column:
    """``a - b`` at 9 decimals."""
    a, b = _col(a), _col(b)
    wide = _number(F.try_subtract(_units(a), _units(b)))
    return F.when(_narrow(a, b), (a.try_cast(NARROW_TYPE) - b.try_cast(NARROW_TYPE)).cast(VALUE_TYPE)).otherwise(wide)


def total(c: Column | str) -> Column:
    """The sum of a column, so that only the result must fit.  Numbers of up to
    19 whole digits are added up by Spark, exactly for 10^10 rows; the others
    limb by limb: whole parts and billionths apart, the carry is taken once.
    Rows without a value add nothing; without any the sum is null."""
    c = _col(c)
    narrow = c.try_cast(NARROW_TYPE)
    wide = F.when(narrow.isNull(), c)
    common, whole, units = F.sum(narrow), F.sum(whole_part(wide)).cast(WHOLE), F.sum(billionths(wide))
    rest = F.coalesce(common, F.lit(0).cast(VALUE_TYPE))
    whole_sum, units_sum = F.try_add(whole, whole_part(rest)).cast(WHOLE), units + billionths(rest)
    with_wide = _number(F.try_add(F.try_multiply(whole_sum, F.lit(UNITS)).cast(WHOLE), units_sum))
    return F.when(whole.isNull(), common).otherwise(with_wide)
