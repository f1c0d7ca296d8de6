"""Missing values, numbers and normalised measurements as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fixed_values import NA_TOKENS, NUMBER_PATTERN


def missing_to_null(text: Column, na_tokens: Sequence[str] = NA_TOKENS) -> Column:
    return F.when(~text.isin(*na_tokens), text)


def to_number(text: Column) -> Column:
    """Number in a text, NULL when it is none. NaN and infinities never come out.

    A text that ends in a digit and is not hexadecimal is a plain number or
    fails to parse; only other texts are compared with the pattern.
    """
    plain = F.right(text, F.lit(1)).between("0", "9") & ~text.contains("x") & ~text.contains("X")
    number = F.when(plain | text.rlike(NUMBER_PATTERN), text.try_cast("double"))
    return F.when(F.abs(number) < float("inf"), number)


#: Bits of a limb, and the exponents of the limbs that a number is cut into.
LIMB = 32
EXPONENTS = (32, 0, -32, -64, -96)


def limbs(value: Column) -> list[Column]:
    """Whole numbers l with value = sum of l * 2**exponent, exactly, for |value| below 2**95.

    What lies below 2**-96 is cut off, each value by itself. A larger value fails.
    """
    rest, out = value / F.lit(2.0 ** EXPONENTS[0]), []
    for _ in EXPONENTS:
        whole = rest.cast("bigint")
        out.append(whole)
        rest = (rest - whole.cast("double")) * F.lit(2.0**LIMB)
    return out


def put_together(sums: Sequence[Column]) -> Column:
    """The double of sums of limbs, rounded from their carried form, which no order of addition changes.

    Carried limbs lie in [-2**31, 2**31), so a negative total loses nothing to the complement of a fraction.
    """
    half, carried, carry = F.lit(1 << (LIMB - 1)), [], F.lit(0).cast("bigint")
    for total in reversed(sums[1:]):
        now = total + carry
        carry = F.shiftright(now + half, LIMB)
        carried.append(now - F.shiftleft(carry, LIMB))
    *fraction, unit = carried
    below = F.lit(0.0)
    for limb in fraction:
        below = (limb.cast("double") + below) * F.lit(2.0**-LIMB)
    whole = (sums[0] + carry).cast("double") * F.lit(2.0**LIMB) + unit.cast("double")
    return whole + below


def sum_of(df: DataFrame, column: str) -> Column:
    """Sum over the present values of a column as a double, the same for every order of the rows; NULL when none is present.

    Doubles are added as whole numbers and put together once. Limbs of two thousand million values of one group fit; more
    may fail, but never give another sum. DECIMAL and whole numbers are added as they are.
    """
    value = F.col(f"`{column}`")
    if df.schema[column].dataType.typeName() not in ("float", "double"):
        return F.sum(value).cast("double")
    return put_together([F.sum(limb) for limb in limbs(value.cast("double"))])


def mean_of(df: DataFrame, column: str) -> Column:
    """Mean over the present values; NULL when none is present."""
    return F.try_divide(sum_of(df, column), F.count(F.col(f"`{column}`")).cast("double"))


def total_of(df: DataFrame, column: str) -> Column:
    """Sum over the present values; 0.0 when none is present."""
    return F.coalesce(sum_of(df, column), F.lit(0.0))


def mean_with_zeros(df: DataFrame, column: str) -> Column:
    """Mean in which a missing value counts as 0.0, in the denominator too."""
    return total_of(df, column) / F.count(F.lit(1)).cast("double")


def log2_cpm(count: Column, library: Column) -> Column:
    """log2(counts per million + 1); NULL for an empty library."""
    return F.log2(F.try_divide(count, library) * F.lit(1_000_000.0) + F.lit(1.0))
