"""Null-on-error casts and fills, reproducing the non-ANSI results under ANSI.

* text -> INT/BIGINT: optional sign, digits and an optional fraction that is
  dropped (``"12.7"`` -> 12, as the non-ANSI cast did); anything else, or a
  value out of range, gives null.
* double -> DECIMAL: rounds half up, null on overflow.
* a ratio: null when the divisor is 0 or null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FRACTION_ONLY = r"^\s*[+-]?\.\d*\s*$"
_INTEGER_TEXT = r"^\s*([+-]?\d+)(\.\d*)?\s*$"
_DIGITS = r"^\d{1,18}\z"
_CONTROL = r"[\x00-\x1F\x7F]"
INT_LIMIT = 2_147_483_647


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _text_to_integral(c, type_name: str) -> Column:
    # A failing try_cast builds an exception with its message inside, which costs more than all else here: so digits are
    # read as BIGINT, which always fits, and narrowed; only odd texts are tried.
    c = _col(c)

    def narrowed(digits: Column) -> Column:
        long = digits.cast("bigint")
        return F.when(long.between(-INT_LIMIT - 1, INT_LIMIT), long.cast(type_name)) if type_name == "int" else long

    def odd(t: Column) -> Column:
        whole = F.regexp_extract(t, _INTEGER_TEXT, 1)
        return (
            F.when(whole != "", F.when(F.length(whole) <= 18, narrowed(whole)).otherwise(whole.try_cast(type_name)))
            # ".5", "+.5" and "." have no whole part, which counts as 0
            .when(t.rlike(_FRACTION_ONLY), F.lit(0).cast(type_name))
            # a cast trims control characters too
            .when(t.rlike(_CONTROL), t.try_cast(type_name))
        )

    # in a lambda, so that a row of many numbers makes no large generated method
    return F.when(c.rlike(_DIGITS), narrowed(c)).when(c.isNotNull(), F.transform(F.array(c), odd)[0])


def text_to_int(c) -> Column:
    return _text_to_integral(c, "int")


def text_to_bigint(c) -> Column:
    return _text_to_integral(c, "bigint")


def to_decimal(c, precision: int, scale: int) -> Column:
    return _col(c).try_cast(f"decimal({precision},{scale})")


def ratio(numerator, denominator) -> Column:
    """numerator / denominator as DOUBLE; null when the divisor is 0."""
    return _col(numerator).cast("double") / F.nullif(_col(denominator), F.lit(0)).cast("double")


def percent(numerator, denominator, precision: int = 22, scale: int = 2) -> Column:
    """(numerator / denominator * 100) as DECIMAL(p, s); null on 0 or overflow.

    The double is formed exactly as ``(n / d) * 100`` so every engine rounds the
    same value.
    """
    return to_decimal(ratio(numerator, denominator) * F.lit(100), precision, scale)


def fill_empty(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null -> '' on the named string columns."""
    return df.na.fill("", subset=columns)


def fill_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null -> 0 on the named numeric columns (keeps their types)."""
    return df.na.fill(0, subset=columns)
