"""Numbers from dirty text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Accepted spellings; Spark's own cast would also take suffixes such as "12d".
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

_LINE_ENDS = "\n\r\u0085\u2028\u2029"      # one of these may follow a match of ``$``


def to_number(col: Column, dtype: str = "double") -> Column:
    """Number, or null where the text is none."""
    text = F.trim(col.cast("string"))
    return F.when(F.regexp_like(text, F.lit(NUMBER)), text.try_cast(dtype))


def decimals(col: Column) -> Column:
    """How many decimal places a number written as text needs: 2 for ``12.75`` and ``1275e-2``, 0 for
    ``12.0``, -3 for ``1e3``. Null for zero and for what is no number."""
    text = F.trim(col.cast("string"))
    # Plain cuts of a checked text: a match for each part costs many times as much.
    bare = F.lower(F.ltrim(F.rtrim(text, F.lit(_LINE_ENDS)), F.lit("+-")))
    mantissa = F.substring_index(bare, "e", 1)
    whole = F.substring_index(mantissa, ".", 1)
    fraction = F.substring(mantissa, F.length(whole) + 2, F.length(mantissa))
    written = F.concat(whole, fraction)
    digits = F.rtrim(written, F.lit("0"))
    exponent = F.coalesce(F.when(F.contains(bare, F.lit("e")), F.substring_index(bare, "e", -1)).try_cast("int"), F.lit(0))
    known = F.regexp_like(text, F.lit(NUMBER)) & (F.ltrim(digits, F.lit("0")) != "")
    return F.when(known, F.length(fraction) - F.length(written) + F.length(digits) - exponent)


def no_nan(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def tidy(col: Column, digits: int) -> Column:
    """Rounded, with negative zero turned into zero."""
    return F.round(col, digits) + F.lit(0.0)


def order_key(col: Column) -> Column:
    """A long that orders like the double, and is equal only for equal numbers (zeros are one).

    The bits of the absolute value are its exponent and fraction, taken by exact scaling with
    powers of two: no function gives them, and a logarithm may miss the exponent by one. Null for NaN.
    """
    size = F.abs(col)
    two = lambda power: F.pow(F.lit(2.0), power)
    tiny, endless = 2.0 ** -1022, float("inf")
    near = F.least(F.greatest(F.floor(F.log2(size)), F.lit(-1022)), F.lit(1023))
    power = near + F.when(size < two(near), -1).when((near < 1023) & (size / two(near) >= 2), 1).otherwise(0)
    normal = (power + 1023) * F.lit(1 << 52) + ((size / two(power) - 1) * F.lit(2.0 ** 52)).cast("long")
    bits = (F.when(F.isnan(col), None).when(size == endless, F.lit(2047 << 52))
            .when(size < tiny, (size * F.lit(2.0 ** 537) * F.lit(2.0 ** 537)).cast("long")).otherwise(normal))
    return F.when(col < 0, -bits).otherwise(bits)
