"""Reproducible hashing: the same md5 number on every engine and partitioning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# 15 hexadecimal digits fit a signed 64-bit integer.
HEX_DIGITS = 15
HASH_SPACE = 16 ** HEX_DIGITS


def md5_number(col: Column) -> Column:
    """Integer in [0, 16^15) from the first digits of the md5 of a string."""
    return F.conv(F.substring(F.md5(col), 1, HEX_DIGITS), 16, 10).cast("long")


def seeded(id_col: Column, seed: int = 42) -> Column:
    """Text ``seed|id``: the value whose hash orders or samples the rows."""
    return F.concat(F.lit(f"{seed}|"), id_col.cast("string"))


def seeded_number(id_col: Column, seed: int = 42) -> Column:
    return md5_number(seeded(id_col, seed))
