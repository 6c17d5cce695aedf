"""Helpers that several operators share."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from marea.functions.hashing import seeded_number

KEY_BITS = 60           # of the md5 numbers that order rows
ROWS_PER_BUCKET = 4_000

# --- Fixed values -----------------------------------------------------------
# A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
# Labelled rows whose crc32(doc_id) has this remainder are never learnt from.
HELD_OUT_MODULUS, HELD_OUT_REMAINDER = 3, 1
# ----------------------------------------------------------------------------


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh(taken: Iterable[str], name: str) -> str:
    """``name``, or a variant of it that no column in ``taken`` has (in any case)."""
    lower = {column.lower() for column in taken}
    while name.lower() in lower:
        name += "_"
    return name


def column(df: DataFrame, name: str) -> Column:
    """A column by its exact name, also if the name holds dots."""
    return df["`" + name.replace("`", "``") + "`"]


def held_out(doc_id: Column) -> Column:
    """True for rows kept out of training; false for a null id."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(crc % HELD_OUT_MODULUS == HELD_OUT_REMAINDER, F.lit(False))


def hash_key(doc_id: Column, seed: int) -> Column:
    """Hash-random number of a row, below 2^60; a null id counts as empty text."""
    return seeded_number(F.coalesce(doc_id.cast("string"), F.lit("")), seed)


def bucket_bits(rows: int, per_bucket: int = ROWS_PER_BUCKET) -> int:
    """How many leading bits of a hash key split ``rows`` into buckets of about ``per_bucket``."""
    return min(KEY_BITS - 1, max(0, math.ceil(math.log2(max(rows, 1) / per_bucket))))


def running_sums(df: DataFrame, group: str, key: str, order: list[str], value: str, out: str,
                 bits: int) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows before this one in its group, in the
    order of ``key`` (a hash key) and then ``order``.

    Nothing sorts a whole group: each range of keys is summed, the sums are added up
    in key order, and only the rows of one range are sorted together. ``group`` must
    not be null. Both joined sides and the window use one exchange of the rows.
    """
    bucket, start = fresh(df.columns, "bucket"), fresh(df.columns, "start")
    keyed = df.withColumn(bucket, F.shiftright(key, KEY_BITS - bits).cast("int") if bits < 31
                          else F.shiftright(key, KEY_BITS - bits))
    sums = keyed.groupBy(group, bucket).agg(F.sum(value).alias(start))
    ranges = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn(start, F.coalesce(F.sum(start).over(ranges), F.lit(0)))
    within = (Window.partitionBy(group, bucket).orderBy(key, *order)
              .rowsBetween(Window.unboundedPreceding, -1))
    return (keyed.join(starts, [group, bucket])
            .withColumn(out, column(starts, start) + F.coalesce(F.sum(value).over(within), F.lit(0)))
            .drop(bucket, start))
