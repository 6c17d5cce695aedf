"""Profiles and target statistics over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DecimalType, FractionalType, NumericType, StringType

from marea.functions.bounded import broadcast_if_small
from marea.functions.numeric import no_nan
from marea.functions.text import compact_text
from marea.operators.ordered import binned_values, exact_quantiles


def columns_of(df: DataFrame, *types: type) -> list[str]:
    """Names of the columns whose data type is one of ``types``, in order."""
    return [f.name for f in df.schema if isinstance(f.dataType, types)]


def _as_text(df: DataFrame, name: str) -> Column:
    col, dtype = F.col(name), df.schema[name].dataType
    if isinstance(dtype, StringType):
        return compact_text(col)
    # NaN is a missing value, and negative zero is zero.
    return (no_nan(col) + F.lit(0.0) if isinstance(dtype, FractionalType) and not isinstance(dtype, DecimalType)
            else col).cast("string")


def _blank(df: DataFrame, name: str) -> Column:
    """Whether a text holds nothing but spaces; asked before long texts become digests."""
    if not isinstance(df.schema[name].dataType, StringType):
        return F.lit(False)
    return F.coalesce(F.trim(F.col(name)) == "", F.lit(False))


def profile_columns(df: DataFrame, exact: bool = True) -> DataFrame:
    """Per column: position, type, rows, nulls, null share in %, blanks, distinct values.

    Counts first collapse per (column, value) on the map side, and long texts count
    by digest. ``exact=False`` estimates the distinct values in one pass instead.
    """
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("position"), _as_text(df, f.name).alias("value"), _blank(df, f.name).alias("blank"))
        for i, f in enumerate(df.schema)])))
    blank = F.col("blank").cast("int")
    if exact:
        values = long.groupBy("position", "value", "blank").agg(F.count("*").alias("n"))
        stats = values.groupBy("position").agg(
            F.sum("n").alias("n_rows"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
            F.sum(blank * F.col("n")).alias("blank_count"), F.count("value").alias("distinct_count"))
    else:
        stats = long.groupBy("position").agg(
            F.count("*").alias("n_rows"), (F.count("*") - F.count("value")).alias("null_count"),
            F.sum(blank).alias("blank_count"), F.approx_count_distinct("value").alias("distinct_count"))
    label = lambda texts: F.get(F.array(*map(F.lit, texts)), F.col("position"))
    return stats.select(
        "position", label(df.columns).alias("column"),
        label([f.dataType.simpleString() for f in df.schema]).alias("dtype"), "n_rows", "null_count",
        F.round(100 * F.col("null_count") / F.col("n_rows"), 2).alias("null_pct"), "blank_count", "distinct_count")


def table_shape(df: DataFrame) -> DataFrame:
    """One row ``n_rows, n_columns``."""
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: rows in all, and rows that repeat an earlier one (null equals null).

    Long texts are grouped by digest, so the shuffle never moves them.
    """
    keys = df.select(*[(compact_text(F.col(f.name)) if isinstance(f.dataType, StringType)
                        else F.col(f.name)).alias(f.name) for f in df.schema])
    return (keys.groupBy(*keys.columns).agg(F.count("*").alias("n"))
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
                 F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates")))


def value_counts(df: DataFrame, col: str, digits: int = 2) -> DataFrame:
    """Count and share in % of every non-null value, most frequent first."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return (counts.withColumn("share_pct", F.round(100 * F.col("n") / total, digits))
            .orderBy(F.desc("n"), col))


def category_by_target(df: DataFrame, target: str, exclude: tuple[str, ...] = (),
                       columns: list[str] | None = None) -> DataFrame:
    """Rows per category and target value, for every text column at once."""
    names = columns or [c for c in columns_of(df, StringType) if c != target and c not in exclude]
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                      for c in names])
    return (df.where(F.col(target).isNotNull()).select(target, F.inline(cells))
            .where("value is not null")
            .groupBy("column", "value", target).agg(F.count("*").alias("n")))


def numeric_by_target(df: DataFrame, target: str, columns: list[str] | None = None,
                      digits: int = 2) -> DataFrame:
    """Mean, median and sample deviation of every numeric column per target value."""
    names = columns or [c for c in columns_of(df, NumericType) if c != target]
    binned = binned_values(df, names, target)
    medians = exact_quantiles(binned, target, {"median": 0.5})
    moments = binned.groupBy("column", target).agg(F.avg("value").alias("mean"),
                                                   F.stddev_samp("value").alias("std"))
    return medians.join(moments, ["column", target]).select(
        "column", target, "n", *[F.round(c, digits).alias(c) for c in ("mean", "median", "std")])


def boxplot_stats(df: DataFrame, target: str, columns: list[str] | None = None,
                  digits: int = 4) -> DataFrame:
    """Quartiles, whisker ends (furthest values within 1.5 IQR) and outliers."""
    names = columns or [c for c in columns_of(df, NumericType) if c != target]
    binned = binned_values(df, names, target)
    quartiles = broadcast_if_small(
        exact_quantiles(binned, target, {"q1": 0.25, "median": 0.5, "q3": 0.75}))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    keys = ["column", target, "n", "q1", "median", "q3"]
    return (binned.join(quartiles, ["column", target]).groupBy(*keys)
            .agg(F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
                 F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
                 F.count_if(~inside).alias("n_outliers"))
            .select("column", target, "n", "n_outliers",
                    *[F.round(c, digits).alias(c)
                      for c in ("q1", "median", "q3", "whisker_low", "whisker_high")]))
