"""Reproducible samples and exact stratified splits, by hash instead of by chance."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from marea.functions.bounded import broadcast_if_small
from marea.functions.hashing import HASH_SPACE, seeded, seeded_number


def hash_sample(df: DataFrame, id_col: str, fraction: float, seed: int = 42,
                limit: int | None = None) -> DataFrame:
    """Rows whose hash falls below ``fraction``, the same rows on every run; with
    ``limit``, the first so many of them in hash order."""
    number = seeded_number(F.col(id_col), seed)
    sample = df.where(number < F.lit(int(fraction * HASH_SPACE)))
    return sample if limit is None else sample.orderBy(number, id_col).limit(limit)


def random_sample(df: DataFrame, fraction: float, seed: int = 42, limit: int | None = None) -> DataFrame:
    """Spark's own sample, then a limit: no id is needed, but which rows it takes depends on
    the partitions. ``hash_sample`` takes the same rows everywhere."""
    sample = df.sample(fraction=fraction, seed=seed)
    return sample if limit is None else sample.limit(limit)


def class_quotas(classes: DataFrame, fraction: float) -> DataFrame:
    """(label, quota) from (label, rows): ceil(fraction * n) test rows in all, shared out by
    largest remainder, ties by label. Only one row per class is ordered, never the rows."""
    every = Window.partitionBy()
    shared = classes.withColumn("total", F.sum("rows").over(every)) \
        .withColumn("wanted", F.ceil(F.lit(float(fraction)) * F.col("total")).cast("long")) \
        .withColumn("exact", F.col("rows") * F.col("wanted") / F.col("total")) \
        .withColumn("quota", F.floor("exact").cast("long"))
    nth = F.row_number().over(Window.orderBy(F.col("quota") - F.col("exact"), "label"))
    left = F.col("wanted") - F.sum("quota").over(every)
    return shared.select("label", (F.col("quota") + (nth <= left).cast("long")).alias("quota"))


def _edges(bins: DataFrame, fraction: float) -> DataFrame:
    """Per class the hash prefix at the cut, and how many of its rows are still test rows."""
    quotas = broadcast_if_small(class_quotas(bins.groupBy("label").agg(F.sum("n").alias("rows")), fraction))
    by_bin = Window.partitionBy("label").orderBy("bin")
    edge = (bins.withColumn("end", F.sum("n").over(by_bin)).join(quotas, "label")
            .where("quota <= end and quota > end - n")
            .select("label", "bin", (F.col("quota") - F.col("end") + F.col("n")).alias("take")))
    return broadcast_if_small(edge)


def stratified_split(df: DataFrame, id_col: str, label_col: str, fraction: float = 0.2,
                     seed: int = 42, hex_digits: int = 4) -> DataFrame:
    """Add ``part`` (``train`` / ``test``) with exact class shares.

    Rows without a label are left out. Within a class the rows with the smallest
    hashes are the test rows. The cut is
    found from counts per hash prefix, then from the rows that share the prefix at
    the cut, so a class is neither sorted nor shuffled, however large it is.
    """
    rows = df.where(F.col(label_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"),
        F.md5(seeded(F.col(id_col), seed)).alias("hash"))
    rows = rows.withColumn("bin", F.substring("hash", 1, hex_digits))
    bins = rows.groupBy("label", "bin").agg(F.count("*").alias("n")).persist()
    try:
        edge = _edges(bins, fraction)
    finally:
        bins.unpersist()
    by_hash = Window.partitionBy("label").orderBy("hash", "id")
    cut = (rows.join(edge, ["label", "bin"]).withColumn("nth", F.row_number().over(by_hash))
           .where("nth = take").select(F.col("label").alias("_label"), F.col("hash").alias("_hash"),
                                       F.col("id").alias("_id")))
    cut = broadcast_if_small(cut)
    own = F.md5(seeded(F.col(id_col), seed))
    first = (own < F.col("_hash")) | ((own == F.col("_hash")) & (F.col(id_col) <= F.col("_id")))
    return (df.where(F.col(label_col).isNotNull())
            .join(cut, F.col(label_col) == F.col("_label"), "left")
            .withColumn("part", F.when(first, "test").otherwise("train"))
            .drop("_label", "_hash", "_id"))
