"""Partitioning of scans."""

from __future__ import annotations

from pyspark.sql import DataFrame

FEW_SPLITS = 16


def spread(scan: DataFrame) -> DataFrame:
    """Spread a small scan over all cores, where its files give a handful of splits,
    fewer than there are cores, and the work per row is heavy.

    Only a handful: that bounds what is shuffled to a few GB at the usual split
    size. Larger tables come back as they are, unshuffled. For plain scans and
    persisted frames: asking a frame with shuffles for its partitions would run them.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    splits = scan.rdd.getNumPartitions()
    return scan.repartition(cores) if splits < cores and splits <= FEW_SPLITS else scan
