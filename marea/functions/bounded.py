"""Small sides of a join: broadcast only once their size is known."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType, StructType

from marea.session import materialized

MAX_ROWS = 500_000
MAX_BYTES = 32 * 1024 * 1024


def local_frame(spark: SparkSession, rows: list[dict], schema: StructType | str) -> DataFrame:
    """A few driver-side rows as a local relation, whose size the optimizer knows."""
    if not rows:
        return spark.createDataFrame([], schema)
    return spark.createDataFrame(pa.Table.from_pylist(rows), schema)


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Evaluate a statistics frame once, into the shared folder, and mark the written table
    for broadcast if it has at most ``max_rows`` rows that take at most ``max_bytes``.

    A larger one comes back without a hint, so that the join shuffles both sides. Either
    way it is computed once, however often it is used.
    """
    written = materialized(df)
    sizes = [F.octet_length(F.col("`" + f.name.replace("`", "``") + "`")) if isinstance(f.dataType, (StringType, BinaryType))
             else F.size(F.col("`" + f.name.replace("`", "``") + "`")) * 8 if isinstance(f.dataType, ArrayType)
             else F.lit(16) for f in df.schema]
    row = sum(map(lambda size: F.coalesce(size, F.lit(0)), sizes), F.lit(0).cast("long"))
    found = written.agg(F.count("*").alias("rows"), F.coalesce(F.sum(row), F.lit(0)).alias("bytes")).first()
    return F.broadcast(written) if found["rows"] <= max_rows and found["bytes"] <= max_bytes else written
