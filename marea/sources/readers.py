"""Scans: tables, CSV with an explicit schema, whole text files, small local rows."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table by name, or a folder of files by path."""
    if "/" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.read.table(name_or_path)


NULL_TEXT = "\\N"      # an unquoted cell of this text, or an empty unquoted one, is null
SPLITS_PER_TASK = 16     # of ``read_texts``
NULL_ID = "__HIVE_DEFAULT_PARTITION__"      # in a path, Spark's word for a null


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             multi_line: bool = False) -> DataFrame:
    """CSV with a header; quoted cells may hold doubled quotes, and ``""`` is empty text.

    Files are split among tasks. Cells with line breaks need ``multi_line``, which
    reads each file in one task. Without a schema every column stays text, as the
    bronze layer wants it; inference would cost a second pass over the files.
    """
    reader = (spark.read.option("header", True).option("multiLine", multi_line)
              .option("quote", '"').option("escape", '"').option("nullValue", NULL_TEXT).option("emptyValue", ""))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_whole_text(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """One row per file; with ``recursive``, of the folders below ``path`` as well. ``wholetext``
    must be the keyword: the method's own default overrides an ``option`` of the same name."""
    return spark.read.text(path, wholetext=True, recursiveFileLookup=recursive)


def read_texts(spark: SparkSession, path: str, id_col: str) -> DataFrame:
    """``id_col, value``: the files that ``writers.write_texts`` wrote, with the id (text) that
    stands in a file's path.

    Spark counts a file as 4 MB at least, which makes a task of every few dozen files, so
    tasks take ``SPLITS_PER_TASK`` such splits each where that leaves enough for all cores.
    """
    name = F.regexp_extract(F.col("_metadata.file_path"), f"/{re.escape(id_col)}=([^/]*?)(?:/[^/]*|[.]txt)$", 1)
    rows = read_whole_text(spark, path, recursive=True).select(F.nullif(name, F.lit(NULL_ID)).alias(id_col), "value")
    return rows.coalesce(max(rows.rdd.getNumPartitions() // SPLITS_PER_TASK, 4 * spark.sparkContext.defaultParallelism))


def local_rows(spark: SparkSession, rows: Iterable, schema: StructType | str) -> DataFrame:
    """A few driver-side rows (questions, tags) as a DataFrame."""
    return spark.createDataFrame(list(rows), schema)
