"""Sinks: layer tables with schema overwrite, CSV and JSON exports, text files, namespaces."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from marea.session import exists, make_folder, materialized
from marea.sources.readers import NULL_ID, NULL_TEXT

LAYERS = ("bronze", "silver", "gold")
FILES_PER_FOLDER = 1000     # of ``write_texts``: folders are listed in parallel, a folder by one task


def layer_path(root: str, layer: str, name: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}, expected one of {LAYERS}")
    return f"{root.rstrip('/')}/{layer}/{name}"


def write_layer(df: DataFrame, root: str, layer: str, name: str, fmt: str = "parquet",
                mode: str = "overwrite") -> str:
    """Write a layer table and return its path; an overwrite replaces the schema too."""
    path = layer_path(root, layer, name)
    writer = df.write.format(fmt).mode(mode)
    if fmt == "delta" and mode == "overwrite":
        writer = writer.option("overwriteSchema", "true")
    writer.save(path)
    return path


def replace_layer(df: DataFrame, root: str, layer: str, name: str, fmt: str = "parquet") -> str:
    """Overwrite a table with a frame that may have been read from that very table."""
    return write_layer(materialized(df), root, layer, name, fmt)


def save_table(df: DataFrame, table: str, fmt: str = "parquet", bucket_by: str | None = None,
               buckets: int = 200) -> None:
    """Overwrite a catalog table including its schema. Tables bucketed alike by a
    key join on it without a shuffle."""
    writer = df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(table)


def create_namespaces(spark: SparkSession, names: tuple[str, ...] = LAYERS) -> None:
    for name in names:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; cells with line breaks or quotes are quoted, and blanks at
    the ends of a cell stay. Nulls and empty texts are told apart."""
    (df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
       .option("nullValue", NULL_TEXT).option("emptyValue", '""')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per row, null fields kept."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_texts(df: DataFrame, path: str, id_col: str, text_col: str) -> None:
    """A text file for each id (a number or null), its path ending in ``id_col=id``, below a new
    folder; a text ends in a line break (a null is empty), and rows of one id that meet in a task
    share its file.

    On a mounted file system Hadoop starts processes (``chmod``) for each file and folder that
    Spark's writer makes, so there the tasks write the files. Other stores go through Spark's
    writer, with a folder for each id below one for each task, which is moved into place as a whole.
    """
    if exists(df.sparkSession, path):
        raise FileExistsError(path)
    place = urlsplit(make_folder(df.sparkSession, path))
    if place.scheme != "file":
        spread_out = df.select(F.spark_partition_id().alias("_task"), id_col, text_col)
        return spread_out.write.mode("append").partitionBy("_task", id_col).text(path)
    rows = df.sortWithinPartitions(id_col).select(
        F.coalesce(F.col(id_col).cast("string"), F.lit(NULL_ID)).alias("id"), F.col(text_col).cast("binary").alias("text"))
    written = rows.mapInArrow(_text_files(unquote(place.path), id_col, FILES_PER_FOLDER), "files long")
    written.write.format("noop").mode("overwrite").save()


def _text_files(root: str, id_col: str, most: int) -> Callable:
    """Writes batches of ``id, text``, rows of an id in a row, as files in folders of ``most``.
    A folder has a hidden name until it is full, so that an attempt that fails or is one of two
    leaves nothing that is read."""

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, nth, hidden, final = TaskContext.get(), 0, "", ""
        rows = (row for batch in batches for row in zip(batch["id"].to_pylist(), batch["text"].to_pylist()))
        for name, lines in groupby(rows, key=lambda row: row[0]):
            if nth % most == 0:
                if hidden:
                    _publish(hidden, final)
                hidden, final = f"{root}/.{task.taskAttemptId()}-{nth}", f"{root}/{task.partitionId()}-{nth}"
                os.mkdir(hidden)
            with open(f"{hidden}/{id_col}={name}.txt", "wb") as file:
                file.writelines((text or b"") + b"\n" for _, text in lines)
            nth += 1
        if hidden:
            _publish(hidden, final)
        yield pa.RecordBatch.from_pydict({"files": pa.array([nth], pa.int64())})

    return write


def _publish(hidden: str, final: str) -> None:
    """Show a folder under its final name, unless another attempt of the task was first."""
    try:
        os.rename(hidden, final)
    except OSError:
        if not os.path.isdir(hidden) or not os.path.isdir(final):
            raise
