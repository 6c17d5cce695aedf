"""Vectors as numbered blocks, and every block of one side beside every block of another.

A block is one row: up to ``rows`` vectors of one length as a matrix in bytes, beside
their ids as an Arrow stream. Searches work on pairs of blocks, so that a task moves
megabytes and multiplies matrices instead of handling pairs of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marea.session import materialized

BLOCK_ROWS = 1024
BROADCAST_BYTES = 32 * 1024 * 1024      # of asked blocks that travel to every executor
BLOCKS_PER_LANE = 128
LANES_PER_CORE = 4       # while lanes hold fewer blocks than that; each lane gets all asked blocks

BLOCK_SCHEMA = "block long, dims int, n int, ids binary, matrix binary"


def encoded(rows: pa.RecordBatch | pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as stream:
        stream.write(rows)
    return sink.getvalue().to_pybytes()


def decoded(data) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def matrix_of(lists: pa.Array, dtype=np.float64) -> np.ndarray:
    """Vectors of one length as a matrix; a null component is NaN."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return flat.reshape(len(lists), -1 if len(flat) else 0)


def pack(id_cols: int, rows: int, finite: bool, dtype=np.float64):
    """Task function: ids and a vector to blocks. Null vectors and those with a missing
    component (or, if ``finite``, an infinite one) are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        first, made = TaskContext.get().partitionId() << 32, 0
        held: dict[int, list[tuple[pa.Table, np.ndarray]]] = {}

        def block(dims: int) -> pa.RecordBatch:
            ids = pa.concat_tables([t for t, _ in held[dims]]).combine_chunks()
            matrix = np.concatenate([m for _, m in held[dims]])
            held[dims] = []
            return pa.RecordBatch.from_arrays(
                [pa.array([first + made], pa.int64()), pa.array([dims], pa.int32()), pa.array([len(matrix)], pa.int32()),
                 pa.array([encoded(ids)], pa.binary()), pa.array([matrix.tobytes()], pa.binary())],
                names=["block", "dims", "n", "ids", "matrix"])

        for batch in batches:
            table = pa.Table.from_batches([batch]).filter(batch.column(id_cols).is_valid())
            if not len(table):
                continue
            sizes = table.column(id_cols).combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
            for dims in np.unique(sizes):
                same = table.filter(pa.array(sizes == dims))
                matrix = matrix_of(same.column(id_cols).combine_chunks(), dtype) if dims else np.zeros((len(same), 0), dtype)
                good = np.isfinite(matrix).all(axis=1) if finite else ~np.isnan(matrix).any(axis=1)
                same, matrix = same.select(list(range(id_cols))).filter(pa.array(good)), matrix[good]
                begin = 0
                while begin < len(matrix):
                    parts = held.setdefault(int(dims), [])
                    take = min(rows - sum(len(m) for _, m in parts), len(matrix) - begin)
                    parts.append((same.slice(begin, take), matrix[begin:begin + take]))
                    begin += take
                    if sum(len(m) for _, m in parts) == rows:
                        yield block(int(dims))
                        made += 1
        for dims in [d for d, parts in held.items() if parts]:
            yield block(dims)
            made += 1

    return run


def blocks(df: DataFrame, id_cols: list[str], vector_col: str, rows: int = BLOCK_ROWS,
           finite: bool = False, *, dtype=np.float64) -> DataFrame:
    """``df`` as blocks: ``block`` (a number), ``dims``, ``n``, ``ids`` and ``matrix`` (of ``dtype``, by rows)."""
    ordered = df.select(*[df["`" + c.replace("`", "``") + "`"] for c in [*id_cols, vector_col]])
    return ordered.mapInArrow(pack(len(id_cols), rows, finite, dtype), BLOCK_SCHEMA)


def total_bytes(written: DataFrame) -> int:
    blobs = [F.octet_length(f.name) for f in written.schema if f.dataType.simpleString() == "binary"]
    return written.agg(F.coalesce(F.sum(sum(blobs, F.lit(0)).cast("long")), F.lit(0))).first()[0]


def beside(asked: DataFrame, corpus: DataFrame, on: list[str], max_broadcast: int = BROADCAST_BYTES) -> DataFrame:
    """Every block of ``asked`` (a written table; its columns but ``on`` start with ``q_``)
    beside every block of ``corpus`` that agrees in ``on``.

    Asked blocks of a checked size go to where the corpus blocks are made. More of them are
    joined by lanes: the corpus, packed once and written, is dealt to lanes of about a hundred
    blocks, and each lane gets all asked blocks, one after the other. Either way the
    corpus is scanned once.
    """
    names = [c for c in corpus.columns if c not in on]
    if total_bytes(asked) <= max_broadcast:
        lanes, near = 1, F.broadcast(asked)
        placed = corpus.withColumn("lane", F.lit(0))
    else:
        corpus = materialized(corpus)
        spark = corpus.sparkSession
        busy = min(int(spark.conf.get("spark.sql.shuffle.partitions")),
                   LANES_PER_CORE * spark.sparkContext.defaultParallelism)
        lanes, near = max(2, busy, corpus.count() // BLOCKS_PER_LANE), asked
        placed = corpus.withColumn("lane", F.pmod(F.xxhash64("block"), F.lit(lanes)).cast("int"))
    near = near.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    if lanes == 1 and not on:
        # A lane that the optimizer knows would leave a join without keys.
        near = asked.withColumn("lane", F.pmod(F.xxhash64("q_block"), F.lit(1)).cast("int"))
        placed = corpus.withColumn("lane", F.pmod(F.xxhash64("block"), F.lit(1)).cast("int"))
    if lanes == 1:
        near = F.broadcast(near)
    return near.join(placed, ["lane", *on]).select(*on, *[c for c in asked.columns if c not in on], *names)
