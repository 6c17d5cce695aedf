"""Consistent-hash sharding with virtual nodes and bounded loads.

Every shard owns the arcs before its virtual nodes on a hash ring. Keys that find
their shard full continue clockwise to the next virtual node whose shard has room.
The ring is divided into a fixed number of cells, and a cell moves as one, so the
plan needs one histogram of fixed size, whatever the number of documents. Copies of
one text have one key, hence one cell and one shard.

A shard holds at most ``load_factor`` times the mean, in bytes. Only a cell that is
larger than that by itself (thousands of copies of one text) is dealt in parts, by
its documents' ids. Cells are placed largest first, which keeps the bound with the
smallest ``load_factor``.

Defined cases: a null text counts as empty text; a null id hashes as empty text;
repeated rows are separate rows with slots of their own; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from marea.llm.common import column, documents, hash_key
from marea.session import materialized

SHARDS = 8
VIRTUAL_NODES = 128
CELL_BITS = 16
PART_BITS = 6
LOAD_FACTOR = 1.005
HEAVY_SHARE = 512       # a cell above this part of all rows or bytes is counted in parts


def ring(shards: int, virtual_nodes: int, cell_bits: int = CELL_BITS) -> list[tuple[int, int]]:
    """Sorted (cell, shard) of all virtual nodes; adding a shard moves no other node."""
    def cell(shard: int, node: int) -> int:
        digest = hashlib.md5(f"shard {shard} node {node}".encode()).digest()
        return int.from_bytes(digest[:8], "big") >> (64 - cell_bits)

    return sorted((cell(s, v), s) for s in range(shards) for v in range(virtual_nodes))


def place(loads: dict[tuple[int, int], int], nodes: list[tuple[int, int]], shards: int,
          load_factor: float = LOAD_FACTOR) -> dict[tuple[int, int], int]:
    """Shard of each (cell, part); all parts of a cell go together if any shard can hold them."""
    capacity = load_factor * sum(loads.values()) / shards
    room = [capacity] * shards
    cells: dict[int, list[tuple[int, int]]] = {}
    for unit in sorted(loads):
        cells.setdefault(unit[0], []).append(unit)
    units = []
    for parts in cells.values():
        whole = sum(loads[p] for p in parts)
        units += [(whole, parts)] if whole <= capacity else [(loads[p], [p]) for p in parts]
    placed = {}
    for load, parts in sorted(units, key=lambda unit: (-unit[0], unit[1])):
        at = bisect_left(nodes, (parts[0][0], -1))
        clockwise = (nodes[(at + step) % len(nodes)][1] for step in range(len(nodes)))
        shard = next((s for s in clockwise if room[s] >= load), max(range(shards), key=room.__getitem__))
        room[shard] -= load
        placed.update(dict.fromkeys(parts, shard))
    return placed


def shard(docs: DataFrame, shards: int = SHARDS, virtual_nodes: int = VIRTUAL_NODES,
          load_factor: float = LOAD_FACTOR, id_col: str = "doc_id", text_col: str = "text",
          cell_bits: int = CELL_BITS, heavy_share: int = HEAVY_SHARE) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` per document. Texts are hashed where
    they are read; a shuffle moves only these numbers, by cell.

    To the driver go the histogram, at most 2^cell_bits rows, and the parts of heavy
    cells, at most 2 * heavy_share * 2^PART_BITS rows.
    """
    spark = docs.sparkSession
    doc_id = column(docs, id_col)
    text = F.coalesce(column(docs, text_col), F.lit("")).cast("binary")
    cell = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    base = materialized(docs.select(
        doc_id.alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.shiftright(cell, 32 - cell_bits).cast("int").alias("cell"),
        F.pmod(hash_key(doc_id, seed=0), F.lit(1 << PART_BITS)).cast("int").alias("part")))
    totals = [F.count("*").alias("rows"), F.sum("size").alias("bytes")]
    cells = base.groupBy("cell").agg(*totals).toArrow().to_pylist()
    limits = {name: sum(c[name] for c in cells) / heavy_share for name in ("rows", "bytes")}
    heavy = {c["cell"] for c in cells if any(c[name] > limits[name] for name in limits)}
    units = {(c["cell"], -1): (c["bytes"], c["rows"]) for c in cells if c["cell"] not in heavy}
    if heavy:
        wanted = F.broadcast(spark.createDataFrame(pa.table({"cell": pa.array(sorted(heavy), pa.int32())})))
        parts = base.join(wanted, "cell").groupBy("cell", "part").agg(*totals).toArrow().to_pylist()
        units |= {(p["cell"], p["part"]): (p["bytes"], p["rows"]) for p in parts}
    placed = place({u: b for u, (b, _) in units.items()}, ring(shards, virtual_nodes, cell_bits),
                   shards, load_factor)
    filled, rows = [0] * shards, []
    for unit in sorted(units):
        rows.append((*unit, placed[unit], filled[placed[unit]]))
        filled[placed[unit]] += units[unit][1]
    names = ("cell", "counted_part", "shard", "first_slot")
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
    columns = zip(*rows) if rows else ([],) * len(names)
    plan = spark.createDataFrame(pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)}))
    # One row of the plan matches a document: that of its cell, or of its part in a heavy cell.
    matches = (base["cell"] == plan["cell"]) & plan["counted_part"].isin(-1) | \
        (base["cell"] == plan["cell"]) & (plan["counted_part"] == base["part"])
    found = base.join(F.broadcast(plan), matches).drop(plan["cell"])
    order = Window.partitionBy("cell", "counted_part").orderBy("text_crc32", "doc_id", "size")
    return found.select("doc_id", "size", "text_crc32", "shard",
                        (F.col("first_slot") + F.row_number().over(order) - 1).alias("slot"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
