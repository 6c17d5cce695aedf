"""Packing token sequences shortest pack first.

Documents are tokenised, ended with one more id, and cut where they exceed a
sequence. The histogram of the pieces' lengths, one count per possible length, is
packed on the driver: lengths go longest first, each into the pack that is shortest
so far, and packs of one pattern are kept as a count. Patterns then become ranges of
ranks within each length, and every piece finds its sequence by its own rank.

Defined cases: a null text is an empty text, which is the end id alone; repeated
rows, and rows with a null id, are packed each on their own; an empty table gives
no pieces.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from marea.llm.common import column, documents
from marea.session import scratch_path

SEQUENCE = 1024
END_ID = 0
BLOCK = 128             # documents whose ids a task holds at a time
PIECES = ("part int, rank_in_part long, doc_id {id_type}, start long, length int, doc_tokens long, "
          "ids binary")

# --- Fixed values -----------------------------------------------------------
# How byte-level vocabularies with this splitter cut a text before merging.
SPLITTER = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# ----------------------------------------------------------------------------


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes
    for themselves, the others for the letters from 256 on, in order."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


def encoder(definition: str) -> Callable[[str], Sequence[int]]:
    """Text to ids, as the ``tokenizers`` library gives them without added special tokens.

    A byte-level vocabulary whose ids follow its merges gives the same ids through
    ``tiktoken`` at four times the speed; texts that hold an added token, and all other
    vocabularies, go through ``tokenizers`` itself.
    """
    loaded = []

    def exact(text: str) -> Sequence[int]:
        if not loaded:      # rarely needed beside the fast one, and large
            from tokenizers import Tokenizer

            loaded.append(Tokenizer.from_str(definition))
        return loaded[0].encode(text, add_special_tokens=False).ids

    spec = json.loads(definition)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    added = [t["content"] for t in spec.get("added_tokens", ())]
    plain = (model.get("type") == "BPE" and before.get("type") == "ByteLevel"
             and not before.get("add_prefix_space") and before.get("use_regex", True)
             and not spec.get("normalizer") and not model.get("dropout") and not model.get("byte_fallback"))
    letters = byte_letters()
    if plain:
        merged = ("".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"])
        plain = all(model["vocab"].get(token) == 256 + n for n, token in enumerate(merged))
    if not plain:
        return exact

    import tiktoken

    ranks = {bytes(letters[c] for c in token): n for token, n in model["vocab"].items() if token not in added}
    fast = tiktoken.Encoding("byte level", pat_str=SPLITTER, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> Sequence[int]:
        if any(token in text for token in added):
            return exact(text)
        return fast.encode_ordinary(text)

    return encode


def cut_tokens(definition: str, limit: int, end_id: int):
    """Task function: (doc_id, text) batches to pieces, numbered by length within the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(definition), TaskContext.get().partitionId()
        seen = np.zeros(limit + 1, np.int64)
        for batch in batches:
            for rows in (batch.slice(n, BLOCK) for n in range(0, batch.num_rows, BLOCK)):
                ids = [np.array([*encode(t or ""), end_id], "<u4") for t in rows.column(1).to_pylist()]
                tokens = np.array([len(x) for x in ids], np.int64)
                pieces = -(-tokens // limit)
                of = np.repeat(np.arange(len(ids)), pieces)
                first = np.cumsum(pieces) - pieces
                start = (np.arange(len(of)) - first[of]) * limit
                length = np.minimum(tokens[of] - start, limit)
                order = np.argsort(length, kind="stable")
                counts = np.bincount(length, minlength=limit + 1)
                rank = np.empty(len(of), np.int64)
                rank[order] = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
                rank += seen[length]
                seen += counts
                ends = np.concatenate(([0], np.cumsum(length))).astype(np.int64) * 4
                data = np.concatenate(ids) if ids else np.zeros(0, "<u4")
                blobs = pa.Array.from_buffers(pa.large_binary(), len(of), [None, pa.py_buffer(ends), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(of), part, np.int32)), pa.array(rank), rows.column(0).take(pa.array(of)),
                     pa.array(start), pa.array(length.astype(np.int32)), pa.array(tokens[of]),
                     blobs.cast(pa.binary())],
                    names=["part", "rank_in_part", "doc_id", "start", "length", "doc_tokens", "ids"])

    return run


def token_pieces(docs: DataFrame, definition: str, limit: int = SEQUENCE, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written table of pieces, with their ids as little-endian unsigned 32-bit numbers.

    Tokenising is the costly step, so it runs once; pieces are numbered by task and
    length there, which is only stable in a written table.
    """
    spark = docs.sparkSession
    doc_id = column(docs, id_col)
    schema = PIECES.format(id_type=docs.select(doc_id).schema[0].dataType.simpleString())
    pieces = docs.select(doc_id.alias("doc_id"), column(docs, text_col).alias("text")) \
        .mapInArrow(cut_tokens(definition, limit, end_id), schema)
    path = scratch_path(spark, "pieces")
    pieces.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(pieces.schema).parquet(path)


def shortest_pack_first(histogram: dict[int, int], limit: int) -> list[tuple[int, tuple[int, ...]]]:
    """(number of packs, lengths in the pack) for every packing pattern used."""
    by_room: list[list[tuple[int, tuple[int, ...]]]] = [[] for _ in range(limit + 1)]
    for length in range(limit, 0, -1):
        left, widest = histogram.get(length, 0), limit
        while left:
            while widest >= length and not by_room[widest]:
                widest -= 1
            count, pattern = by_room[widest].pop() if widest >= length else (left, ())
            room = widest if pattern else limit
            used = min(count, left)
            if count > used:
                by_room[room].append((count - used, pattern))
            by_room[room - length].append((used, (*pattern, length)))
            left -= used
    return [pack for packs in by_room for pack in packs]


def slots(packs: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, sequence of the first rank, offset) for every place
    of every pattern: the pieces of that length with those ranks fill it in order."""
    given: dict[int, int] = {}
    found, sequence = [], 0
    for count, pattern in packs:
        offset = 0
        for length in pattern:
            first = given.get(length, 0)
            found.append((length, first, first + count, sequence, offset))
            given[length] = first + count
            offset += length
        sequence += count
    return found


def pack(pieces: DataFrame, limit: int = SEQUENCE) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``. To the driver goes one count per
    length, and back one row per place of a pattern, both bounded by ``limit``."""
    spark = pieces.sparkSession
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = slots(shortest_pack_first(histogram, limit))
    names, kinds = ("length", "from_rank", "to_rank", "first_sequence", "offset"), (pa.int32(), *[pa.int64()] * 4)
    columns = zip(*places) if places else ([],) * len(names)
    plan = spark.createDataFrame(pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)}))
    ranked = pieces.join(starts, ["part", "length"]) \
        .withColumn("rank", F.col("first") + F.col("rank_in_part"))
    here = (ranked["length"] == plan["length"]) & (ranked["rank"] >= plan["from_rank"]) \
        & (ranked["rank"] < plan["to_rank"])
    return (ranked.join(F.broadcast(plan), here).drop(plan["length"])
            .withColumn("sequence_id", F.col("first_sequence") + F.col("rank") - F.col("from_rank"))
            .drop("part", "rank_in_part", "first", "rank", "first_sequence", "from_rank", "to_rank"))


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, tokens, ids``: the packed ids of each sequence, in order."""
    pieces = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("tokens"), pieces.alias("pieces")) \
        .select("sequence_id", "tokens", F.aggregate(
            "pieces", F.lit(b""), lambda joined, piece: F.concat(joined, piece["ids"])).alias("ids"))


def definition_of(path: str | None = None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        return file.read()


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces without their ids, which a checksum stands for."""
    return pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")).select(
        "doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens",
        "sequence_id", "offset")


def op4_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    return digest(token_pieces(documents(spark, sf_dir), definition_of(tokenizer)))
