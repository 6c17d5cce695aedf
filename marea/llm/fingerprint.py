"""Context-triggered piecewise hashing.

A rolling hash over the last seven bytes ends a chunk wherever its low bits are zero,
so chunk ends follow the content and an edit moves only those near it. Each chunk
gives one letter of a signature. The block size, a power of two, is the smallest at
which the whole text has at most 64 chunks; a fingerprint holds the signatures at
that size and at twice that size, ``bits:signature:signature``. Two fingerprints are
compared by edit distance wherever they hold signatures of one block size.

Defined cases: a null text counts as empty, whose fingerprint has empty signatures;
rows follow each other by descending id, a null id last, rows of one id by their
text; a table of one row is its own successor; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marea.llm.common import column, documents

WINDOW = 7
MAX_CHUNKS = 64
FIRST_BITS = 2
SHARED_RUN = 4          # signatures of any length share this many letters in a row, or are unlike
LONG_SIGNATURE = 16     # from here on
NULL_ID = -(1 << 63)

# --- Fixed values -----------------------------------------------------------
LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
# ----------------------------------------------------------------------------


def byte_numbers() -> np.ndarray:
    """A fixed random 32-bit number for each byte."""
    return np.array([int.from_bytes(hashlib.md5(bytes([b])).digest()[:4], "little") for b in range(256)], np.uint32)


def rolling(data: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Hash of the up to seven bytes that end at each byte."""
    terms = numbers[data]
    hashes = terms.copy()
    factor = 1
    for back in range(1, min(WINDOW, len(data))):
        factor = factor * 0x01000193 & 0xFFFFFFFF
        hashes[back:] += terms[:-back] * np.uint32(factor)
    hashes ^= hashes >> np.uint32(15)
    hashes *= np.uint32(0x2C1B3C6D)
    hashes ^= hashes >> np.uint32(13)
    return hashes


def fingerprint(text: str, numbers: np.ndarray) -> str:
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if not len(data):
        return f"{FIRST_BITS}::"
    hashes = rolling(data, numbers)
    bits = FIRST_BITS
    ends = np.flatnonzero((hashes & np.uint32((1 << bits) - 1)) == 0)
    while True:
        if len(ends) and ends[-1] == len(data) - 1:
            ends = ends[:-1]                        # the end of the text closes the last chunk
        if len(ends) < MAX_CHUNKS or bits == 32:
            break
        bits += 1
        ends = ends[hashes[ends] & np.uint32(1 << (bits - 1)) == 0]
    sums = np.add.reduceat(hashes * np.uint32(0x9E3779B1), np.concatenate(([0], ends + 1)), dtype=np.uint32)
    wider = np.flatnonzero(hashes[ends] >> np.uint32(min(bits, 31)) & np.uint32(1) == 0)
    signatures = [sums, np.add.reduceat(sums, np.concatenate(([0], wider + 1)), dtype=np.uint32)]
    letters = np.frombuffer(LETTERS, np.uint8)
    shown = [letters[(s * np.uint32(0x85EBCA6B)) >> np.uint32(26)].tobytes().decode() for s in signatures]
    return f"{bits}:{shown[0]}:{shown[1]}"


def with_fingerprint(docs: DataFrame, out: str = "fingerprint", text_col: str = "text") -> DataFrame:
    """``docs`` and the fingerprint of each whole text."""
    def run(texts: pd.Series) -> pd.Series:
        numbers = byte_numbers()
        return pd.Series([fingerprint(t or "", numbers) for t in texts], dtype=object)

    return docs.withColumn(out, F.pandas_udf(run, "string")(column(docs, text_col)))


def alike(one: Column, other: Column) -> Column:
    """1 less the edit distance of two signatures over the longer length; 0 for long
    signatures without a run of letters in common, which only chance makes similar."""
    longer = F.greatest(F.length(one), F.length(other))
    runs = F.transform(F.sequence(F.lit(1), F.length(one) - (SHARED_RUN - 1)),
                       lambda i: F.substr(one, i, F.lit(SHARED_RUN)))
    chance = (F.least(F.length(one), F.length(other)) >= LONG_SIGNATURE) \
        & ~F.exists(runs, lambda run: F.contains(other, run))
    return F.when((longer == 0) | chance, F.lit(0.0)).otherwise(1 - F.levenshtein(one, other) / longer)


def likeness(one: Column, other: Column) -> Column:
    """0 to 1; 1 for equal fingerprints, 0 for block sizes that do not meet."""
    bits = [F.split_part(f, F.lit(":"), F.lit(1)).cast("int") for f in (one, other)]
    fine = [F.split_part(f, F.lit(":"), F.lit(2)) for f in (one, other)]
    coarse = [F.split_part(f, F.lit(":"), F.lit(3)) for f in (one, other)]
    return (F.when(one == other, F.lit(1.0))
            .when(bits[0] == bits[1], F.greatest(alike(fine[0], fine[1]), alike(coarse[0], coarse[1])))
            .when(bits[0] + 1 == bits[1], alike(coarse[0], fine[1]))
            .when(bits[0] == bits[1] + 1, alike(fine[0], coarse[1]))
            .otherwise(F.lit(0.0)))


def in_ranges(docs: DataFrame, key: str, ranges: int) -> DataFrame:
    """``docs`` with ``range`` and ``guest``, sorted by range and descending key in each
    partition, where each range ends with the row that follows it, as a guest.

    To the driver go the bounds of the ranges and the first key of each.
    """
    bounds = sorted(set(docs.approxQuantile(key, [n / ranges for n in range(1, ranges)], 0.2 / ranges))) \
        if ranges > 1 else []
    edges = np.array([int(b) for b in bounds], np.int64)

    def find(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, keys.to_numpy(), side="right"))

    number = F.pandas_udf(find, "int")
    tops = {r["range"]: r["top"] for r in docs.select(number(key).alias("range"), key)
            .groupBy("range").agg(F.max(key).alias("top")).collect()}
    full = sorted(tops)
    hosts = {tops[below]: above for below, above in zip(full, full[1:])}
    if full:
        hosts[tops[full[-1]]] = full[0]
    here = F.struct(F.col("own").alias("range"), F.lit(False).alias("guest"))
    host = F.create_map(*[F.lit(x).cast(kind) for pair in hosts.items() for x, kind in zip(pair, ("long", "int"))]) \
        if hosts else F.lit(None).cast("map<bigint,int>")
    visit = F.try_element_at(host, F.col(key))
    places = F.when(visit.isNull(), F.array(here)) \
        .otherwise(F.array(here, F.struct(visit.alias("range"), F.lit(True).alias("guest"))))
    return (docs.withColumn("own", number(key)).withColumn("place", F.explode(places))
            .select("place.range", "place.guest", *docs.columns)
            .repartition(max(1, ranges), "range").sortWithinPartitions("range", "guest", F.desc(key), "text"))


FOLLOWED = ("doc_id {id_type}, n_chars long, edited_sha256 string, fingerprint string, "
            "edited_fingerprint string, next_fingerprint string")


def compare_followers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: each own row with the row after it in its range."""
    numbers, last = byte_numbers(), None
    for batch in batches:
        out: list[list] = [[] for _ in range(6)]
        for place, guest, doc_id, text in zip(*(batch.column(n).to_pylist() for n in ("range", "guest", "doc_id", "text"))):
            text = text or ""
            own = (place, guest, doc_id, text, fingerprint(text, numbers))
            if last and last[0] == place and not last[1]:
                size = len(last[3])
                edited = last[3][:size - size // 3] + text[:size // 3]
                digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                row = (last[2], size, digest, last[4], fingerprint(edited, numbers), own[4])
                for values, value in zip(out, row):
                    values.append(value)
            last = own
        kinds = [batch.schema.field("doc_id").type, pa.int64(), *[pa.string()] * 4]
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint"]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], names=names)


def followed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its fingerprint, that of its text with the last third replaced by the
    start of the next document, and that of the next document."""
    spark = docs.sparkSession
    doc_id = column(docs, id_col)
    rows = docs.select(F.coalesce(doc_id, F.lit(NULL_ID)).cast("long").alias("key"), doc_id.alias("doc_id"),
                       column(docs, text_col).alias("text"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = FOLLOWED.format(id_type=rows.schema["doc_id"].dataType.simpleString())
    return in_ranges(rows, "key", ranges).mapInArrow(compare_followers, schema)


def op6_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = followed(documents(spark, sf_dir))
    own = F.col("fingerprint")
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       likeness(own, F.col("edited_fingerprint")).alias("near_edited"),
                       likeness(own, F.col("next_fingerprint")).alias("near_next"))
