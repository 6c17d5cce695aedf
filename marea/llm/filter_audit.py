"""How text filters interact, audited over a sparse document-term matrix.

Each task turns its documents into shards of a compressed sparse row matrix: row starts,
word numbers and counts, with the words numbered as the shard meets them. The words of
all shards meet in a global dictionary: a shard's distinct words are dealt to hash ranges,
a range sorts its words, and a word's id is its place within its range times the number
of ranges, plus the number of its range, so that no task and no driver holds the dictionary
and a repeated task gives the same ids. The number of ranges grows with the text. A shard
then takes the ids of its own words and is part of the one global matrix. Row sums are the documents' words,
nonzero counts their distinct words. What does not depend on words is attached to the rows.

The audit removes documents by every order of the filters. It needs no more than the number
of documents for each set of failed filters in a part of the table: documents are
counted by these sets first, so the orders multiply a few rows and not the documents.

What is shuffled: each shard's distinct words, twice, its compressed rows once, and a
digest per document. A shard ends with the document that brings it to a million words or
8 MB of text, and texts come in batches of 4 MB, none kept longer than it is read; so a task's
memory is bounded but for one document, whose words are read in pieces and whose distinct words are
held. A range of the dictionary holds each of its words once, however many shards share
them. Copies and repeated rows collapse map-side before they meet.

Defined cases: a null text is an empty one, which fails only the filter for short texts
and, as a copy, that for repeated texts; a null part is the empty one; a document repeats
if the table holds an equal text (by SHA-256) under a smaller id, so that rows of one id
and text are no repeats of each other, and rows with a null id neither repeat nor are
repeated; a document counts as good or toxic if any of its label rows says so; long texts
are read whole; columns of any other name are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, StructType

from marea.functions.bounded import broadcast_if_small
from marea.llm.common import column, documents
from marea.session import arrow_batches, materialized

SHARD_WORDS = 1_000_000
SHARD_BYTES = 8 * 1024 * 1024       # of text
ROW_BYTES = 256                     # counted for a document besides its text
PIECE_BYTES = 1024 * 1024           # of a long text split into words at once
BATCH_BYTES = 4 * 1024 * 1024       # of texts handed to a task at once
RANGE_BYTES = 16 * 1024 * 1024      # of text for each range of the dictionary

# --- Fixed values -----------------------------------------------------------
# Filters: A short, B repetitive, C capitals, D symbols, E an earlier document's text.
FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITAL_PERCENT = 200, 50, 3
SYMBOLS = "[#$%&*|]"
# ----------------------------------------------------------------------------


def packed(values: np.ndarray) -> bytes:
    """Integers as compressed bytes, the bytes of equal weight side by side."""
    return pa.compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T),
                       "zstd", asbytes=True)


def unpacked(data: bytes, count: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, count * size, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, count).T).view(kind).reshape(count)


GAP = re.compile(rb"[\x20\x09-\x0D]")


def pieces(text: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """A text in pieces that end between words, of ``size`` bytes or up to the next gap."""
    begin = 0
    while len(text) - begin > size and (gap := GAP.search(text, begin + size)):
        yield text[begin:gap.start()]
        begin = gap.end()
    yield text[begin:]


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class _Shard:
    """Rows gathered by a task, with words numbered in order of appearance."""

    def __init__(self):
        self.words = _Words()
        self.terms: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.rows: list[pa.StructArray] = []
        self.size = self.bytes = 0

    def add(self, text: bytes) -> None:
        cells: Counter[bytes] = Counter()
        for piece in pieces(text):
            found = piece.split()
            cells.update(found)
            self.size += len(found)
        self.bytes += len(text) + ROW_BYTES
        terms = np.fromiter(map(self.words.__getitem__, cells), np.uint32, len(cells))
        order = np.argsort(terms)
        self.terms.append(terms[order])
        self.counts.append(np.fromiter(cells.values(), np.uint32, len(cells))[order])

    def add_rows(self, rows: pa.StructArray, begin: int, end: int) -> None:
        """Keep rows as copies: a slice would hold on to its whole batch, texts included."""
        self.rows.append(rows.take(pa.array(np.arange(begin, end))))

    def matrix(self) -> list[bytes]:
        """Row starts, word numbers as differences, and counts."""
        starts = np.concatenate(([0], np.cumsum([len(t) for t in self.terms]))).astype(np.int64)
        terms = np.concatenate(self.terms)
        return [starts.tobytes(), packed(np.diff(terms, prepend=np.uint32(0))), packed(np.concatenate(self.counts))]

    def word_ranges(self, ranges: int) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
        """The words of each range that has any, with their numbers."""
        words = list(self.words)
        own = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % np.uint32(ranges)
        order = np.argsort(own, kind="stable").astype(np.uint32)
        cuts = np.flatnonzero(np.diff(own[order], prepend=-1))
        for begin, end in zip(cuts, [*cuts[1:], len(order)]):
            numbers = order[begin:end]
            yield int(own[numbers[0]]), [words[n] for n in numbers], numbers


SHARD_NAMES = ["shard", "rows", "starts", "terms", "counts", "range", "n", "words", "numbers"]
WORD_SCHEMA = "range int, shard long, n int, words binary, numbers binary"


def build_shards(attributes: int, shard_words: int, ranges: int, shard_bytes: int = SHARD_BYTES):
    """Task function: attributes and a text to shards. A shard is one row with its matrix and
    its documents' attributes, followed by its words, a row per range of the dictionary."""

    def shard_batches(shard: _Shard, name: int) -> Iterator[pa.RecordBatch]:
        rows = pa.concat_arrays(shard.rows)
        lists = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)
        blobs = [pa.array([part], pa.binary()) for part in shard.matrix()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), lists, *blobs, pa.nulls(1, pa.int32()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()),
             pa.nulls(1, pa.binary())], names=SHARD_NAMES)
        parts = list(shard.word_ranges(ranges))
        for at in range(0, len(parts), 1000):
            some = parts[at:at + 1000]
            columns = [pa.array([r for r, _, _ in some], pa.int32()), pa.array([len(w) for _, w, _ in some], pa.int32()),
                       pa.array([b" ".join(w) for _, w, _ in some], pa.binary()),
                       pa.array([packed(n) for _, _, n in some], pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), name)), pa.nulls(len(some), lists.type),
                 *[pa.nulls(len(some), pa.binary())] * 3, *columns], names=SHARD_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        place, made, shard = TaskContext.get().partitionId(), 0, _Shard()
        for batch in batches:
            fields = [batch.schema.field(n) for n in range(attributes)]
            rows = pa.StructArray.from_arrays([batch.column(n) for n in range(attributes)], fields=fields)
            begin = 0
            for n, text in enumerate(batch.column(attributes)):
                shard.add(text.as_py() or b"")
                if shard.size >= shard_words or shard.bytes >= shard_bytes:
                    shard.add_rows(rows, begin, n + 1)
                    yield from shard_batches(shard, place << 32 | made)
                    made, shard, begin = made + 1, _Shard(), n + 1
            if begin < batch.num_rows:
                shard.add_rows(rows, begin, batch.num_rows)
        if shard.rows:
            yield from shard_batches(shard, place << 32 | made)

    return run


def range_words(table: pa.Table) -> list[bytes]:
    """The words of one range in order, those of its shards added one shard at a time."""
    known: set[bytes] = set()
    for blob in table.column("words"):
        known.update(blob.as_py().split(b" "))
    return sorted(known)


def number_range(ranges: int):
    """Group function over one range of the dictionary: for each shard the ids of its words."""

    def run(table: pa.Table) -> pa.Table:
        own = table.column("range")[0].as_py()
        place = {word: n * ranges + own for n, word in enumerate(range_words(table))}
        ids = [packed(np.fromiter(map(place.__getitem__, blob.as_py().split(b" ")), np.int64, count))
               for blob, count in zip(table.column("words"), table.column("n").to_pylist())]
        return pa.table([table.column("shard"), table.column("n"), table.column("numbers"), pa.array(ids, pa.binary())],
                        names=["shard", "n", "numbers", "ids"])

    return run


def list_range(ranges: int):
    """Group function: the words of one range of the dictionary with their ids."""

    def run(table: pa.Table) -> pa.Table:
        ordered = range_words(table)
        ids = np.arange(len(ordered), dtype=np.int64) * ranges + table.column("range")[0].as_py()
        return pa.table([pa.array(ordered, pa.binary()), pa.array(ids)], names=["word", "term"])

    return run


def with_global_terms(shard: pa.Table, words: pa.Table) -> pa.Table:
    """A shard's matrix with the dictionary's ids in place of its own numbers."""
    ids = np.zeros(sum(words.column("n").to_pylist()), np.int64)
    for count, numbers, known in zip(*(words.column(c).to_pylist() for c in ("n", "numbers", "ids"))):
        ids[unpacked(numbers, count, np.uint32)] = unpacked(known, count, np.int64)
    columns = {n: shard.column(n).to_pylist() for n in ("starts", "terms", "counts")}
    terms, counts = [], []
    for starts, differences, sizes in zip(*columns.values()):
        cells = int(np.frombuffer(starts, np.int64)[-1])
        terms.append(ids[np.cumsum(unpacked(differences, cells, np.uint32), dtype=np.uint32)].tobytes())
        counts.append(unpacked(sizes, cells, np.uint32).tobytes())
    return pa.table([shard.column("shard"), shard.column("rows"), shard.column("starts"), pa.array(terms, pa.binary()),
                     pa.array(counts, pa.binary())], names=["shard", "rows", "starts", "terms", "counts"])


def term_matrix(rows: DataFrame, text: str, shard_words: int = SHARD_WORDS,
                range_bytes: int = RANGE_BYTES) -> tuple[DataFrame, DataFrame]:
    """The document-term matrix of ``rows`` and its dictionary.

    The matrix has one row per shard: ``shard``, ``rows`` (an array of the documents' other
    columns), and as bytes ``starts`` (64-bit, one more than rows), ``terms`` (64-bit ids) and
    ``counts`` (32-bit) of its cells. The dictionary is ``word`` (UTF-8 bytes), ``term``.
    """
    attributes = [f for f in rows.schema if f.name != text]
    size = rows.agg(F.coalesce(F.sum(F.octet_length(column(rows, text)).cast("long")), F.lit(0))).first()[0]
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(partitions, -(-size // range_bytes))
    ordered = rows.select(*[column(rows, f.name) for f in attributes], column(rows, text).cast("binary"))
    with arrow_batches(rows.sparkSession, BATCH_BYTES):
        shards = materialized(ordered.mapInArrow(
            build_shards(len(attributes), shard_words, ranges),
            f"shard long, rows array<{StructType(attributes).simpleString()}>, starts binary, terms binary, counts binary, "
            + WORD_SCHEMA.replace("shard long, ", "")))
    words = shards.where(F.col("range").isNotNull()).select("range", "shard", "n", "words", "numbers").groupBy("range")
    numbered = words.applyInArrow(number_range(ranges), "shard long, n int, numbers binary, ids binary")
    local = shards.where(F.col("range").isNull()).select("shard", "rows", "starts", "terms", "counts")
    matrix = local.groupBy("shard").cogroup(numbered.groupBy("shard")).applyInArrow(with_global_terms, local.schema)
    return matrix, words.applyInArrow(list_range(ranges), "word binary, term long")


def row_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function over shards: the attributes of each row, its sum and its nonzero cells."""
    for batch in batches:
        for n in range(batch.num_rows):
            starts = np.frombuffer(batch.column("starts")[n].as_buffer(), np.int64)
            counts = np.frombuffer(batch.column("counts")[n].as_buffer(), np.uint32)
            sums = np.diff(np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))[starts])
            rows = batch.column("rows").slice(n, 1).flatten()
            yield pa.RecordBatch.from_arrays([rows, pa.array(sums), pa.array(np.diff(starts))],
                                             names=["row", "n_words", "n_distinct"])


def matrix_rows(matrix: DataFrame) -> DataFrame:
    """Each document's other columns, with ``n_words`` and ``n_distinct`` from the matrix."""
    rows = matrix.schema["rows"].dataType
    assert isinstance(rows, ArrayType)
    totals = matrix.select("rows", "starts", "counts").mapInArrow(
        row_totals, f"row {rows.elementType.simpleString()}, n_words long, n_distinct long")
    return totals.select("row.*", "n_words", "n_distinct")


def failed_filters(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   part_col: str = "lang") -> DataFrame:
    """``doc_id, part, digest`` and a number whose bits say which of the filters A to D fail."""
    text = F.coalesce(column(docs, text_col), F.lit(""))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    rows = docs.select(
        column(docs, id_col).alias("doc_id"), F.coalesce(column(docs, part_col), F.lit("")).alias("part"),
        F.sha2(text.cast("binary"), 256).alias("digest"),
        (100 * capitals > MAX_CAPITAL_PERCENT * F.length(text).cast("long")).alias("fails_c"),
        F.rlike(text, F.lit(SYMBOLS)).alias("fails_d"), text.alias("text"))
    matrix, _ = term_matrix(rows, "text")
    found = matrix_rows(matrix)
    fails = [F.col("n_words") < MIN_WORDS, 100 * F.col("n_distinct") < MIN_DISTINCT_PERCENT * F.col("n_words"),
             F.col("fails_c"), F.col("fails_d")]
    return found.select("doc_id", "part", "digest", sum((f.cast("int") * (1 << n) for n, f in enumerate(fails)), F.lit(0))
                        .alias("fails"))


def failure_counts(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, fails, n, good, toxic``: documents for each set of failed filters, E included."""
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    rows = flags.groupBy("doc_id", "part", "digest", "fails").agg(F.count("*").alias("n"))
    marked = rows.join(broadcast_if_small(marks), "doc_id", "left").fillna(False, ["good", "toxic"])
    known = F.col("doc_id").isNotNull()
    copies = marked.groupBy("digest", "part", "fails", "good", "toxic").agg(
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("known"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("unknown"),
        F.min(F.when(known, F.struct("doc_id", "n"))).alias("first"))
    copies = copies.withColumn("smallest", F.min("first.doc_id").over(Window.partitionBy("digest"))).withColumn(
        "originals", F.coalesce(F.when(F.col("first.doc_id") == F.col("smallest"), F.col("first.n")), F.lit(0)))
    repeat_bit = 1 << FILTERS.index("E")
    parted = copies.select("part", "good", "toxic", F.inline(F.array(
        F.struct(F.col("fails").alias("fails"), (F.col("unknown") + F.col("originals")).alias("n")),
        F.struct((F.col("fails") + repeat_bit).alias("fails"), (F.col("known") - F.col("originals")).alias("n")))))
    return parted.groupBy("part", "fails").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("good"), F.col("n"))), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.when(F.col("toxic"), F.col("n"))), F.lit(0)).alias("toxic"))


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Every order of the filters applied to ``counts``: a row per part, order and step."""
    orders = ",".join(map("".join, permutations(filters)))
    steps = counts.withColumn("filter_order", F.explode(F.split(F.lit(orders), ","))) \
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))))
    bit_of = {letter: 1 << n for n, letter in enumerate(filters)}
    place = {letter: F.instr("filter_order", F.lit(letter)) for letter in filters}
    before = sum((F.when(place[f] < F.col("step"), bit).otherwise(0) for f, bit in bit_of.items()), F.lit(0))
    here = sum((F.when(place[f] == F.col("step"), bit).otherwise(0) for f, bit in bit_of.items()), F.lit(0))
    steps = steps.withColumns({"before": before, "here": here})
    gone, failed = F.col("fails").bitwiseAND(F.col("before")) != 0, F.col("fails").bitwiseAND(F.col("here")) != 0

    def total(condition: Column, value: str = "n") -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(value))), F.lit(0)).cast("long")

    found = steps.groupBy("part", "filter_order", "step", "here").agg(
        total(~gone & ~failed).alias("kept"), total(~gone & failed).alias("removed"),
        total(gone & failed).alias("redundant"), total(F.col("fails") == F.col("here")).alias("unique_fails"),
        total(~gone & failed, "good").alias("good_lost"), total(~gone & failed, "toxic").alias("toxic_lost"))
    shapley = F.sum("removed").over(Window.partitionBy("part", "here")).alias("shapley")
    return found.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                        "toxic_lost", shapley)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = failed_filters(documents(spark, sf_dir))
    return audit(failure_counts(flags, spark.read.parquet(f"{sf_dir}/labels.parquet")))


OP13_SQL = r"""
with words as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
marks as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id),
flags as (
  select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
    [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
     100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
     regexp_matches(text, '[#$%&*|]'),
     words.doc_id > min(words.doc_id) over (partition by text)] as fails
  from words left join marks on words.doc_id = marks.doc_id),
one as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
  select a.x || b.x || c.x || d.x || e.x as filter_order from one a, one b, one c, one d, one e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps as (select filter_order, unnest([1, 2, 3, 4, 5])::int as step from orders),
sets as (select part, fails, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic
         from flags group by all),
tried as (
  select part, filter_order, step, substr(filter_order, step, 1) as letter, n, good, toxic,
    fails[ascii(substr(filter_order, step, 1)) - 64] as here,
    len(list_filter(range(1, step), lambda i: fails[ascii(substr(filter_order, i, 1)) - 64])) > 0 as gone,
    len(list_filter(fails, lambda f: f)) as failed
  from sets, steps),
counted as (
  select part, filter_order, step, letter,
    coalesce(sum(n) filter (not gone and not here), 0)::bigint as kept,
    coalesce(sum(n) filter (not gone and here), 0)::bigint as removed,
    coalesce(sum(n) filter (gone and here), 0)::bigint as redundant,
    coalesce(sum(n) filter (here and failed = 1), 0)::bigint as unique_fails,
    coalesce(sum(good) filter (not gone and here), 0)::bigint as good_lost,
    coalesce(sum(toxic) filter (not gone and here), 0)::bigint as toxic_lost
  from tried group by part, filter_order, step, letter)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) over (partition by part, letter))::bigint as shapley
from counted
"""
