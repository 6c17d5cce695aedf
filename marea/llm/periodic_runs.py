"""Runs of repeated word stretches, by a difference cover and a harmonic grid.

A run is a stretch of words with smallest period q, at least ``min_exponent`` times as
long as q and at least ``min_length`` words, that no neighbouring word extends keeping
the period. Documents are independent: a task joins many of them into one sequence of
word numbers, each closed by a separator of its own that equals nothing else, and
works on that sequence with whole-array operations:

* positions whose remainder modulo 31 lies in a perfect difference cover are sampled, six
  of 31. Only their suffixes are sorted: by blocks of 31 words, then by prefix doubling,
  in which only suffixes that still tie take part;
* neighbours in that order give common prefix lengths, and a sparse table over them
  answers range minima;
* two positions agree for as long as their words do until both meet a sampled position,
  less than 31 words on; from there the range minimum tells the rest. A second structure
  over the reversed sequence looks to the left;
* a run of period p and exponent e holds a position on any grid of step (e - 1) * p at
  which the word p further on lies in the run as well, so the positions 0, (e - 1) * p,
  2 * (e - 1) * p, ... of each p are enough, a harmonic sum of positions. Of the periods
  found for one stretch, the smallest one stays.

Nothing is shuffled. A document longer than a batch is a batch of its own, and memory is
proportional to it; grid positions are taken in pieces of a fixed size.

Defined cases: a null text has no words, no runs and an empty collapsed text, as has an
empty one; repeated rows give one row each; a null id stays null; equal words are equal
bytes; ties cannot arise, since a stretch has one smallest period; long texts are read
whole; columns of any other name are ignored, whatever they are called; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marea.functions.text import let
from marea.llm.common import column, documents

MIN_LENGTH, MIN_EXPONENT = 6, 4
BATCH_WORDS = 250_000       # words that a task works on at a time, if no document is longer
GRID_POSITIONS = 2_000_000  # grid positions held at a time
KNOWN_WORDS = 200_000       # word numbers kept from batch to batch

# --- Fixed values -----------------------------------------------------------
# A perfect difference cover: each difference modulo 31 is that of two of its members.
COVER_MODULUS, COVER = 31, (0, 1, 3, 8, 12, 18)
# ----------------------------------------------------------------------------

_PLACE = np.full(COVER_MODULUS, -1)
_PLACE[list(COVER)] = range(len(COVER))
# For a difference d the member a such that a + d is a member as well.
_MEMBER = np.array([next(a for a in COVER if (a + d) % COVER_MODULUS in COVER) for d in range(COVER_MODULUS)])


class CommonExtension:
    """How many words from two positions on are equal, for arrays of positions. The sequence
    must be such that two different positions always differ before its end."""

    def __init__(self, words: np.ndarray):
        self.words = np.concatenate((words.astype(np.int64), np.zeros(COVER_MODULUS, np.int64)))
        positions = np.arange(len(words))
        self.sampled = positions[_PLACE[positions % COVER_MODULUS] >= 0]
        order, levels = self._sorted()
        self.rank = levels[-1]
        self.minima = [self._neighbours(order, levels)]
        width = 1
        while 2 * width <= len(order):
            last = self.minima[-1]
            self.minima.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def _sorted(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """The order of the sampled suffixes, and their ranks by 1, 2, 4, ... blocks; a rank is
        the number of smaller suffixes, so that ties share one."""
        count, bits = len(self.sampled), max(1, int(self.words.max()).bit_length())
        together = 62 // bits
        rank, tied = np.zeros(count, np.int64), np.arange(count)
        for first in range(0, COVER_MODULUS, together):
            if len(tied):
                key = np.zeros(len(tied), np.int64)
                for n in range(first, min(first + together, COVER_MODULUS)):
                    key = (key << bits) | self.words[self.sampled[tied] + n]
                tied = refine(rank, tied, key)
        levels, step = [rank.astype(np.int32)], len(COVER)
        while len(tied) and step < count:
            after = tied + step
            key = np.where(after < count, rank[np.minimum(after, count - 1)] + 1, 0)
            tied = refine(rank, tied, key)
            levels.append(rank.astype(np.int32))
            step *= 2
        order = np.empty(count, np.int64)
        order[rank] = np.arange(count)
        return order, levels

    def _neighbours(self, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefix of each sampled suffix with the one before it in the order."""
        x, y = order[:-1].copy(), order[1:].copy()
        common, count = np.zeros(len(x), np.int64), len(order)
        for level in range(len(levels) - 1, -1, -1):
            step = len(COVER) << max(level, 0)
            inside = np.maximum(x, y) < count
            same = inside.copy()
            same[inside] = levels[level][x[inside]] == levels[level][y[inside]]
            x[same] += step
            y[same] += step
            common[same] += COVER_MODULUS << level
        start_x, start_y = self.sampled[order[:-1]], self.sampled[order[1:]]
        live = np.arange(len(common))
        while len(live):
            a, b = start_x[live] + common[live], start_y[live] + common[live]
            live = live[self.words[a] == self.words[b]]
            common[live] += 1
        return np.concatenate(([0], common)).astype(np.int32)

    def __call__(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Equal words from ``x`` and ``y`` on, which must differ."""
        until = (_MEMBER[(y - x) % COVER_MODULUS] - x) % COVER_MODULUS
        out, live, met = np.zeros(len(x), np.int64), np.arange(len(x)), []
        for n in range(COVER_MODULUS):
            there = until[live] == n
            met.append(live[there])
            live = live[~there]
            same = self.words[x[live] + n] == self.words[y[live] + n]
            out[live[~same]] = n
            live = live[same]
            if not len(live):
                break
        met = np.concatenate(met)
        ranks = [self.rank[at // COVER_MODULUS * len(COVER) + _PLACE[at % COVER_MODULUS]]
                 for at in (x[met] + until[met], y[met] + until[met])]
        low, high = np.minimum(*ranks) + 1, np.maximum(*ranks)
        power = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        rest = np.zeros(len(met), np.int64)
        for k in np.unique(power):
            at = power == k
            rest[at] = np.minimum(self.minima[k][low[at]], self.minima[k][high[at] - (1 << int(k)) + 1])
        out[met] = until[met] + rest
        return out


def refine(rank: np.ndarray, tied: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Part suffixes of equal rank by a further key, in place; returns those that still tie."""
    own = rank[tied]
    order = np.lexsort((key, own))
    tied, own, key = tied[order], own[order], key[order]
    place = np.arange(len(tied))
    new_rank = np.concatenate(([True], own[1:] != own[:-1]))
    new_key = new_rank | np.concatenate(([True], key[1:] != key[:-1]))
    first_of_rank = np.maximum.accumulate(np.where(new_rank, place, 0))
    first_of_key = np.maximum.accumulate(np.where(new_key, place, 0))
    rank[tied] = own + first_of_key - first_of_rank
    alone = new_key & np.concatenate((new_key[1:], [True]))
    return tied[~alone]


def grid(sizes: np.ndarray, min_exponent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(sequence, position in it, period) of all grid positions, in pieces."""
    most = sizes // min_exponent
    number = np.repeat(np.arange(len(sizes)), most)
    period = np.arange(len(number)) - np.repeat(np.cumsum(most) - most, most) + 1
    points = (sizes[number] - 1 - period) // ((min_exponent - 1) * period) + 1
    before = np.concatenate(([0], np.cumsum(points)))
    begin = 0
    while begin < len(number):
        end = max(begin + 1, int(np.searchsorted(before, before[begin] + GRID_POSITIONS, "right")) - 1)
        here = points[begin:end]
        step = np.arange(int(here.sum())) - np.repeat(before[begin:end] - before[begin], here)
        p = np.repeat(period[begin:end], here)
        yield np.repeat(number[begin:end], here), step * (min_exponent - 1) * p, p
        begin = end


def find_runs(sequences: list[np.ndarray], min_length: int = MIN_LENGTH,
              min_exponent: int = MIN_EXPONENT) -> tuple[np.ndarray, ...]:
    """(sequence, start, length, period) of all runs, by sequence, start and period."""
    sizes = np.array([len(s) for s in sequences], np.int64)
    if not len(sizes) or sizes.max() < min_exponent:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    unused = 1 + max(int(s.max()) for s in sequences if len(s))
    parts = [np.array([unused], np.int64)]
    for n, sequence in enumerate(sequences):
        parts += [sequence, np.array([unused + n + 1], np.int64)]
    words = np.concatenate(parts)
    starts = 1 + np.cumsum(sizes + 1) - (sizes + 1)
    found = [np.zeros((0, 3), np.int64)]
    right = left = None
    for number, position, period in grid(sizes, min_exponent):
        x = starts[number] + position
        same = words[x] == words[x + period]
        x, period = x[same], period[same]
        if not len(x):
            continue
        if right is None:
            right, left = CommonExtension(words), CommonExtension(words[::-1])
        ahead = right(x, x + period)
        last = len(words) - 1
        behind = left(last - (x - 1), last - (x + period - 1))
        long = ahead + behind >= (min_exponent - 1) * period
        x, period, ahead, behind = x[long], period[long], ahead[long], behind[long]
        found.append(np.stack((x - behind, ahead + behind + period, period), 1))
    runs = np.unique(np.concatenate(found), axis=0)     # by start, length and period
    runs = runs[runs[:, 1] >= min_length]
    if len(runs):
        smallest = np.concatenate(([True], (runs[1:, :2] != runs[:-1, :2]).any(1)))
        runs = runs[smallest]
        runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    number = np.searchsorted(starts, runs[:, 0], "right") - 1
    return number, runs[:, 0] - starts[number], runs[:, 1], runs[:, 2]


class WordNumbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) + 1
        return number


def describe_batch(ids: list[pa.Scalar], texts: list[list[bytes]], numbers: WordNumbers, kind: pa.DataType,
                   min_length: int, min_exponent: int) -> pa.RecordBatch:
    if len(numbers) > KNOWN_WORDS:
        numbers.clear()
    sequences = [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) for words in texts]
    number, start, length, period = find_runs(sequences, min_length, min_exponent)
    ends = np.concatenate(([0], np.cumsum(np.bincount(number, minlength=len(texts))))).astype(np.int32)
    collapsed = []
    for n, words in enumerate(texts):
        if ends[n] < ends[n + 1]:
            depth = np.zeros(len(words) + 1, np.int64)
            for at in range(ends[n], ends[n + 1]):
                depth[start[at] + period[at]] += 1
                depth[start[at] + length[at]] -= 1
            words = compress(words, np.cumsum(depth[:-1]) == 0)
        collapsed.append(b" ".join(words))
    runs = pa.StructArray.from_arrays([pa.array(v) for v in (start, length, period)], names=["start", "length", "period"])
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, kind), pa.array([len(words) for words in texts], pa.int64()),
         pa.ListArray.from_arrays(ends, runs), pa.array(collapsed, pa.binary())],
        names=["doc_id", "n_words", "runs", "collapsed"])


def described_runs(min_length: int, min_exponent: int):
    """Task function: id and text to the rows of ``periodic_runs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, ids, texts, held, kind = WordNumbers(), [], [], 0, None
        for batch in batches:
            kind = batch.schema.field(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                texts.append((text.as_py() or b"").split())
                held += len(texts[-1]) + 1
                if held >= BATCH_WORDS:
                    yield describe_batch(ids, texts, numbers, kind, min_length, min_exponent)
                    ids, texts, held = [], [], 0
        if ids:
            yield describe_batch(ids, texts, numbers, kind, min_length, min_exponent)

    return run


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` per document: its runs by start and period, and
    its words without those that a run repeats, joined by single spaces."""
    if min_exponent < 2:
        raise ValueError("min_exponent must be at least 2")
    rows = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(
        described_runs(min_length, min_exponent),
        f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def with_repeats(text: Column, doc_id: Column) -> Column:
    """The text, or for every tenth document (by the checksum of its id) its words with a
    repeated end: from word a on, word i becomes word a + (i - a) % p."""
    checksum = F.crc32(doc_id.cast("string").cast("binary"))
    lot = F.floor(checksum / 10).cast("long")

    def repeated(words: Column) -> Column:
        size = F.size(words).cast("long")
        first = lot % size
        period = F.lit(1) + F.floor((size - first) / (F.lit(3) + lot % 8)).cast("long")
        place = lambda i, a, p: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")
        return let(first, lambda a: let(period, lambda p: F.array_join(F.transform(
            words, lambda _, i: F.get(words, place(i.cast("long"), a, p))), " ")))

    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    changed = let(words, lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(F.lit("")))
    return F.when((checksum % 10 == 0) & text.isNotNull(), changed).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = periodic_runs(docs.select("doc_id", with_repeats(F.col("text"), F.col("doc_id")).alias("text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("shortness"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"),
        F.lit("\n"))), "")
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.back")).alias("start"),
        F.col("longest.length").alias("length"), (-F.col("longest.shortness")).alias("period"),
        F.floor(1000 * F.col("longest.length") / -F.col("longest.shortness")).cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


# Pairs of equal words within a quarter of a text, for distances at which there are enough of
# them; equal pairs in a row make a run. The checksum is computed bit by bit.
OP12_SQL = r"""
with checked as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as original,
    xor(4294967295, list_reduce(list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint),
      lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, _: xor(x >> 1, (x & 1) * 3988292384)), 4294967295)) as h
  from documents),
placed as (
  select *, (h // 10) % greatest(len(original), 1) as a from checked),
words as (
  select doc_id, case when h % 10 <> 0 then original else
    list_transform(range(len(original)), lambda i: original[1 + case when i < a then i else
      a + (i - a) % (1 + (len(original) - a) // (3 + (h // 10) % 8)) end]) end as w
  from placed),
-- A quick look at which distances can hold a run at all.
tokens as (select doc_id, len(w) as n, unnest(w) as word, unnest(range(len(w))) as i from words),
pairs as (
  select x.doc_id, x.i, y.i - x.i as p from tokens x join tokens y
    on x.doc_id = y.doc_id and x.word = y.word and y.i > x.i and y.i - x.i <= x.n // 4),
likely as (
  select doc_id, p from pairs group by doc_id, p having count(*) >= greatest(3 * p, 6 - p)),
islands as (
  select doc_id, p, i, i - row_number() over (partition by doc_id, p order by i) as island
  from pairs semi join likely using (doc_id, p)),
stretches as (
  select doc_id, p, min(i) as start, count(*) + p as length from islands group by doc_id, p, island
  having count(*) + p >= greatest(6, 4 * p)),
runs as (
  select doc_id, start, length, min(p) as period from stretches group by doc_id, start, length),
per_doc as (
  select doc_id, count(*) as n_runs,
    first({'start': start, 'length': length, 'period': period} order by length desc, start, period) as best,
    string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines,
    list({'from': start + period, 'upto': start + length}) as cuts
  from runs group by doc_id)
select doc_id, coalesce(n_runs, 0)::bigint as n_runs, best.start::bigint as start, best.length::bigint as length,
  best.period::bigint as period, (1000 * best.length // best.period)::bigint as exponent_milli,
  sha256(coalesce(lines, '')) as runs_sha256,
  sha256(array_to_string(case when cuts is null then w else list_filter(w, lambda word, i:
    len(list_filter(cuts, lambda c: i - 1 >= c."from" and i - 1 < c."upto")) = 0) end, ' ')) as collapsed_sha256
from words left join per_doc using (doc_id)
"""
