"""Exact top-k by inner product over sorted lists, without random access.

Vectors become integers, floor(scale * x) by component, and lie in blocks. A block is its own
index: each dimension is a list of the block's rows sorted by value, of which the index keeps
the values at growing depths from both ends, its frontiers. A query reads a list from its high end where
its own component is positive, and from its low end where it is negative, all lists
to the same depth at a time:

* a row seen in a list adds its true product to both of its bounds; unseen, it adds the
  frontier's product to the upper bound, since it can be no better than the last value read, and
  that of the list's far end to the lower one;
* the k-th highest lower bound, or the k-th score known from other blocks if that is higher,
  is the bar. Rows whose upper bound lies below it are outsiders;
* a query is done with a block as soon as no more than a few rows are left, whose final scores
  are then resolved; before a list is read at all, the sum of the list heads may show that
  the block holds outsiders only. Otherwise reading goes on to the next depth, the last of
  which is the whole list.

Reading to a depth is done for all open queries and the rows still in question at once, as
products of the queries with the rows clipped at the frontiers. Each task keeps the k best per query,
and these are ranked across tasks. Nothing is skipped that could tie with the k-th score.

Integers beyond 2^53 in a product use 64-bit arithmetic; a product that may exceed 64 bits is
an error.

Defined cases: vectors that are null, or hold null or non-finite components, take no part; vectors
meet only those of their own length; a row with a null id asks nothing and is a candidate whose id is
null and sorts last; a query's candidates are the rows of other ids, so rows that repeat
an id never answer each other, and each row of a repeated query id asks for itself; ties go to the
smaller id; empty vectors have score 0; texts do not occur; columns of any other name are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from marea.functions.vector_blocks import BROADCAST_BYTES, beside, blocks, decoded
from marea.llm.common import column
from marea.session import materialized

SCALE, K = 256, 5
QUERY_BLOCK, CORPUS_BLOCK = 512, 2048
DEPTHS = (1 / 16, 1 / 4, 1 / 2)     # shares of a list that are read before the whole of it
RESOLVED_AT = 4                     # rows per wanted one that are few enough to resolve
HELD_ROWS = 500_000                 # best rows that a task holds at a time
NO_ID = np.iinfo(np.int64).max

INDEX_SCHEMA = "block long, dims int, ids binary, matrix binary, heads binary, tails binary"


def sorted_lists(scale: int):
    """Task function: blocks of vectors to blocks of integers, with the frontiers of their
    sorted lists from the high ends (``heads``) and the low ends (``tails``), by depth."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                count, dims = batch.column("n")[n].as_py(), batch.column("dims")[n].as_py()
                vectors = np.frombuffer(batch.column("matrix")[n].as_buffer(), np.float64).reshape(count, dims)
                scaled = np.floor(scale * vectors)
                if len(scaled) and dims and np.abs(scaled).max() >= 2.0 ** 62:
                    raise ValueError("a component is too large for 64-bit scores")
                lists = np.sort(scaled, axis=0)
                depths = [0, *(min(count - 1, int(count * d)) for d in DEPTHS), count - 1]
                heads, tails = lists[::-1][depths], lists[depths]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("block").slice(n, 1), batch.column("dims").slice(n, 1), batch.column("ids").slice(n, 1),
                     *[pa.array([a.astype(np.int64).tobytes()], pa.binary()) for a in (scaled, heads, tails)]],
                    names=["block", "dims", "ids", "matrix", "heads", "tails"])

    return run


def kth_largest(scores: np.ndarray, k: int, lowest) -> np.ndarray:
    if scores.shape[1] < k:
        return np.full(len(scores), lowest)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]


def read_lists(queries: np.ndarray, rows: np.ndarray, heads: np.ndarray, tails: np.ndarray, bar: np.ndarray,
               own: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of every pair that may be among the k best of its query, given that
    scores below ``bar`` cannot be. ``own`` are the pairs to leave out."""
    lowest = -np.inf if rows.dtype == np.float64 else np.iinfo(np.int64).min
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    open_ = np.flatnonzero(up @ heads[0] + down @ tails[0] >= bar)
    left = np.arange(len(rows))
    found = [np.zeros((0, 3), rows.dtype)]
    for depth in range(1, len(heads)):
        if not len(open_) or not len(left):
            break
        values, whole = rows[left], depth == len(heads) - 1
        high, low = values >= heads[depth], values <= tails[depth]
        upper = up[open_] @ np.where(high, values, heads[depth]).T + down[open_] @ np.where(low, values, tails[depth]).T
        lower = upper if whole else \
            up[open_] @ np.where(high, values, tails[0]).T + down[open_] @ np.where(low, values, heads[0]).T
        place = np.searchsorted(open_, own[0])
        at = np.searchsorted(left, own[1])
        here = (place < len(open_)) & (at < len(left))
        here[here] = (open_[place[here]] == own[0][here]) & (left[at[here]] == own[1][here])
        upper[place[here], at[here]] = lower[place[here], at[here]] = lowest
        bar[open_] = np.maximum(bar[open_], kth_largest(lower, k, lowest))
        inside = (upper >= bar[open_][:, None]) & (upper > lowest)
        done = (inside.sum(axis=1) <= RESOLVED_AT * k) | whole
        query, row = np.nonzero(inside & done[:, None])
        query, row = open_[query], left[row]
        final = np.einsum("ij,ij->i", queries[query], rows[row])
        found.append(np.stack((query.astype(rows.dtype), row.astype(rows.dtype), final), 1))
        open_, left = open_[~done], left[inside[~done].any(axis=0)]
    query, row, score = np.concatenate(found).T
    return query.astype(np.int64), row.astype(np.int64), score.astype(np.int64)


def same_ids(asked: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (query, row) of equal ids, known ones."""
    order = np.argsort(ids, kind="stable")
    begin, end = (np.searchsorted(ids[order], asked, side) for side in ("left", "right"))
    many = end - begin
    place = np.repeat(begin, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    return np.repeat(np.arange(len(asked)), many), order[place]


def best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k best rows of each query: higher scores first, then smaller ids."""
    order = np.lexsort((ids, -score, query))
    query, ids, score = query[order], ids[order], score[order]
    first = np.concatenate(([True], query[1:] != query[:-1]))[:len(query)]
    begin = np.maximum.accumulate(np.where(first, np.arange(len(query)), 0)) if len(query) else query
    keep = np.arange(len(query)) - begin < k
    return query[keep], ids[keep], score[keep]


class _Asked:
    """A block of queries and the best rows a task has found for them."""

    def __init__(self, number: int, ids: np.ndarray, asker: np.ndarray, queries: np.ndarray):
        self.number, self.ids, self.asker, self.queries = number, ids, asker, queries
        self.held = tuple(np.zeros(0, np.int64) for _ in range(3))

    def bar(self, k: int, lowest) -> np.ndarray:
        query, _, score = self.held
        bar = np.full(len(self.ids), lowest)
        full = np.bincount(query, minlength=len(self.ids)) == k
        last = np.concatenate((query[1:] != query[:-1], [True]))[:len(query)]
        bar[query[last]] = np.where(full[query[last]], score[last], lowest)
        return bar

    def search(self, ids: np.ndarray, rows: np.ndarray, heads: np.ndarray, tails: np.ndarray, k: int) -> None:
        queries = self.queries
        bound = (int(np.abs(queries).max(initial=0)) + 1) * (int(np.abs(rows).max(initial=0)) + 1) * max(1, rows.shape[1])
        if bound >= 1 << 63:
            raise ValueError("scores may exceed 64 bits")
        if bound < 1 << 53:
            queries, rows, heads, tails = (a.astype(np.float64) for a in (queries, rows, heads, tails))
        bar = self.bar(k, -np.inf if bound < 1 << 53 else np.iinfo(np.int64).min)
        query, row, score = read_lists(queries, rows, heads, tails, bar, same_ids(self.ids, ids), k)
        both = [np.concatenate(p) for p in zip(self.held, (query, ids[row], score))]
        self.held = best(*both, k)

    def batch(self) -> pa.RecordBatch:
        query, ids, score = self.held
        return pa.RecordBatch.from_arrays(
            [pa.array(self.asker[query]), pa.array(self.ids[query]), pa.array(ids, mask=ids == NO_ID), pa.array(score)],
            names=["asker", "query_id", "vec_id", "score"])


def search_blocks(k: int):
    """Task function over pairs of a block of queries and an indexed block."""

    def numbers(data) -> np.ndarray:
        return np.frombuffer(data.as_buffer(), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: dict[int, _Asked] = {}
        for batch in batches:
            for n in range(batch.num_rows):
                name, dims = batch.column("q_block")[n].as_py(), batch.column("dims")[n].as_py()
                if name not in asked:
                    if sum(len(a.ids) for a in asked.values()) * k > HELD_ROWS:
                        yield from (a.batch() for a in asked.values())
                        asked.clear()
                    ids = decoded(batch.column("q_ids")[n].as_buffer())
                    matrix = numbers(batch.column("q_matrix")[n]).reshape(len(ids), dims)
                    asked[name] = _Asked(name, ids.column("id").to_numpy(), (np.arange(len(ids)) + (name << 12)), matrix)
                ids = decoded(batch.column("ids")[n].as_buffer()).column("id").fill_null(NO_ID).to_numpy()
                rows, heads, tails = (numbers(batch.column(c)[n]).reshape(-1, dims) if dims else
                                      np.zeros((len(ids) if c == "matrix" else len(DEPTHS) + 2, 0), np.int64)
                                      for c in ("matrix", "heads", "tails"))
                asked[name].search(ids, rows, heads, tails, k)
        yield from (a.batch() for a in asked.values())

    return run


def top_k(corpus: DataFrame, asks: Column, k: int = K, scale: int = SCALE, id_col: str = "vec_id",
          vector_col: str = "embedding", max_broadcast: int = BROADCAST_BYTES) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row for which ``asks`` holds, the ``k`` rows of
    other ids with the highest integer inner products."""
    if k < 1:
        raise ValueError("k must be at least 1")
    named = corpus.select(column(corpus, id_col).cast("long").alias("id"), column(corpus, vector_col).alias("vector"),
                          (asks & column(corpus, id_col).isNotNull()).alias("asks"))

    def indexed(rows: DataFrame, size: int) -> DataFrame:
        return blocks(rows, ["id"], "vector", size, finite=True).mapInArrow(sorted_lists(scale), INDEX_SCHEMA)

    queries = materialized(indexed(named.where("asks"), QUERY_BLOCK))
    asked = queries.select("dims", *[F.col(c).alias(f"q_{c}") for c in ("block", "ids", "matrix")])
    pairs = beside(asked, indexed(named, CORPUS_BLOCK), ["dims"], max_broadcast)
    found = pairs.mapInArrow(search_blocks(k), "asker long, query_id long, vec_id long, score long")
    order = Window.partitionBy("asker").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def op11_top_k_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, F.col("vec_id") % 50 == 0)


OP11_SQL = """
with vectors as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from vectors q join vectors c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id),
ranked as (
  select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
  from scored)
select * from ranked where rank <= 5
"""
