import numpy as np
import pytest
from pyspark.sql import functions as F

from marea.llm import top_k_lists as lists

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, score double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 0.5) for i, v in rows], SCHEMA)


def scaled(vector):
    return [int(np.floor(256 * float(np.float32(x)))) for x in vector]


def by_hand(rows, k, divisor):
    known = [(i, scaled(v)) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, v in known:
        if i is None or i % divisor:
            continue
        scores = sorted((-sum(map(int.__mul__, v, w)), j is None, j or 0) for j, w in known if j != i and len(w) == len(v))
        out += [(i, rank, None if unknown else j, -score) for rank, (score, unknown, j) in enumerate(scores[:k], 1)]
    return sorted(out, key=str)


def check(spark, rows, k=5, divisor=5, parts=3, **options):
    got = lists.top_k(frame(spark, rows).repartition(parts), F.col("vec_id") % divisor == 0, k, **options)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == by_hand(rows, k, divisor)


def vectors(n, dims=8, seed=1, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dims))
    made = centres[rng.integers(0, 4, n)] + spread * rng.normal(size=(n, dims))
    return [(int(i), [float(x) for x in v / np.linalg.norm(v)]) for i, v in enumerate(made)]


@pytest.mark.parametrize("spread", [0.05, 3.0])
@pytest.mark.parametrize("max_broadcast", [1 << 25, 0])
def test_small_blocks_by_broadcast_and_by_lanes(spark, monkeypatch, spread, max_broadcast):
    monkeypatch.setattr(lists, "QUERY_BLOCK", 7)
    monkeypatch.setattr(lists, "CORPUS_BLOCK", 16)
    check(spark, vectors(300, spread=spread), max_broadcast=max_broadcast)


def test_best_rows_are_passed_on_when_many(spark, monkeypatch):
    monkeypatch.setattr(lists, "QUERY_BLOCK", 5)
    monkeypatch.setattr(lists, "HELD_ROWS", 10)
    check(spark, vectors(200), parts=1)


def test_ties_go_to_smaller_ids(spark):
    check(spark, [(i, [1.0, 0.0]) for i in range(40)] + [(i, [0.0, 1.0]) for i in range(40, 60)])


def test_odd_rows(spark):
    rows = vectors(30, 3) + [(100, None), (105, [1.0, None, 0.0]), (110, [float("nan"), 0.0, 1.0]),
                             (115, [float("inf"), 0.0, 0.0]), (None, [0.9, 0.1, 0.1]), (120, [0.0, 0.0, 0.0]),
                             (125, [1.0, 2.0]), (130, [3.0, -1.0]), (135, []), (140, []), (200, [-0.001, 0.3, -0.3])]
    check(spark, rows)
    check(spark, [(7, [1.0]), (10, [2.0])])
    check(spark, [(10, [2.0])])


def test_repeated_ids_never_answer_themselves(spark):
    rows = [(5, [1.0, 0.0]), (5, [0.5, 0.5]), (7, [1.0, 0.1]), (7, [1.0, 0.1]), (8, [0.0, 1.0])]
    check(spark, rows, k=3)


def test_large_values_use_whole_numbers(spark):
    check(spark, [(i, [float(3 ** (i % 13)), 1e6, -float(i)]) for i in range(20)])
    with pytest.raises(Exception, match="64"):
        lists.top_k(frame(spark, [(5, [1e12]), (6, [1e12])]), F.col("vec_id") == 5).collect()


def test_empty_table_and_no_queries(spark):
    assert lists.top_k(frame(spark, []), F.col("vec_id") % 5 == 0).count() == 0
    assert lists.top_k(frame(spark, [(1, [1.0])]), F.col("vec_id") % 5 == 0).count() == 0


def test_bounds_stop_before_whole_lists_are_read(monkeypatch):
    """Near copies in one block: the other blocks are ruled out by their list heads."""
    rng = np.random.default_rng(3)
    near, far = 250 + rng.integers(0, 5, (64, 16)), -250 + rng.integers(0, 5, (2000, 16))
    bar = np.full(1, -np.inf)
    reads = []
    monkeypatch.setattr(lists, "kth_largest", lambda s, k, low, f=lists.kth_largest: reads.append(s.shape) or f(s, k, low))
    for rows in (near, far):
        ordered = np.sort(rows, axis=0).astype(float)
        depths = [0, *(int(len(rows) * d) for d in lists.DEPTHS), len(rows) - 1]
        query, row, score = lists.read_lists(near[:1].astype(float), rows.astype(float), ordered[::-1][depths],
                                             ordered[depths], bar, (np.zeros(0, int), np.zeros(0, int)), 5)
    assert len(query) == 0 and max(s[1] for s in reads) == 64
