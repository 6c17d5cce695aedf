import numpy as np
import pytest

from marea.llm import near_dup
from marea.llm.components import components

SCHEMA = "vec_id long, embedding array<float>, label int, node long, unit string, component_id long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "u", 2) for i, v, label in rows], SCHEMA)


def brute(rows, threshold=0.93):
    """vec_id -> (links, component) by comparing all pairs; ids must be unique."""
    units, ids = {}, [i for i, _, _ in rows]
    for i, v, label in rows:
        if i is None or v is None or label is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        a = np.array(v, np.float32).astype(np.float64)
        units[i] = (label, a / np.linalg.norm(a))
    near = {i: [j for j in units if j != i and units[j][0] == units[i][0] and len(units[j][1]) == len(units[i][1])
                and units[i][1] @ units[j][1] >= threshold] for i in units}
    found = {}
    for i in ids:
        seen, todo = {i}, [i]
        while todo:
            for j in near.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        found[i] = (len(near.get(i, ())), min(seen))
    return found


def clustered(rng, groups, size, dim=24, noise=0.1):
    rows = []
    for g in range(groups):
        centre = rng.normal(size=dim)
        for _ in range(size):
            v = centre / np.linalg.norm(centre) + rng.normal(size=dim) * noise / np.sqrt(dim)
            rows.append((len(rows) * 3, v.astype(np.float32).tolist(), g % 3))
    return rows


def test_small_labels_are_compared_in_full(spark):
    rows = clustered(np.random.default_rng(1), 30, 5, noise=0.35)
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_dup.near_duplicates(frame(spark, rows)).collect()}
    assert got == brute(rows)


@pytest.mark.parametrize("sample", [100_000, 120])
def test_forest_finds_the_links_of_large_labels(spark, sample):
    rows = clustered(np.random.default_rng(2), 60, 10)
    got = {r.vec_id: (r.n_links, r.component_id)
           for r in near_dup.near_duplicates(frame(spark, rows), leaf=40, sample=sample, trees=12).collect()}
    want = brute(rows)
    assert all(got[i][0] <= want[i][0] for i in want)       # no link below the threshold, none twice
    assert sum(n for n, _ in got.values()) >= 0.97 * sum(n for n, _ in want.values())
    assert sum(got[i][1] == want[i][1] for i in want) >= 0.97 * len(want)


def test_copies_count_as_links_without_being_paired(spark):
    v, w = [1.0, 2.0, 3.0, 4.0], [1.0, 2.0, 3.0, 4.1]
    rows = [(n, v, 1) for n in range(50)] + [(100, w, 1), (101, v, 2), (102, [2.0, 4.0, 6.0, 8.0], 1)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_dup.near_duplicates(frame(spark, rows)).collect()}
    assert got == brute(rows)


def test_odd_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    v = [0.5, 0.5]
    rows = [(1, v, 1), (2, v, 1), (3, None, 1), (4, [0.0, 0.0], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1),
            (7, [None, 1.0], 1), (8, [], 1), (9, v, None), (10, [0.5, 0.5, 0.5], 1), (11, [1e-30, 1e-30], 1)]
    got = {r.vec_id: r for r in near_dup.near_duplicates(frame(spark, rows)).collect()}
    assert {i: (r.n_links, r.component_id) for i, r in got.items()} == brute(rows)
    assert all(r.kept == (r.component_id == i) for i, r in got.items())
    odd = near_dup.near_duplicates(frame(spark, [(None, v, 1), (1, v, 1), (1, v, 1)])).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in odd) == [
        (0, 0, 0, False), (1, 1, 1, True), (1, 1, 1, True)]
    assert near_dup.near_duplicates(frame(spark, [])).count() == 0


def test_components_of_chains_stars_and_rings(spark):
    chain = [(n, n + 1) for n in range(0, 300)]
    star = [(1000, n) for n in range(1001, 1400)]
    ring = [(2000 + n, 2000 + (n + 1) % 50) for n in range(50)]
    links = spark.createDataFrame(chain + star + ring + [(7, 7), (5, 4)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    want = {n: 0 for n in range(301)} | {n: 1000 for n in range(1000, 1400)} | {n: 2000 for n in range(2000, 2050)}
    assert got == want


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_arrays(rows, threshold=0.93):
    """As brute(), for sound vectors, whose ids ascend."""
    units = np.array([v for _, v, _ in rows], np.float32).astype(np.float64)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    labels = np.array([label for _, _, label in rows])
    near = (units @ units.T >= threshold) & (labels[:, None] == labels)
    np.fill_diagonal(near, False)
    least, last = np.arange(len(rows)), None
    while last is None or (least != last).any():
        last, least = least, np.minimum(least, np.where(near, least, len(rows)).min(1))
    return {i: (int(n), rows[c][0]) for (i, _, _), n, c in zip(rows, near.sum(1), least)}


@pytest.mark.parametrize("noise", [0.1, 0.24, 0.3])
def test_links_of_groups_larger_than_a_leaf(spark, noise):
    """A group of near copies that fills many leaves, beside spread vectors and isolated pairs."""
    rng = np.random.default_rng(5)
    centre = rng.normal(size=24)
    group = centre / np.linalg.norm(centre) + rng.normal(size=(1500, 24)) * noise / np.sqrt(24)
    spread = rng.normal(size=(600, 24))
    pairs = spread[:100] + rng.normal(size=(100, 24)) * 0.1
    rows = [(n, v.astype(np.float32).tolist(), 1) for n, v in enumerate(np.concatenate((group, spread, pairs)))]
    got = {r.vec_id: (r.n_links, r.component_id)
           for r in near_dup.near_duplicates(frame(spark, rows), leaf=64).collect()}
    want = brute_arrays(rows)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(n for n, _ in got.values()) >= 0.999 * sum(n for n, _ in want.values())
    assert sum(got[i][1] == want[i][1] for i in want) >= 0.99 * len(want)


def test_labels_of_a_few_leaves_are_compared_in_full(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "RING", 60)
    rows = clustered(np.random.default_rng(6), 12, 75, noise=0.3)
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_dup.near_duplicates(frame(spark, rows), leaf=50).collect()}
    assert got == brute_arrays(rows)
