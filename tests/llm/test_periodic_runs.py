import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from marea.llm import periodic_runs as runs
from tests.llm.frames import LONG, empty, messy


def all_runs(words, min_length=6, min_exponent=4):
    """By definition: for each period, all stretches in which words that far apart are equal."""
    smallest = {}
    for p in range(1, len(words) // min_exponent + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j > i and j - i + p >= max(min_length, min_exponent * p):
                smallest.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted(((s, n, p) for (s, n), p in smallest.items()), key=lambda r: (r[0], r[2]))


def found(sequences, **limits):
    number, *columns = runs.find_runs([np.array(s, np.int64) for s in sequences], **limits)
    out = [[] for _ in sequences]
    for n, *run in zip(number, *columns):
        out[n].append(tuple(map(int, run)))
    return out


def repeated(words, first, period):
    return [w if i < first else words[first + (i - first) % period] for i, w in enumerate(words)]


def test_cover_holds_every_difference():
    assert {(b - a) % runs.COVER_MODULUS for a in runs.COVER for b in runs.COVER} == set(range(runs.COVER_MODULUS))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), max_size=70), min_size=1, max_size=5))
def test_few_words_match_definition(sequences):
    assert found(sequences) == [all_runs(s) for s in sequences]


def test_planted_repeats_match_definition():
    rng = random.Random(5)
    for _ in range(60):
        sequences = []
        for _ in range(4):
            words = [rng.randrange(1, 9) for _ in range(rng.randrange(400))]
            if len(words) > 40:
                words = repeated(words, rng.randrange(len(words) - 20), rng.randrange(1, 90))
            sequences += [words, words[:len(words) // 2]]
        assert found(sequences) == [all_runs(s) for s in sequences]


@pytest.mark.parametrize("limits", [{"min_exponent": 2, "min_length": 2}, {"min_exponent": 3, "min_length": 9}])
def test_other_limits(limits):
    rng = random.Random(6)
    sequences = [[rng.randrange(1, 3) for _ in range(120)] for _ in range(10)]
    assert found(sequences, **limits) == [all_runs(s, **limits) for s in sequences]


def test_small_pieces_of_the_grid(monkeypatch):
    words = [1, 2, 3] * 40 + list(range(4, 60)) + [7] * 30
    monkeypatch.setattr(runs, "GRID_POSITIONS", 50)
    assert found([words, words[::-1]]) == [all_runs(words), all_runs(words[::-1])]


def test_one_long_text_of_one_word():
    assert found([[5] * 300_000]) == [[(0, 300_000, 1)]]
    half = list(range(1, 40_001)) * 5
    assert found([half]) == [[(0, 200_000, 40_000)]]


def expected(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        first, lot = h // 10 % len(words), h // 10
        words = repeated(words, first, 1 + (len(words) - first) // (3 + lot % 8))
    own = all_runs(words)
    dropped = {i for s, n, p in own for i in range(s + p, s + n)}
    best = max(own, key=lambda r: (r[1], -r[0], -r[2])) if own else (None,) * 3
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in own)
    return (doc_id, len(own), *best, 1000 * best[1] // best[2] if own else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_matches_definition(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(120))) + rng.choice(["", " \t\x0b a b "]))
            for i in range(300)]
    rows += [(300, None), (301, ""), (302, " \n"), (None, "a " * 9), (303, "a " * 9), (303, "a " * 9)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = runs.op12_periodic_runs(spark, str(tmp_path)).collect()
    key = lambda row: [(v is not None, v) for v in row]
    assert sorted(map(tuple, got), key=key) == sorted((expected(*r) for r in rows), key=key)
    assert sum(r["n_runs"] for r in got) > 10


def test_messy_rows_and_empty_table(spark):
    got = {r["doc_id"]: r for r in runs.periodic_runs(messy(spark)).collect()}
    assert got[4]["n_words"] == 0 and got[4]["runs"] == [] and got[4]["collapsed"] == ""
    assert got[7]["n_words"] == len(LONG.split())
    assert runs.periodic_runs(messy(spark)).count() == messy(spark).count()
    assert runs.periodic_runs(empty(spark)).count() == 0


def test_long_batches_are_parted(spark, monkeypatch):
    texts = [(i, " ".join(["x y z"] * (i % 7) + [f"u{i}"])) for i in range(200)]
    frame = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    whole = {r["doc_id"]: r["collapsed"] for r in runs.periodic_runs(frame).collect()}
    monkeypatch.setattr(runs, "BATCH_WORDS", 50)
    monkeypatch.setattr(runs, "KNOWN_WORDS", 20)
    assert {r["doc_id"]: r["collapsed"] for r in runs.periodic_runs(frame).collect()} == whole
    assert whole[6] == "x y z u6" and whole[3] == "x y z x y z x y z u3"
