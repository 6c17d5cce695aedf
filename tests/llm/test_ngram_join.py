import random

import pytest

from marea.llm import ngram_join
from tests.llm.frames import empty, messy, prose


def sets_of(rows, words):
    found = {}
    for i, text, *_ in rows:
        w = (text or "").encode().lower().split()
        found[i] = frozenset(tuple(w[k:k + words]) for k in range(len(w) - words + 1)) or frozenset([tuple(w)] if w else [])
    return found


def brute(rows, words, threshold):
    sets = sets_of(rows, words)
    group = {i: i for i in sets}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for n, i in enumerate(ids):
        for j in ids[:n]:
            common = len(sets[i] & sets[j])
            if 100 * common >= threshold * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((root(i), root(j)))
                group[b] = a
    return {i: (len(sets[i]), root(i)) for i in sets}


def edited(rng, text, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10_000)}"
    return " ".join(words)


def corpus(seed, groups, size, passage=""):
    rng, rows = random.Random(seed), []
    for g in range(groups):
        base = prose(seed * 1000 + g, rng.randrange(3, 160)) + passage
        for _ in range(rng.randrange(1, size)):
            text = edited(rng, base, rng.randrange(0, 5))
            rows.append((len(rows) * 2 + 1, text.upper() if rng.random() < 0.2 else text, "en", "a"))
    return rows


@pytest.mark.parametrize(("words", "threshold"), [(3, 90), (5, 80)])
def test_components_match_all_pairs(spark, words, threshold):
    rows = corpus(words, 40, 9, " a passage that all documents of this corpus share with one another word by word")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(messy(spark, rows), words, threshold).collect()}
    assert got == brute(rows, words, threshold)


def test_long_lists_of_near_copies(spark):
    """One group whose members differ more and more: some link, some do not."""
    rng, base = random.Random(8), prose(77, 150)
    rows = [(n, edited(rng, base, n % 14), "en", "a") for n in range(160)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(messy(spark, rows)).collect()}
    assert got == brute(rows, 3, 90)


def test_odd_rows_of_the_join(spark):
    found = ngram_join.join(messy(spark)).collect()
    assert len(found) == messy(spark).count()
    by_id = {r.doc_id: r for r in found}
    assert (by_id[1].component_id, by_id[2].component_id, by_id[3].component_id) == (1, 1, 3)
    assert [by_id[i].n_shingles for i in (4, 5, 6, 8)] == [0, 0, 0, 1]
    assert [by_id[i].component_id for i in (4, 5, 6)] == [4, 5, 6]
    assert by_id[None].component_id is None
    assert by_id[10].component_id == 10 and by_id[11].component_id == 10
    assert ngram_join.join(empty(spark)).count() == 0
    assert ngram_join.join(messy(spark, [(1, None, "en", "a")])).collect()[0].component_id == 1


def test_prefixes_are_long_enough():
    for threshold in (80, 90):
        for size in range(1, 400):
            needed = -(-threshold * size // 100)
            assert ngram_join.prefix_size(size, threshold) == size - needed + 1


def test_shingles_split_at_ascii_white_space_only():
    hashes = ngram_join.WordHashes()
    same = [ngram_join.shingles(t, 3, hashes).tolist() for t in ("A b\tc\x0bD", "a B c d", " a  b\r\nc\x0cd ")]
    assert same[0] == same[1] == same[2]
    assert len(ngram_join.shingles("a b c d", 3, hashes)) == 2
    assert len(ngram_join.shingles("É é É é", 3, hashes)) == 2


def test_repeats_across_batches_lose_no_entry():
    """Lists of (token, sets) cut into batches at every size."""
    import itertools

    import pyarrow as pa

    lists = [[1, 1, 1, 2], [3], [1, 1, 2, 2, 2], [4, 4, 4, 4], [1], [1, 2, 3], [5, 5], [6, 7]]
    rows = [(token, key) for token, keys in enumerate(lists) for key in keys]
    want = [(token, key) for token, keys in enumerate(lists) for key in dict.fromkeys(keys) if len(set(keys)) > 1]
    for size in range(1, len(rows) + 1):
        batches = [pa.RecordBatch.from_pydict({"token": [t for t, _ in some], "set_key": [k for _, k in some]})
                   for some in itertools.batched(rows, size)]
        got = [(r["token"], r["set_key"]) for b in ngram_join.shared_entries(iter(batches)) for r in b.to_pylist()]
        assert got == want, size


def test_copies_in_many_tasks_and_small_batches(spark):
    rows = corpus(11, 12, 6)
    rows = rows + [(10_000 * k + r[0], *r[1:]) for k in range(1, 4) for r in rows]
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = {r.doc_id: (r.n_shingles, r.component_id)
               for r in ngram_join.join(messy(spark, rows).repartition(8), 3, 90).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == brute(rows, 3, 90)


def test_few_comparisons_for_a_group_of_near_copies(spark, monkeypatch):
    rng = random.Random(12)
    text = " ".join(f"w{n}" for n in range(200))
    rows = [(i, edited(rng, text, 1)) for i in range(120)]
    compared, asked = ngram_join.compared, []

    def counted(pairs, *args):
        asked.append(pairs.count())
        return compared(pairs, *args)

    monkeypatch.setattr(ngram_join, "compared", counted)
    found = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80).collect()
    assert {r["component_id"] for r in found} == {0}
    assert sum(asked) <= len(rows) * (len(rows) - 1) // 4      # half of all pairs


def test_places_across_batches():
    import itertools

    import pyarrow as pa

    lists = [[1, 2], [3], [1, 1, 2, 2, 3], [4, 4, 4, 4], [1, 2, 3, 4, 5, 6, 7], [5, 6]]
    rows = [(token, key) for token, keys in enumerate(lists) for key in keys]
    want = [(token, key, place) for token, keys in enumerate(lists) if len(set(keys)) > 1
            for place, key in enumerate(dict.fromkeys(keys))]
    for size in range(1, len(rows) + 1):
        batches = [pa.RecordBatch.from_pydict({"token": [t for t, _ in some], "set_key": [k for _, k in some]})
                   for some in itertools.batched(rows, size)]
        got = [(r["token"], r["set_key"], r["place"]) for b in ngram_join.placed_entries(iter(batches)) for r in b.to_pylist()]
        assert got == want, size


@pytest.mark.parametrize(("first", "last"), [(1, 1), (1, 3), (4, 9), (10, 40)])
def test_chunks_give_the_pairs_of_whole_lists(spark, monkeypatch, first, last):
    """A list of 100 sets, one of 9 and one of 2: all pairs at these distances, whatever the chunks."""
    monkeypatch.setattr(ngram_join, "CHUNK", 5)
    lengths, bits = {1: 100, 2: 9, -3: 2}, bytes(ngram_join.PARITY_BITS // 8)
    rows = [(token, 1000 * token + n, 50, 0, n, bits, n % 3) for token, length in lengths.items() for n in range(length)]
    entries = spark.createDataFrame(
        rows, "token long, set_key long, size int, position int, place long, parity binary, component long")
    found = ngram_join.chunked(entries, last).repartition(7, "token", "chunk") \
        .sortWithinPartitions("token", "chunk", "place") \
        .mapInArrow(ngram_join.candidate_pairs(90, first, last), "a long, b long").collect()
    want = [(1000 * t + x, 1000 * t + y) for t, length in lengths.items() for y in range(length) for x in range(y)
            if first <= y - x <= last and x % 3 != y % 3]
    assert sorted((r.a, r.b) for r in found if r.a is not None) == sorted(tuple(sorted(p)) for p in want)
    assert {r.b for r in found if r.a is None} == {t for t, length in lengths.items() if length > last + 1}


def test_a_long_list_is_dealt_to_many_tasks(spark):
    """A token of four fifths of the rows: no chunk holds more than half as many again as its own entries."""
    from pyspark.sql import functions as F

    places = spark.range(8000).select(F.lit(1).cast("long").alias("token"), F.col("id").alias("place"))
    places = places.unionByName(spark.range(2000).select((F.col("id") + 2).alias("token"), F.lit(0).cast("long").alias("place")))
    for last in (1, 8, 64, 512):
        sizes = ngram_join.chunked(places, last).groupBy("token", "chunk").count()
        most, rows = sizes.agg(F.max("count"), F.sum("count")).first()
        assert most <= 1.5 * ngram_join.chunk_size(last) and rows <= 1.5 * 10_000


def test_rows_of_a_large_component_are_looked_up_by_set(spark):
    """Most rows in one component, with repeated ids, null ids and exact copies; none is dealt by it."""
    rng, base = random.Random(5), prose(55, 150)
    copies = [(100 + n, edited(rng, base, n % 3), "en", "a") for n in range(60)]
    rows = copies + [(300 + n, base, "en", "a") for n in range(30)] + copies[:5] + [(400 + n, prose(900 + n), "en", "a") for n in range(9)]
    frame = messy(spark, [*rows, *[(None, base, "en", "a")] * 3, (500, None, "en", "a"), (501, "", "en", "a")])
    joined = ngram_join.join(frame)
    want = brute(rows, 3, 90)
    got = joined.collect()
    assert len(got) == len(rows) + 5
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id and r.doc_id < 500} == want
    assert [r.component_id for r in got if r.doc_id is None] == [None] * 3
    assert {r.doc_id: r.component_id for r in got if r.doc_id and r.doc_id >= 500} == {500: 500, 501: 501}
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(group" not in plan and "hashpartitioning(component" not in plan
