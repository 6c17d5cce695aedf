import io
import tracemalloc
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from marea.llm import filter_audit as audit
from tests.llm.frames import LONG, ROWS, empty, messy


def matrix_of(spark, rows, **options):
    frame = spark.createDataFrame(rows, "doc_id long, word string, text string").repartition(3)
    shards, dictionary = audit.term_matrix(frame, "text", **options)
    words = {r["term"]: bytes(r["word"]) for r in dictionary.collect()}
    assert len(set(words.values())) == len(words)
    cells = {}
    for shard in shards.collect():
        starts, terms = (np.frombuffer(shard[c], np.int64) for c in ("starts", "terms"))
        counts = np.frombuffer(shard["counts"], np.int32)
        for n, row in enumerate(shard["rows"]):
            at = slice(starts[n], starts[n + 1])
            cells[row["doc_id"]] = {words[t]: int(c) for t, c in zip(terms[at], counts[at])}
    return shards, cells


@pytest.mark.parametrize("shard_words", [1, 40, 10 ** 6])
def test_matrix_holds_every_word(spark, shard_words):
    rows = [(i, "w", t) for i, (_, t, _, _) in enumerate(ROWS)] + [(99, None, "b a b   é a b")]
    shards, cells = matrix_of(spark, rows, shard_words=shard_words)
    assert cells == {i: dict(Counter((t or "").encode().split())) for i, _, t in rows}
    totals = {r["doc_id"]: (r["n_words"], r["n_distinct"], r["word"]) for r in audit.matrix_rows(shards).collect()}
    assert totals == {i: (len((t or "").encode().split()), len(set((t or "").encode().split())), w) for i, w, t in rows}


def fails(rows, i):
    doc_id, text = rows[i][0], rows[i][1] or ""
    words = text.encode().split()
    found = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
             "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), "D": any(c in "#$%&*|" for c in text),
             "E": doc_id is not None and any(r[0] is not None and r[0] < doc_id and (r[1] or "") == text for r in rows)}
    return {f for f, failed in found.items() if failed}


def by_hand(rows, labels):
    sets = [(r[2] or "", fails(rows, i), [q for d, q, _ in labels if d == r[0] and d is not None],
             [t for d, _, t in labels if d == r[0] and d is not None]) for i, r in enumerate(rows)]
    out, removed = {}, Counter()
    for part in {s[0] for s in sets}:
        for order in map("".join, permutations("ABCDE")):
            left = [s for s in sets if s[0] == part]
            for step, letter in enumerate(order, 1):
                mine = [s for s in sets if s[0] == part and letter in s[1]]
                gone = [s for s in left if letter in s[1]]
                left = [s for s in left if letter not in s[1]]
                out[part, order, step] = [len(left), len(gone), len(mine) - len(gone),
                                          sum(s[1] == {letter} for s in mine), sum(1 in s[2] for s in gone),
                                          sum(1 in s[3] for s in gone)]
                removed[part, letter] += len(gone)
    return {k: (*v, removed[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def check(spark, rows, labels):
    frame = messy(spark, rows).repartition(4)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audit.audit(audit.failure_counts(audit.failed_filters(frame), marks)).collect()
    assert {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in got} == by_hand(rows, labels)
    assert len(got) == 600 * len({r[2] or "" for r in rows})


LABELS = [(1, 1, 0), (2, 0, 1), (3, 1, 1), (4, None, 1), (5, 1, None), (5, 0, 0), (7, 1, 1), (None, 1, 1), (12, 1, 1)]


def test_audit_of_messy_rows(spark):
    check(spark, ROWS, LABELS)


def test_audit_of_each_mix_of_failures(spark):
    varied = " ".join(f"w{n}" for n in range(250))
    texts = [varied, varied + " #", "A " * 250, "short", "SHORT *", varied + " AB" * 30, "x " * 300 + "|", varied]
    rows = [(n, texts[n % len(texts)] + ("" if n < 16 else f" {n}"), ["en", "de", None][n % 3], "s") for n in range(40)]
    check(spark, rows, [(n, n % 2, n % 3 == 0) for n in range(0, 40, 2)] and [(n, n % 2, int(n % 3 == 0)) for n in range(30)])


def test_copies_under_repeated_and_null_ids(spark):
    rows = [(i, t, lang, "s") for i, t, lang in
            [(1, "a", "en"), (1, "a", "en"), (1, "b", "en"), (2, "a", "de"), (2, "a", "de"), (None, "a", "en"),
             (None, "b", "de"), (3, None, "en"), (4, "", "de"), (0, "b", None)]]
    check(spark, rows, LABELS)


def test_long_text_and_empty_table(spark):
    flags = audit.failed_filters(messy(spark, [(7, LONG, "en", "a")]))
    assert [r["fails"] for r in flags.collect()] == [2]      # 977 words and two more, over and over
    none = audit.failed_filters(empty(spark))
    assert audit.audit(audit.failure_counts(none, spark.createDataFrame([], "doc_id long, quality int, toxic int"))).count() == 0


def peak_mb(action):
    tracemalloc.start()
    try:
        action()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


class OneTask:
    @classmethod
    def get(cls):
        return cls

    @staticmethod
    def partitionId():
        return 3


def streamed(ids_and_texts, batch_rows):
    """Record batches as a Python worker gets them: the columns of each share one buffer."""
    sink = pa.BufferOutputStream()
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.binary())])
    with pa.ipc.new_stream(sink, schema) as out:
        for at in range(0, len(ids_and_texts), batch_rows):
            ids, texts = zip(*ids_and_texts[at:at + batch_rows])
            out.write_batch(pa.record_batch([pa.array(ids), pa.array(texts, pa.binary())], schema=schema))
    return pa.ipc.open_stream(pa.PythonFile(io.BytesIO(sink.getvalue().to_pybytes()), mode="r"))


def test_a_shard_keeps_no_texts(monkeypatch):
    monkeypatch.setattr("pyspark.TaskContext", OneTask)
    held = []

    def batches():
        reader = streamed([(n, (b"a" * 99 + b" ") * 9_000) for n in range(40)], 4)     # 36 MB, 3.6 MB a batch
        start = tracemalloc.get_traced_memory()[0]
        for batch in reader:
            held.append(tracemalloc.get_traced_memory()[0] - start)
            yield batch
            del batch

    tracemalloc.start()
    try:
        found = list(audit.build_shards(1, 10 ** 9, 4, 10 ** 9)(batches()))
    finally:
        tracemalloc.stop()
    shards = [b for b in found if b.column("starts")[0].is_valid]
    assert [r["doc_id"] for r in shards[0].column("rows")[0].as_py()] == list(range(40)) and len(shards) == 1
    assert max(held) < 15e6


def test_shards_end_at_their_words_and_bytes(monkeypatch):
    monkeypatch.setattr("pyspark.TaskContext", OneTask)

    def rows_of_shards(texts):
        found = audit.build_shards(1, audit.SHARD_WORDS, 4)(iter(streamed(list(enumerate(texts)), 7)))
        return [[r["doc_id"] for r in b.column("rows")[0].as_py()] for b in found if b.column("starts")[0].is_valid]

    assert rows_of_shards([b"a " * 300_000] * 10) == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9]]
    assert rows_of_shards([b"a" * 3_000_000 + b" b"] * 7) == [[0, 1, 2], [3, 4, 5], [6]]
    assert rows_of_shards([b"a", b"b " * 2_000_000, b"c"]) == [[0, 1], [2]]
    assert max(map(len, rows_of_shards([b"", None] * 25_000))) < 40_000


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_pieces_hold_the_same_words(size):
    for text in [b"", b" ", b"one", b"one two\tthree\n\n four\x0b\x0cfive \xc2\xa0six", b"  a bb  ccc dddd ", LONG.encode()[:5000]]:
        assert [w for p in audit.pieces(text, size) for w in p.split()] == text.split()


def test_a_long_text_is_split_in_pieces():
    text, shard = b"some words " * 1_500_000, audit._Shard()
    assert peak_mb(lambda: shard.add(text)) < 40
    assert (shard.size, sorted(shard.words), shard.counts[0].tolist()) == (3_000_000, [b"some", b"words"], [1_500_000] * 2)


def test_a_range_holds_shared_words_once():
    words = [b"w%d" % n for n in range(20_000)]
    rows = [(0, shard, words[shard:]) for shard in range(40)]
    table = pa.table({"range": pa.array([r for r, _, _ in rows], pa.int32()), "shard": [s for _, s, _ in rows],
                      "n": pa.array([len(w) for _, _, w in rows], pa.int32()),
                      "words": pa.array([b" ".join(w) for _, _, w in rows], pa.binary()),
                      "numbers": pa.array([b""] * len(rows), pa.binary())})
    found = []
    assert peak_mb(lambda: found.append(audit.number_range(4)(table))) < 12
    place = {w: 4 * n for n, w in enumerate(sorted(words))}
    for n, ids in zip(found[0].column("n").to_pylist(), found[0].column("ids").to_pylist()):
        assert audit.unpacked(ids, n, np.int64).tolist() == [place[w] for w in words[20_000 - n:]]


def test_tasks_get_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes])], names=["size"])

    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    frame = spark.range(0, 200, 1, 1).selectExpr("repeat('some words ', 10000) as text")       # 22 MB
    with audit.arrow_batches(spark, audit.BATCH_BYTES):
        found = [r["size"] for r in frame.mapInArrow(sizes, "size long").collect()]
    assert sum(found) > 20e6 and max(found) < 5e6
    assert spark.conf.get(setting) == before
    assert audit.matrix_rows(audit.term_matrix(frame.selectExpr("1L as doc_id", "text"), "text")[0]).count() == 200
    assert spark.conf.get(setting) == before
