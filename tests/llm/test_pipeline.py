"""The pipeline on a small corpus, stage by stage against plain Python."""

from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline as pipeline
from marea.llm import mixing
from tests.llm.frames import LONG, messy, prose
from tests.llm.test_mixing_and_sharding import brute_targets
from tests.llm.test_ngram_join import brute

TOXIC = " grobian17"
MAIL = "someone.12@mail3.example.com"


def corpus():
    rows, labels = [], []
    for n in range(240):
        text = prose(n % 150, 40 + n % 50)
        toxic = n % 5 == 0
        if n >= 150:
            text = prose(n % 150, 40 + (n - 150) % 50) + " end"
        rows.append((n, text + TOXIC * toxic + (f" {MAIL}" if n % 7 == 1 else ""), "en", f"s{n % 4}" if n % 11 else None))
        labels.append((n, int(toxic), 1))
    rows += [(1000, None, "en", "s1"), (1001, "", "en", "s2"), (1002, LONG, "en", "s3"), (None, prose(900, 30), "en", "s0"),
             (1003, prose(901, 30), "en", "s0"), (1003, prose(901, 30), "en", "s0")]
    return rows, labels


def words(text):
    return len((text or "").encode().split())


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pipeline"))
    rows, labels = corpus()
    messy(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{folder}/labels.parquet")
    docs, found = spark.read.parquet(f"{folder}/documents.parquet"), []
    for number, (_, stage) in enumerate(pipeline.STAGES):
        result = stage(spark, docs, folder)
        result.write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        found.append((docs.columns, docs.collect()))
    return folder, found


def test_columns_stay(stages):
    for columns, _ in stages[1][:-1]:
        assert columns == stages[1][0][0] and columns[:4] == ["doc_id", "text", "lang", "source"]


def test_toxic_documents_go_and_clean_ones_stay(stages):
    rows, _ = corpus()
    want = Counter((i, t) for i, t, *_ in rows if not (t or "").count(TOXIC))
    assert Counter((r.doc_id, r.text) for r in stages[1][0][1]) == want


def test_one_document_of_each_group_stays(stages):
    before = {r.doc_id: r.text for r in stages[1][0][1]}
    groups = brute([(i, t) for i, t in before.items() if i is not None], 5, 80)
    want = sorted(i for i in before if i is not None and groups[i][1] == i)
    got = [r.doc_id for r in stages[1][1][1]]
    assert sorted(i for i in got if i is not None) == want and got.count(None) == 1
    assert len(want) < len(before) - 20


def test_personal_data_is_replaced(stages):
    before = {r.doc_id: r.text for r in stages[1][1][1]}
    after = {r.doc_id: r.text for r in stages[1][2][1]}
    assert before.keys() == after.keys()
    assert not any(MAIL in (t or "") for t in after.values())
    assert all(after[i] == t for i, t in before.items() if MAIL not in (t or ""))
    assert len({after[i].split()[-1] for i, t in before.items() if MAIL in (t or "")}) == 1


def test_sources_get_their_targets(stages):
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in stages[1][2][1]:
        sizes["1" if r.source is None else f"0{r.source}"] += words(r.text)
    for r in stages[1][3][1]:
        taken["1" if r.source is None else f"0{r.source}"] += words(r.text)
    weights = {s: mixing.WEIGHTS[n % 3] for n, s in enumerate(sorted(sizes))}
    for source, target in brute_targets(sizes, weights, 1.5, 2).items():
        assert abs(taken[source] - target) <= 0.5


def test_pieces_hold_every_token(stages):
    import public_tokenizers
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter((r.doc_id, len(exact.encode(r.text or "", add_special_tokens=False).ids) + 1) for r in stages[1][3][1])
    pieces = stages[1][4][1]
    assert Counter((r.doc_id, r.doc_tokens) for r in pieces if r.start == 0) == want
    assert sum(r.length for r in pieces) == sum(tokens * n for (_, tokens), n in want.items())
    by_sequence = defaultdict(list)
    for r in pieces:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        starts, lengths = zip(*sorted(places))
        assert list(starts) == [0, *np.cumsum(lengths)[:-1]] and sum(lengths) <= 1024


def test_run_gives_the_same_rows(spark, stages):
    folder, found = stages
    again = pipeline.run(spark, folder).select("doc_id", "start", "length", "ids_crc32").collect()
    assert Counter(map(tuple, again)) == Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in found[-1][1])
