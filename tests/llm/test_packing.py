import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from marea.llm import packing
from tests.llm.frames import empty, messy, prose


@pytest.fixture(scope="module")
def definition():
    return packing.definition_of()


@pytest.fixture(scope="module")
def both(definition):
    from tokenizers import Tokenizer

    exact = Tokenizer.from_str(definition)
    return packing.encoder(definition), lambda t: exact.encode(t, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_fast_ids_are_those_of_the_tokenizer(both, text):
    assert list(both[0](text)) == both[1](text)


@pytest.mark.parametrize("text", ["<|endoftext|>", "a<|endoftext|>b", "  tabs\t\n\n ", "é" * 3000, "'s 're don't",
                                  "x" * 5000, "一二三 \U0001f600‍", "12345 67", "\u0000\u0085 "])
def test_fast_ids_of_special_texts(both, text):
    assert list(both[0](text)) == both[1](text)


def test_other_vocabularies_use_the_tokenizer_itself(both):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    ids = packing.encoder(packing.definition_of(path))("Some words, and more")
    assert ids == Tokenizer.from_file(path).encode("Some words, and more", add_special_tokens=False).ids


def test_pieces_give_the_documents_back(spark, definition, both):
    rows = [(n, prose(n, 5 + 90 * (n % 9)), "en", "a") for n in range(120)]
    pieces = packing.token_pieces(messy(spark, rows).repartition(3), definition, limit=128)
    packed = packing.pack(pieces, limit=128).toPandas()
    want = {n: [*both[1](text), 0] for n, text, *_ in rows}
    for doc_id, of in packed.sort_values("start").groupby("doc_id"):
        assert np.concatenate([np.frombuffer(b, "<u4") for b in of.ids]).tolist() == want[doc_id]
        assert of.start.tolist() == [0, *np.cumsum(of.length)[:-1]]
        assert (of.doc_tokens == len(want[doc_id])).all()
    for _, of in packed.sort_values("offset").groupby("sequence_id"):
        assert of.offset.tolist() == [0, *np.cumsum(of.length)[:-1]]
        assert of.length.sum() <= 128
    assert packed.sequence_id.max() + 1 == packed.sequence_id.nunique()
    assert packed.length.sum() / packed.sequence_id.nunique() / 128 > 0.9
    sequences = packing.sequences(packing.pack(pieces, limit=128)).toPandas()
    assert (sequences.ids.map(len) == 4 * sequences.tokens).all()
    assert sequences.tokens.sum() == sum(map(len, want.values()))


def test_checksums_are_those_of_the_ids(spark, definition, both):
    found = packing.digest(packing.token_pieces(messy(spark, [(1, "some text", "en", "a")]), definition)).collect()
    ids = np.array([*both[1]("some text"), 0], "<u4")
    assert [r.ids_crc32 for r in found] == [zlib.crc32(ids.tobytes())]


def test_histogram_packing_is_complete_and_within_the_limit():
    rng = random.Random(5)
    for _ in range(20):
        histogram = dict(Counter(rng.randint(1, 64) for _ in range(rng.randint(1, 400))))
        packs = packing.shortest_pack_first(histogram, 64)
        placed = Counter()
        for count, pattern in packs:
            assert sum(pattern) <= 64 and count > 0
            for length in pattern:
                placed[length] += count
        assert placed == histogram


def test_shortest_pack_is_filled_first():
    assert sorted(packing.shortest_pack_first({6: 1, 5: 1, 3: 1}, 10)) == [(1, (5, 3)), (1, (6,))]


def test_packing_of_odd_rows(spark, definition):
    found = packing.digest(packing.token_pieces(messy(spark), definition)).toPandas()
    assert found.groupby("doc_id").size()[4] == 1 and found[found.doc_id == 4].length.tolist() == [1]
    assert found[found.doc_id == 7].length.sum() == found[found.doc_id == 7].doc_tokens.iloc[0] > 100_000
    assert (found[found.doc_id == 3].start == 0).sum() == 2
    assert found.doc_id.isna().sum() >= 1
    assert packing.digest(packing.token_pieces(empty(spark), definition)).count() == 0
