import hashlib

import numpy as np
import pytest

from marea.llm import fingerprint as fp
from tests.llm.frames import empty, messy, prose

NUMBERS = fp.byte_numbers()


def slow_fingerprint(text):
    """The same by one byte at a time."""
    data = text.encode("utf-8", "surrogatepass")
    if not data:
        return f"{fp.FIRST_BITS}::"
    hashes = []
    for n in range(len(data)):
        value, factor = 0, 1
        for byte in reversed(data[max(0, n - fp.WINDOW + 1):n + 1]):
            value = value + int(NUMBERS[byte]) * factor & 0xFFFFFFFF
            factor = factor * 0x01000193 & 0xFFFFFFFF
        value ^= value >> 15
        value = value * 0x2C1B3C6D & 0xFFFFFFFF
        hashes.append(value ^ value >> 13)

    def signature(bits):
        letters, total = "", 0
        for n, value in enumerate(hashes):
            total = total + value * 0x9E3779B1 & 0xFFFFFFFF
            if n == len(hashes) - 1 or bits < 32 and value & ((1 << bits) - 1) == 0:
                letters += chr(fp.LETTERS[(total * 0x85EBCA6B & 0xFFFFFFFF) >> 26])
                total = 0
        return letters

    bits = next(b for b in range(fp.FIRST_BITS, 33) if len(signature(b)) <= fp.MAX_CHUNKS)
    return f"{bits}:{signature(bits)}:{signature(bits + 1)}"


@pytest.mark.parametrize("text", ["", "a", "short", "été 😀", prose(1, 8), prose(2, 300), "ab" * 400, "\ud800x"])
def test_fingerprint_matches_a_bytewise_version(text):
    assert fp.fingerprint(text, NUMBERS) == slow_fingerprint(text)


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def slow_likeness(one, other):
    if one == other:
        return 1.0
    (a, *own), (b, *their) = one.split(":"), other.split(":")

    def alike(s, t):
        runs = {s[n:n + 4] for n in range(len(s) - 3)}
        if not s and not t or min(len(s), len(t)) >= 16 and not any(r in t for r in runs):
            return 0.0
        return 1 - edit_distance(s, t) / max(len(s), len(t))

    pairs = {0: list(zip(own, their)), 1: [(own[1], their[0])], -1: [(own[0], their[1])]}
    return max((alike(s, t) for s, t in pairs.get(int(b) - int(a), [])), default=0.0)


def test_rows_match_brute_force(spark):
    rows = [(n * 7, prose(n // 2, 3 + 13 * (n % 23)), "en", "a") for n in range(90)]
    docs = messy(spark, rows).repartition(5)
    got = {r.doc_id: r for r in fp.followed(docs).select(
        "*", fp.likeness(fp.F.col("fingerprint"), fp.F.col("edited_fingerprint")).alias("near_edited"),
        fp.likeness(fp.F.col("fingerprint"), fp.F.col("next_fingerprint")).alias("near_next")).collect()}
    ordered = sorted(rows, reverse=True)
    assert len(got) == len(rows)
    for (i, text, *_), (_, following, *_) in zip(ordered, ordered[1:] + ordered[:1]):
        cut = len(text) // 3
        edited = text[:len(text) - cut] + following[:cut]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == fp.fingerprint(text, NUMBERS)
        assert r.edited_fingerprint == fp.fingerprint(edited, NUMBERS)
        assert r.next_fingerprint == fp.fingerprint(following, NUMBERS)
        assert r.near_edited == pytest.approx(slow_likeness(r.fingerprint, r.edited_fingerprint))
        assert r.near_next == pytest.approx(slow_likeness(r.fingerprint, r.next_fingerprint))
    assert np.median([r.near_edited for r in got.values()]) > 0.5


def test_an_edit_at_the_end_keeps_the_start_of_the_signature():
    one, other = (fp.fingerprint(prose(5, 400) + end, NUMBERS).split(":")[1] for end in ("", " and a new end"))
    assert one[:40] == other[:40]


def test_odd_rows_of_fingerprints(spark):
    got = fp.followed(messy(spark)).collect()
    assert len(got) == messy(spark).count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[4].n_chars == by_id[5].n_chars == 0 and by_id[4].fingerprint == by_id[5].fingerprint == "2::"
    assert by_id[1].fingerprint == by_id[2].fingerprint
    lone = fp.followed(messy(spark, [(1, "only one here", "en", "a")])).collect()
    assert lone[0].next_fingerprint == lone[0].fingerprint
    assert fp.followed(empty(spark)).count() == 0
    assert fp.with_fingerprint(messy(spark), "print").count() == messy(spark).count()
