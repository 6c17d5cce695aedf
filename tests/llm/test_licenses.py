import math
import re
from collections import Counter

import pytest

from marea.llm import licenses
from tests.llm.frames import empty, messy

FILES = [
    (1, "a/LICENSE", "Released under the MIT License."),
    (2, "a/x.py", "print(1)\nfoo bar"),
    (3, "a/b/y.py", "some code and more code in a longer file than its notice is long, surely\n"
                    "Licensed under the Apache License, Version 2.0\nmore"),
    (4, "a/b/c/z.py", "nothing here"), (5, "q/z.py", "zzz"), (6, None, "zzz"), (7, "a/n", None),
    (8, "a/b/COPYING", "This work is licensed under the GNU General Public License, version 2."),
    (9, "top", "All rights reserved"), (10, "ab/x.py", "zzz"), (11, "a/b/c/d/e/f", ""),
    (12, "w/n.md", "# licensed under the gnu general public license, version 3"), (12, "w/n.md", "unrelated words"),
]


def scanned(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "file_id long, path string, text string, license string, score int")
    return licenses.scan(frame, **options).collect()


def test_own_and_inherited_licenses(spark):
    got = {(r.file_id, r.own_license): (r.license, r.inherited_from) for r in scanned(spark, FILES)}
    assert got == {
        (1, "MIT"): ("MIT", None), (2, None): ("MIT", "a"), (3, "Apache-2.0"): ("Apache-2.0", None),
        (4, None): ("GPL-2.0", "a/b"), (5, None): (None, None), (6, None): (None, None), (7, None): ("MIT", "a"),
        (8, "GPL-2.0"): ("GPL-2.0", None), (9, "Proprietary"): ("Proprietary", None), (10, None): (None, None),
        (11, None): ("GPL-2.0", "a/b"), (12, "GPL-3.0"): ("GPL-3.0", None), (12, None): ("GPL-3.0", "w")}


def brute_scores(rows):
    """Best cosine of any line, or of the text of a licence file, to any template."""
    terms = lambda t: re.findall(r"[^\W_]+(?:[.-][^\W_]+)*", t.lower())
    seen = Counter(w for _, _, t in rows for w in set(terms(t or "")))
    idf = lambda w: math.log((1 + len(rows)) / (1 + seen[w])) + 1
    vector = lambda t: {w: n * idf(w) for w, n in Counter(terms(t)).items()}
    size = lambda v: math.sqrt(sum(x * x for x in v.values()))
    found = []
    for i, path, text in rows:
        lines = (text or "").split("\n") + [text or ""] * bool(re.match(licenses.LICENSE_FILE[4:], (path or "").split("/")[-1], re.I))
        best = max(((sum(x * b.get(w, 0) for w, x in a.items()) / (size(a) * size(b)), name)
                    for line in lines if (a := vector(line)) for name, texts in licenses.TEMPLATES.items()
                    for b in map(vector, texts)), default=(0, None), key=lambda s: (round(s[0], 9), [-ord(c) for c in s[1] or ""]))
        found.append((i, path, round(best[0], 6)) if best[0] >= licenses.MIN_COSINE else (i, path, None))
    return found


def test_scores_match_brute_force(spark):
    words = "licensed under the mit apache license version 2.0 software and work gnu general public copy of cc by".split()
    rows = FILES[:11] + [(100 + n, f"r/{n}/f", "text\n" + " ".join(words[(n * k) % len(words)] for k in range(1, 4 + n % 9)))
                         for n in range(120)]
    rows += [(300 + n, f"s/{n}", f"Licensed under the MIT License. {' extra' * n}") for n in range(8)]
    got = sorted(((r.file_id, r.path or "", None if r.score is None else round(r.score, 6)) for r in scanned(spark, rows)))
    want = sorted((i, p or "", s) for i, p, s in brute_scores(rows))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    for g, w in zip(got, want):
        assert g[2] == pytest.approx(w[2], abs=2e-6) if w[2] is not None else g[2] is None, (g, w)


def test_anchors_cover_every_template():
    rows = [{"template": "t", "term": c, "weight": w} for c, w in zip("abcd", (4.0, 3.0, 1.0, 1.0))]
    rare = licenses.anchors(rows, 0.75)
    left = sum(r["weight"] ** 2 for r in rows if r["term"] not in rare)
    assert math.sqrt(left / 27) < 0.75 and rare == ["a"]


def test_odd_rows_of_the_scan(spark):
    docs = messy(spark)
    assert licenses.scan(docs, id_col="doc_id", path_col="source").count() == docs.count()
    assert licenses.scan(empty(spark), id_col="doc_id", path_col="source").count() == 0
