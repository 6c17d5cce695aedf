"""Small frames that hold every odd case at once."""

from __future__ import annotations

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, score double, "
          "bucket string, key string, node long, rule string, stats string, terms string, label string, guest string")
EXTRA = (7, 0.5, "b", "k", 9, "r", "s", "t", "l", "g")     # columns whose names the operators use themselves
LONG = " ".join(f"word{n % 977} and more" for n in range(40_000))


def prose(seed: int, words: int = 60) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split())
                    + str(rng.randrange(40)) for _ in range(words))


ROWS = [
    (1, prose(1), "en", "a"), (2, prose(1), "en", "a"), (3, prose(2), "en", "b"), (3, prose(2), "en", "b"),
    (4, None, "en", "a"), (5, "", "en", None), (6, " \n\t ", None, "c"), (7, LONG, "en", "a"),
    (None, prose(3), "en", "a"), (8, "one two", "en", "c"), (9, "ONE TWO \U0001f600 İ", "de", "é"),
    (10, prose(4) + " x", "en", "a"), (11, prose(4), "en", "a"),
]


def messy(spark, rows=ROWS):
    data = [(i, t, lang, source, None if t is None else len(t), *EXTRA) for i, t, lang, source in rows]
    return spark.createDataFrame(data, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
