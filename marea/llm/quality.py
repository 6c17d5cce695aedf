"""Quality by a regularised quadratic discriminant over document statistics.

Each whole text becomes a few transformed statistics. Per class, their mean and
covariance are summed over all training rows; the covariance is shrunk towards the
pooled one and towards its diagonal, and its Cholesky factor is kept. The two log
densities (Mahalanobis distances and log determinants) give a difference, which a
logistic fit over the training rows turns into a score: statistics depend on each other
and have long tails, so the plain difference is far too sure and not centred.

Defined cases: a null text counts as empty; all statistics of an empty text are 0, so
it has a score like any other; null labels are ignored, and a document labelled more
than once takes the lowest label; with fewer than two rows of a class every score is
the share of label 1 (0.5 without any rows); repeated rows score alike; an empty
table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

from marea.llm.common import column, documents, fresh, held_out
from marea.session import materialized

POOLED, DIAGONAL = 0.1, 0.05    # shrinkage towards the pooled covariance, and its diagonal

# --- Fixed values -----------------------------------------------------------
STATISTICS = ("log_words", "word_length", "upper_share", "symbol_share", "mark_share", "digit_share",
              "repeated_lines", "repeated_words", "repeated_pairs", "line_length", "top_word", "cell_share")
# Classes of bytes: 1 upper case, 2 lower case and all of non-ASCII, 3 digit, 4 white space,
# 5 the marks of plain prose, 6 the bar between table cells, 0 any other symbol.
BYTE_CLASSES = {1: b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 2: b"abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256)),
                3: b"0123456789", 4: b" \t\n\x0b\x0c\r", 5: b".,;:'\"()-", 6: b"|"}
# ----------------------------------------------------------------------------


def class_table() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for kind, members in BYTE_CLASSES.items():
        table[list(members)] = kind
    return table


def statistics(text: str, table: np.ndarray) -> list[float]:
    """The transformed statistics of one text, in the order of STATISTICS."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    symbol, upper, lower, digit, blank, mark, bar = np.bincount(table[data], minlength=7)[:7]
    shown = len(data) - blank
    lines = [line for line in text.split("\n") if line.strip()]
    pairs = len(set(zip(words, words[1:])))
    distinct = set(words)
    n = len(words)
    root = lambda share: float(np.sqrt(max(0.0, share)))
    counts = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    return [
        float(np.log1p(n)),
        float(np.log(shown / n)),
        root(upper / max(1, upper + lower)),
        root(symbol / shown),
        root(mark / shown),
        root(digit / shown),
        root(1 - len(set(lines)) / max(1, len(lines))),
        root(1 - len(distinct) / n),
        root(1 - pairs / max(1, n - 1)) if n > 1 else 0.0,
        float(np.log(n / max(1, len(lines)))),
        root(max(counts.values()) / n),
        root(bar / shown),
    ]


def with_statistics(docs: DataFrame, out: str, text_col: str = "text", drop_text: bool = False) -> DataFrame:
    """``docs`` with the array column ``out``, computed in Arrow batches."""
    def run(texts: pd.Series) -> pd.Series:
        table = class_table()
        return pd.Series([statistics(t or "", table) for t in texts])

    compute = F.pandas_udf(run, "array<double>")
    added = docs.withColumn(out, compute(column(docs, text_col)))
    return added.select(*[column(added, n) for n in added.columns if not (drop_text and n == text_col)])


@dataclass
class QualityModel:
    """Per class its mean and Cholesky factor. A score is the logistic of ``odds`` and
    ``slope`` times the squashed difference of the log densities."""

    odds: float
    means: list[np.ndarray]
    factors: list[np.ndarray]
    slope: float = 1.0

    def log_ratio(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0, for every row of ``x``."""
        densities = []
        for mean, factor in zip(self.means, self.factors):
            white = np.linalg.solve(factor, (x - mean).T)
            densities.append(-0.5 * (white * white).sum(0) - np.log(np.diag(factor)).sum())
        return densities[1] - densities[0]

    def evidence(self, values: pd.Series) -> np.ndarray:
        """The difference of the log densities on a logarithmic scale to both sides of 0."""
        ratio = self.log_ratio(np.vstack(values.to_numpy()))
        return np.sign(ratio) * np.log1p(np.abs(ratio))

    def score(self, df: DataFrame, stats: str, out: str = "score") -> DataFrame:
        model = self

        def run(values: pd.Series) -> pd.Series:
            if not model.means or not len(values):
                return pd.Series(np.full(len(values), 1 / (1 + np.exp(-model.odds))))
            z = model.slope * model.evidence(values) + model.odds
            return pd.Series(1 / (1 + np.exp(-np.clip(z, -60, 60))))

        return df.withColumn(out, F.pandas_udf(run, "double")(column(df, stats)))


def moments(rows: DataFrame, stats: str, label: str, size: int) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, sums and sums of products per class: one partial aggregate of fixed width."""
    at = [F.col(stats)[i] for i in range(size)]
    sums = [F.sum(a).alias(f"s{i}") for i, a in enumerate(at)]
    products = [F.sum(at[i] * at[j]).alias(f"p{i}_{j}") for i in range(size) for j in range(i + 1)]
    found = {}
    for r in rows.groupBy(label).agg(F.count("*").alias("n"), *sums, *products).collect():
        square = np.zeros((size, size))
        for i in range(size):
            for j in range(i + 1):
                square[i, j] = square[j, i] = r[f"p{i}_{j}"]
        found[int(r[label])] = (float(r["n"]), np.array([r[f"s{i}"] for i in range(size)]), square)
    return found


def fit(rows: DataFrame, stats: str, label: str, pooled: float = POOLED,
        diagonal: float = DIAGONAL, size: int = len(STATISTICS)) -> QualityModel:
    """Model from rows with an array of statistics and a label 0 or 1, over all of them."""
    found = moments(rows, stats, label, size)
    counts = [found[c][0] if c in found else 0.0 for c in (0, 1)]
    odds = float(np.log((counts[1] + 0.5) / (counts[0] + 0.5)))
    if min(counts) < 2:
        share = counts[1] / sum(counts) if sum(counts) else 0.5
        odds = float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
        return QualityModel(odds, [], [])
    means = [found[c][1] / counts[c] for c in (0, 1)]
    own = [found[c][2] / counts[c] - np.outer(means[c], means[c]) for c in (0, 1)]
    both = sum(n * s for n, s in zip(counts, own)) / sum(counts)
    factors = []
    for covariance in own:
        mixed = (1 - pooled) * covariance + pooled * both
        mixed = (1 - diagonal) * mixed + diagonal * np.diag(np.diag(mixed))
        factors.append(np.linalg.cholesky(mixed + 1e-4 * np.eye(size)))
    return calibrated(QualityModel(odds, means, factors), rows, stats, label)


def calibrated(model: QualityModel, rows: DataFrame, stats: str, label: str) -> QualityModel:
    """The model with slope and odds fitted to the training rows."""
    def run(values: pd.Series) -> pd.Series:
        return pd.Series(model.evidence(values) if len(values) else np.zeros(0))

    evidence = F.pandas_udf(run, "double")(column(rows, stats))
    points = materialized(rows.select(array_to_vector(F.array(evidence)).alias("features"),
                                      column(rows, label).cast("double").alias("label")))
    fitted = LogisticRegression(regParam=1e-4, standardization=False).fit(points)
    return replace(model, slope=float(fitted.coefficients[0]), odds=float(fitted.intercept))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    stats = materialized(with_statistics(docs.select("doc_id", "text"), "stats", drop_text=True))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet") \
        .where(F.col("quality").isNotNull() & ~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
    model = fit(materialized(stats.join(labels, "doc_id").select("stats", "quality")), "stats", "quality")
    scored = model.score(stats, "stats")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
