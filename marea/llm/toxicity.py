"""Toxicity by a factorization machine over hashed terms.

Terms are a text's distinct lower-case words and the first letters of its longer
words, hashed into a fixed number of buckets. The buckets most associated with the
label (chi-square over the training rows) enter a factorization machine, which adds
to the linear weights one learned interaction for every pair of terms, such as an
insult beside the mention of a group.

Training reads a sample of labelled rows whose size is the parameter ``train_rows``
(drawn by hash of the id); rows that ``held_out`` marks are never learnt from.

Defined cases: a null or empty text has no terms and gets the score of an empty text;
labels that are null are ignored, and a document labelled more than once counts as
toxic if any label says so; without training rows of both classes every score is the
share of toxic training rows (0 without any); repeated rows score alike; an empty
table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import FMClassificationModel, FMClassifier
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marea.functions.bounded import broadcast_if_small
from marea.functions.text import let
from marea.llm.common import KEY_BITS, column, documents, fresh, hash_key, held_out
from marea.session import materialized

BUCKETS = 1 << 20
PREFIXES = (4, 5)
TERMS = 512
MIN_SUPPORT = 3
MIN_CHI2 = 20.0         # far beyond chance, whatever the number of terms tried
TRAIN_ROWS = 20_000
FACTORS = 4
ITERATIONS = 150
THRESHOLD = 0.7


def buckets(text: Column) -> Column:
    """Distinct hashed terms of a text, as text. The words are found once; whatever is done with the
    score, such as a filter that Spark pushes down to the scan, keeps that."""

    def of_words(words: Column) -> Column:
        prefixes = [F.transform(F.filter(words, lambda w: F.length(w) > n),
                                lambda w: F.concat(F.lit("^"), F.substring(w, 1, n))) for n in PREFIXES]
        terms = F.filter(F.concat(words, F.array_distinct(F.concat(*prefixes))), lambda w: w != "")
        return F.transform(terms, lambda w: F.xxhash64(w).bitwiseAND(BUCKETS - 1).cast("string"))

    return let(F.array_distinct(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+")), of_words)


@dataclass
class ToxicityModel:
    """``machine`` over the buckets of ``vocabulary``; without one, ``prior`` is every score."""

    prior: float
    vocabulary: list[str]
    machine: FMClassificationModel | None

    def score(self, docs: DataFrame, text_col: str = "text", out: str = "score") -> DataFrame:
        """``docs`` and one more column, row by row and inside the JVM."""
        if self.machine is None:
            return docs.withColumn(out, F.lit(self.prior))
        names = docs.columns
        terms, vector, raw, chance, label = (fresh([*names, out], n) for n in
                                             ("terms", "vector", "raw", "chance", "label"))
        counted = count_terms(docs.withColumn(terms, buckets(column(docs, text_col))), self.vocabulary,
                              terms, vector)
        machine = self.machine.setFeaturesCol(vector).setRawPredictionCol(raw) \
            .setProbabilityCol(chance).setPredictionCol(label)
        scored = machine.transform(counted.drop(terms))
        return scored.select(*[column(scored, n) for n in names], vector_to_array(chance)[1].alias(out))


def count_terms(df: DataFrame, vocabulary: list[str], terms: str, vector: str) -> DataFrame:
    counter = CountVectorizerModel.from_vocabulary(vocabulary, inputCol=terms, outputCol=vector)
    return counter.setBinary(True).transform(df)


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, train_rows: int, seed: int,
                  id_col: str, text_col: str) -> DataFrame:
    """Written table (label, terms) of the sampled labelled rows that are not held out."""
    ids = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col))) \
        .groupBy(F.col(id_col).alias("labelled_id")).agg(F.max(label_col).cast("double").alias("label"))
    ids = materialized(ids)
    share = min(1.0, train_rows / max(1, ids.count()))
    sample = ids.where(hash_key(F.col("labelled_id"), seed) < F.lit(int(share * (1 << KEY_BITS))))
    texts = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).alias("text"))
    joined = texts.join(broadcast_if_small(sample, max_rows=max(train_rows * 2, 1000)),
                        F.col("doc_id") == F.col("labelled_id"))
    return materialized(joined.select("label", buckets(F.col("text")).alias("terms")))


def associated(rows: DataFrame, terms: int, min_support: int) -> list[str]:
    """The buckets with the largest chi-square against the label: at most ``terms``."""
    totals = rows.agg(F.count("*").alias("n"), F.sum("label").alias("toxic")).first()
    n, toxic = float(totals["n"]), float(totals["toxic"] or 0)
    seen = rows.select("label", F.explode("terms").alias("term")).groupBy("term").agg(
        F.count("*").cast("double").alias("with"), F.sum("label").alias("both"))
    with_, both = F.col("with"), F.col("both")
    cross = both * n - with_ * toxic
    spread = with_ * toxic * (n - with_) * (n - toxic)
    ranked = seen.where((both >= min_support) & (cross > 0) & (spread > 0)) \
        .select("term", (cross * cross * n / spread).alias("chi2")).where(F.col("chi2") >= MIN_CHI2)
    return [r["term"] for r in ranked.orderBy(F.desc("chi2"), "term").limit(terms).collect()]


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", train_rows: int = TRAIN_ROWS,
        terms: int = TERMS, min_support: int = MIN_SUPPORT, factors: int = FACTORS,
        iterations: int = ITERATIONS, seed: int = 42, id_col: str = "doc_id",
        text_col: str = "text") -> ToxicityModel:
    rows = training_rows(docs, labels, label_col, train_rows, seed, id_col, text_col)
    totals = rows.agg(F.avg("label").alias("share"), F.count_distinct("label").alias("classes")).first()
    prior = float(totals["share"] or 0.0)
    chosen = associated(rows, terms, min_support) if totals["classes"] == 2 else []
    if not chosen:
        return ToxicityModel(prior, [], None)
    vectors = materialized(count_terms(rows, chosen, "terms", "features").select("label", "features"))
    learner = FMClassifier(factorSize=factors, maxIter=iterations, stepSize=0.1, regParam=1e-2,
                           initStd=0.01, solver="adamW", seed=seed)
    return ToxicityModel(prior, chosen, learner.fit(vectors))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = fit(docs, labels).score(docs.select("doc_id", "text"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
