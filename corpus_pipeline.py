"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; its
result is written and read again before the next one starts, so a lost executor costs
part of one stage at most. All stages but the last return the columns of documents. A stage
begins by letting the driver drop what the one before it left.

The rows of a run depend on trained weights and keyed hashes, which SQL cannot express,
so there is no check SQL; the tests hold a run against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from marea.functions.bounded import broadcast_if_small
from marea.llm import mixing, ngram_join, packing, pii, toxicity
from marea.llm.common import column, documents, fresh
from marea.session import materialized, release

SHINGLE_WORDS, SIMILARITY = 5, 80
MAX_BROADCAST = 500_000

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the threshold of the toxicity score; null and empty texts stay."""
    release(spark)
    score = fresh(docs.columns, "score")
    scored = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).score(docs, out=score)
    return scored.where(column(scored, score) < toxicity.THRESHOLD).select(
        *[column(scored, n) for n in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates. Documents without
    words and rows with a null id belong to no group; a row that repeats another's id and
    text goes, and rows of one id with different texts are judged by that id."""
    release(spark)
    groups = materialized(ngram_join.join(docs, SHINGLE_WORDS, SIMILARITY))
    leave = groups.where(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct()
    kept = docs.join(broadcast_if_small(leave, MAX_BROADCAST), "doc_id", "left_anti").select(
        *[column(docs, n) for n in docs.columns])
    repeated = groups.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():
        return kept
    repeated = broadcast_if_small(repeated, MAX_BROADCAST)
    number = fresh(docs.columns, "number")
    numbered = kept.join(repeated, "doc_id", "left_semi").withColumn(
        number, F.row_number().over(Window.partitionBy("doc_id", F.md5("text")).orderBy("doc_id")))
    first = numbered.where(column(numbered, number) == 1)
    return kept.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(first.select(*docs.columns))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data and secrets."""
    release(spark)
    return pii.replace_entities(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix takes them: once or more, the last of a source cut."""
    release(spark)
    return mixing.mixed_documents(docs, materialized(mixing.mix_plan(docs)))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document, with its place in a sequence."""
    release(spark)
    return packing.digest(packing.token_pieces(docs, packing.definition_of()))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("pii", replace_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = materialized(stage(spark, docs, sf_dir))
    return docs
