"""Inputs derived from the given tables, the same in Spark and in the check SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (DecimalType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

from marea.functions.partitions import spread
from marea.operators.prepare import (as_category, coerce_numeric, impute_mean, standard_scale,
                                     target_encode)
from marea.session import materialized
from marea.sources.readers import read_table

PARAGRAPH_BREAK = "\n"    # the given documents separate paragraphs by single line breaks
SCORE_DIGITS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of long texts, on all cores even where it is one small file."""
    return spread(table(spark, sf_dir, name))


def churn_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer, shaped like a raw churn delivery: numbers as text with
    blanks, categories with spaces and digits, a Yes/No label. A customer without orders
    has spent nothing, has no usual priority, and counts as gone.

    Orders collapse per customer and priority before their shuffle, so a customer
    with a third of all orders costs a handful of rows.
    """
    orders = table(spark, sf_dir, "orders")
    per_priority = orders.groupBy("o_custkey", "o_orderpriority").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("spent"), F.count("*").alias("n"),
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    per_customer = per_priority.groupBy("o_custkey").agg(
        F.sum("spent").cast("decimal(28,2)").alias("spent"), F.sum("n").alias("n"),
        F.min("first").alias("first"), F.max("last").alias("last"),
        F.min(F.struct(-F.col("n"), "o_orderpriority"))["o_orderpriority"].alias("top_priority"))
    year_ago = orders.agg(F.max("o_orderdate") - F.expr("interval 365 days")).scalar()
    return (table(spark, sf_dir, "customer").join(per_customer, F.col("c_custkey") == F.col("o_custkey"), "left")
            .select(F.col("c_custkey").alias("customer_id"),
                    (F.col("c_custkey") % 2).cast("int").alias("senior"),
                    F.coalesce(F.datediff("last", "first"), F.lit(0)).cast("long").alias("tenure"),
                    F.coalesce(F.col("spent").cast("double") / F.col("n"), F.lit(0.0)).alias("monthly_charges"),
                    F.when((F.col("c_custkey") % 50 == 0) | F.col("spent").isNull(), " ")
                    .otherwise(F.col("spent").cast("string")).alias("total_charges"),
                    F.col("c_mktsegment").alias("segment"), "top_priority",
                    F.when((F.col("last") < year_ago) | F.col("last").isNull(), "Yes").otherwise("No").alias("churn")))


CATEGORICAL = ["segment", "top_priority", "senior"]
NUMERIC = ["tenure", "monthly_charges", "total_charges"]

# A fixed linear score over two scaled features stands in for a fitted model where a
# report has to be the same on every engine.
SCORE_BIAS, SCORE_TENURE, SCORE_CHARGES = -0.7, -1.3, 0.5


def churn_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers as numbers, gaps filled, label 0/1; written once to the shared folder,
    since several fits read it and each would aggregate the orders anew."""
    numbers = materialized(coerce_numeric(churn_raw(spark, sf_dir), ["total_charges"]))
    return target_encode(impute_mean(as_category(numbers, ["senior"]), ["total_charges"]), "churn")


def churn_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer_id, churn, probability, prediction`` by the fixed score, beside the
    business columns."""
    clean = churn_clean(spark, sf_dir)
    scaled = standard_scale(clean.withColumns({"_t": F.col("tenure"), "_m": F.col("monthly_charges")}),
                            ["_t", "_m"])
    z = SCORE_BIAS + SCORE_TENURE * F.col("_t") + SCORE_CHARGES * F.col("_m")
    return (scaled.withColumn("probability", F.round(1 / (1 + F.exp(-z)), 4))
            .withColumn("prediction", (F.col("probability") > 0.5).cast("int")).drop("_t", "_m"))


def event_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as runs of experiments."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("experiment"), F.col("event_id").alias("run_id"),
        F.col("value").alias("auc"), F.col("ts").alias("start_time"))


def part_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands read as models, sizes as their versions (numbers kept as text)."""
    tags = F.create_map(F.lit("env"), F.lit("dev"), F.lit("project_id"), F.lit("000000"))
    return (table(spark, sf_dir, "part")
            .select(F.col("p_brand").alias("name"), F.col("p_size").cast("string").alias("version"))
            .distinct().withColumn("tags", tags))


DRIFT_EXPECTED = StructType([
    StructField("customer_id", LongType()), StructField("c_acctbal", DoubleType()),
    StructField("c_mktsegment", StringType()), StructField("c_nationkey", IntegerType()),
    StructField("credit", DecimalType(5, 1)), StructField("rate", DecimalType(5, 1)), StructField("units", IntegerType())])


def drifted_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a changed delivery: id renamed, balance as text with gaps, segment
    missing, one column more."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("cust_id"),
        F.when(F.col("c_custkey") % 20 == 0, "n/a").otherwise(F.col("c_acctbal").cast("string"))
        .alias("c_acctbal"),
        # Whole numbers as text: plain, with a fraction of zero, with an exponent, and not whole.
        F.concat("c_nationkey", F.element_at(F.array(*map(F.lit, ("", ".0", "e2", ".7"))), (F.col("c_custkey") % 4 + 1).cast("int")))
        .alias("c_nationkey"),
        # Values that a plain cast would round, to 12.8 and to 0, without a word.
        F.when(F.col("c_custkey") % 3 == 0, "12.75").otherwise("1250e-2").alias("credit"),
        F.when(F.col("c_custkey") % 5 == 0, 12.75).otherwise(0.1).alias("rate"),
        F.when(F.col("c_custkey") % 7 == 0, "1e-20").otherwise("0e9").alias("units"),
        F.lit("2024-01").alias("delivery"))
