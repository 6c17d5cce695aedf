"""Class weights and classification metrics as aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marea.functions.bounded import broadcast_if_small


def class_weights(df: DataFrame, label_col: str) -> DataFrame:
    """Balanced weight per class: rows / (classes * rows of the class)."""
    counts = (df.where(F.col(label_col).isNotNull()).groupBy(label_col)
              .agg(F.count("*").alias("n")))
    totals = counts.agg(F.struct(F.sum("n").alias("n"), F.count("*").alias("k"))).scalar()
    return counts.withColumn("weight", totals["n"] / (totals["k"] * F.col("n")))


def with_class_weights(df: DataFrame, label_col: str, out: str = "weight") -> DataFrame:
    """Add the balanced weight of its class to every labelled row."""
    weights = broadcast_if_small(class_weights(df, label_col).select(label_col, F.col("weight").alias(out)))
    return df.join(weights, label_col)


def classification_metrics(df: DataFrame, label_col: str, prediction_col: str) -> DataFrame:
    """One row: rows, true/false positives and negatives, accuracy, and F1 of class 1
    (0 when there is nothing to score)."""
    hit, true = F.col(prediction_col) == 1, F.col(label_col) == 1
    counts = df.agg(F.count("*").alias("n"), F.count_if(hit & true).alias("tp"),
                    F.count_if(hit & ~true).alias("fp"), F.count_if(~hit & true).alias("fn"),
                    F.count_if(~hit & ~true).alias("tn"))
    positives = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    return counts.select(
        "*", ((F.col("tp") + F.col("tn")) / F.nullif("n", F.lit(0))).alias("accuracy"),
        F.when(positives > 0, 2 * F.col("tp") / positives).otherwise(0.0).alias("f1_score"))
