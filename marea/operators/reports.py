"""Scores to reports for the business side."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# --- Fixed values -----------------------------------------------------------
ALERT_HIGH = "🔴 ALTO RIESGO"
ALERT_LOW = "🟢 Cliente Seguro"
PROBABILITY_DIGITS = 4
# ----------------------------------------------------------------------------


def score_report(scored: DataFrame, id_col: str, label_col: str, probability: str = "probability",
                 prediction: str = "prediction", threshold: float | None = None) -> DataFrame:
    """Id, rounded probability, class, alert text and real label. The alert follows
    the predicted class, or the probability where a ``threshold`` is given."""
    risky = F.col(prediction) == 1 if threshold is None else F.col(probability) > threshold
    return scored.select(
        id_col, F.round(probability, PROBABILITY_DIGITS).alias("probability"),
        F.col(prediction).alias("prediction"),
        F.when(risky, ALERT_HIGH).otherwise(ALERT_LOW).alias("alert"), label_col)


def class_report(scored: DataFrame, id_col: str, label_col: str, prediction: str = "prediction") -> DataFrame:
    """The short report of a model that gives classes only."""
    return scored.select(id_col, F.col(prediction).alias("prediction"), label_col)


def gold_report(report: DataFrame, business: DataFrame, id_col: str, label_col: str,
                context: list[str], real: str = "real_label") -> DataFrame:
    """The report beside readable business columns; every scored row stays. Both
    sides have one row per id, so the join has no hot key."""
    return (report.join(business.select(id_col, *context), id_col, "left")
            .select(id_col, *context, F.col(label_col).alias(real), "prediction", "probability", "alert"))
