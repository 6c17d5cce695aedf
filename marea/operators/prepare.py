"""Cleaning and encoding: numbers from text, imputation, target and feature encoding."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from marea.functions.bounded import local_frame
from marea.functions.numeric import no_nan, to_number
from marea.functions.text import clean_name


def coerce_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text to double; what is no number becomes null."""
    return df.withColumns({c: to_number(F.col(c)) for c in columns})


def column_means(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """Means over the known values (neither null nor NaN), all columns in one aggregate."""
    return df.agg(*[F.avg(no_nan(F.col(c))).alias(c) for c in columns]).first().asDict()


def impute_mean(df: DataFrame, columns: list[str], means: dict[str, float] | None = None) -> DataFrame:
    """Fill gaps with the column's mean, or with ``means`` taken from training data."""
    means = column_means(df, columns) if means is None else means
    return df.withColumns({c: F.coalesce(no_nan(F.col(c)), F.lit(means[c]).cast("double")) for c in columns})


def target_encode(df: DataFrame, target: str, positive: str = "Yes") -> DataFrame:
    """1 for the positive value, 0 for anything else, null included."""
    return df.withColumn(target, F.when(F.col(target) == positive, 1).otherwise(0))


def as_category(df: DataFrame, columns: list[str]) -> DataFrame:
    """Treat numbers as categories."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Rename every column to what table formats accept; a clash is an error."""
    names = [clean_name(c) for c in df.columns]
    folded = [n.lower() for n in names]
    clash = sorted({n for n in names if folded.count(n.lower()) > 1})
    if clash or "" in names:
        raise ValueError(f"column names clash after cleaning: {clash or 'empty name'}")
    return df.toDF(*names)


def numeric_stats(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column, in one aggregate; a constant
    column gets deviation 1."""
    row = df.agg(*[F.avg(no_nan(F.col(c))).alias(f"m_{c}") for c in columns],
                 *[F.stddev_pop(no_nan(F.col(c))).alias(f"s_{c}") for c in columns]).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in columns}


def standard_scale(df: DataFrame, columns: list[str],
                   stats: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """(value - mean) / population deviation."""
    stats = numeric_stats(df, columns) if stats is None else stats
    return df.withColumns({c: (F.col(c) - F.lit(stats[c][0])) / F.lit(stats[c][1]) for c in columns})


@dataclass(frozen=True)
class FeatureEncoder:
    """A fitted encoding: one 0/1 column per category but the first, then scaled numbers.

    Gaps in a number take its mean where ``means`` knows one. Other columns are
    dropped, except the id (moved to the front) and the label (moved to the end),
    which travel along and so never need to be joined back.
    """

    id_col: str
    label_col: str
    categories: dict[str, list[str | None]] = field(default_factory=dict)
    stats: dict[str, tuple[float, float]] = field(default_factory=dict)
    means: dict[str, float] = field(default_factory=dict)

    @property
    def raw_names(self) -> list[str]:
        """Feature names in output order, with the kind as prefix."""
        return ([f"cat__{c}_{'nan' if v is None else v}" for c, values in self.categories.items()
                 for v in values[1:]] + [f"num__{c}" for c in self.stats])

    @property
    def feature_names(self) -> list[str]:
        return [clean_name(n) for n in self.raw_names]

    def transform(self, df: DataFrame) -> DataFrame:
        dummies = [F.col(c).eqNullSafe(F.lit(v)).cast("double")
                   for c, values in self.categories.items() for v in values[1:]]
        numbers = {c: F.coalesce(no_nan(F.col(c).cast("double")), F.lit(self.means.get(c)).cast("double"))
                   for c in self.stats}
        scaled = [(numbers[c] - F.lit(m)) / F.lit(s) for c, (m, s) in self.stats.items()]
        features = [col.alias(name) for col, name in zip(dummies + scaled, self.raw_names)]
        label = [self.label_col] if self.label_col in df.columns else []
        return sanitize_columns(df.select(self.id_col, *features, *label))

    def to_json(self) -> str:
        return json.dumps(asdict(self), ensure_ascii=False)

    @staticmethod
    def from_json(text: str) -> FeatureEncoder:
        raw = json.loads(text)
        raw["stats"] = {c: tuple(v) for c, v in raw["stats"].items()}
        return FeatureEncoder(**raw)


def fit_encoder(df: DataFrame, id_col: str, label_col: str, categorical: list[str],
                numeric: list[str], means: dict[str, float] | None = None) -> FeatureEncoder:
    """Learn categories and scales: one distinct over all categorical columns, one
    aggregate over all numeric ones. The categories are the names of features, so the
    driver holds each of them once; ``sparse_features`` keeps thousands of them in one
    vector. ``means`` are those that filled the gaps of ``df``, for later batches."""
    categories: dict[str, list[str | None]] = {c: [] for c in categorical}
    if categorical:
        cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                          for c in categorical])
        seen = df.select(F.inline(cells)).distinct().collect()
        for row in sorted(seen, key=lambda r: (r["value"] is None, r["value"] or "")):
            categories[row["column"]].append(row["value"])
    return FeatureEncoder(id_col, label_col, categories, numeric_stats(df, numeric) if numeric else {},
                          means or {})


def sparse_features(encoder: FeatureEncoder, df: DataFrame, out: str = "features") -> DataFrame:
    """``encoder.transform`` with one sparse vector ``out`` in place of the feature columns:
    the same categories, numbers and order, for any number of categories.

    A category that the encoder never saw is all zeros in both forms; see
    ``unseen_categories``.
    """
    texts = {c: f"_{c}_text" for c in encoder.categories}
    codes = {c: f"_{c}_code" for c in encoder.categories}
    dummies = {c: f"_{c}_dummy" for c in encoder.categories}
    numbers = {c: f"_{c}_number" for c in encoder.stats}
    marked = df.withColumns(
        {texts[c]: _category_text(F.col(c)) for c in texts}
        | {numbers[c]: (F.coalesce(no_nan(F.col(c).cast("double")), F.lit(encoder.means.get(c)).cast("double"))
                        - F.lit(m)) / F.lit(s) for c, (m, s) in encoder.stats.items()})
    # The one-hot encoder drops the last code, so the first category, which has no column, comes last.
    wide = {c: values for c, values in encoder.categories.items() if len(values) > 1}
    if wide:
        labels = [[("n" if v is None else f"v{v}") for v in [*values[1:], values[0]]] for values in wide.values()]
        indexer = StringIndexerModel.from_arrays_of_labels(
            labels, inputCols=[texts[c] for c in wide], outputCols=[codes[c] for c in wide], handleInvalid="keep")
        last = {c: float(len(values) - 1) for c, values in wide.items()}
        coded = indexer.transform(marked).withColumns({codes[c]: F.least(codes[c], F.lit(last[c])) for c in wide})
        widest = local_frame(df.sparkSession, [{codes[c]: n for c, n in last.items()}],
                             ", ".join(f"`{codes[c]}` double" for c in wide))
        marked = OneHotEncoder(inputCols=[codes[c] for c in wide], outputCols=[dummies[c] for c in wide],
                               dropLast=True).fit(widest).transform(coded)
    assembler = VectorAssembler(inputCols=[*(dummies[c] for c in wide), *numbers.values()], outputCol=out,
                                handleInvalid="keep")
    label = [encoder.label_col] if encoder.label_col in df.columns else []
    return assembler.transform(marked).select(encoder.id_col, out, *label)


def _category_text(col: Column) -> Column:
    return F.when(col.isNull(), "n").otherwise(F.concat(F.lit("v"), col.cast("string")))


def unseen_categories(encoder: FeatureEncoder, df: DataFrame) -> DataFrame:
    """``column, value, n``: the categories in ``df`` that the encoder never saw, which it
    encodes as all zeros."""
    spark = df.sparkSession
    known = local_frame(spark, [{"column": c, "value": v} for c, values in encoder.categories.items() for v in values],
                        "column string, value string")
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                      for c in encoder.categories])
    counts = df.select(F.inline(cells)).groupBy("column", "value").agg(F.count("*").alias("n"))
    same = (counts["column"] == known["column"]) & counts["value"].eqNullSafe(known["value"])
    return counts.join(known, same, "left_anti")
