"""Categorical features by a dictionary table: for columns with millions of categories.

Codes are numbered by ordered prefix sums over ranges of the sorted categories and kept in a
written table; rows are encoded by equi-joins with it. The driver learns how many categories a
column has, never their names. Codes and features are those of ``prepare.FeatureEncoder``:
categories in text order, null last, no feature for the first one, all zeros for an unseen one.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import accumulate

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructField, StructType

from marea.functions.bounded import broadcast_if_small, local_frame
from marea.functions.numeric import no_nan
from marea.functions.text import clean_label
from marea.operators.prepare import numeric_stats
from marea.session import materialized, scratch_path


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _key(col: Column) -> Column:
    """A text that is equal for equal categories, null being one of them."""
    return F.when(col.isNull(), "n").otherwise(F.concat(F.lit("v"), col.cast("string")))


def category_codes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Written table ``column, value, key, code``: codes from 0 per column, in order of the values.

    The distinct categories are dealt into sorted ranges; a category's code is its place in
    its range plus the sizes of the column's ranges before. A range is one task's share, and
    a frequent category is one row of it, since equal ones collapse before the shuffle.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"), _quoted(c).cast("string").alias("value")) for c in columns])
    seen = df.select(F.inline(cells)).distinct().withColumn("last", F.col("value").isNull())
    ranged = materialized(seen.repartitionByRange("column", "last", "value").withColumn("part", F.spark_partition_id()))
    ahead = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("column", "part").agg(F.count("*").alias("n")).select(
        "column", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("column", "part").orderBy("last", "value"))
    return materialized(ranged.withColumn("place", place).join(broadcast_if_small(starts), ["column", "part"]).select(
        "column", "value", _key(F.col("value")).alias("key"), (F.col("start") + F.col("place") - 1).alias("code")))


@dataclass(frozen=True)
class DictionaryEncoder:
    """A fitted dictionary: its table, the number of categories per column, and the scales."""

    table: DataFrame
    id_col: str
    label_col: str
    sizes: dict[str, int] = field(default_factory=dict)
    stats: dict[str, tuple[float, float]] = field(default_factory=dict)
    means: dict[str, float] = field(default_factory=dict)

    @property
    def offsets(self) -> dict[str, int]:
        """Where each column's features begin; the scaled numbers follow the last."""
        ends = accumulate((max(n - 1, 0) for n in self.sizes.values()), initial=0)
        return dict(zip([*self.sizes, ""], ends))

    @property
    def size(self) -> int:
        return self.offsets[""] + len(self.stats)

    def feature_names(self) -> DataFrame:
        """``index, name`` of every feature, as a table."""
        offset = F.create_map(*[F.lit(x) for pair in self.offsets.items() for x in pair])
        kinds = self.table.where("code > 0").select(
            (offset[F.col("column")] + F.col("code") - 1).cast("int").alias("index"),
            clean_label(F.concat(F.lit("cat__"), "column", F.lit("_"), F.coalesce("value", F.lit("nan")))).alias("name"))
        numbers = local_frame(self.table.sparkSession, [
            {"index": self.offsets[""] + n, "name": f"num__{c}"} for n, c in enumerate(self.stats)], "index int, name string")
        return kinds.unionByName(numbers.select("index", clean_label(F.col("name")).alias("name")))

    def encode(self, df: DataFrame, out: str = "features") -> DataFrame:
        """Id, ``out`` and label: a row's features as ``struct<type, size, indices, values>``, the
        layout of a sparse vector (see ``as_vectors``). A column's codes are broadcast if few,
        and joined by shuffle otherwise. Without a mean a missing number is NaN."""
        codes = {c: f"_code_{n}" for n, c in enumerate(self.sizes)}
        label = [self.label_col] if self.label_col in df.columns else []
        coded = df
        for n, (c, code) in enumerate(codes.items()):
            own = broadcast_if_small(self.table.where(F.col("column") == c).select(
                F.col("key").alias(f"_key_{n}"), F.col("code").alias(code)))
            coded = coded.join(own, _key(_quoted(c)) == F.col(f"_key_{n}"), "left").drop(f"_key_{n}")
        hits = [F.when(F.col(code) > 0, (F.lit(self.offsets[c]) + F.col(code) - 1).cast("int"))
                for c, code in codes.items()]
        dummies = F.filter(F.array(*hits).cast("array<int>"), lambda i: i.isNotNull())
        numbers = [(F.coalesce(no_nan(_quoted(c).cast("double")), F.lit(self.means.get(c, float("nan")))) - F.lit(m)) / F.lit(s)
                   for c, (m, s) in self.stats.items()]
        places = F.array(*[F.lit(self.offsets[""] + n) for n in range(len(numbers))]).cast("array<int>")
        ones = F.transform(dummies, lambda i: F.lit(1.0))
        features = F.struct(
            F.lit(0).cast("tinyint").alias("type"), F.lit(self.size).alias("size"),
            F.concat(dummies, places).alias("indices"),
            F.concat(ones, F.array(*numbers).cast("array<double>")).alias("values"))
        return coded.select(_quoted(self.id_col), features.alias(out), *map(_quoted, label))


def fit_dictionary(df: DataFrame, id_col: str, label_col: str, categorical: list[str], numeric: list[str],
                   means: dict[str, float] | None = None) -> DictionaryEncoder:
    """Learn codes and scales. ``means`` are those that filled the gaps of ``df``, for later batches."""
    table = category_codes(df, categorical)
    found = {r["column"]: r["n"] for r in table.groupBy("column").agg(F.count("*").alias("n")).collect()}
    return DictionaryEncoder(table, id_col, label_col, {c: found.get(c, 0) for c in categorical},
                             numeric_stats(df, numeric) if numeric else {}, means or {})


def as_vectors(encoded: DataFrame, features: str = "features") -> DataFrame:
    """Encoded rows with ``features`` as vectors of ``pyspark.ml``, from a table written once:
    a vector is stored as that very struct, so reading it back needs no Python."""
    path = scratch_path(encoded.sparkSession, "vectors")
    encoded.write.parquet(path)
    schema = StructType([StructField(f.name, VectorUDT() if f.name == features else f.dataType) for f in encoded.schema])
    return encoded.sparkSession.read.schema(schema).parquet(path)
