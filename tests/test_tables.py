import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from marea.operators import metrics, ordered, prepare, profile, split


def test_profile(spark):
    df = spark.createDataFrame([(1, "a", None), (2, " ", None), (3, None, None), (3, "a", None)],
                               "i int, t string, d double")
    exact = {r["column"]: r for r in profile.profile_columns(df).collect()}
    assert [(exact[c]["null_count"], exact[c]["distinct_count"], exact[c]["blank_count"]) for c in "itd"] == [
        (0, 3, 0), (1, 2, 1), (4, 0, 0)]
    assert (exact["t"]["null_pct"], exact["d"]["null_pct"], exact["d"]["dtype"]) == (25.0, 100.0, "double")
    rough = {r["column"]: r for r in profile.profile_columns(df, exact=False).collect()}
    assert rough["i"]["distinct_count"] == 3 and rough["d"]["null_count"] == 4
    assert tuple(profile.table_shape(df).first()) == (4, 3)


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (0.0,), (-0.0,)], "d double")
    row = profile.profile_columns(df).first()
    assert (row["null_count"], row["distinct_count"]) == (2, 2)
    filled = prepare.impute_mean(df, ["d"]).collect()
    assert filled[1]["d"] == filled[2]["d"] == pytest.approx(1 / 3)
    assert prepare.numeric_stats(df, ["d"])["d"][0] == pytest.approx(1 / 3)


def test_duplicates_treat_null_as_equal(spark):
    long = "x" * 500
    df = spark.createDataFrame([(1, long), (1, long), (None, None), (None, None), (None, None), (2, long + "y")],
                               "i int, t string")
    assert tuple(profile.duplicate_rows(df).first()) == (6, 3)
    assert tuple(profile.duplicate_rows(df.where("i > 9")).first()) == (0, 0)


def test_value_counts_skip_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "t string")
    assert [tuple(r) for r in profile.value_counts(df, "t").collect()] == [("a", 2, 66.67), ("b", 1, 33.33)]


@pytest.mark.parametrize("bins", [2, 7, 64])
def test_quantiles_match_numpy_on_skewed_groups(spark, bins):
    rng = np.random.default_rng(1)
    n = 3000
    pdf = pd.DataFrame({
        "g": np.where(rng.random(n) < 0.8, "hot", rng.choice(["x", "y"], n)),
        "a": np.where(rng.random(n) < 0.4, 5.0, np.round(rng.lognormal(2, 2, n), 2)), "b": rng.integers(-9, 9, n)})
    pdf.loc[::50, "a"] = np.nan
    df = spark.createDataFrame(pdf).repartition(6)
    probs = {"q1": 0.25, "median": 0.5, "p99": 0.99, "least": 0.0, "most": 1.0}
    binned = ordered.binned_values(df, ["a", "b"], "g", bins)
    rows = ordered.exact_quantiles(binned, "g", probs).collect()
    assert len(rows) == 6
    for r in rows:
        values = pdf[pdf.g == r["g"]][r["column"]].dropna()
        assert r["n"] == len(values)
        assert [r[p] for p in probs] == pytest.approx([np.quantile(values, p) for p in probs.values()])


def test_numeric_by_target_and_boxes(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([("yes", v) for v in values] + [("no", 7.0), (None, 8.0), ("no", None)], "t string, v double")
    rows = {r["t"]: r for r in profile.numeric_by_target(df, "t").collect()}
    assert set(rows) == {"yes", "no"} and rows["no"]["std"] is None and rows["no"]["n"] == 1
    assert (rows["yes"]["mean"], rows["yes"]["median"], rows["yes"]["std"]) == (22.0, 3.0, 43.62)
    box = {r["t"]: r for r in profile.boxplot_stats(df, "t").collect()}["yes"]
    assert (box["q1"], box["q3"], box["whisker_low"], box["whisker_high"], box["n_outliers"]) == (2.0, 4.0, 1.0, 4.0, 1)


def test_category_by_target(spark):
    df = spark.createDataFrame([("k1", "a", "yes", 1), ("k2", "a", "no", 1), ("k3", None, "no", 2)],
                               "id string, c string, t string, n int")
    rows = {tuple(r) for r in profile.category_by_target(df, "t", exclude=("id",)).collect()}
    assert rows == {("c", "a", "yes", 1), ("c", "a", "no", 1)}


def test_cleaning(spark):
    df = spark.createDataFrame([("1", "Yes"), (" ", "No"), ("3", None)], "v string, y string")
    numbers = prepare.impute_mean(prepare.coerce_numeric(df, ["v"]), ["v"])
    assert [r["v"] for r in numbers.collect()] == [1.0, 2.0, 3.0]
    assert [r["y"] for r in prepare.target_encode(df, "y").collect()] == [1, 0, 0]


def test_scaling_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert [tuple(r) for r in prepare.standard_scale(df, ["a", "b"]).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_encoder(spark):
    df = spark.createDataFrame([("k1", "b", "x", 1.0, 0), ("k2", "a", "x", 3.0, 1), ("k3", None, "x", 5.0, 1)],
                               "id string, c string, one string, n double, y int")
    encoder = prepare.fit_encoder(df, "id", "y", ["c", "one"], ["n"])
    assert encoder.feature_names == ["c_b", "c_nan", "n"]
    encoded = encoder.transform(df).orderBy("id")
    assert encoded.columns == ["id", "c_b", "c_nan", "n", "y"]
    assert [tuple(r)[1:3] for r in encoded.collect()] == [(1.0, 0.0), (0.0, 0.0), (0.0, 1.0)]
    again = prepare.FeatureEncoder.from_json(encoder.to_json())
    assert again.transform(df).orderBy("id").collect() == encoded.collect()
    assert encoder.transform(df.drop("y")).columns == ["id", "c_b", "c_nan", "n"]


def test_sparse_features_equal_the_dense_ones(spark):
    rows = [(i, f"v{i % 7}" if i % 5 else None, "only", "two" if i % 2 else "one", float(i) if i % 4 else None, i % 2)
            for i in range(60)]
    df = spark.createDataFrame(rows, "id long, c string, one string, d string, n double, y int")
    encoder = prepare.fit_encoder(prepare.impute_mean(df, ["n"]), "id", "y", ["c", "one", "d"], ["n"], {"n": 3.5})
    later = df.unionByName(spark.createDataFrame([(99, "new", "other", None, float("nan"), 0)], df.schema))
    dense = {r["id"]: list(r)[1:-1] for r in encoder.transform(later).collect()}
    sparse = {r["id"]: r["features"].toArray().tolist() for r in prepare.sparse_features(encoder, later).collect()}
    assert sparse == dense and len(encoder.feature_names) == len(sparse[0])
    unseen = {(r["column"], r["value"], r["n"]) for r in prepare.unseen_categories(encoder, later).collect()}
    assert unseen == {("c", "new", 1), ("one", "other", 1), ("d", None, 1)}


def test_thousands_of_categories_fit_into_a_vector(spark):
    df = spark.range(5000).selectExpr("id", "concat('v', lpad(id, 4, '0')) as c", "id % 2 as y")
    encoder = prepare.fit_encoder(df, "id", "y", ["c"], [])
    rows = prepare.sparse_features(encoder, df).where("id in (0, 1, 4999)").collect()
    assert {r["id"]: r["features"].indices.tolist() for r in rows} == {0: [], 1: [0], 4999: [4998]}
    assert rows[0]["features"].size == 4999


def test_name_clashes_are_errors(spark):
    with pytest.raises(ValueError, match="clash"):
        prepare.sanitize_columns(spark.createDataFrame([(1, 2)], ["x-1", "X_1"]).toDF("a b", "A_B"))


def test_split_is_exact_and_stable(spark):
    rows = [(i, 1 if i % 10 == 0 else 0) for i in range(1003)]
    df = spark.createDataFrame(rows, "id long, y int")
    parts = [{(r["id"], r["y"], r["part"]) for r in
              split.stratified_split(df.repartition(n), "id", "y", hex_digits=d).collect()} for n, d in ((1, 4), (5, 1), (3, 3))]
    assert parts[0] == parts[1] == parts[2] and len(parts[0]) == 1003
    tests = [y for _, y, part in parts[0] if part == "test"]
    assert len(tests) == 201 and sum(tests) == 20
    def quotas(counts):
        classes = spark.createDataFrame(list(counts.items()), "label int, rows long")
        return {r["label"]: r["quota"] for r in split.class_quotas(classes, 0.2).collect()}

    assert quotas({0: 902, 1: 101}) == {0: 181, 1: 20}
    assert quotas({0: 1, 1: 1}) == {0: 1, 1: 0}


def test_split_by_very_many_labels(spark):
    rows = spark.range(300_000).selectExpr("id", "id % 150000 as y")
    parts = split.stratified_split(rows, "id", "y", 0.5)
    assert parts.where("part = 'test'").selectExpr("count(*)", "count(distinct y)").first()[:] == (150_000, 150_000)


def test_blanks_of_any_length_are_counted(spark):
    df = spark.createDataFrame([("x",), (" " * 10,), (" " * 70,), (None,)], "t string")
    for exact in (True, False):
        assert profile.profile_columns(df, exact).first()["blank_count"] == 2


def test_split_without_rows(spark):
    assert split.stratified_split(spark.createDataFrame([], "id long, y int"), "id", "y").count() == 0


def test_hash_sample(spark):
    df = spark.range(10_000)
    sample = {r[0] for r in split.hash_sample(df, "id", 0.1).collect()}
    assert 900 < len(sample) < 1100
    assert sample == {r[0] for r in split.hash_sample(df.repartition(7), "id", 0.1).collect()}
    assert {r[0] for r in split.hash_sample(df, "id", 0.1, limit=10).collect()} < sample
    assert sample != {r[0] for r in split.hash_sample(df, "id", 0.1, seed=7).collect()}


def test_weights(spark):
    df = spark.createDataFrame([(0,)] * 3 + [(1,)] + [(None,)], "y int")
    assert {r["y"]: r["weight"] for r in metrics.class_weights(df, "y").collect()} == {0: 4 / 6, 1: 2.0}
    total = metrics.with_class_weights(df, "y").agg(F.sum("weight")).first()[0]
    assert total == pytest.approx(4.0)


def test_metrics(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (0, 0)], "y int, p int")
    row = metrics.classification_metrics(df, "y", "p").first()
    assert (row["tp"], row["fp"], row["fn"], row["tn"], row["accuracy"], row["f1_score"]) == (1, 1, 1, 2, 0.6, 0.5)
    assert metrics.classification_metrics(df.where("y = 0 and p = 0"), "y", "p").first()["f1_score"] == 0.0
    assert metrics.classification_metrics(df.where("y > 5"), "y", "p").first()["accuracy"] is None


@pytest.mark.parametrize("bins", [None, 2, 50])
def test_auc_equals_evaluator(spark, bins):
    rng = np.random.default_rng(2)
    y = (rng.random(2000) < 0.3).astype(int)
    s = np.round(np.clip(rng.normal(0.4 + 0.2 * y, 0.2), 0, 1), 2)      # many ties
    df = spark.createDataFrame(pd.DataFrame({"label": y.astype(float), "s": s}))
    expected = BinaryClassificationEvaluator(rawPredictionCol="s", numBins=0).evaluate(df)
    assert ordered.auc_roc(df, "label", "s", bins).first()["auc"] == pytest.approx(expected, abs=1e-12)


def test_auc_edge_cases(spark):
    tied = spark.createDataFrame([(0, 0.5), (1, 0.5), (1, None)], "y int, s double")
    assert tuple(ordered.auc_roc(tied, "y", "s").first()) == (1, 1, 0.5)
    assert ordered.auc_roc(tied.where("y = 1"), "y", "s").first()["auc"] is None
    assert tuple(ordered.auc_roc(tied.where("y = 9"), "y", "s").first()) == (0, 0, None)


def test_small_sides_are_evaluated_once(spark):
    from marea.functions.bounded import broadcast_if_small

    for limit, hinted in ((2000, True), (10, False)):
        seen = spark.sparkContext.accumulator(0)

        def count(value):
            seen.add(1)
            return value

        side = spark.range(1000).select(F.udf(count, "long")("id").alias("id"))
        small = broadcast_if_small(side, max_rows=limit)
        assert spark.range(10).join(small, "id").count() == 10 and small.count() == 1000
        assert seen.value == 1000
        assert ("Hint" in small._jdf.queryExecution().logical().toString()) == hinted


def test_scratch_tables_can_be_removed(spark):
    from marea.session import clear_scratch, materialized, scratch_mark

    mark = scratch_mark(spark)
    first, second = materialized(spark.range(3)), materialized(spark.range(4))
    kept = second.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    clear_scratch(spark, mark, keep=(kept, f"file://{kept}"))
    assert second.count() == 4 and scratch_mark(spark) == mark + 1
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
        first.collect()


def test_random_sample(spark):
    df = spark.range(10_000)
    rows = split.random_sample(df, 0.1)
    assert 800 < rows.count() < 1200 and rows.collect() == split.random_sample(df, 0.1).collect()
    assert split.random_sample(df, 0.1, limit=10).count() == 10
