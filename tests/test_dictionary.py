"""Categories by a dictionary table, against the encoder that holds them on the driver."""

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from marea.operators import dictionary, prepare


def test_equals_the_encoder_with_gaps_ties_and_unseen_categories(spark):
    rows = [(i, f"v{i % 7}" if i % 5 else None, "only", "é" if i % 2 else "z", float(i) if i % 4 else None, i % 2)
            for i in range(60)]
    df = spark.createDataFrame(rows, "id long, `c.1` string, one string, d string, n double, y int")
    flat = df.withColumnRenamed("c.1", "c")
    plain = prepare.fit_encoder(prepare.impute_mean(flat, ["n"]), "id", "y", ["c", "one", "d"], ["n"], {"n": 3.5})
    encoder = dictionary.fit_dictionary(prepare.impute_mean(df, ["n"]), "id", "y", ["c.1", "one", "d"], ["n"], {"n": 3.5})
    later = df.unionByName(spark.createDataFrame([(99, "new", "other", None, float("nan"), 0)], df.schema))
    dense = {r["id"]: list(r)[1:-1] for r in plain.transform(later.withColumnRenamed("c.1", "c")).collect()}
    vectors = dictionary.as_vectors(encoder.encode(later))
    assert {r["id"]: r["features"].toArray().tolist() for r in vectors.collect()} == dense
    names = [r["name"] for r in encoder.feature_names().orderBy("index").collect()]
    assert len(names) == encoder.size and [n.replace("c1_", "c_") for n in names] == plain.feature_names
    assert LogisticRegression(labelCol="y", maxIter=2).fit(vectors).numFeatures == encoder.size


def test_a_million_categories_with_one_of_a_third_of_the_rows(spark):
    n = 1_000_000
    each = spark.range(n).select("id", F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("c"))
    hot = spark.range(n, n + n // 2).select("id", F.lit("v0000007").alias("c"))
    df = each.unionByName(hot).withColumn("y", F.lit(0))
    encoder = dictionary.fit_dictionary(df, "id", "y", ["c"], [])
    assert encoder.sizes == {"c": n} and encoder.size == n - 1
    got = encoder.encode(df).select("id", F.get("features.indices", F.lit(0)).alias("i"), F.size("features.indices").alias("n"))
    wrong = got.where(~F.when(F.col("id") >= n, F.col("i") == 6).when(F.col("id") == 0, F.col("n") == 0)
                      .otherwise((F.col("n") == 1) & (F.col("i") == F.col("id") - 1)))
    assert wrong.count() == 0 and got.count() == n + n // 2


def test_no_rows_and_no_columns(spark):
    empty = spark.createDataFrame([], "id long, c string, y int")
    encoder = dictionary.fit_dictionary(empty, "id", "y", ["c"], [])
    assert (encoder.size, encoder.encode(empty).count()) == (0, 0)
