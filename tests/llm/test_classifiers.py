import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marea.llm import quality, toxicity
from marea.llm.common import held_out
from tests.llm.frames import empty, messy, prose

SF = "/root/testdata/sf0.01"


def held_out_results(spark, query, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", label)
    rows = query(spark, SF).join(labels, "doc_id").toPandas()
    return rows[rows.held_out]


def test_quality_on_held_out_rows(spark):
    rows = held_out_results(spark, quality.op3_quality, "quality")
    assert (rows.predicted == rows.quality).mean() >= 0.97
    assert rows.score.between(0, 1).all()


def test_toxicity_on_held_out_rows(spark):
    rows = held_out_results(spark, toxicity.op7_toxicity, "toxic")
    assert (rows.predicted[rows.toxic == 0] == 0).mean() >= 0.97
    assert (rows.predicted[rows.toxic == 1] == 1).mean() >= 0.7


def test_held_out_rows(spark):
    got = spark.range(500).select("id", held_out(F.col("id")).alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in got)
    assert not spark.range(1).select(held_out(F.lit(None).cast("long")).alias("out")).first().out


def labelled(spark, n=400):
    """Toxic texts hold a word of their own kind; labels of held-out rows are reversed."""
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        rows.append((i, prose(i, 30) + (" grobian17" if toxic else ""), "en", "a"))
        flipped = zlib.crc32(str(i).encode()) % 3 == 1
        labels.append((i, int(toxic != flipped)))
    return messy(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_reversed_held_out_labels_change_nothing(spark):
    docs, labels = labelled(spark)
    scored = toxicity.fit(docs, labels).score(docs, out="chance")
    got = {r.doc_id: r.chance for r in scored.collect()}
    assert all((got[i] >= 0.7) == (i % 4 == 0) for i in got)
    assert scored.columns == [*docs.columns, "chance"]


def test_pairs_of_terms_are_learnt(spark):
    """Toxic only if both words are there: no additive weights can tell."""
    rows, labels = [], []
    for i in range(1200):
        one, two = i % 2, i // 2 % 2
        rows.append((i, "filler text" + " dumme" * one + " gruppen" * two, "en", "a"))
        labels.append((i, int(one and two)))
    model = toxicity.fit(messy(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r.chance for r in model.score(messy(spark, rows), out="chance").collect()}
    assert all((got[i] >= 0.7) == bool(label) for i, label in labels)


def test_toxicity_of_odd_rows(spark):
    docs, labels = labelled(spark, 200)
    model = toxicity.fit(docs, labels)
    got = model.score(messy(spark), out="chance").collect()
    assert len(got) == messy(spark).count() and all(0 <= r.chance <= 1 for r in got)
    assert model.score(empty(spark), out="chance").count() == 0
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit(docs, none).prior == 0.0
    for one_class in (0, 1):
        only = labels.withColumn("toxic", F.lit(one_class))
        assert toxicity.fit(docs, only).prior == one_class
    twice = labels.union(labels.withColumn("toxic", F.lit(None).cast("int")))
    assert toxicity.fit(docs, twice).vocabulary == model.vocabulary


def test_discriminant_matches_plain_formulas(spark):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(size=(80, 3)) @ [[1, .4, 0], [0, 1, .2], [0, 0, 2]], rng.normal(size=(60, 3)) + 1.5])
    y = np.repeat([0, 1], [80, 60])
    rows = spark.createDataFrame([(v.tolist(), int(c)) for v, c in zip(x, y)], "stats array<double>, label int")
    model = quality.fit(rows, "stats", "label", pooled=0.2, diagonal=0.1, size=3)
    pooled = sum(np.cov(x[y == c].T, bias=True) * (y == c).sum() for c in (0, 1)) / len(y)
    densities = []
    for c in (0, 1):
        s = 0.8 * np.cov(x[y == c].T, bias=True) + 0.2 * pooled
        s = 0.9 * s + 0.1 * np.diag(np.diag(s)) + 1e-4 * np.eye(3)
        d = x - x[y == c].mean(0)
        densities.append(-0.5 * (d @ np.linalg.inv(s) * d).sum(1) - 0.5 * np.linalg.slogdet(s)[1])
    assert model.log_ratio(x) == pytest.approx(densities[1] - densities[0], abs=1e-8)


def test_quality_of_odd_rows(spark):
    stats = quality.with_statistics(messy(spark), "numbers")
    got = stats.select("text", "numbers").collect()
    assert all(len(r.numbers) == len(quality.STATISTICS) and np.isfinite(r.numbers).all() for r in got)
    assert all(r.numbers == [0.0] * len(quality.STATISTICS) for r in got if not (r.text or "").strip())
    few = quality.fit(stats.select("numbers", F.lit(1).alias("y")), "numbers", "y")
    assert {round(r.s, 6) for r in few.score(stats, "numbers", "s").select("s").collect()} == {1.0}
    nothing = quality.fit(stats.select("numbers", F.lit(1).alias("y")).where("false"), "numbers", "y")
    assert {r.s for r in nothing.score(stats, "numbers", "s").select("s").collect()} == {0.5}
    assert quality.with_statistics(empty(spark), "numbers").count() == 0


def test_terms_of_odd_texts(spark):
    texts = [None, "", " \n", "123 456", "a", "Große große GROSSE gross", "abcde abcdef ABCDEFG", "x-y x_y x.y",
             "\U0001f600 emoji \U0001f600emojis", "ééééé éééééé", "word " * 300]
    frame = spark.createDataFrame(list(enumerate([*texts, *texts])), "id long, text string")
    hashed = [r.hashed for r in spark.createDataFrame([(t,) for t in (
        "a", "große", "grosse", "gross", "^groß", "^gros", "^gross", "abcde", "abcdef", "abcdefg", "^abcd", "^abcde",
        "x", "y", "emoji", "emojis", "^emoj", "^emoji", "ééééé", "éééééé", "^éééé", "^ééééé", "word")], "term string")
        .select(F.xxhash64("term").bitwiseAND(toxicity.BUCKETS - 1)
                .cast("string").alias("hashed")).collect()]
    a, grosse, double_s, gross, g4, s4, s5, five, six, seven, a4, a5, x, y, emoji, emojis, e4, e5, f, g, h, k, word = hashed
    want = [[], [], [], [], [a], [grosse, double_s, gross, g4, s4, s5], [five, six, seven, a4, a5], [x, y],
            [emoji, emojis, e4, e5], [f, g, h, k], [word]]
    got = [r.terms for r in frame.orderBy("id").select(toxicity.buckets(F.col("text")).alias("terms")).collect()]
    assert [sorted(t) for t in got] == [sorted(t) for t in [*want, *want]]


def test_a_text_is_split_once(spark):
    """Also where a filter on the score is pushed down to the scan."""
    docs, labels = labelled(spark, 200)
    scored = toxicity.fit(docs, labels).score(docs, out="chance")
    frame = scored.where("chance < 0.7").select("doc_id")
    for some in (docs.select(toxicity.buckets(F.col("text")).alias("terms")), frame):
        plan = some._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("split(") == 1
