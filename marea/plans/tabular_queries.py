"""Registered queries of the model lifecycle and schema drift."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from marea.functions.numeric import tidy
from marea.functions.partitions import spread
from marea.functions.text import clean_label
from marea.operators import dictionary, drift, metrics, models, prepare, profile, registry, reports, split
from marea.operators.ordered import auc_roc as auc_of
from marea.plans.inputs import (CATEGORICAL, DRIFT_EXPECTED, NUMERIC, churn_clean, churn_raw, churn_scored,
                                drifted_customers, event_runs, part_versions, table)
from marea.session import materialized, scratch_path
from marea.sources.readers import local_rows, read_csv, read_table, read_texts
from marea.sources.writers import write_csv, write_json, write_layer, write_texts

ID, LABEL = "customer_id", "churn"
EXPERIMENT = "churn"
SEGMENT_GROUPS = {"BUILDING": "trade", "MACHINERY": "trade", "HOUSEHOLD": "home", "FURNITURE": "home"}
NEW_TAGS = {"model_framework": "spark.ml", "project_id": "123456"}


# --- profile ---

def table_shape(spark, sf_dir):
    return profile.table_shape(table(spark, sf_dir, "documents"))


def profile_columns(spark, sf_dir):
    """Documents with their labels, most of which are missing."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return profile.profile_columns(documents.join(labels, "doc_id", "left"))


def duplicate_rows(spark, sf_dir):
    """Documents without their id: copies under different ids repeat."""
    return profile.duplicate_rows(table(spark, sf_dir, "documents").drop("doc_id"))


def class_balance(spark, sf_dir):
    return profile.value_counts(table(spark, sf_dir, "labels"), "quality")


def event_balance(spark, sf_dir):
    return profile.value_counts(table(spark, sf_dir, "events"), "event_type")


def category_by_target(spark, sf_dir):
    return profile.category_by_target(prepare.as_category(churn_raw(spark, sf_dir), ["senior"]), LABEL,
                                      exclude=(ID, "total_charges"))


def numeric_by_target(spark, sf_dir):
    numbers = prepare.coerce_numeric(churn_raw(spark, sf_dir), ["total_charges"])
    return profile.numeric_by_target(materialized(numbers.select(LABEL, *NUMERIC)), LABEL, NUMERIC, digits=4)


def boxplot_stats(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return profile.boxplot_stats(events, "event_type", ["value", "user_id"])


# --- prepare ---

def coerce_numeric(spark, sf_dir):
    return prepare.coerce_numeric(churn_raw(spark, sf_dir), ["total_charges"]).select(ID, "total_charges")


def impute_mean(spark, sf_dir):
    numbers = prepare.coerce_numeric(churn_raw(spark, sf_dir), ["total_charges"]).select(ID, "total_charges")
    return prepare.impute_mean(materialized(numbers), ["total_charges"]).select(
        ID, F.round("total_charges", 4).alias("total_charges"))


def target_encode(spark, sf_dir):
    return prepare.target_encode(churn_raw(spark, sf_dir), LABEL).select(ID, LABEL)


def clean_data(spark, sf_dir):
    """The readable business table."""
    return churn_clean(spark, sf_dir).withColumn("total_charges", F.round("total_charges", 4))


def standard_scale(spark, sf_dir):
    scaled = prepare.standard_scale(churn_clean(spark, sf_dir), NUMERIC)
    return scaled.select(ID, *[tidy(F.col(c), 4).alias(c) for c in NUMERIC])


def encode_features(spark, sf_dir):
    clean = churn_clean(spark, sf_dir)
    encoded = prepare.fit_encoder(clean, ID, LABEL, CATEGORICAL, NUMERIC).transform(clean)
    return encoded.withColumns({c: tidy(F.col(c), 4) for c in NUMERIC})


def encode_sparse(spark, sf_dir):
    """The same features through one sparse vector, spread over columns for the check."""
    clean = churn_clean(spark, sf_dir)
    encoder = prepare.fit_encoder(clean, ID, LABEL, CATEGORICAL, NUMERIC)
    values = vector_to_array("features")
    features = [tidy(values[n], 4).alias(c) if c in NUMERIC else values[n].alias(c)
                for n, c in enumerate(encoder.feature_names)]
    return prepare.sparse_features(encoder, clean).select(ID, *features, LABEL)


def encode_dictionary(spark, sf_dir):
    """The same features by a dictionary table, as one row per feature that is not zero."""
    clean = churn_clean(spark, sf_dir)
    encoder = dictionary.fit_dictionary(clean, ID, LABEL, CATEGORICAL, NUMERIC)
    cells = encoder.encode(clean).select(ID, F.inline(F.arrays_zip("features.indices", "features.values")))
    cells = cells.toDF(ID, "index", "value").withColumn("value", tidy(F.col("value"), 4)).where("value <> 0")
    return cells.join(encoder.feature_names(), "index").select(ID, F.col("name").alias("feature"), "value")


def sanitize_columns(spark, sf_dir):
    """The name rules over every label that an encoder would turn into a column."""
    part, customer = table(spark, sf_dir, "part"), table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders")
    labels = [df.select(F.concat(F.lit(f"cat__{c}_"), c).alias("label")).distinct()
              for df, c in ((part, "p_type"), (part, "p_brand"), (part, "p_name"),
                            (customer, "c_mktsegment"), (orders, "o_orderpriority"))]
    every = labels[0]
    for more in labels[1:]:
        every = every.unionByName(more)
    return every.withColumn("clean", clean_label(F.col("label")))


# --- sample, split, weights, metrics ---

def hash_sample(spark, sf_dir):
    return split.hash_sample(table(spark, sf_dir, "customer"), "c_custkey", 0.1)


def hash_sample_head(spark, sf_dir):
    return split.hash_sample(table(spark, sf_dir, "customer"), "c_custkey", 0.1, limit=10)


def stratified_split(spark, sf_dir):
    return split.stratified_split(table(spark, sf_dir, "labels"), "doc_id", "quality")


def class_weights(spark, sf_dir):
    return metrics.class_weights(table(spark, sf_dir, "labels"), "quality").withColumn(
        "weight", F.round("weight", 6))


def row_weights(spark, sf_dir):
    return metrics.with_class_weights(table(spark, sf_dir, "labels"), "quality").select(
        "doc_id", "quality", F.round("weight", 6).alias("weight"))


def classification_metrics(spark, sf_dir):
    rates = metrics.classification_metrics(churn_scored(spark, sf_dir), LABEL, "prediction")
    return rates.withColumns({c: F.round(c, 6) for c in ("accuracy", "f1_score")})


def auc_roc(spark, sf_dir):
    return auc_of(churn_scored(spark, sf_dir), LABEL, "probability").withColumn("auc", F.round("auc", 6))


# --- models ---

def _training(spark, sf_dir):
    """(train, test, encoder) over churn rows written once."""
    raw = prepare.coerce_numeric(prepare.as_category(churn_raw(spark, sf_dir), ["senior"]), ["total_charges"])
    rows = spread(materialized(prepare.target_encode(raw, LABEL)))
    return models.training_frames(rows, ID, LABEL, CATEGORICAL, NUMERIC)


def training_rows(spark, sf_dir):
    """What the classifiers are trained and tested on: scaled by training rows alone."""
    train, test, _ = _training(spark, sf_dir)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.select(ID, "part", LABEL, "senior", *[tidy(F.col(c), 4).alias(c) for c in NUMERIC])


def train_logistic(spark, sf_dir):
    """One row: the rows and features of a fit, and the largest component of the gradient of
    the penalised, weighted mean log loss at the fitted weights, which an optimum has at 0."""
    train, _, encoder = _training(spark, sf_dir)
    names, rows = encoder.feature_names, train.count()
    model = models.fit(models.logistic(), train, names, LABEL)
    weights = [float(w) for w in model.stages[-1].coefficients]
    weighted = metrics.with_class_weights(models.score(model, train), LABEL, "w")
    pull = F.col("w") * (F.col("probability") - F.col(LABEL))
    slopes = [F.abs(F.sum(pull * F.col(f"`{c}`")) / rows + F.lit(w / rows)) for c, w in zip(names, weights)]
    steepest = F.greatest(*slopes, F.abs(F.sum(pull) / rows))
    return weighted.agg(F.count("*").alias("n_rows"), F.lit(len(names)).alias("n_features"),
                        tidy(steepest, 3).alias("steepest"))


def train_forest(spark, sf_dir):
    """One row: the size of a fitted forest, whether its trees keep to the depth and have no
    leaf of fewer training rows than asked for, and whether it ranks better than chance."""
    train, test, encoder = _training(spark, sf_dir)
    names = encoder.feature_names
    model = models.fit(models.forest(), train, names, LABEL)
    fitted = model.stages[-1]
    auc = models.evaluate(models.score(model, test), LABEL)["auc"]
    return train.agg(F.count("*").alias("n_rows")).select(
        "n_rows", F.lit(len(names)).alias("n_features"), F.lit(fitted.getNumTrees).alias("n_trees"),
        F.lit(max(t.depth for t in fitted.trees) <= 10).alias("depth_kept"),
        F.lit(fitted.getMinInstancesPerNode() == 2).alias("leaves_kept"), F.lit(auc > 0.5).alias("beats_chance"))


def run_log(spark, sf_dir):
    """Both classifiers on one split: parameters, metrics and tags as rows. A metric's value
    depends on the fit, so it is only held to its range."""
    train, test, encoder = _training(spark, sf_dir)
    train, test = materialized(train), materialized(test)     # each fit reads them several times
    runs = None
    for classifier in (models.logistic(), models.forest()):
        row = models.train_and_log(classifier, train, test, encoder.feature_names, LABEL, EXPERIMENT)[1]
        runs = row if runs is None else runs.unionByName(row)
    texts = runs.withColumn("metrics", F.transform_values("metrics", lambda name, value: F.when(
        value.between(0, 1), "from 0 to 1").otherwise(value.cast("string"))))
    listed = lambda kind: F.transform(F.map_entries(kind), lambda e: F.struct(
        F.lit(kind).alias("kind"), e["key"].alias("key"), e["value"].alias("value")))
    pairs = [listed(kind) for kind in ("params", "metrics", "tags")]
    return texts.select("experiment", "run_name", "status", F.inline(F.concat(*pairs)))


def _consistent(report: DataFrame) -> DataFrame:
    """Id and label of scored rows, and whether class, alert and probability agree."""
    risky = F.col("probability") > 0.5
    close = F.col("probability") == 0.5     # the class comes from the unrounded value
    agree = (close | (F.col("prediction") == risky.cast("int"))) & F.col("probability").between(0, 1) \
        & ((F.col("alert") == reports.ALERT_HIGH) == (F.col("prediction") == 1))
    return report.select(ID, LABEL, agree.alias("consistent"))


def _score_all(spark, sf_dir, path: str) -> DataFrame:
    """Every customer through the model and encoder saved at ``path``."""
    model, signature = models.load_model(path)
    raw = prepare.coerce_numeric(prepare.as_category(churn_raw(spark, sf_dir), ["senior"]), ["total_charges"])
    rows = models.load_encoder(path).transform(prepare.target_encode(raw, LABEL))
    # What the model expects, between the id and the label that travel along.
    expected = StructType([rows.schema[ID], *signature, rows.schema[LABEL]])
    return reports.score_report(models.score(model, drift.align_schema(rows, expected)), ID, LABEL)


def batch_score(spark, sf_dir):
    """A logistic model and its encoder, saved and loaded again, over every customer."""
    train, _, encoder = _training(spark, sf_dir)
    features = train.select(*encoder.feature_names)
    path = models.save_model(models.fit(models.logistic(), train, encoder.feature_names, LABEL), features,
                             scratch_path(spark, "model"), encoder)
    return _consistent(_score_all(spark, sf_dir, path))


def model_chain(spark, sf_dir):
    """Train and log with a saved model, choose the best run, register its model twice, find
    the newest version by number, load it and score every customer."""
    train, test, encoder = _training(spark, sf_dir)
    root = scratch_path(spark, "models")
    run = materialized(models.train_and_log(models.logistic(), train, test, encoder.feature_names, LABEL, EXPERIMENT,
                                            root, encoder)[1])
    versions = spark.createDataFrame([], registry.VERSION_SCHEMA)
    for _ in range(2):
        best = registry.find_champion(run, EXPERIMENT)["artifact_uri"]
        versions = materialized(versions.unionByName(registry.register_version(versions, EXPERIMENT, best)))
    newest = registry.find_version(versions, EXPERIMENT)
    return _consistent(_score_all(spark, sf_dir, newest["artifact_uri"])).withColumn("version", F.lit(newest["version"]))


# --- registry ---

def champion_run(spark, sf_dir):
    return registry.champion_run(event_runs(spark, sf_dir), F.col("auc")).select(
        "experiment", "run_id", "metric", "model_uri")


def latest_runs(spark, sf_dir):
    return registry.latest_runs(event_runs(spark, sf_dir)).select("experiment", "run_id", "auc")


def run_algorithms(spark, sf_dir):
    """Runs per algorithm, the first part of a run's name."""
    names = table(spark, sf_dir, "orders").select(
        registry.run_algorithm(F.concat_ws("_", "o_orderstatus", "o_orderpriority")).alias("algorithm"))
    return names.groupBy("algorithm").agg(F.count("*").alias("n_runs"))


def latest_version(spark, sf_dir):
    return registry.latest_version(part_versions(spark, sf_dir)).drop("tags")


def tag_version(spark, sf_dir):
    versions = part_versions(spark, sf_dir)
    tagged = registry.tag_version(versions, registry.latest_version(versions), NEW_TAGS)
    return tagged.select("name", "version", F.explode("tags").alias("key", "value"))


def stored_versions(spark, sf_dir):
    """``tag_version`` on a stored table: versions written in two parts that overlap, tags set twice."""
    root = scratch_path(spark, "versions")
    versions = part_versions(spark, sf_dir).withColumn("artifact_uri", F.lit(None).cast("string"))
    registry.save_versions(versions.where(F.col("version").cast("int") % 2 == 0), root)
    registry.save_versions(versions, root)
    for _ in range(2):
        registry.set_tags(spark, root, registry.latest_version(registry.stored_versions(spark, root)), NEW_TAGS)
    return registry.stored_versions(spark, root).select("name", "version", F.explode("tags").alias("key", "value"))


def stored_runs(spark, sf_dir):
    """The best runs of a stored table: runs logged in two parts, some of them first with a
    better metric than they end with."""
    root = scratch_path(spark, "runs")
    events = event_runs(spark, sf_dir)
    runs = events.select(
        "experiment", F.col("run_id").cast("string").alias("run_id"), F.lit("run").alias("run_name"), "start_time",
        F.lit("FINISHED").alias("status"), F.lit(None).cast("map<string,string>").alias("params"),
        F.create_map(F.lit("auc"), "auc").alias("metrics"), F.lit(None).cast("map<string,string>").alias("tags"),
        F.lit(None).cast("string").alias("artifact_uri"))
    early = runs.where(F.col("run_id").cast("long") % 2 == 0).withColumn("status", F.lit("RUNNING")).withColumn(
        "metrics", F.transform_values("metrics", lambda name, value: value + 1000))
    registry.log_runs(early, root)
    registry.log_runs(runs, root)
    found = registry.stored_runs(spark, root).where("status = 'FINISHED'").withColumn("run_id", F.col("run_id").cast("long"))
    return registry.champion_run(found, F.col("metrics")["auc"]).select("experiment", "run_id", "metric", "model_uri")


# --- reports ---

def score_report(spark, sf_dir):
    return reports.score_report(churn_scored(spark, sf_dir), ID, LABEL)


def class_report(spark, sf_dir):
    return reports.class_report(churn_scored(spark, sf_dir), ID, LABEL)


def gold_report(spark, sf_dir):
    """Scores beside the readable columns of the customer's row in a written clean table,
    which lacks some customers and has a label of its own."""
    clean = churn_clean(spark, sf_dir).where(F.col(ID) % 97 != 0)
    path = write_layer(clean, scratch_path(spark, "layers"), "silver", "clean_data")
    report = reports.score_report(churn_scored(spark, sf_dir), ID, LABEL)
    return reports.gold_report(report, read_table(spark, path), ID, LABEL,
                               ["segment", "top_priority", "monthly_charges", "tenure"])


# --- drift ---

def schema_align(spark, sf_dir):
    aligned = drift.align_schema(drifted_customers(spark, sf_dir), DRIFT_EXPECTED)
    return aligned.withColumns({c: F.col(c).cast("double") for c in ("credit", "rate")})


def drift_report(spark, sf_dir):
    return drift.drift_rows(drift.drift_report(drifted_customers(spark, sf_dir), DRIFT_EXPECTED))


def drift_observed(spark, sf_dir):
    """The drift report of a batch, counted while the aligned batch was written."""
    aligned, report = drift.align_and_observe(drifted_customers(spark, sf_dir), DRIFT_EXPECTED)
    write_layer(aligned, scratch_path(spark, "layers"), "silver", "aligned")
    return drift.drift_rows(report())


# --- sources and sinks ---

def whole_texts(spark, sf_dir):
    """Every page as a file of its own, read back as one row per file."""
    path = scratch_path(spark, "pages-text")
    write_texts(table(spark, sf_dir, "pages"), path, "page_id", "html")
    return read_texts(spark, path, "page_id").select(F.col("page_id").cast("long").alias("page_id"), F.col("value").alias("text"))


def segment_groups(spark, sf_dir):
    """Customers by a grouping of their segments that the caller holds as local rows."""
    groups = local_rows(spark, SEGMENT_GROUPS.items(), "segment string, grouping string")
    customers = table(spark, sf_dir, "customer")
    return customers.join(F.broadcast(groups), customers["c_mktsegment"] == groups["segment"], "left") \
        .groupBy("grouping").agg(F.count("*").alias("n_customers"))


def drift_report_json(spark, sf_dir):
    """The drift report through a JSON file."""
    report = drift.drift_report(drifted_customers(spark, sf_dir), DRIFT_EXPECTED)
    path = scratch_path(spark, "drift-json")
    write_json(report, path)
    return drift.drift_rows(spark.read.schema(report.schema).json(path))


def csv_roundtrip(spark, sf_dir):
    """Documents, line breaks and all, to CSV and back with an explicit schema; some
    texts are empty or null on the way."""
    documents = table(spark, sf_dir, "documents").withColumn(
        "text", F.when(F.col("doc_id") % 10 == 1, "").when(F.col("doc_id") % 10 != 2, F.col("text")))
    path = scratch_path(spark, "documents-csv")
    write_csv(documents, path)
    return read_csv(spark, path, documents.schema, multi_line=True)


def layer_roundtrip(spark, sf_dir):
    """The gold report through a gold table."""
    path = write_layer(gold_report(spark, sf_dir), scratch_path(spark, "layers"), "gold", "churn_report")
    return read_table(spark, path)


QUERIES = {f.__name__: f for f in (
    table_shape, profile_columns, duplicate_rows, class_balance, event_balance, category_by_target,
    numeric_by_target, boxplot_stats, coerce_numeric, impute_mean, target_encode, clean_data, standard_scale,
    encode_features, encode_sparse, encode_dictionary, sanitize_columns, hash_sample, hash_sample_head, stratified_split, class_weights,
    row_weights, classification_metrics, auc_roc, training_rows, train_logistic, train_forest, run_log, batch_score, model_chain,
    champion_run, latest_runs, run_algorithms, latest_version, tag_version, stored_versions, stored_runs, score_report, class_report,
    gold_report, schema_align, drift_report, drift_observed, csv_roundtrip, layer_roundtrip,
    whole_texts, segment_groups, drift_report_json)}
