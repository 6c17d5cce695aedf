"""Weighted classifiers: train, evaluate, log, save, load and score with pyspark.ml."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from marea.functions.partitions import spread
from marea.operators.metrics import classification_metrics, with_class_weights
from marea.operators.ordered import auc_roc
from marea.operators.prepare import FeatureEncoder, column_means, fit_encoder, impute_mean
from marea.operators.registry import find_champion, find_version, run_row
from marea.operators.split import stratified_split
from marea.sources.readers import read_whole_text

WEIGHT = "class_weight"


@dataclass(frozen=True)
class Classifier:
    """A named estimator: ``build(n_rows, label_col)`` and the parameters to log."""

    name: str
    build: Callable[[int, str], Estimator]
    params: dict[str, str] = field(default_factory=dict)


def logistic(name: str = "Logistic_Regression_Balanced", c: float = 1.0) -> Classifier:
    """L2-penalised logistic regression with balanced classes.

    Balanced weights sum to the number of rows, and the loss here is a mean, so
    the inverse strength C becomes the penalty 1 / (C * rows).
    """

    def build(n_rows: int, label_col: str) -> Estimator:
        return LogisticRegression(labelCol=label_col, weightCol=WEIGHT, regParam=1.0 / (c * n_rows),
                                  elasticNetParam=0.0, standardization=False)

    return Classifier(name, build, {"C": str(c), "class_weight": "balanced", "regParam": "1 / (C * rows)",
                                    "standardization": "false"})


def forest(name: str = "Random_Forest_Balanced", trees: int = 100, depth: int = 10,
           min_split: int = 5, seed: int = 42) -> Classifier:
    """Random forest with balanced classes. Spark bounds the size of the children
    rather than of the node to split, so ``min_split`` rows become at least half
    of that per child; both numbers are logged. The node of each row in each tree is kept from
    level to level, on the executors (memory, then disk), so that trees are not walked from the
    root; a lost partition is made again from the levels before, without checkpoints."""
    per_child = max(1, min_split // 2)

    def build(n_rows: int, label_col: str) -> Estimator:
        return RandomForestClassifier(
            labelCol=label_col, weightCol=WEIGHT, numTrees=trees, maxDepth=depth,
            minInstancesPerNode=per_child, featureSubsetStrategy="sqrt", seed=seed,
            cacheNodeIds=True, checkpointInterval=-1)

    return Classifier(name, build, {
        "n_estimators": str(trees), "max_depth": str(depth), "min_samples_split": str(min_split),
        "minInstancesPerNode": str(per_child), "featureSubsetStrategy": "sqrt",
        "class_weight": "balanced", "random_state": str(seed)})


def training_frames(df: DataFrame, id_col: str, label_col: str, categorical: list[str],
                    numeric: list[str], fraction: float = 0.2, seed: int = 42,
                    fit_on: str = "train") -> tuple[DataFrame, DataFrame, FeatureEncoder]:
    """Encoded (train, test) and the encoder, which also fills gaps of later batches.

    Means, categories and scales are learnt from the training rows, or with
    ``fit_on="all"`` from every row, which lets the test rows leak into them.
    """
    if fit_on not in ("train", "all"):
        raise ValueError(f"unknown fit_on {fit_on!r}")
    parts = stratified_split(df, id_col, label_col, fraction, seed)
    train, test = parts.where("part = 'train'"), parts.where("part = 'test'")
    base = train if fit_on == "train" else parts
    means = column_means(base, numeric)
    encoder = fit_encoder(impute_mean(base, numeric, means), id_col, label_col, categorical, numeric, means)
    return encoder.transform(train), encoder.transform(test), encoder


def fit(classifier: Classifier, train: DataFrame, features: list[str], label_col: str) -> PipelineModel:
    """Fit on balanced class weights. The weighted rows stay on the executors (memory,
    then disk) while the fit reads them, spread over all cores."""
    weighted = with_class_weights(train.select(*features, label_col), label_col, WEIGHT).persist()
    try:
        stages = [VectorAssembler(inputCols=features, outputCol="features"),
                  classifier.build(weighted.count(), label_col)]
        return Pipeline(stages=stages).fit(spread(weighted))
    finally:
        weighted.unpersist()


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``probability`` of class 1 and the ``prediction``; every other column,
    the id and the label among them, stays beside them. A model that gives no
    probabilities has its class stand in."""
    scored = model.transform(df)
    prediction = F.col("prediction").cast("int")
    probability = (vector_to_array("probability")[1] if "probability" in scored.columns
                   else prediction.cast("double"))
    return scored.select(*df.columns, probability.alias("probability"), prediction.alias("prediction"))


def evaluate(scored: DataFrame, label_col: str) -> dict[str, float]:
    """Accuracy, F1 of class 1 and AUC; the scores are computed once for all three."""
    kept = scored.select(label_col, "probability", "prediction").persist()
    try:
        rates = classification_metrics(kept, label_col, "prediction").first()
        auc = auc_roc(kept, label_col, "probability").first()["auc"]
    finally:
        kept.unpersist()
    return {"accuracy": rates["accuracy"], "f1_score": rates["f1_score"], "auc": auc}


def train_and_log(classifier: Classifier, train: DataFrame, test: DataFrame, features: list[str],
                  label_col: str, experiment: str, model_root: str | None = None,
                  encoder: FeatureEncoder | None = None, tags: dict[str, str] | None = None,
                  log_failure: bool = False) -> tuple[PipelineModel | None, DataFrame]:
    """Fit, evaluate on ``test``, save, and return the model with its row for the
    ``runs`` table. A run that breaks raises its error; with ``log_failure`` its row is
    returned instead, FAILED and with the whole error as a tag."""
    run_id = uuid.uuid4().hex
    spark = train.sparkSession
    labels = {"env": "dev", "algorithm": classifier.name.split("_")[0], **(tags or {})}
    try:
        model = fit(classifier, train, features, label_col)
        metrics = evaluate(score(model, test), label_col)
        uri = (save_model(model, train.select(*features), f"{model_root}/{run_id}", encoder)
               if model_root else None)
    except Exception as error:  # noqa: BLE001 - the failure is the record
        if not log_failure:
            raise
        return None, run_row(spark, experiment, run_id, classifier.name, classifier.params, {},
                             {**labels, "error": str(error)}, "FAILED")
    return model, run_row(spark, experiment, run_id, classifier.name, classifier.params, metrics,
                          labels, "FINISHED", uri)


def save_model(model: PipelineModel, features: DataFrame, path: str,
               encoder: FeatureEncoder | None = None) -> str:
    """Save the model, the schema of its features, five of their rows as an example,
    and the encoder that makes them; returns the path."""
    model.write().overwrite().save(f"{path}/model")
    _write_text(features.schema.json(), f"{path}/signature")
    features.limit(5).write.mode("overwrite").json(f"{path}/input_example")
    if encoder is not None:
        _write_text(encoder.to_json(), f"{path}/encoder")
    return path


def _write_text(text: str, path: str) -> None:
    row = SparkSession.active().createDataFrame([(text,)], "value string")
    row.coalesce(1).write.mode("overwrite").text(path)


def load_encoder(path: str) -> FeatureEncoder:
    """The encoder saved beside a model."""
    return FeatureEncoder.from_json(read_whole_text(SparkSession.active(), f"{path}/encoder").first()[0])


def load_model(path: str) -> tuple[PipelineModel, StructType]:
    """The model and the feature schema it expects."""
    text = read_whole_text(SparkSession.active(), f"{path}/signature").first()[0]
    return PipelineModel.load(f"{path}/model"), StructType.fromJson(json.loads(text))


def load_champion(runs: DataFrame, experiment: str, metric: str = "auc") -> tuple[PipelineModel, StructType]:
    """The model of an experiment's best run."""
    return load_model(find_champion(runs, experiment, metric)["artifact_uri"])


def load_version(versions: DataFrame, name: str, version: int | None = None) -> tuple[PipelineModel, StructType]:
    """A registered model by version, or its newest one."""
    return load_model(find_version(versions, name, version)["artifact_uri"])
