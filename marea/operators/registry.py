"""Runs and model versions as plain tables.

On storage both are Parquet folders with one partition per experiment or model name. A write
replaces the partitions it touches as a whole and leaves the files of all others alone; rows
are found again by their key, so that a repeated write changes nothing. Two writers of one
experiment or name at the same time need a table format with transactions instead.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from marea.session import exists, materialized

RUN_SCHEMA = ("experiment string, run_id string, run_name string, start_time timestamp, status string, "
              "params map<string,string>, metrics map<string,double>, tags map<string,string>, "
              "artifact_uri string")
VERSION_SCHEMA = "name string, version string, artifact_uri string, tags map<string,string>"


def run_row(spark: SparkSession, experiment: str, run_id: str, run_name: str, params: dict, metrics: dict,
            tags: dict, status: str, artifact_uri: str | None = None) -> DataFrame:
    """One run, ready to append to the ``runs`` table."""
    known = {k: float(v) for k, v in metrics.items() if v is not None}
    row = (experiment, run_id, run_name, dt.datetime.now(), status, params, known, tags, artifact_uri)
    return spark.createDataFrame([row], RUN_SCHEMA)


def run_algorithm(run_name: Column) -> Column:
    """First part of a run name."""
    return F.split_part(run_name, F.lit("_"), F.lit(1))


def champion_run(runs: DataFrame, metric: Column, experiment_col: str = "experiment",
                 run_id: str = "run_id") -> DataFrame:
    """Best run per experiment: highest ``metric``, then smallest id; a missing or
    NaN metric comes last. Adds ``metric`` and the model's ``model_uri``."""
    ranked = runs.withColumn("metric", F.when(~F.isnan(metric), metric))
    best = Window.partitionBy(experiment_col).orderBy(F.desc_nulls_last("metric"), run_id)
    return (ranked.withColumn("_nth", F.row_number().over(best)).where("_nth = 1").drop("_nth")
            .withColumn("model_uri", F.format_string("runs:/%s/model", F.col(run_id).cast("string"))))


def find_champion(runs: DataFrame, experiment: str, metric: str = "auc"):
    """The champion's row for one experiment of a ``runs`` table, or a clear error."""
    own = runs.where(F.col("experiment") == experiment)
    row = champion_run(own, F.col("metrics")[metric]).first()
    if row is None:
        raise LookupError(f"no runs of experiment {experiment!r}")
    return row


def latest_runs(runs: DataFrame, n: int = 2, start_col: str = "start_time",
                run_id: str = "run_id") -> DataFrame:
    return runs.orderBy(F.desc(start_col), run_id).limit(n)


def latest_version(versions: DataFrame) -> DataFrame:
    """Highest version per name, in numeric order, with its ``model_uri``."""
    newest = Window.partitionBy("name").orderBy(F.desc(F.col("version").cast("long")))
    return (versions.withColumn("_nth", F.row_number().over(newest)).where("_nth = 1").drop("_nth")
            .withColumn("model_uri", F.format_string("models:/%s/%s", "name", "version")))


def find_version(versions: DataFrame, name: str, version: int | None = None):
    """The row of one version, the newest by default, or a clear error."""
    own = versions.where(F.col("name") == name)
    if version is not None:
        own = own.where(F.col("version").cast("long") == version)
    row = latest_version(own).first()
    if row is None:
        raise LookupError(f"no version {version or ''} of model {name!r}")
    return row


def register_version(versions: DataFrame, name: str, artifact_uri: str,
                     tags: dict[str, str] | None = None) -> DataFrame:
    """One row for the next version of a name, ready to append."""
    known = versions.where(F.col("name") == name).agg(F.max(F.col("version").cast("long"))).first()[0]
    row = (name, str((known or 0) + 1), artifact_uri, tags or {})
    return versions.sparkSession.createDataFrame([row], VERSION_SCHEMA)


def tag_version(versions: DataFrame, target: DataFrame, tags: dict[str, str]) -> DataFrame:
    """All versions, with ``tags`` set on those in ``target`` (``name, version``); a
    tag that is there already takes the new value."""
    new = F.create_map(*[F.lit(x) for pair in tags.items() for x in pair])
    chosen = target.select("name", "version").distinct().withColumn("_hit", F.lit(True))
    old = F.coalesce("tags", F.create_map().cast("map<string,string>"))
    merged = F.map_zip_with(old, new, lambda key, was, now: F.coalesce(now, was))
    return (versions.join(chosen, ["name", "version"], "left")
            .withColumn("tags", F.when(F.col("_hit"), merged).otherwise(F.col("tags"))).drop("_hit"))


def stored(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """A table on storage, empty where nothing was written yet."""
    wanted = StructType.fromDDL(schema)
    if not exists(spark, root):
        return spark.createDataFrame([], wanted)
    return spark.read.schema(wanted).parquet(root).select(*wanted.names)


def _upsert(rows: DataFrame, root: str, schema: str, part: str, keys: list[str]) -> None:
    """Add rows, or replace those with the same key. One row per key is kept."""
    wanted = StructType.fromDDL(schema)
    new = materialized(rows.select(*wanted.names).dropDuplicates(keys))
    if not new.where(F.col(part).isNull() | (F.col(part) == "")).isEmpty():
        raise ValueError(f"{part!r} may be neither null nor empty")
    old = stored(new.sparkSession, root, schema)
    kept = old.join(new.select(part).distinct(), part, "left_semi").join(new.select(*keys), keys, "left_anti")
    whole = materialized(kept.select(*wanted.names).unionByName(new))      # read before it is replaced
    (whole.repartition(part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(part).parquet(root))


def stored_runs(spark: SparkSession, root: str) -> DataFrame:
    return stored(spark, root, RUN_SCHEMA)


def log_runs(runs: DataFrame, root: str) -> None:
    """Append runs to the table at ``root``; a run logged again replaces its earlier row."""
    _upsert(runs, root, RUN_SCHEMA, "experiment", ["experiment", "run_id"])


def stored_versions(spark: SparkSession, root: str) -> DataFrame:
    return stored(spark, root, VERSION_SCHEMA)


def save_versions(versions: DataFrame, root: str) -> None:
    """Append versions to the table at ``root``; a version saved again replaces its earlier row."""
    _upsert(versions, root, VERSION_SCHEMA, "name", ["name", "version"])


def set_tags(spark: SparkSession, root: str, target: DataFrame, tags: dict[str, str]) -> None:
    """Set tags on the stored versions in ``target`` (``name, version``), as ``tag_version`` does.
    Only partitions of names in ``target`` are read and written."""
    chosen = materialized(target.select("name", "version").distinct())
    own = stored_versions(spark, root).join(chosen, ["name", "version"], "left_semi")
    save_versions(tag_version(own, chosen, tags), root)
