"""Spark session and the shared folder that jobs may write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


_local_dirs: dict[str, str] = {}    # application -> its folder, in local mode only
_scratch: dict[str, list[str]] = {}     # application -> the scratch paths it was given


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g",
                  app: str = "marea", conf: dict[str, str] | None = None) -> SparkSession:
    """Session for tests and the bench; on a cluster spark-submit supplies it."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder: on a cluster
    a machine-local path would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="marea-")
    return _local_dirs[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_mark(spark: SparkSession) -> int:
    """Where the list of this application's scratch tables ends now."""
    return len(_scratch.get(spark.sparkContext.applicationId, ()))


def clear_scratch(spark: SparkSession, since: int = 0, keep: tuple[str, ...] = ()) -> None:
    """Remove the scratch tables written since a mark, but those in ``keep``. Only for
    tables that no frame in use reads any more: when a job's result has been written."""
    paths = _scratch.get(spark.sparkContext.applicationId, [])
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for text in [p for p in paths[since:] if p not in keep]:
        path = jvm.org.apache.hadoop.fs.Path(text)
        path.getFileSystem(conf).delete(path, True)
        paths.remove(text)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store the path names."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def make_folder(spark: SparkSession, path: str) -> str:
    """Make a folder where it is not there yet; its path in full, with the store's scheme."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(place)
    return store.makeQualified(place).toString()


def release(spark: SparkSession) -> None:
    """Have the driver let go of what finished jobs left: broadcasts, shuffle files and plans
    that nothing refers to any more. Spark removes them once the driver's garbage collector
    has found them, which in a long chain of stages may be late or never."""
    spark.sparkContext._jvm.java.lang.System.gc()


def materialized(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder once and go on from the written table.

    That cuts the lineage for good, whichever executors are lost later, and unlike
    a checkpoint of rows the table can be read column by column.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """What is run inside hands rows to Python tasks in batches that end once they take ``size`` bytes."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, str(size))
    try:
        yield
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)
