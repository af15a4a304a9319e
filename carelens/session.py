"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows that a join may copy to the driver and from there to every executor.
COPIED = 10_000


def local_session(
    app: str = "carelens", cores: str | int = "*", shuffle_partitions: int = 8, **settings: str
) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # Recording the Python call site of every expression doubles the time to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="carelens-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _in_store(spark: SparkSession, path: str):
    """The path and the store it lies in."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path, if it is there."""
    store, target = _in_store(spark, path)
    store.delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    store, target = _in_store(spark, path)
    return store.exists(target)


def any_exists(spark: SparkSession, pattern: str) -> bool:
    """Whether a path matches the glob pattern."""
    store, target = _in_store(spark, pattern)
    return bool(store.globStatus(target))


def bounded(frame: DataFrame, rows: int | None = None) -> DataFrame:
    """The side of a join that may be copied if it is small: with more than ``COPIED`` rows it is shuffled instead.

    Spark guesses a side's size by its files, and names and ids made from a number are many times larger than that.
    ``rows`` is how many it has, if that is known.
    """
    return frame.hint("merge") if (frame.count() if rows is None else rows) > COPIED else frame
