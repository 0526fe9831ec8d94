"""Session settings and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "siltstone", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` maps conf keys (dots as ``__``) to values."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers, which need not have it on their path. Once per application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = os.path.realpath(tempfile.mkdtemp(prefix="siltstone-"))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # the driver serves the file as long as it runs
    archive = os.path.join(folder, "siltstone.zip")
    with zipfile.ZipFile(archive, "w") as packed:
        for path, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                file = os.path.join(path, name)
                packed.write(file, os.path.relpath(file, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a temporary folder; a cluster
    that names none is an error, because a machine-local folder would be lost
    with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="siltstone-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/siltstone-{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later readers all see the same rows, even after a lost executor."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


# Bytes from which a batch of rows goes to a Python worker.
BATCH_BYTES = 4 << 20


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs inside sends rows to Python by their size: batches of so many rows, as Spark sends them else, grow with the texts."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: as lasting as ``settle``, and compressed."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
