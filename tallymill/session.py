"""Session settings and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Folders made for local sessions that name none, by application.
_local_folders: dict[str, str] = {}


def local_session(cores: int | str = "*", app: str = "tallymill") -> SparkSession:
    """A single-machine session for tests and the bench. Clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master gets a folder of our own when the setting is missing: a
    machine-local path would lose data as soon as an executor is replaced.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="tallymill-")
    return _local_folders[context.applicationId]


@contextmanager
def settings(spark: SparkSession, wanted: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the length of a block; the old values come back after it."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """As ``new_path``, for a folder that is removed when the driver ends."""
    path = new_path(spark, label)
    _remove_at_exit(spark, path)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    Later steps then see the same rows whatever is recomputed, a lost executor
    costs a re-read rather than the whole lineage, and each reader still gets
    column pruning and filter pushdown.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    """Have the file system drop a folder when the driver ends, should it exist then."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
