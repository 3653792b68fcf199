"""Session set-up and the shared scratch folder.

Some operators need the result of one step to plan the next (tile boundaries,
medians, publishing).  They cut the plan by writing a Parquet table under the
cluster's checkpoint folder: it survives lost executors, prunes columns when
read back, and its file sizes are known to the planner, so that small results
are broadcast and large ones are not, without a hint.  Zstandard keeps these
tables, which are written once and read a few times, smaller than the default.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "ordermill", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with AQE; every other setting is the caller's."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_checkpoint_folder(spark: SparkSession) -> SparkSession:
    """Give a session without ``spark.checkpoint.dir`` a folder of its own.

    For entry points of tests, benches and trials; a cluster names its shared
    folder in the setting, which is then left as it is.
    """
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ordermill-"))
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The application's folder under ``spark.checkpoint.dir``, which has to be set."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """(FileSystem, Path) of a location on any store Spark can reach."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()), target


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder that goes when the application ends."""
    path = scratch_path(spark, label)
    fs, target = hadoop_path(spark, path)
    fs.mkdirs(target)
    fs.deleteOnExit(target)
    return path


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
CONCURRENT_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_brief: dict[str, list] = {}
_brief_lock = threading.Lock()


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries begun within leave no shuffle files behind; else these stay until the driver happens to collect garbage.

    For a write or a collect, whose plan runs once.  The setting is the session's, so it is held as long as any thread
    is within; a frame that another thread makes meanwhile and runs twice shuffles again.
    """
    application = spark.sparkContext.applicationId
    with _brief_lock:
        inside = _brief.setdefault(application, [0, spark.conf.get(SHUFFLE_CLEANUP, None)])
        inside[0] += 1
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with _brief_lock:
            inside[0] -= 1
            if not inside[0]:
                _brief.pop(application)
                if inside[1] is None:
                    spark.conf.unset(SHUFFLE_CLEANUP)
                else:
                    spark.conf.set(SHUFFLE_CLEANUP, inside[1])


def allow_unsorted_writes(spark: SparkSession, values: int) -> None:
    """Let tasks write up to so many partition values side by side; only rows of more values are sorted by value first.

    Stays set, unless the caller has chosen a number: a write that is planned with it must not run without it.
    """
    if int(spark.conf.get(CONCURRENT_WRITERS, "0")) == 0:
        spark.conf.set(CONCURRENT_WRITERS, str(values))


_scopes = threading.local()


@contextmanager
def scratch_scope(keep: bool = False) -> Iterator[None]:
    """What this thread materializes within goes at the end of the block; with ``keep`` a scope around it leaves it alone."""
    outer, made = getattr(_scopes, "made", None), None if keep else []
    _scopes.made = made
    try:
        yield
    finally:
        _scopes.made = outer
        for spark, path in made or ():
            fs, target = hadoop_path(spark, path)
            fs.delete(target, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to scratch and go on from the stored rows."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with brief_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    fs, target = hadoop_path(spark, path)
    fs.deleteOnExit(target)
    if getattr(_scopes, "made", None) is not None:
        _scopes.made.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)
