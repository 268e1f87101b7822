"""Session helpers: the shared work folder and intermediate tables written to it."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_local_folder: dict[str, str] = {}
#: of a batch for Python workers; Spark's own bound is 64 MB, and a task holds several batches on both sides
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_releasing: dict[SparkSession, tuple[int, str | None]] = {}  # how many actions do so, and the setting before them
_lock = threading.Lock()


def build_session(app_name: str = "riskflow", **conf: str) -> SparkSession:
    """A session with the settings the package relies on; ``conf`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    builder = builder.config("spark.sql.session.timeZone", "UTC")
    builder = builder.config("spark.sql.adaptive.enabled", "true")
    builder = builder.config("spark.sql.adaptive.skewJoin.enabled", "true")
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_folder:
        _local_folder[app] = tempfile.mkdtemp(prefix="riskflow-")
    return _local_folder[app]


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; it is removed when the application ends."""
    folder = f"{shared_folder(spark)}/riskflow-{uuid.uuid4().hex}"
    jvm_folder = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = jvm_folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(jvm_folder)  # only a folder that is there can be marked for removal
    files.deleteOnExit(jvm_folder)
    return f"{folder}/{name}"


def bound_batches(spark: SparkSession) -> None:
    """From now on, Arrow batches of this session end at ``BATCH_BYTES``; one longer row is a batch by itself.

    Spark reads the setting when an action runs, so it stays for the caller's actions. A lower setting is left alone.
    """
    set_to = re.fullmatch(r"(\d+)([kmg]?)b?", (spark.conf.get(_BATCH, None) or "").lower())
    if not set_to or int(set_to[1]) << 10 * " kmg".index(set_to[2] or " ") > BATCH_BYTES:
        spark.conf.set(_BATCH, f"{BATCH_BYTES}b")


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of an action go as soon as it ends, not when the driver collects its garbage."""
    with _lock:
        actions, before = _releasing.get(spark, (0, None))
        if not actions:
            before = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _releasing[spark] = actions + 1, before
    try:
        yield
    finally:
        with _lock:
            actions, before = _releasing.pop(spark)
            if actions > 1:
                _releasing[spark] = actions - 1, before
            elif before is None:
                spark.conf.unset(_CLEANUP)
            else:
                spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    The result survives lost executors, has no lineage and has known file sizes, so Catalyst decides from
    a measured size whether it can be broadcast. The shuffle files behind it are removed.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    with shuffles_released(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Remove a table of ``materialize`` that nothing will read again."""
    spark = table.sparkSession
    for file in table.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        if folder.getParent().getName().startswith("riskflow-"):
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder.getParent(), True)


def together[T](jobs: Mapping[str, Callable[[], T]]) -> dict[str, T]:
    """Run independent loads at the same time, so that the last tasks of one do not leave executors idle.

    They run in the caller's scheduler pool and job group.
    """
    spark = SparkSession.active()
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(job)) for name, job in jobs.items()}
        return {name: job.result() for name, job in running.items()}
