"""Session defaults and the shared folder that written intermediate tables go to."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

_own_folders: dict[str, str] = {}
_taken: ContextVar[list[str]] = ContextVar("paths taken by the run", default=[])


def local_session(app_name: str = "caremeld", cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the session is the caller's."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a temporary folder that is removed at exit.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _own_folders:
        folder = tempfile.mkdtemp(prefix="caremeld-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
        _own_folders[app] = folder
    return _own_folders[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other call has used; within ``intermediates`` one that goes with that run."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _taken.get().append(path)
    return path


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Whatever the block writes below the shared folder is deleted at its end; other runs in the process keep theirs.

    Threads that the block starts take part when they run in its context (``contextvars.copy_context``).
    """
    own: list[str] = []
    token = _taken.set(own)
    try:
        yield
    finally:
        _taken.reset(token)
        _delete(spark, own)


def remove_intermediate(spark: SparkSession) -> None:
    """Deletes what was written outside of any ``intermediates``; results that still read it become unreadable."""
    _delete(spark, _taken.get())


def delete(spark: SparkSession, path: str) -> None:
    """Removes a file or a folder, if it is there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def _delete(spark: SparkSession, paths: list[str]) -> None:
    for name in paths:
        delete(spark, name)
    paths.clear()


def stored_bytes(spark: SparkSession, path: str) -> int:
    """The size of the files below ``path``."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(place).getLength()
