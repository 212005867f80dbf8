"""Folders for tables a job writes and reads back."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Folders made within the innermost `scratch_scope`.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name below ``spark.checkpoint.dir``.

    Where that is unset the folder lies below ``/tmp`` of the session's default
    file system: shared storage on a cluster, the local disk in a local run. A
    cluster whose default file system is each machine's own disk is refused.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        system = spark.conf.get("spark.hadoop.fs.defaultFS", None) or spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")
        if (system or "file:").startswith("file:") and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        shared = "/tmp"
    folder = f"{shared.rstrip('/')}/ebbmark-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(folder)
    return folder


def remove(spark: SparkSession, folder: str) -> None:
    """Remove a scratch folder, and those whose names begin with its name, if they exist."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder + "*")
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in system.globStatus(path) or []:
        system.delete(status.getPath(), True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove at the end of a ``with`` block the scratch folders made in it.

    For steps whose result has been written elsewhere by then: frames that still
    read these folders fail afterwards.
    """
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for folder in made:
            remove(spark, folder)
