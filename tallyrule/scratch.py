"""Shared scratch locations taken from the session's checkpoint folder, and their removal.

On a cluster ``spark.checkpoint.dir`` names a folder every executor can
reach; intermediate tables written there survive the loss of an executor.
Nothing here falls back to a machine-local folder: without the setting,
:func:`scratch_path` raises.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Paths of the innermost open scope, or ``None`` outside of any.
_OPEN: ContextVar[list[str] | None] = ContextVar("tallyrule_scratch", default=None)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The session's checkpoint folder, or ``None`` when unset."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None) or None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint folder, owned by the scope that is open, if any."""
    d = checkpoint_dir(spark)
    if d is None:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    path = f"{d.rstrip('/')}/tallyrule/{name}-{uuid.uuid4().hex}"
    owned = _OPEN.get()
    if owned is not None:
        owned.append(path)
    return path


def remove(spark: SparkSession, path: str) -> bool:
    """Remove a file or folder wherever Spark can write; ``False`` if there was none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def rename(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file or folder within one file system; ``False`` if it is not there or the target is."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(fs_path(source)) or fs.exists(fs_path(target)):
        return False
    return fs.rename(fs_path(source), fs_path(target))


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Own every scratch path that is made inside, and remove them all on leaving, also after a failure.

    Frames made inside may read those paths: use up or write what is wanted of
    them before the scope ends. Scopes nest; a path belongs to the innermost.
    Without a scope nothing is removed, since nobody can tell when the last
    reader of a lazy frame is done.
    """
    owned: list[str] = []
    token = _OPEN.set(owned)
    try:
        yield owned
    finally:
        _OPEN.reset(token)
        for path in reversed(owned):
            # A folder that cannot be removed must not hide what happened inside.
            with contextlib.suppress(Py4JJavaError):
                remove(spark, path)
