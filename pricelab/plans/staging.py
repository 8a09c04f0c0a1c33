"""Intermediates that several jobs read, written once to shared storage.

A staged table cuts the lineage and outlives lost executors. It goes to the
checkpoint folder the cluster names in ``spark.checkpoint.dir``, or to the one set on
the context. Only a ``local`` master may do without either: it then gets a temporary
folder of this machine. Elsewhere that is an error, as executors would not share it.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
_folders: dict[str, list[str]] = {}

#: The scopes that each thread is in, innermost last, with what was staged in them.
_scopes = threading.local()


def staging_root(spark: SparkSession) -> str:
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        folder = context._jsc.sc().getCheckpointDir()
        shared = folder.get() if folder.isDefined() else None
    if shared:
        return shared.rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="pricelab-")
    return _local_roots[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path nothing has been written to yet."""
    path = f"{staging_root(spark)}/pricelab/{label}-{uuid.uuid4().hex}"
    _folders.setdefault(spark.sparkContext.applicationId, []).append(path)
    for scope in _open_scopes()[-1:]:
        scope.append(path)
    return path


def stage(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet and return a scan of the written table.

    With ``partition_by`` a filter on that column reads only its rows.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_staged(spark: SparkSession) -> int:
    """Delete what this application has staged; for when no result needs it any more."""
    folders = _folders.pop(spark.sparkContext.applicationId, [])
    _delete(spark, folders)
    return len(folders)


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Delete, on leaving, what this thread staged inside; what was staged before stays.

    For one pipeline from its first read to its last write: a DataFrame that reads
    a staged table must not be used after its scope.
    """
    own: list[str] = []
    _open_scopes().append(own)
    try:
        yield
    finally:
        _open_scopes().pop()
        folders = _folders.get(spark.sparkContext.applicationId, [])
        for path in own:
            if path in folders:
                folders.remove(path)
        _delete(spark, own)


def _open_scopes() -> list[list[str]]:
    if not hasattr(_scopes, "open"):
        _scopes.open = []
    return _scopes.open


def _delete(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
