"""Writing an intermediate table where several fits read it."""

from __future__ import annotations

import logging
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

_local_folder: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folder:
        _local_folder[app] = tempfile.mkdtemp(prefix="stage-")
        spark.sparkContext.setCheckpointDir(_local_folder[app])
    return _local_folder[app]


def ensure_checkpoints(spark: SparkSession) -> None:
    """Long iterations cut their lineage only when a checkpoint folder is known."""
    try:
        shared_folder(spark)
    except ValueError as e:
        log.warning("boosting runs without checkpoints: %s", e)


#: Folders that open scopes write into, innermost last, by application.
_scopes: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, outlast: bool = False) -> str:
    """A new path in the folder of the innermost scope (``outlast``: of the one around it).

    Without a scope all paths of an application lie in one folder, which may be dropped when the application is over.
    """
    app = spark.sparkContext.applicationId
    open_ = _scopes.get(app, [])
    open_ = open_[:-1] if outlast else open_
    return f"{open_[-1] if open_ else f'{shared_folder(spark)}/{app}'}/{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Tables written inside are removed at the end, but for those that are to outlast it."""
    app = spark.sparkContext.applicationId
    folder = scratch_path(spark)
    _scopes.setdefault(app, []).append(folder)
    try:
        yield folder
    finally:
        _scopes[app].remove(folder)
        remove(spark, folder)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared file system, if it is there."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    try:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)
    except Exception as e:  # a table left behind takes room, nothing else
        log.warning("%s could not be removed: %s", path, e)


def materialise(df: DataFrame, outlast: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and lets each later fit read only its own columns. ``outlast``: the
    table is needed beyond the scope it is written in. ``by``: columns of few values, each of which gets a folder that can be
    read alone.
    """
    path = scratch_path(df.sparkSession, outlast)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
