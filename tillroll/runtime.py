"""Session-level helpers: where intermediates are cut, how long they live, and how they are reused."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_scope: ContextVar[str | None] = ContextVar("tillroll_scratch", default=None)
_registered: set[str] = set()
_log = logging.getLogger(__name__)


def _file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """Hadoop's file system of a path, which may be any that Spark can write to, and the path in its terms."""
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(context._jsc.hadoopConfiguration()), where


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder if it is there. A folder that cannot be deleted is reported, and does not end a run that has its results."""
    files, where = _file_system(spark, path)
    try:
        files.delete(where, True)
    except Py4JJavaError as error:
        _log.warning("%s stays: %s", path, error.java_exception)


def write_once(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not be there yet; readers see all of it or nothing."""
    files, where = _file_system(spark, path)
    _, draft = _file_system(spark, f"{path}.{uuid.uuid4().hex}.draft")
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if files.exists(where) or not files.rename(draft, where):
        files.delete(draft, False)
        raise FileExistsError(path)


def small_text(spark: SparkSession, path: str) -> str:
    files, where = _file_system(spark, path)
    stream = files.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder, none if it is not there."""
    files, where = _file_system(spark, folder)
    return [f.getPath().getName() for f in files.listStatus(where)] if files.exists(where) else []


def _remove_at_end(spark: SparkSession, path: str) -> None:
    """Have the driver delete a folder when it ends."""
    files, where = _file_system(spark, path)
    files.mkdirs(where)
    files.deleteOnExit(where)


def cut_folder(spark: SparkSession) -> str:
    """Folder for intermediates of this application, on storage that the driver and all executors share.

    It lies below ``spark.checkpoint.dir`` if the session names one, else below the warehouse, which holds shared
    tables already. It is removed when the driver ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{shared.rstrip('/')}/tillroll-{spark.sparkContext.applicationId}"
    if folder not in _registered:
        _remove_at_end(spark, folder)
        _registered.add(folder)
    return folder


def fresh_path(spark: SparkSession) -> str:
    """A path below the innermost ``scratch``, else below ``cut_folder``, that nothing uses yet."""
    return f"{_scope.get() or cut_folder(spark)}/{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Own the intermediates that are cut inside the block: their folder is removed at its end, also after an error.

    For work whose results are written or read before the block ends. A frame that leaves the block must not rest on a
    cut made inside.
    """
    folder = fresh_path(spark)
    before = _scope.set(folder)
    try:
        yield folder
    finally:
        _scope.reset(before)
        remove_path(spark, folder)


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, write it as a table and go on from the table.

    The files outlive executors, later steps read only the columns they need, and the planner knows their size.
    """
    path = fresh_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
