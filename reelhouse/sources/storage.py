"""What exists under a path, asked of the file system Spark itself uses.

Works for any scheme Hadoop knows (hdfs, s3a, file), unlike ``os.path``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_DONE = "_SUCCESS"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: How stored Parquet is compressed: most of it is ids and texts made of them.
COMPRESSION = "zstd"


def _path(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, fs = _path(spark, path)
    return fs.exists(hadoop)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    hadoop, fs = _path(spark, path)
    if not fs.exists(hadoop):
        return []
    return [s.getPath().getName() for s in fs.listStatus(hadoop) if s.isDirectory()]


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the data files in a folder, in name order."""
    hadoop, fs = _path(spark, path)
    if not fs.exists(hadoop):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(hadoop) if s.isFile()]
    return sorted(name for name in names if not name.startswith(("_", ".")))


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder, 0 where there is none."""
    hadoop, fs = _path(spark, path)
    return fs.getContentSummary(hadoop).getLength() if fs.exists(hadoop) else 0


def files(spark: SparkSession, path: str, ending: str) -> list[str]:
    """Full names of the files in a folder, in name order."""
    hadoop, fs = _path(spark, path)
    found = [s.getPath().toString() for s in fs.listStatus(hadoop) if s.isFile()]
    return sorted(name for name in found if name.endswith(ending))


def all_files(spark: SparkSession, path: str) -> list[str]:
    """Full names of the data files in a folder, or of the one that ``path`` is."""
    hadoop, fs = _path(spark, path)
    found = [s.getPath() for s in fs.listStatus(hadoop) if s.isFile()]
    return sorted(p.toString() for p in found if not p.getName().startswith(("_", ".")))


def head(spark: SparkSession, path: str, size: int) -> bytes:
    """The first bytes of a file as they lie there."""
    hadoop, fs = _path(spark, path)
    stream = fs.open(hadoop)
    try:
        return bytes(stream.readNBytes(size))
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    hadoop, fs = _path(spark, path)
    out = fs.create(hadoop, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that must not be there yet; False, and nothing done, if it is."""
    hadoop, fs = _path(spark, path)
    try:
        out = fs.create(hadoop, False)
    except Py4JJavaError:
        if fs.exists(hadoop):
            return False
        raise
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None where there is none."""
    hadoop, fs = _path(spark, path)
    if not fs.exists(hadoop):
        return None
    stream = fs.open(hadoop)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when a Spark job that wrote this folder was committed."""
    return exists(spark, f"{path}/{_DONE}")


def delete(spark: SparkSession, path: str) -> None:
    hadoop, fs = _path(spark, path)
    fs.delete(hadoop, True)


def join(*parts: str) -> str:
    return "/".join([parts[0].rstrip("/"), *[p.strip("/") for p in parts[1:]]])


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, what a query of the session has shuffled is deleted when the query ends,
    and not when the driver next collects garbage. For jobs that write: a frame whose
    rows are taken twice is computed twice."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, True)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder the cluster names for checkpoints.

    Where a session names none, the warehouse serves, which all executors share too.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    return join(
        shared or join(spark.conf.get("spark.sql.warehouse.dir"), "_scratch"),
        f"{name}-{uuid.uuid4().hex}",
    )
