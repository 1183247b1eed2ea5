"""Hadoop FileSystem access for table folders (works on HDFS/S3A/ABFS/local).

Only metadata operations (exists, delete one partition folder, list
partition folders) go through here; data always moves through Spark jobs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(conf), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return bool(fs.exists(p))


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs_and_path(spark, path)
    fs.mkdirs(p)


def delete(spark: SparkSession, path: str) -> bool:
    """Recursive delete; returns whether anything was removed."""
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return False
    return bool(fs.delete(p, True))


def list_children(spark: SparkSession, path: str) -> list[str]:
    """Names of direct children (one level, no data read)."""
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return []
    return [status.getPath().getName() for status in fs.listStatus(p)]


def qualify(spark: SparkSession, path: str) -> str:
    """Fully qualified URI of ``path`` (``file:/…``, ``s3a://…``)."""
    fs, p = _fs_and_path(spark, path)
    return str(fs.makeQualified(p).toString())


def size(spark: SparkSession, path: str) -> int:
    """Bytes under a file or folder; 0 if there is none."""
    fs, p = _fs_and_path(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def listing(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """``(name, bytes, modification time)`` of a file or of a folder's direct children."""
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return []
    return sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(p))


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A small file written by the driver (code, markers; never table data)."""
    fs, p = _fs_and_path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """A small file (journals, markers), read by the driver."""
    fs, p = _fs_and_path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, source = _fs_and_path(spark, old)
    _, target = _fs_and_path(spark, new)
    if not fs.rename(source, target):
        raise OSError(f"cannot rename {old} to {new}")
