"""Path probes through the session's Hadoop file systems.

Spark's own configuration (credentials, mounts, schemes) applies, so every
store that Spark can read can be probed: for facts its file sources do not
expose, such as whether a path exists before it is read, and hidden files such
as the ``_SUCCESS`` job marker.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _resolve(spark, path)
    return fs.exists(p)


def file_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _resolve(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isFile()


def first_bytes(spark: SparkSession, path: str, most: int) -> tuple[bytes, int]:
    """(the first ``most`` bytes of a file's content, the file's size); a file
    that is compressed by its name, as Spark reads it, is expanded."""
    fs, p = _resolve(spark, path)
    size = fs.getFileStatus(p).getLen()
    codec = spark.sparkContext._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
        spark.sparkContext._jsc.hadoopConfiguration()).getCodec(p)
    stream = fs.open(p)
    try:
        return bytes((codec.createInputStream(stream) if codec else stream).readNBytes(most)), size
    finally:
        stream.close()


def list_files(spark: SparkSession, folder: str, suffix: str) -> list[str]:
    """Paths of the files in a folder whose names end in ``suffix``, by name."""
    fs, p = _resolve(spark, folder)
    if not fs.exists(p):
        raise FileNotFoundError(folder)
    found = [f.getPath().toString() for f in fs.listStatus(p) if f.isFile()]
    return sorted(f for f in found if f.endswith(suffix))


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's whole text (UTF-8)."""
    return first_bytes(spark, path, (1 << 31) - 1)[0].decode("utf-8")


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Rename within one file system; the target must not exist."""
    fs, p = _resolve(spark, source)
    to = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    parent = to.getParent()
    if fs.exists(to):
        raise FileExistsError(target)
    if parent is not None:
        fs.mkdirs(parent)
    if not fs.rename(p, to):
        raise OSError(f"cannot rename {source} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    """Remove what a job wrote for itself (scratch data after use)."""
    fs, p = _resolve(spark, path)
    fs.delete(p, True)
