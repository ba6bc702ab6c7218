"""Folder operations on whatever file system a path belongs to.

Only names of folders pass through here, never rows.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Of stored Parquet: digests are hex text, which only an entropy coder makes smaller.
PACKED = {"compression": "zstd"}


def _open(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _open(spark, path)
    return fs.exists(hadoop)


def ensure(spark: SparkSession, path: str) -> None:
    fs, hadoop = _open(spark, path)
    fs.mkdirs(hadoop)


def remove(spark: SparkSession, path: str) -> None:
    fs, hadoop = _open(spark, path)
    fs.delete(hadoop, True)


def move_into(spark: SparkSession, path: str, destination: str) -> None:
    """Put a folder where another one may be."""
    fs, source = _open(spark, path)
    _, target = _open(spark, destination)
    fs.delete(target, True)
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"could not move {path} to {destination}")


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing if there is none."""
    fs, hadoop = _open(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(hadoop)] if fs.exists(hadoop) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop = _open(spark, path)
    stream = fs.open(hadoop)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears with its whole content, and must not be there yet."""
    fs, hadoop = _open(spark, path)
    _, beside = _open(spark, f"{path}.writing")
    stream = fs.create(beside, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    if fs.exists(hadoop) or not fs.rename(beside, hadoop):
        raise OSError(f"{path} was written by somebody else")


def partition_dirs(spark: SparkSession, path: str, depth: int) -> list[str]:
    """``a=1/b=2`` style folders below ``path``, relative to it."""
    fs, hadoop = _open(spark, path)
    levels = [(hadoop, "")]
    for _ in range(depth):
        levels = [
            (status.getPath(), f"{prefix}{status.getPath().getName()}/")
            for folder, prefix in levels
            for status in fs.listStatus(folder)
            if status.isDirectory() and "=" in status.getPath().getName()
        ]
    return [prefix.rstrip("/") for _, prefix in levels]
