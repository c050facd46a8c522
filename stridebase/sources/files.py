"""Folders in whatever file system Spark reads: listing, deleting, and deleting at exit."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def scheme(spark: SparkSession, folder: str) -> str:
    """The scheme of the file system that holds the folder, also if the path names none."""
    system, _ = _open(spark, folder)
    return system.getUri().getScheme()


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _open(spark, path)
    return system.exists(target)


def subfolders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders in a folder, sorted; none if it does not exist."""
    system, path = _open(spark, folder)
    if not system.exists(path):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(path) if s.isDirectory())


def state(spark: SparkSession, path: str) -> tuple[int, ...]:
    """Modification time, bytes and number of files of a file or folder: what tells whether it has been replaced."""
    system, target = _open(spark, path)
    summary = system.getContentSummary(target)
    return system.getFileStatus(target).getModificationTime(), summary.getLength(), summary.getFileCount()


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder, sorted; none if it does not exist."""
    system, path = _open(spark, folder)
    if not system.exists(path):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(path) if s.isFile())


def first_bytes(spark: SparkSession, path: str, n: int) -> bytes:
    """At most ``n`` bytes from the start of a file."""
    system, target = _open(spark, path)
    stream = system.open(target)
    try:
        return bytes(stream.readNBytes(n))
    finally:
        stream.close()


def make_folder(spark: SparkSession, folder: str) -> None:
    system, path = _open(spark, folder)
    system.mkdirs(path)


def touch(spark: SparkSession, path: str) -> None:
    system, target = _open(spark, path)
    system.create(target, True).close()


def delete_folder(spark: SparkSession, folder: str) -> None:
    system, path = _open(spark, folder)
    system.delete(path, True)


def delete_at_exit(spark: SparkSession, folder: str) -> None:
    """Make the folder, and delete it with all its files when the application's driver ends."""
    system, path = _open(spark, folder)
    system.mkdirs(path)
    system.deleteOnExit(path)
