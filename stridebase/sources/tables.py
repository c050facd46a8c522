"""Table sink with full refresh, and intermediate tables in the shared folder."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridebase.session import shared_folder
from stridebase.sources import files

if TYPE_CHECKING:
    from stridebase.sources.audit import Audit

MARKER = "_refreshed_in_full"
KEPT_VERSIONS = 2  # the published one, and the one that running readers may still hold
COMPRESSION = "zstd"  # hashed keys in hexadecimal take half the space that they take with Spark's default
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Application and table -> the version that was published last, and its state then.
_published: dict[tuple[str, str], tuple[str, tuple[int, ...]]] = {}


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_schema(spark: SparkSession, schema: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION {_quoted(location)}")


@contextmanager
def shuffles_end_with_writes(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is executed inside go when it ends; else they stay until the driver's garbage is collected."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def refresh_table(
    df: DataFrame, name: str, comment: str, path: str, partition_by: tuple[str, ...] = (), audit: Audit | None = None,
    buckets: tuple[int, str] | None = None,
) -> DataFrame:
    """Replace the stored table by ``df`` and return it as read back.

    The rows go to a new version folder under ``path``, and only when all are written is the
    table pointed there. A failed refresh leaves the table as it was and its own
    files removed. The version before stays until the next refresh, for readers that began
    with it; older ones are removed. The files belong to ``path``, not to the catalog:
    a later application whose catalog starts empty goes on in the same folder.

    With ``partition_by`` the rows are rebalanced on those columns first: every
    partition value lands in few, evenly sized files, and adaptive execution splits a
    value that holds a large share of the rows. An ``audit`` watches the rows that are written and
    may stop the publication by an exception. With ``buckets`` (number, column) equal values share a bucket, one
    sorted file each, so that tables with the same buckets join without a shuffle.
    """
    spark = df.sparkSession
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if audit:
        df = audit.watch(df)
    version = f"{path}/v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    beside = f"{name}_{uuid.uuid4().hex[:8]}"
    try:
        with shuffles_end_with_writes(spark):
            if buckets:
                number, column = buckets
                rows = df.repartition(number, column).write.option("compression", COMPRESSION).bucketBy(number, column).sortBy(column)
                rows.format("parquet").option("path", version).saveAsTable(beside)
            else:
                writer = df.write.partitionBy(*partition_by) if partition_by else df.write
                writer.parquet(version, compression=COMPRESSION)
            if audit:
                audit.inspect(spark.read.parquet(version))
    except BaseException:
        if buckets:
            spark.sql(f"DROP TABLE IF EXISTS {beside}")
        files.delete_folder(spark, version)
        raise
    files.touch(spark, f"{path}/{MARKER}")
    if buckets:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"ALTER TABLE {beside} RENAME TO {name}")
    else:
        _publish(spark, name, version, bool(partition_by))
    spark.sql(f"COMMENT ON TABLE {name} IS {_quoted(comment)}")
    _published[spark.sparkContext.applicationId, name] = version, files.state(spark, version)
    for old in [v for v in files.subfolders(spark, path) if v.startswith("v")][:-KEPT_VERSIONS]:
        files.delete_folder(spark, f"{path}/{old}")
    return spark.table(name)


def _publish(spark: SparkSession, name: str, version: str, partitioned: bool) -> None:
    """Point the table to the version, in one step if its columns are the same and it has no partitions.

    Otherwise a table is defined beside it and takes its name: two steps of the catalog alone.
    """
    there = spark.catalog.tableExists(name)
    if there and not partitioned and spark.table(name).schema == spark.read.parquet(version).schema:
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(version)}")
        spark.catalog.refreshTable(name)
        return
    beside = f"{name}_{uuid.uuid4().hex[:8]}" if there else name
    spark.sql(f"CREATE TABLE {beside} USING parquet LOCATION {_quoted(version)}")
    if partitioned:
        spark.sql(f"ALTER TABLE {beside} RECOVER PARTITIONS")
    if there:
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"ALTER TABLE {beside} RENAME TO {name}")


def is_stored(spark: SparkSession, name: str) -> bool:
    """Whether the catalog has a table that this application refreshed, and all its files are still there."""
    version, state = _published.get((spark.sparkContext.applicationId, name), ("", ()))
    there = bool(version) and spark.catalog.tableExists(name) and files.exists(spark, version)
    return there and files.state(spark, version) == state


def is_refreshed_in_full(spark: SparkSession, folder: str) -> bool:
    """Whether :func:`refresh_table` owns the folder or the one above it."""
    above = folder.rstrip("/").rpartition("/")[0]
    return any(files.exists(spark, f"{place}/{MARKER}") for place in (folder, above) if place)


def drop_table(spark: SparkSession, name: str, path: str | None = None) -> None:
    """Forget the table and, if its ``path`` is given, remove its files."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if path:
        files.delete_folder(spark, path)


_scope: ContextVar[str | None] = ContextVar("scope", default=None)
_applications: dict[str, str] = {}


def application_folder(spark: SparkSession) -> str:
    """This application's folder among the shared ones; it goes when the driver ends.

    Applications that start at the same time may have the same id: masters count on their own. So the id alone
    does not name the folder.
    """
    application = spark.sparkContext.applicationId
    shared = shared_folder(spark)  # each time: executors may have joined that do not reach it
    if application not in _applications:
        folder = f"{shared}/stridebase/{application}-{uuid.uuid4().hex[:12]}"
        files.delete_at_exit(spark, folder)
        _applications[application] = folder
    elif not _applications[application].startswith(f"{shared}/"):
        raise RuntimeError(f"executors have joined that do not share {_applications[application]}")
    return _applications[application]


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[str]:
    """A folder for the intermediate tables of one run, removed with them at its end.

    What the run returns must be stored or collected inside.
    """
    folder = f"{application_folder(spark)}/run-{uuid.uuid4().hex}"
    files.make_folder(spark, folder)
    token = _scope.set(folder)
    try:
        yield folder
    finally:
        _scope.reset(token)
        files.delete_folder(spark, folder)


def cut_lineage(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written files.

    Unlike a cache, the files survive lost executors, and unlike a row checkpoint they
    are columnar. They belong to the run of :func:`intermediates` around the call, or else to the application.
    """
    spark = df.sparkSession
    folder = application_folder(spark)
    path = f"{_scope.get() or folder}/{label}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
