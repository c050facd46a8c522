"""Session settings and the shared folder that intermediate tables live in."""

from __future__ import annotations

import os
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from stridebase.sources import files

# Settings the jobs are tuned for. They go on the builder, so a cluster's own
# spark-defaults still decide master, memory and the checkpoint folder.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
}

SHARED_MOUNT = "spark.stridebase.sharedMount"

ROUNDS, PAUSE_MS = 10, 200  # in which executors are asked for the folder, and how long a task holds its place in one

_local_folder: dict[str, str] = {}
# Application and folder -> the executors that were there when all were seen to share it.
_sharing: dict[tuple[str, str], set[str]] = {}


def build_session(app_name: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may run without it; there the driver is the one executor
    and gets a temporary folder. On a cluster, a folder in a machine's own file system is taken only if all executors are seen
    to share it with the driver, also those that join later, or if ``spark.stridebase.sharedMount`` says that all machines
    mount it. If it is not, or none is named, the warehouse's folder is taken if executors are seen to share that.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    local = context.master.startswith("local")
    mounted = spark.conf.get(SHARED_MOUNT, "false").lower() == "true"
    if folder and (local or mounted or _reached(spark, folder)):
        return folder.rstrip("/")
    if not local:
        if warehouse := spark.conf.get("spark.sql.warehouse.dir", None):
            files.make_folder(spark, warehouse)  # as Spark does with its first database
            if _reached(spark, warehouse):
                return warehouse.rstrip("/")
        if folder:
            raise RuntimeError(f"{folder} is on a machine's own disk, or not all executors were seen to share it; set {SHARED_MOUNT} if all machines mount it")
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    if context.applicationId not in _local_folder:
        # executors of a local cluster have a working directory of their own, and TMPDIR may be relative to it
        _local_folder[context.applicationId] = os.path.realpath(tempfile.mkdtemp(prefix="stridebase-"))
    return _local_folder[context.applicationId]


def _reached(spark: SparkSession, folder: str) -> bool:
    """Whether the folder is in no machine's own file system, or else there and shared by all executors that are known now."""
    if files.scheme(spark, folder) != "file":
        return True
    asked = spark.sparkContext.applicationId, folder
    if _executors(spark) <= _sharing.get(asked, set()):
        return True
    if not files.exists(spark, folder):
        return False
    seen: set[str] = set()
    for _ in range(ROUNDS):
        known = _executors(spark)
        found = _sharers(spark, folder, 2 * max(len(known), spark.sparkContext.defaultParallelism))
        if not found:
            return False
        seen |= found
        if len(seen) >= len(known) - 1:  # without the driver
            _sharing[asked] = known
            return True
    return False


def _executors(spark: SparkSession) -> set[str]:
    """Host and port of the driver and of the executors."""
    return {f"{info.host()}:{info.port()}" for info in spark._jsc.sc().statusTracker().getExecutorInfos()}


def _sharers(spark: SparkSession, folder: str, tasks: int) -> set[str]:
    """The processes that wrote one row in each of so many tasks; none if not all of the rows can be read back."""
    place = f"{folder.rstrip('/')}/stridebase/asked-{uuid.uuid4().hex}"
    process = F.concat_ws(
        " ",
        F.try_reflect(F.lit("java.net.InetAddress"), F.lit("getLocalHost")),
        F.reflect(F.lit("java.lang.ProcessHandle"), F.lit("current")),
        F.try_reflect(F.lit("java.lang.System"), F.lit("getProperty"), F.lit("sun.java.command")),  # names the executor
    )
    pause = F.reflect(F.lit("java.lang.Thread"), F.lit("sleep"), F.lit(PAUSE_MS).cast("long"))  # else a few executors take all tasks
    try:
        spark.range(0, tasks, 1, tasks).select(process.alias("process"), pause.alias("pause")).write.parquet(place)
        rows = spark.read.schema("process string, pause string").parquet(place).collect()
    except (PySparkException, Py4JError):
        return set()
    finally:
        files.delete_folder(spark, place)
    return {row["process"] for row in rows} if len(rows) == tasks else set()
