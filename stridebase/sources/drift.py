"""Raw files whose columns are not the declared ones.

A header that differs ends a read, and a file of another shape that happens to have the right number of columns
would shift values. So headers, and the values of a few lines, are compared with the declared schema before
anything is read: files that do not fit are set aside by name and reason, and the others are read. Only the first bytes
of every file are looked at, by a few threads of the driver, which lists the files for a read anyway.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridebase.schema import BRONZE_SCHEMA, RAW_SCHEMA
from stridebase.sources import files
from stridebase.sources.races_csv import read_races_csv

PEEK = 1 << 16  # bytes of a file that are looked at
THREADS = 16
READABLE = 0.5  # of a column's sampled values that its type must be able to hold

_READS: dict[type, Callable[[str], object]] = {T.IntegerType: int, T.LongType: int, T.DoubleType: float}


@dataclass(frozen=True)
class Drift:
    """One way in which a file differs: ``missing``, ``unknown``, ``repeated``, ``order``, ``type`` or ``empty``, and the column."""

    file: str
    reason: str
    column_name: str


def differences(file: str, start: str, schema: T.StructType = RAW_SCHEMA) -> list[Drift]:
    """How a file that begins so differs from the schema; the last line may be cut off and does not count."""
    lines = list(csv.reader(io.StringIO(start)))
    if not lines or not any(lines[0]):
        return [Drift(file, "empty", "")]
    header, declared = lines[0], schema.names
    found = [Drift(file, "missing", c) for c in declared if c not in header]
    found += [Drift(file, "unknown", c) for c in header if c not in declared]
    found += [Drift(file, "repeated", c) for c in declared if header.count(c) > 1]
    if not found and header != declared:
        found = [Drift(file, "order", next(a for a, b in zip(declared, header) if a != b))]
    if found:
        return found
    for i, column in enumerate(schema.fields):
        read = _READS.get(type(column.dataType))
        values = [line[i] for line in lines[1:-1] if len(line) > i and line[i]] if read else []
        if values and sum(map(lambda v: _holds(read, v), values)) < READABLE * len(values):
            found.append(Drift(file, "type", column.name))
    return found


def _holds(read: Callable[[str], object], value: str) -> bool:
    try:
        read(value)
    except ValueError:
        return False
    return True


def inspect(spark: SparkSession, folder: str, schema: T.StructType = RAW_SCHEMA) -> tuple[list[str], list[Drift]]:
    """The files of a folder that fit the schema, and what is wrong with the others. Names that begin with "_" or "."
    are no data, as for Spark's readers."""
    names = [f for f in files.file_names(spark, folder) if not f.startswith(("_", "."))]
    paths = [f"{folder.rstrip('/')}/{name}" for name in names]
    with ThreadPoolExecutor(THREADS) as pool:
        starts = list(pool.map(lambda path: files.first_bytes(spark, path, PEEK).decode("utf-8", "replace"), paths))
    drifts = [d for path, start in zip(paths, starts) for d in differences(path, start, schema)]
    apart = {d.file for d in drifts}
    return [p for p in paths if p not in apart], drifts


def read_fitting_races(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Bronze rows of the files that fit, and a table ``file, reason, column_name`` of those set aside."""
    fitting, drifts = inspect(spark, folder)
    rows = read_races_csv(spark, fitting) if fitting else spark.createDataFrame([], BRONZE_SCHEMA)
    return rows, as_table(spark, drifts)


def as_table(spark: SparkSession, drifts: list[Drift]) -> DataFrame:
    """Differences as rows."""
    columns = ("file", "reason", "column_name")
    rows = [F.struct(*[F.lit(getattr(d, c)).alias(c) for c in columns]) for d in drifts]
    empty = spark.range(0).select(*[F.lit("").alias(c) for c in columns])
    return spark.range(1).select(F.inline(F.array(*rows))) if rows else empty
