"""Race results as CSV: reader and writer with the raw headers."""

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridebase.schema import BRONZE_COLUMNS, BRONZE_TO_RAW, RAW_SCHEMA, RAW_TO_BRONZE

REJECTED = "rejected_line"


def _reader(spark: SparkSession) -> DataFrameReader:
    """The schema is given, so there is no inference pass over the data, and
    ``enforceSchema=False`` makes a file with other headers fail instead of shifting columns."""
    return spark.read.option("header", True).option("enforceSchema", False)


def read_races_csv(spark: SparkSession, path: str | list[str], fail: bool = False) -> DataFrame:
    """Bronze rows from CSV files with header.

    A value that its column cannot hold, and a column that a short line lacks, are NULL; such
    lines are listed by :func:`rejected_lines`. With ``fail`` the first of them ends the job.
    """
    reader = _reader(spark).schema(RAW_SCHEMA).option("mode", "FAILFAST" if fail else "PERMISSIVE")
    return reader.csv(path).withColumnsRenamed(RAW_TO_BRONZE)


def with_rejected_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Bronze rows and, in ``rejected_line``, the text of every line that could not be read in full."""
    schema = T.StructType([*RAW_SCHEMA.fields, T.StructField(REJECTED, T.StringType())])
    rows = _reader(spark).schema(schema).option("columnNameOfCorruptRecord", REJECTED).csv(path)
    return rows.withColumnsRenamed(RAW_TO_BRONZE).select(*BRONZE_COLUMNS, REJECTED)


def rejected_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The lines of which :func:`read_races_csv` loses something, their file, and what was read of them."""
    rows = with_rejected_lines(spark, path).where(F.col(REJECTED).isNotNull())
    return rows.select(F.input_file_name().alias("file"), REJECTED, *BRONZE_COLUMNS)


def count_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Number of lines, of those among them that could not be read in full, and of values read."""
    read = sum((F.col(c).isNotNull().cast("long") for c in BRONZE_COLUMNS), F.lit(0))
    return with_rejected_lines(spark, path).agg(
        F.count(F.lit(1)).alias("lines"), F.count(REJECTED).alias("rejected"), F.sum(read).alias("values_read")
    )


def write_races_csv(races: DataFrame, path: str) -> None:
    """The inverse of :func:`read_races_csv`; padding around values is kept."""
    (
        races.withColumnsRenamed(BRONZE_TO_RAW)
        .write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
