"""Column profiles. Each reads the data once, whatever the number of columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that a cast to double may accept, type letters and hex included.
CASTABLE = (
    r"^[\x00-\x20]*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?[fFdD]?"
    r"|0[xX][0-9a-fA-F.]+[pP][+-]?[0-9]+[fFdD]?|(?i:inf|infinity|nan))[\x00-\x20]*$"
)


def _long_form(
    df: DataFrame, columns: Sequence[str], measures: dict[str, Callable[[str], Column]], totals: dict[str, Column]
) -> DataFrame:
    """One row per column with the given measures; ``totals`` repeat on every row.

    All measures come from one aggregate whose single row is turned into long form.
    """
    row = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("column"),
                    *[measure(name).alias(label) for label, measure in measures.items()],
                )
                for name in columns
            ]
        ).alias("profile"),
        *[total.alias(label) for label, total in totals.items()],
    )
    return row.select(*totals, F.inline("profile"))


def null_counts(df: DataFrame) -> DataFrame:
    """NULLs per column, one wide row."""
    return df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns])


def null_summary(df: DataFrame) -> DataFrame:
    """``column, null_count, null_pct`` with two decimals."""
    profile = _long_form(
        df,
        df.columns,
        {"null_count": lambda name: F.count_if(F.col(name).isNull())},
        {"rows": F.count(F.lit(1))},
    )
    return profile.select("column", "null_count", percent("null_count", "rows", 2).alias("null_pct"))


def null_or_blank_pct(df: DataFrame) -> DataFrame:
    """``column, nulls, pct`` counting empty text as missing, one decimal, most first."""
    profile = _long_form(
        df,
        df.columns,
        {"nulls": lambda name: F.count_if(F.col(name).isNull() | (F.col(name).cast("string") == ""))},
        {"rows": F.count(F.lit(1))},
    )
    return profile.select("column", "nulls", percent("nulls", "rows", 1).alias("pct")).orderBy(
        F.desc("pct"), "column"
    )


def percent(part: str, whole: str, digits: int) -> Column:
    """Rounded percentage; NULL of an empty whole."""
    return F.round(F.try_divide(F.col(part) * 100.0, F.col(whole)), digits)


def describe(df: DataFrame) -> DataFrame:
    """``column, count, mean, stddev, min, max`` for every column.

    The figures of Spark's own ``describe``, in long form and from one aggregate. Mean and
    deviation of text are those of the values that Spark can cast to a number ("6d" is
    6); least and greatest are given as text.
    """
    text_columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    numbers = df.withColumns({f"{name}_number": _castable(F.col(name)) for name in text_columns})

    def number(name: str) -> Column:
        return F.col(f"{name}_number" if name in text_columns else name).cast("double")

    return _long_form(
        numbers,
        df.columns,
        {
            "count": F.count,
            "mean": lambda name: F.avg(number(name)),
            "stddev": lambda name: F.stddev(number(name)),
            "min": lambda name: F.min(name).cast("string"),
            "max": lambda name: F.max(name).cast("string"),
        },
        {},
    )


def _castable(text: Column) -> Column:
    """Number that Spark's cast reads from the text. The pattern goes first because a
    failing cast costs an exception, and most text is no number; before it goes the first
    character, which alone tells most texts apart: a number begins with a sign up to "9" or as inf and nan do."""
    first = F.ascii(text)
    return F.when((first <= ord("9")) | first.isin(*map(ord, "iInN")), F.when(text.rlike(CASTABLE), text.try_cast("double")))


def value_counts(df: DataFrame, column: str, top_n: int | None = 20, name: str = "count") -> DataFrame:
    """Most frequent values first, ties by value; all of them with ``top_n=None``."""
    counts = (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.desc(name), F.asc_nulls_first(column))
    )
    return counts if top_n is None else counts.limit(top_n)


def unique_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, unique_values`` with NULL as a value, from one scan and one shuffle.

    The values of all columns share one ``distinct``, which drops repeats in each task
    before the shuffle.
    """
    return (
        df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])))
        .distinct()
        .groupBy("column")
        .agg(F.count(F.lit(1)).alias("unique_values"))
    )
