"""Finishing times: text to seconds and back."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import FINITE_NUMBER, INTEGER, before, second_field, strip, whole_number

# Fixed values.
UNIT_SUFFIXES = ("h", "km", "mi")
DAY_WORD = "day"
SECONDS_PER_DAY, SECONDS_PER_HOUR, SECONDS_PER_MINUTE = 86400, 3600, 60
CLOCK = rf"^\s*{INTEGER}\s*:\s*{INTEGER}\s*:\s*{FINITE_NUMBER}\s*$"


def without_unit(performance: Column) -> Column:
    """The performance without a unit at its end. Blanks before the unit stay; the readers
    of times and of numbers ignore them."""
    bare = performance
    for suffix in UNIT_SUFFIXES:
        shorter = F.left(performance, F.length(performance) - len(suffix))
        bare = F.when(performance.endswith(suffix), shorter).otherwise(bare)
    return bare


def first_word(performance: Column) -> Column:
    """The performance without unit, up to its first space."""
    return before(strip(without_unit(performance)), " ")


def with_seconds(df: DataFrame, performance: Column, name: str) -> DataFrame:
    """Add ``name``: the seconds of ``[N day(s), ]H:MM:SS``, NULL for any other text.

    Fractions of a second are cut off, minutes and seconds above 59 are taken as they
    are, and a total or part beyond 32 bits is NULL, so the 64-bit arithmetic cannot
    overflow. Any whitespace may surround the text, ASCII blanks its parts.

    The steps are columns of their own because each is used several times by the next:
    Spark keeps such projections apart and computes every step once per row.
    """
    text, days, clock = (F.col(f"{name}_{step}") for step in ("text", "days", "clock"))
    has_days = text.contains(DAY_WORD)
    hours, minutes, seconds = before(clock, ":"), second_field(clock, ":"), F.substring_index(clock, ":", -1)
    total = (
        days.cast("bigint") * SECONDS_PER_DAY
        + hours.try_cast("int").cast("bigint") * SECONDS_PER_HOUR
        + minutes.try_cast("int").cast("bigint") * SECONDS_PER_MINUTE
        + seconds.try_cast("double").try_cast("int").cast("bigint")
    )
    return (
        df.withColumn(f"{name}_text", strip(performance))
        .withColumns(
            {
                f"{name}_days": F.when(has_days, whole_number(before(before(text, ","), " "))).otherwise(F.lit(0)),
                f"{name}_clock": F.when(has_days, second_field(text, ",")).otherwise(text),
            }
        )
        .withColumn(name, F.when(clock.rlike(CLOCK), total).try_cast("int"))
        .drop(f"{name}_text", f"{name}_days", f"{name}_clock")
    )


def seconds_to_clock(seconds: Column) -> Column:
    """``HH:MM:SS``; hours are not limited to two digits."""
    hours = F.floor(seconds / SECONDS_PER_HOUR)
    rest = F.pmod(seconds, F.lit(SECONDS_PER_HOUR))
    return F.when(
        seconds.isNotNull(),
        F.format_string(
            "%02d:%02d:%02d",
            hours,
            F.floor(rest / SECONDS_PER_MINUTE),
            F.pmod(rest, F.lit(SECONDS_PER_MINUTE)),
        ),
    )
