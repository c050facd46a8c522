"""Average speeds given as text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import before

# Fixed values.
NOT_DIGIT_OR_DOT = "[^0-9.]+"


def speed_digits(speed: Column) -> Column:
    """Number left after dropping all but digits and dots; NULL if that is no number."""
    return F.nullif(F.regexp_replace(speed, NOT_DIGIT_OR_DOT, ""), F.lit("")).try_cast("float")


def leading_number(text: Column) -> Column:
    """Number before the first space, as stored; NULL if that is no number."""
    return before(text, " ").try_cast("float")
