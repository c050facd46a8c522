"""Units of event distances and of performances."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import is_number, strip

# Fixed values, in matching order.
EVENT_UNITS = ("km", "mi", "h")
PROFILE_UNITS = ("km", "mi", "h", "d")
UNKNOWN_UNIT = "SKRÄP"


def ending_unit(text: Column, units=PROFILE_UNITS) -> Column:
    """First unit the text ends with, as written: no trimming, no case folding."""
    return F.coalesce(*[F.when(text.endswith(unit), F.lit(unit)) for unit in units])


def event_unit(distance: Column, units=EVENT_UNITS) -> Column:
    """First unit the trimmed, lower-cased distance ends with; NULL if none."""
    return ending_unit(F.lower(strip(distance)), units)


def has_unit(distance: Column, unit: str) -> Column:
    """``event_unit(distance) == unit`` with the text prepared once: no unit ends in another."""
    return F.lower(strip(distance)).endswith(unit)


def performance_unit(performance: Column) -> Column:
    """Strict: a clock text is ``h``, a bare number is ``km``, anything else NULL."""
    return F.when(performance.contains(":"), F.lit("h")).when(is_number(performance), F.lit("km"))


def performance_unit_loose(performance: Column) -> Column:
    """Loose: a clock text is ``h`` and everything else, NULL included, is ``km``."""
    return F.when(performance.contains(":"), F.lit("h")).otherwise(F.lit("km"))


def is_valid_pair(event: Column, performance: Column) -> Column:
    """Distance events are timed, timed events are measured in km. Never NULL."""
    timed = event.isin("km", "mi") & (performance == "h")
    measured = (event == "h") & (performance == "km")
    return F.coalesce(timed | measured, F.lit(False))
