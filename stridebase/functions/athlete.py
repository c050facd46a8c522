"""Athlete attributes."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
GENDERS = ("M", "F", "W")


def upper_code(text: Column) -> Column:
    return F.upper(F.trim(text))


def known_gender(text: Column) -> Column:
    code = upper_code(text)
    return F.when(code.isin(*GENDERS), code)


def age_in(year: Column, year_of_birth: Column) -> Column:
    """Difference of the years, unchecked; NULL on 32-bit overflow instead of a failed job."""
    return F.try_subtract(year, year_of_birth)
