"""Whitespace and number grammar shared by the column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as whitespace when a raw field is trimmed.
# Spark's one-argument trim removes the plain space only.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# What counts as a number. A bare cast is too lenient, it also takes the
# JVM's "39d" and "0x1p3".
INTEGER = r"[+-]?[0-9]+"
FINITE_NUMBER = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
ANY_NUMBER = rf"^(?:{FINITE_NUMBER}|[+-]?(?i:inf|infinity|nan))$"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def is_number(text: Column) -> Column:
    return strip(text).rlike(ANY_NUMBER)


def before(text: Column, delimiter: str) -> Column:
    """The text up to the first delimiter, all of it if there is none."""
    return F.substring_index(text, delimiter, 1)


def second_field(text: Column, delimiter: str) -> Column:
    """Between the first and the second delimiter."""
    return F.substring_index(F.substring_index(text, delimiter, 2), delimiter, -1)


def whole_number(text: Column) -> Column:
    """Integer value, surrounding blanks allowed; NULL where it is none or exceeds 32 bits.

    The pattern goes first because a failing ``try_cast`` to an integer costs an exception.
    """
    return F.when(text.rlike(rf"^\s*{INTEGER}\s*$"), text.try_cast("int"))
