"""The four different truth tests the intake rules use; they are not interchangeable."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Any character that is not white space, counting the Unicode spaces as blank.
NON_BLANK = r"[^\t-\r\x1c-\x20\x{85}\p{Z}]"


def is_empty(c: Column) -> Column:
    """NULL or the empty string."""
    return c.isNull() | (c == "")


def non_empty(c: Column) -> Column:
    return ~is_empty(c)


def non_blank(c: Column) -> Column:
    """Holds at least one character that is not white space."""
    return F.coalesce(c.rlike(NON_BLANK), F.lit(False))


def guard_open(title: Column, date: Column) -> Column:
    """A row still wants tags: no title, and not both title and date present."""
    return is_empty(title) & ~(title.isNotNull() & date.isNotNull())
