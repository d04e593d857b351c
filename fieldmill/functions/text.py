"""Text expressions and column-name helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters removed from names and grouping keys.
REMOVED_CHARS = ".$|,;'# \t\n\x0b\f\r"


def quoted(name: str) -> str:
    """``name`` as an identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def clean_name(name: str) -> str:
    """Lower-case a column name and drop blanks and the removed punctuation."""
    return name.lower().translate(str.maketrans("", "", REMOVED_CHARS))


def clean_chars(value: Column) -> Column:
    """The same cleaning for the values of a column; null stays null."""
    return F.translate(F.lower(value), REMOVED_CHARS, "")


def route_label(origin: Column, dest: Column) -> Column:
    """``origin-dest``, null when either end is unknown."""
    return F.concat(origin, F.lit("-"), dest)
