"""Column names and order."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from fieldmill.functions.text import clean_name, quoted


def refuse_collisions(names: Iterable[str], step: str) -> None:
    """Raise when two names differ at most in case, since Spark could not tell them apart later."""
    counts = Counter(name.lower() for name in names)
    clashing = sorted(name for name, n in counts.items() if n > 1)
    if clashing:
        raise ValueError(f"{step} would give several columns the same name: {clashing}")


def clean_header(df: DataFrame, sort: bool = True, trim: bool = True) -> DataFrame:
    """Repair the header: clean names, alphabetical columns, trimmed text.

    One projection, however wide the table is. Only string columns are trimmed; the others keep
    their type. Names that would collide after cleaning are refused.
    """
    names = [clean_name(name) for name in df.columns]
    refuse_collisions(names, "header cleaning")
    cleaned = df.toDF(*names)
    if sort:
        cleaned = sort_columns(cleaned)
    return trim_strings(cleaned) if trim else cleaned


def sort_columns(df: DataFrame) -> DataFrame:
    """Columns in alphabetical order."""
    return df.select(*[quoted(name) for name in sorted(df.columns)])


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip blanks around the values of every string column."""
    return df.select(
        *[
            F.trim(F.col(quoted(field.name))).alias(field.name)
            if isinstance(field.dataType, StringType)
            else F.col(quoted(field.name))
            for field in df.schema.fields
        ]
    )


def lower_names(df: DataFrame) -> DataFrame:
    """Lower-case column names."""
    names = [name.lower() for name in df.columns]
    refuse_collisions(names, "lower-casing")
    return df.toDF(*names)
