"""Structs and arrays to columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmill.functions.arrays import element_count
from fieldmill.functions.text import quoted
from fieldmill.operators.headers import refuse_collisions


def flatten_struct(df: DataFrame, column: str) -> DataFrame:
    """Replace a struct column by its fields, placed last. Clashing names are refused."""
    others = [name for name in df.columns if name != column]
    inner = df.schema[column].dataType.names
    refuse_collisions(others + inner, f"flattening {column}")
    return df.select(
        *[quoted(name) for name in others],
        *[F.col(f"{quoted(column)}.{quoted(name)}").alias(name) for name in inner],
    )


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    """Put ``prefix`` before every column name."""
    return df.toDF(*[prefix + name for name in df.columns])


def positions_to_columns(
    df: DataFrame,
    column: str,
    names: Sequence[str],
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """Name the slots of an array column; slots beyond its end are null.

    The other columns stay in front. ``types`` casts chosen slots, unreadable values become null.
    """
    types = types or {}
    slots = []
    for i, name in enumerate(names):
        value = F.get(F.col(quoted(column)), F.lit(i))
        slots.append((value.try_cast(types[name]) if name in types else value).alias(name))
    return df.select(*[quoted(name) for name in df.columns if name != column], *slots)


def array_to_columns(df: DataFrame, column: str, prefix: str, n: int | None = None) -> DataFrame:
    """Add ``prefix0 … prefix{n-1}`` from an array column given by name or path (``visits.age``).

    Without ``n`` the longest array in the data decides, found by one job that returns one number. With
    ``n``, what lies beyond is kept as an array in ``prefix_rest``, null where nothing does. Where arrays may be
    very long, :func:`array_positions` gives rows instead of columns.
    """
    values = F.col(column)
    rest = []
    if n is None:
        n = df.agg(F.max(element_count(values))).first()[0] or 0
    else:
        beyond = F.slice(values, n + 1, F.greatest(F.size(values) - n, F.lit(1)))
        rest = [F.when(F.size(values) > n, beyond).alias(f"{prefix}_rest")]
    return df.select("*", *[F.get(values, F.lit(i)).alias(f"{prefix}{i}") for i in range(n)], *rest)


def array_positions(df: DataFrame, column: str, keys: Sequence[str], value: str = "value") -> DataFrame:
    """One row ``(keys, position, value)`` per array element, positions from 0; no array, no row."""
    return df.select(*map(quoted, keys), F.posexplode(F.col(column)).alias("position", value))
