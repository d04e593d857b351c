"""Null markers, tolerant casts and empty columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from fieldmill.functions.text import quoted


def na_to_null(
    df: DataFrame, markers: Sequence[str] = ("NA",), columns: Sequence[str] | None = None
) -> DataFrame:
    """Turn marker texts into null, in all string columns or in those given."""
    wanted = set(df.columns if columns is None else columns)
    projected = []
    for field in df.schema.fields:
        value = F.col(quoted(field.name))
        if field.name in wanted and isinstance(field.dataType, StringType):
            value = F.when(~value.isin(*markers), value).alias(field.name)
        projected.append(value)
    return df.select(*projected)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Project to the columns of ``types``, in that order, each cast; unreadable values become null."""
    return df.select(
        *[F.col(quoted(name)).try_cast(dtype).alias(name) for name, dtype in types.items()]
    )


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Drop the columns that hold no value at all, keeping the order. Runs one job.

    One aggregate over the whole table tells which columns hold something. The input is read again by
    whoever uses the result, so give a stored table. A table without rows loses every column.
    """
    known = [F.max(F.col(quoted(name)).isNotNull()) for name in df.columns]
    filled = df.agg(*known).first() if known else []
    return df.select(*[quoted(name) for name, holds in zip(df.columns, filled) if holds])
