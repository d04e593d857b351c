"""Array expressions that are null-safe in every ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def element_count(values: Column) -> Column:
    """Number of elements; a null array has none."""
    return F.when(values.isNull(), 0).otherwise(F.size(values))


def array_sum(values: Column, dtype: str = "bigint") -> Column:
    """Sum of an array, null elements counting as zero; a null array gives null.

    For an array of structs pass the field: ``array_sum(F.col("visits.age"))``.
    """
    zero = F.lit(0).cast(dtype)
    return F.aggregate(values, zero, lambda total, x: total + F.coalesce(x.cast(dtype), zero))


def array_mean(values: Column, dtype: str = "bigint") -> Column:
    """Sum divided by the number of elements, null elements included; null without elements."""
    return F.try_divide(array_sum(values, dtype).cast("double"), element_count(values))
