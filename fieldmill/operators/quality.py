"""Row expectations and shape checks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldmill.functions.text import quoted


def expect_or_drop(
    df: DataFrame, name: str, condition: str, observation: Observation | None = None
) -> DataFrame:
    """Keep the rows for which the SQL ``condition`` is true; false and null are dropped.

    With an ``observation`` the numbers ``{name}_rows`` and ``{name}_dropped`` are collected while
    the result is computed, at no extra pass.
    """
    holds = F.coalesce(F.expr(condition), F.lit(False))
    if observation is not None:
        df = df.observe(
            observation,
            F.count(F.lit(1)).alias(f"{name}_rows"),
            F.count(F.when(~holds, 1)).alias(f"{name}_dropped"),
        )
    return df.where(holds)


def expectation_report(df: DataFrame, conditions: Mapping[str, str]) -> DataFrame:
    """One row per named SQL condition: ``(expectation, kept, dropped)``, in a single pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(F.when(F.expr(sql), 1)).alias(f"k{i}") for i, sql in enumerate(conditions.values())],
    )
    rows = [
        F.struct(
            F.lit(name).alias("expectation"),
            F.col(f"k{i}").alias("kept"),
            (F.col("n") - F.col(f"k{i}")).alias("dropped"),
        )
        for i, name in enumerate(conditions)
    ]
    return counts.select(F.inline(F.array(*rows)))


def require_shape(df: DataFrame, shape: StructType, keep_extra: bool = True) -> DataFrame:
    """Raise unless ``df`` has every field of ``shape`` with its type; then put those fields first."""
    actual = {field.name: field.dataType for field in df.schema.fields}
    problems = [
        f"{field.name}: expected {field.dataType.simpleString()}, found "
        + (actual[field.name].simpleString() if field.name in actual else "nothing")
        for field in shape.fields
        if actual.get(field.name) != field.dataType
    ]
    if problems:
        raise TypeError("; ".join(problems))
    extra = [name for name in df.columns if name not in shape.names] if keep_extra else []
    return df.select(*[quoted(name) for name in [*shape.names, *extra]])
