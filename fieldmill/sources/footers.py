"""Counts and extremes from the footers of Parquet files, without reading rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from fieldmill.functions.text import quoted


def _pushing_session(spark: SparkSession) -> SparkSession:
    """A session of its own settings in which Parquet scans answer counts and extremes from their footers."""
    own = spark.newSession()
    listed = own.conf.get("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(s for s in listed.split(",") if s.strip() != "parquet"))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def footer_stats(
    spark: SparkSession, path: str, counts: Sequence[str] = (), extremes: Sequence[str] = ()
) -> DataFrame:
    """One row: ``n``, ``n_<column>`` (values that aren't null) of ``counts``, ``min_`` and ``max_`` of ``extremes``.

    Only the footers of the files below ``path`` are read, by as many tasks as there are files to share out. ``extremes`` are
    numbers or dates: footers may hold shortened texts, and a least double of zero may be a negative zero. Counts and extremes of files without statistics are an error.
    """
    table = _pushing_session(spark).read.parquet(path)
    columns = [F.count("*").alias("n")]
    columns += [F.count(quoted(name)).alias(f"n_{name}") for name in counts]
    for name in extremes:
        columns += [F.min(quoted(name)).alias(f"min_{name}"), F.max(quoted(name)).alias(f"max_{name}")]
    return table.agg(*columns)


def filled_columns(spark: SparkSession, path: str) -> list[str]:
    """The columns of a stored table that hold a value, in order. Structs and arrays count as holding one."""
    table = spark.read.parquet(path)
    flat = [f.name for f in table.schema if not isinstance(f.dataType, (StructType, ArrayType, MapType, VariantType))]
    if not flat:
        return table.columns
    known = footer_stats(spark, path, counts=flat).first().asDict()
    return [name for name in table.columns if name not in flat or known[f"n_{name}"]]
