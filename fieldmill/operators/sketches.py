"""Distinct counts from sketches that are stored and merged, and samples that repeat."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmill.functions.text import quoted

#: Registers of a sketch as a power of two; 2^14 give a standard error of 0.8 % in at most 16 KB.
PRECISION = 14


def distinct_sketches(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], precision: int = PRECISION
) -> DataFrame:
    """One row per key with a sketch of each column's distinct non-null values, as binary.

    A task hands on one sketch per key and column, however many values there are. Store the result by day, file or
    partition, and count over any set of them with :func:`merge_sketches`. Columns are integers, text or binary.
    """
    sketches = [F.hll_sketch_agg(quoted(name), F.lit(precision)).alias(name) for name in columns]
    return df.groupBy(*map(quoted, keys)).agg(*sketches)


def merge_sketches(sketches: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The sketches of the union, per key; merging in any order or twice gives the same."""
    merged = [F.hll_union_agg(quoted(name)).alias(name) for name in columns]
    return sketches.groupBy(*map(quoted, keys)).agg(*merged)


def sketched_counts(sketches: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The sketches replaced by the estimated numbers of distinct values."""
    return sketches.withColumns({name: F.hll_sketch_estimate(F.col(quoted(name))) for name in columns})


def hashed_sample(df: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """The ``k`` rows with the smallest hashes of their keys: a random sample that is the same in every run.

    Each task keeps its own ``k`` smallest, so at most ``k`` rows of a task travel. The sample of a union is the sample
    of the parts' samples, so stored samples can be merged. Null keys count as the text ``-``; equal keys are taken in the
    order of the other columns' text.
    """
    texts = [F.coalesce(F.col(quoted(name)).cast("string"), F.lit("-")) for name in keys]
    rest = [F.col(quoted(name)) for name in df.columns if name not in keys]
    by_rest = [F.to_json(F.struct(*rest))] if rest else []
    return df.orderBy(F.md5(F.concat_ws("|", *texts)), *by_rest).limit(k)
