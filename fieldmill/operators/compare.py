"""Comparing two tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmill.functions.text import quoted
from fieldmill.sources.shared import stored

BUCKETS = 1_024


def frame_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with ``left_copies`` and ``right_copies``.

    Columns pair up by position and take their names from ``left``. Both tables are counted in one
    grouped pass; an empty result means that they hold the same rows equally often.
    """
    names = left.columns
    marked = left.select("*", F.lit(1).alias("__l"), F.lit(0).alias("__r")).union(
        right.select("*", F.lit(0), F.lit(1))
    )
    return (
        marked.groupBy(*[quoted(name) for name in names])
        .agg(F.sum("__l").alias("left_copies"), F.sum("__r").alias("right_copies"))
        .where(F.col("left_copies") != F.col("right_copies"))
    )


def _row_hash(df: DataFrame, salt: int) -> Column:
    """A 64-bit hash of a row; a null counts as a value of its own."""
    parts = [part for name in df.columns for part in (F.col(quoted(name)).isNull(), F.col(quoted(name)))]
    return F.xxhash64(F.lit(salt), *parts)


def bucket_digests(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n, first, second)``: rows by hash bucket, their number and two sums of hashes that don't depend on order."""
    hashes = df.select(_row_hash(df, 0).alias("a"), _row_hash(df, 1).alias("b"))
    exact = "decimal(38,0)"
    return hashes.groupBy(F.pmod("a", F.lit(buckets)).alias("bucket")).agg(
        F.count("*").alias("n"), F.sum(F.col("a").cast(exact)).alias("first"), F.sum(F.col("b").cast(exact)).alias("second")
    )


def unequal_buckets(left: DataFrame, right: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket)`` of the buckets whose digests differ; tables that hold the same rows have none."""
    sides = [
        bucket_digests(side, buckets).select("bucket", F.struct("n", "first", "second").alias("digest"), F.lit(sign).alias("sign"))
        for side, sign in ((left, 1), (right, -1))
    ]
    return (
        sides[0]
        .union(sides[1])
        .groupBy("bucket", "digest")
        .agg(F.sum("sign").alias("both"))
        .where("both <> 0")
        .select("bucket")
        .distinct()
    )


def table_difference(left: DataFrame, right: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """:func:`frame_difference` of two stored tables, most of which are expected to be equal.

    A first pass shuffles one digest per bucket and task; then only the rows of unequal buckets are read again and
    compared. Columns pair up by position and must have equal types, none of them a map. Two buckets of different rows
    pass as equal only if their numbers of rows and two sums of 64-bit hashes agree.
    """
    right = right.toDF(*left.columns)
    differ = stored(unequal_buckets(left, right, buckets), "unequal").withColumnRenamed("bucket", "__bucket")

    def rest(side: DataFrame) -> DataFrame:
        where = F.pmod(_row_hash(side, 0), F.lit(buckets)) == F.col("__bucket")
        return side.join(differ, where, "left_semi")

    return frame_difference(rest(left), rest(right))
