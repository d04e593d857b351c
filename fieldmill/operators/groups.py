"""Grouped and ranked results.

Every operator aggregates partially before it shuffles, so a key that holds a large share of the
rows reaches its final task as a handful of partial results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldmill.functions.text import quoted
from fieldmill.sources.shared import stored


def distinct_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The distinct non-null values of each column as rows ``(column, value)``, values as text."""
    names = list(df.columns if columns is None else columns)
    pairs = [
        F.struct(F.lit(name).alias("column"), F.col(quoted(name)).cast("string").alias("value"))
        for name in names
    ]
    return df.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull()).distinct()


def distinct_counts(df: DataFrame, column: str) -> DataFrame:
    """One row: exact distinct values, the same with null as a value, and the sketched estimate.

    All three are counted over the distinct values, so the input is read once and a task hands on one sketch,
    not one for each value.
    """
    values = df.select(F.col(quoted(column)).alias("value")).distinct()
    return values.agg(
        F.count("value").alias("n_distinct"),
        F.count("*").alias("n_distinct_with_null"),
        F.approx_count_distinct("value").alias("n_approx"),
    )


def order_split(df: DataFrame, *order: str | Column) -> DataFrame:
    """Sort so that rows equal in ``order`` may still be spread over several tasks.

    Their place in the input tells them apart.
    """
    numbered = df.withColumn("__row", F.monotonically_increasing_id())
    return numbered.orderBy(*order, "__row").drop("__row")


def _join_groups(
    df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column], *conditions: Column
) -> DataFrame:
    """Aggregate per group and join the result back to the rows of the group; null keys match.

    The aggregate is stored first. So Spark knows its true size when it plans the join: few groups
    are broadcast and the rows of ``df`` stay where they are; for many groups the join is shuffled, and
    adaptive execution may split a heavy key. Planned in one piece, the size would be unknown and
    the rows would be shuffled in either case.
    """
    names = {key: f"__{key}" for key in keys}
    grouped = df.groupBy(*[F.col(quoted(key)).alias(name) for key, name in names.items()])
    groups = stored(grouped.agg(*aggregates), "groups")
    on = [F.col(quoted(key)).eqNullSafe(F.col(quoted(name))) for key, name in names.items()]
    return df.join(groups, [*on, *conditions]).drop(*names.values())


def group_stats(
    df: DataFrame, keys: Sequence[str], value: str, prefix: str, decimals: int = 2
) -> DataFrame:
    """Add min, max, mean and sum of ``value`` over each row's group to every row.

    What a window over the whole group would give, computed as a grouped aggregate joined back, so
    that no task has to hold or sort a group. Null keys form a group. Runs the aggregation as a job;
    the input is read twice and must be deterministic.
    """
    stats = [
        F.min(quoted(value)).alias(f"{prefix}min"),
        F.max(quoted(value)).alias(f"{prefix}max"),
        F.round(F.avg(quoted(value)), decimals).alias(f"{prefix}avg"),
        F.sum(quoted(value)).alias(f"{prefix}sum"),
    ]
    return _join_groups(df, keys, stats)


def top_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    descending: bool = True,
    ties: str = "all",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """The first row of each group by ``order``, nulls last.

    ``ties="all"`` keeps every row that shares the first place, as ``rank() = 1`` would. The best
    value per group is aggregated by a job and joined back, so that a first place shared by very many
    rows is not gathered in one task; the input is read twice and must be deterministic.

    ``ties="one"`` keeps one row, as ``row_number() = 1`` would, and needs a ``tiebreak``, so that the
    choice does not depend on the row order. Each task keeps only its own leader of a group before
    the shuffle.
    """
    value = F.col(quoted(order))
    if ties == "all":
        best = (F.max(value) if descending else F.min(value)).alias("__best")
        return _join_groups(df, keys, [best], value.eqNullSafe(F.col("__best"))).drop("__best")
    if ties != "one":
        raise ValueError("ties must be 'all' or 'one'")
    if not tiebreak:
        raise ValueError("ties='one' needs a tiebreak")
    ranking = [value.desc_nulls_last() if descending else value.asc_nulls_last()]
    ranking += [F.col(quoted(name)).asc_nulls_last() for name in tiebreak]
    place = F.row_number().over(Window.partitionBy(*map(quoted, keys)).orderBy(*ranking))
    return df.withColumn("__place", place).where(F.col("__place") == 1).drop("__place")


def mode_per_group(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The most frequent non-null ``value`` of each group with its count ``n``; least value on a tie."""
    counted = (
        df.where(F.col(quoted(value)).isNotNull())
        .groupBy(*map(quoted, keys), quoted(value))
        .agg(F.count("*").alias("n"))
    )
    return top_per_group(counted, keys, "n", ties="one", tiebreak=[value])


def ratio_where(df: DataFrame, predicate: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Rows that pass ``predicate``, all rows, and the share of the first, overall or per key."""
    passed = F.sum(F.when(predicate, 1).otherwise(0))
    return df.groupBy(*keys).agg(
        F.coalesce(passed, F.lit(0)).alias("n_passed"),
        F.count("*").alias("n"),
        F.try_divide(passed.cast("double"), F.count("*")).alias("ratio"),
    )


def top_k(df: DataFrame, order: Sequence[Column], k: int, tiebreak: Sequence[Column]) -> DataFrame:
    """The first ``k`` rows by ``order``; ``tiebreak`` makes the choice repeatable."""
    return df.orderBy(*order, *tiebreak).limit(k)
