"""One key holds a third of the rows: results stay whole, and no task gets the whole key."""

from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from fieldmill import operators as op

N = 60_000


@pytest.fixture
def skewed(spark):
    """A third of the rows share key 0; the rest spread over 1,000 keys."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(1 + F.pmod(F.xxhash64("id"), F.lit(1000)))
    return spark.range(0, N, 1, 6).select(
        key.cast("bigint").alias("k"), (F.col("id") % 97).alias("v"), "id"
    )


@pytest.fixture
def small_limits(spark):
    """Shuffled joins, with a partition counted as skewed from a few kilobytes on."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def executed_plan(frame) -> str:
    frame.write.format("noop").mode("overwrite").save()
    frame.collect()
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain("simple")
    return out.getvalue()


def test_group_stats_split_the_heavy_key(spark, skewed, small_limits):
    stats = op.group_stats(skewed, ["k"], "v", "v")
    assert "skew=true" in executed_plan(stats)
    assert stats.count() == N
    heavy = stats.where("k = 0").select("vmin", "vmax", "vsum").distinct().collect()
    expected = sum(i % 97 for i in range(0, N, 3))
    assert [tuple(row) for row in heavy] == [(0, 96, expected)]


def test_shared_first_places_are_split(spark, skewed, small_limits):
    level = skewed.withColumn("v", F.when(F.col("k") == 0, 5).otherwise(F.col("v")))
    best = op.top_per_group(level, ["k"], "v")
    assert "skew=true" in executed_plan(best)
    assert best.where("k = 0").count() == N // 3


def test_lookups_split_the_heavy_key(spark, skewed, small_limits):
    names = spark.range(0, 500).select(F.col("id").alias("key"), F.concat(F.lit("n"), "id").alias("name"))
    looked_up = op.lookup_roles(skewed, names, "key", "name", {"k": "city"})
    assert "skew=true" in executed_plan(looked_up)
    assert looked_up.count() == N
    assert looked_up.where("k = 0 and city = 'n0'").count() == N // 3
    assert looked_up.where("k > 499 and city is not null").count() == 0


def test_a_heavy_right_side_is_split(spark, skewed, small_limits):
    bids = spark.range(0, 1200).select(F.col("id").alias("bid"), F.concat(F.lit("os"), "id").alias("os"))
    bids = bids.union(spark.createDataFrame([(None, "no id"), (None, "no id")], "bid bigint, os string"))
    many = skewed.union(skewed.limit(50).withColumn("k", F.lit(None).cast("bigint")))
    joined = op.left_join_many(bids, many, "bid", "k")
    assert "skew=true" in executed_plan(joined)
    plain = bids.join(many, bids.bid == many.k, "left")
    assert joined.count() == plain.count()
    assert op.frame_difference(joined, plain).count() == 0


def test_sorts_spread_rows_that_are_equal(spark, skewed):
    from fieldmill.plans import births

    winners = skewed.select(
        F.lit("ann").alias("first_name_clean"), F.lit(7).alias("count"), F.lit("2007").alias("year"), "v"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    for ordered in (op.order_split(winners, "year", "first_name_clean"), births.top_names(winners)):
        parts = ordered.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert parts < N / 2
    winners.withColumn("sid", F.monotonically_increasing_id()).createOrReplaceTempView("skewed_births")
    ordered = births.top_names_sql(spark, "skewed_births")
    assert ordered.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < N / 2
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_mode_and_distinct_of_a_heavy_key(spark, skewed):
    from collections import Counter

    mode = {r["k"]: (r["v"], r["n"]) for r in op.mode_per_group(skewed, ["k"], "v").collect()}
    counts = Counter(i % 97 for i in range(0, N, 3))
    best = min(counts.items(), key=lambda item: (-item[1], item[0]))
    assert mode[0] == best
    assert op.distinct_values(skewed, ["k", "v"]).count() == 1001 + 97
