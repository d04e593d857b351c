from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from fieldmill.operators import (
    bucket_digests,
    distinct_sketches,
    drop_all_null_columns,
    frame_difference,
    hashed_sample,
    merge_sketches,
    sketched_counts,
    table_difference,
    unequal_buckets,
)
from fieldmill.plans import bids, births
from fieldmill.sources import (
    bucketed_table,
    drop_table,
    filled_columns,
    footer_stats,
    new_shared_folder,
    read_delimited_apart,
    read_document_records,
    read_json_lines_apart,
    stored,
    stored_path,
)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_document_is_read_by_several_tasks(spark, tmp_path):
    records = [[f"row-{i}", i, None, "a,\\n[b] {c}" if i % 3 else "é"] for i in range(4_000)]
    text = '{"meta": {"n": [1]}, "data": [\n' + "\n,".join(json.dumps(r) for r in records) + "\n]}"
    (tmp_path / "big.json").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        rows = read_document_records(spark, str(tmp_path / "big.json"), "array<string>", r'\s*\{.*?"data"\s*:\s*\[')
        assert rows.rdd.getNumPartitions() > 4
        found = {tuple(r["record"]) for r in rows.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == {(a, str(b), None, d) for a, b, _, d in records}


def test_records_that_are_objects_and_those_that_are_broken(spark, tmp_path):
    (tmp_path / "a.json").write_text('[\n{"a": 1, "b": [1]}\n,{"a": 2, "c": "x"}\n,{"a": \n,{"a": "no"}\n,{"a": null}\n]\n')
    (tmp_path / "b.json").write_text("[\n]")
    (tmp_path / "c.json").write_text("")
    rows = read_document_records(spark, str(tmp_path), "a bigint, b array<int>")
    found = sorted(((r["record"], (r["unread"] or "").strip()) for r in rows.collect()), key=repr)
    assert [(r, u) for r, u in found if r] == [((1, [1]), ""), ((2, None), ""), ((None, None), "")]
    assert [u for r, u in found if r is None] == ['{"a": "no"}', '{"a":']


def test_births_from_records(spark, tmp_path):
    record = ["row-1", "0-1", 0, 1_500_000_000, None, 1_500_000_060, None, "{ }", "2010", "Ann", "KINGS", "F", "7"]
    (tmp_path / "one.json").write_text('{"data": [\n' + "\n,".join([json.dumps(record), '["short"]', "oops"]) + "\n]}")
    rows = births.read_births(spark, str(tmp_path)).orderBy("sid").collect()
    assert [(r["sid"], r["first_name"], r["count"]) for r in rows] == [("row-1", "Ann", 7), ("short", None, None)]


def test_damaged_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,n,d\n1,2.5,2020-01-02\n2,x,2020-01-02\n3,1\n4,,\n5,1,2,3\n"6",y,never\n')
    good, bad = read_delimited_apart(spark, str(tmp_path / "a.csv"), "k int, n double, d date")
    assert [r["k"] for r in good.orderBy("k").collect()] == [1, 4] and good.columns == ["k", "n", "d"]
    found = sorted((r["record"], r["reason"], r["fields"], r["file"].rsplit("/", 1)[1]) for r in bad.collect())
    assert found == [
        ('"6",y,never', "unreadable value", "n,d", "a.csv"),
        ("2,x,2020-01-02", "unreadable value", "n", "a.csv"),
        ("3,1", "broken record", None, "a.csv"),
        ("5,1,2,3", "broken record", None, "a.csv"),
    ]
    (tmp_path / "b.json").write_text('{"k": 1, "s": {"x": 2}}\n{"k": "one"}\nnot json\n{"s": 5, "z": 1}\n{}\n')
    good, bad = read_json_lines_apart(spark, str(tmp_path / "b.json"), "k int, s struct<x: int>")
    assert good.count() == 2
    found = sorted((r["record"], r["reason"], r["fields"]) for r in bad.collect())
    assert found == [
        ("not json", "broken record", None),
        ('{"k": "one"}', "unreadable value", "k"),
        ('{"s": 5, "z": 1}', "unreadable value", "s"),
    ]
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "e.csv").write_text("")
    good, bad = read_delimited_apart(spark, str(tmp_path / "empty"), "k int")
    assert (good.count(), bad.count()) == (0, 0)


def test_sketches_merge(spark):
    rows = spark.range(60_000).selectExpr("id % 3 AS g", "id % 20011 AS n", "CAST(nullif(id % 7, 3) AS string) AS t")
    parts = [stored(distinct_sketches(rows.where(F.col("n") % 5 == k), ["g"], ["n", "t"]), "part") for k in range(5)]
    union = parts[0]
    for part in [*parts[1:], parts[2]]:
        union = union.union(part)
    merged = sketched_counts(merge_sketches(union, ["g"], ["n", "t"]), ["n", "t"])
    whole = sketched_counts(distinct_sketches(rows, ["g"], ["n", "t"]), ["n", "t"])
    exact = rows.groupBy("g").agg(F.countDistinct("n").alias("n"), F.countDistinct("t").alias("t"))
    found = {r["g"]: (r["n"], r["t"]) for r in merged.collect()}
    for r in exact.collect():
        assert abs(found[r["g"]][0] - r["n"]) <= 0.02 * r["n"] and found[r["g"]][1] == r["t"] == 6
    assert {r["g"]: (r["n"], r["t"]) for r in whole.collect()}.keys() == found.keys()
    assert plan_of(distinct_sketches(rows, ["g"], ["n"])).count("Exchange") <= 1


def test_sketches_and_samples_of_nothing(spark):
    empty = spark.createDataFrame([], "g int, n int")
    assert sketched_counts(merge_sketches(distinct_sketches(empty, ["g"], ["n"]), ["g"], ["n"]), ["n"]).count() == 0
    assert hashed_sample(empty, ["g"], 5).count() == 0
    assert table_difference(empty, empty).count() == 0


def test_samples_repeat_and_merge(spark):
    rows = spark.range(5_000).selectExpr("id % 4000 AS k", "id AS v")
    first = {tuple(r) for r in hashed_sample(rows, ["k"], 300).collect()}
    assert len(first) == 300
    assert {tuple(r) for r in hashed_sample(rows.repartition(13, "v"), ["k"], 300).collect()} == first
    halves = [hashed_sample(rows.where(F.col("v") % 2 == i), ["k"], 300) for i in (0, 1)]
    assert {tuple(r) for r in hashed_sample(halves[0].union(halves[1]), ["k"], 300).collect()} == first
    assert "TakeOrderedAndProject" in plan_of(hashed_sample(rows, ["k"], 300))


def test_equal_tables_shuffle_digests_only(spark):
    rows = spark.range(3_000).selectExpr("id", "nullif(id % 10, 0) AS a", "nullif(id % 10, 0) AS b", "array(id) AS c")
    left = stored(rows, "left")
    right = stored(rows.repartition(5).sortWithinPartitions(F.rand(1)), "right")
    assert unequal_buckets(left, right, 64).count() == 0 and table_difference(left, right, 64).count() == 0
    assert bucket_digests(left, 64).count() == 64
    changed = right.withColumn("a", F.when(F.col("id") == 20, 1).otherwise(F.col("a")))
    changed = stored(changed.union(right.where("id = 77")), "changed").toDF("w", "x", "y", "z")
    differ = table_difference(left, changed, 64)
    assert {str(r) for r in differ.collect()} == {str(r) for r in frame_difference(left, changed).collect()}
    assert differ.count() == 3
    assert unequal_buckets(left, changed, 64).count() <= 3


def test_swapped_nulls_are_a_difference(spark):
    left = spark.createDataFrame([(1, None)], "a int, b int")
    right = spark.createDataFrame([(None, 1)], "a int, b int")
    assert table_difference(left, right, 1).count() == 2


def test_footers_answer_counts_and_extremes(spark):
    rows = spark.range(1_000).selectExpr("id", "CAST(NULL AS string) AS e", "nullif(id % 2, 1) AS h", "array(id) AS l", "CAST(id AS timestamp) AS t")
    path = stored_path(rows, "footers")
    stats = footer_stats(spark, path, ["id", "e", "h", "t"], ["id"])
    assert "PushedAggregation: [COUNT(*)" in stats._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert tuple(stats.first()) == (1_000, 1_000, 0, 500, 1_000, 0, 999)
    assert filled_columns(spark, path) == ["id", "h", "l", "t"] == drop_all_null_columns(spark.read.parquet(path)).columns
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    assert filled_columns(spark, stored_path(rows.limit(0), "none")) == ["l"]


def test_tables_dealt_alike_join_without_a_shuffle(spark, tmp_path):
    names = {stage: f"dealt_{stage}_{uuid.uuid4().hex}" for stage in bids.SILVER_STEPS}
    request = {"id": "b1", "device": {"os": "x", "ua": "y", "geo": {"country": "DE"}}, "app": {"id": "1", "name": "n"}}
    requests = [{**request, "id": f"b{i}", "imp": [{"id": f"{i}-{k}", "bidfloor": 1.0} for k in range(i % 3)]} for i in range(50)]
    (tmp_path / "bids.json").write_text(json.dumps(requests))
    bronze = bids.read_bids(spark, str(tmp_path))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = bids.bucketed_gold(bronze, names, buckets=4, in_view=F.lit(1.0))
        assert "hashpartitioning(device_auction_id" not in plan_of(table) and "SortMergeJoin" in plan_of(table)
        found = stored(table, "gold")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in names.values():
            drop_table(spark, name)
    silver = [step(bronze) for step in bids.SILVER_STEPS.values()]
    assert frame_difference(found, bids.gold(*silver, F.lit(1.0))).count() == 0
    assert found.count() == 66


def test_a_bucketed_table_is_replaced(spark):
    name = f"dealt_{uuid.uuid4().hex}"
    bucketed_table(spark.range(10), name, "id", 3)
    again = bucketed_table(spark.range(7).withColumnRenamed("id", "a b"), name, "a b", 3)
    assert again.count() == 7
    drop_table(spark, name)
    assert new_shared_folder(spark, "x")
