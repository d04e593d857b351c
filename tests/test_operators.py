from __future__ import annotations

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from fieldmill import operators as op

# ---------------------------------------------------------------- headers


def test_clean_header_renames_sorts_and_trims_only_text(spark):
    frame = spark.createDataFrame([(" x ", 3)], ["Zo.ne Name", "A#ge"])
    cleaned = frame.transform(op.clean_header)
    assert cleaned.columns == ["age", "zonename"]
    assert cleaned.dtypes == [("age", "bigint"), ("zonename", "string")]
    assert tuple(cleaned.first()) == (3, "x")


def test_clean_header_twice_changes_nothing(spark):
    frame = spark.createDataFrame([("a", 1.5)], ["Big Name", "V,al"])
    once = op.clean_header(frame)
    assert op.clean_header(once).dtypes == once.dtypes


def test_clean_header_options(spark):
    frame = spark.createDataFrame([(" x ", 1)], ["B b", "a"])
    assert op.clean_header(frame, sort=False, trim=False).columns == ["bb", "a"]
    assert op.clean_header(frame, sort=False, trim=False).first()[0] == " x "


def test_colliding_names_are_refused(spark):
    frame = spark.createDataFrame([(1, 2)], ["a b", "A.B"])
    with pytest.raises(ValueError, match="ab"):
        op.clean_header(frame)


def test_lower_names_refuses_collisions(spark):
    frame = spark.createDataFrame([(1, 2)], ["a", "A"])
    with pytest.raises(ValueError):
        op.lower_names(frame)


# ---------------------------------------------------------------- nulls and casts


def test_na_to_null_touches_marked_text_only(spark):
    frame = spark.createDataFrame([("NA", "-", 1), (None, "NA", 2)], ["a", "b", "n"])
    assert [tuple(r) for r in op.na_to_null(frame, ["NA", "-"]).collect()] == [
        (None, None, 1),
        (None, None, 2),
    ]
    assert [tuple(r) for r in op.na_to_null(frame, columns=["a"]).collect()] == [
        (None, "-", 1),
        (None, "NA", 2),
    ]


def test_cast_columns_projects_and_tolerates_bad_text(spark):
    frame = spark.createDataFrame([("12", "x", "drop me"), ("1.5", "7", "")], ["a", "b", "c"])
    cast = op.cast_columns(frame, {"b": "int", "a": "double"})
    assert cast.dtypes == [("b", "int"), ("a", "double")]
    assert [tuple(r) for r in cast.collect()] == [(None, 12.0), (7, 1.5)]


def test_drop_all_null_columns(spark):
    frame = spark.createDataFrame(
        [(None, i, "only" if i == 999 else None, None) for i in range(1000)],
        "a string, b int, c string, d double",
    )
    assert op.drop_all_null_columns(frame).columns == ["b", "c"]


def test_drop_all_null_columns_of_an_empty_table(spark):
    frame = spark.createDataFrame([], "a string, b int")
    assert op.drop_all_null_columns(frame).columns == []


# ---------------------------------------------------------------- nested


def nested_frame(spark):
    return spark.createDataFrame(
        [("b1", ("ios", ("DE", 1))), ("b2", None)],
        "id string, device struct<os: string, geo: struct<country: string, zone: int>>",
    )


def test_flatten_two_levels_and_prefix(spark):
    flat = (
        nested_frame(spark)
        .transform(op.flatten_struct, "device")
        .transform(op.flatten_struct, "geo")
        .transform(op.prefix_columns, "device_")
    )
    assert flat.columns == ["device_id", "device_os", "device_country", "device_zone"]
    assert [tuple(r) for r in flat.collect()] == [("b1", "ios", "DE", 1), ("b2", None, None, None)]


def test_flatten_refuses_clashing_names(spark):
    frame = spark.createDataFrame([(1, ("x",))], "ID int, s struct<id: string>")
    with pytest.raises(ValueError, match="id"):
        op.flatten_struct(frame, "s")


def test_positions_to_columns_with_short_and_null_arrays(spark):
    frame = spark.createDataFrame([(1, ["a", "7"]), (2, ["b"]), (3, None)], "k int, v array<string>")
    named = op.positions_to_columns(frame, "v", ["name", "n", "more"], {"n": "int"})
    assert named.dtypes == [("k", "int"), ("name", "string"), ("n", "int"), ("more", "string")]
    assert [tuple(r) for r in named.collect()] == [
        (1, "a", 7, None),
        (2, "b", None, None),
        (3, None, None, None),
    ]


def test_array_to_columns_finds_the_longest_array(spark):
    frame = spark.createDataFrame([(1, [5, 6, 7]), (2, []), (3, None)], "k int, v array<int>")
    wide = op.array_to_columns(frame, "v", "age").drop("v")
    assert wide.columns == ["k", "age0", "age1", "age2"]
    assert tuple(wide.where("k = 1").first()) == (1, 5, 6, 7)
    empty = op.array_to_columns(frame.where("k > 9"), "v", "age")
    assert empty.columns == ["k", "v"]


def test_array_to_columns_keeps_what_lies_beyond(spark, sorted_rows):
    frame = spark.createDataFrame([(1, [5, 6, 7]), (2, [8]), (3, []), (4, None)], "k int, v array<int>")
    wide = op.array_to_columns(frame, "v", "age", n=1).drop("v")
    assert wide.columns == ["k", "age0", "age_rest"]
    assert sorted_rows(wide) == [(1, 5, [6, 7]), (2, 8, None), (3, None, None), (4, None, None)]


def test_array_positions(spark, sorted_rows):
    frame = spark.createDataFrame([(1, "x", [5, None]), (2, "y", []), (3, "z", None)], "k int, s string, v array<int>")
    long = op.array_positions(frame, "v", ["k", "s"], "age")
    assert long.columns == ["k", "s", "position", "age"]
    assert sorted_rows(long) == [(1, "x", 0, 5), (1, "x", 1, None)]


# ---------------------------------------------------------------- joins


def test_lookup_roles_keeps_unmatched_and_repeats_for_duplicate_keys(spark, sorted_rows):
    flights = spark.createDataFrame([("A", "B"), ("B", "Z"), (None, "A")], "origin string, dest string")
    codes = spark.createDataFrame([("A", "Alp"), ("B", "Bay"), ("B", "Bow")], "iata string, city string")
    roles = {"origin": "origcity", "dest": "destcity"}
    joined = op.lookup_roles(flights, codes, "iata", "city", roles)
    assert joined.columns == ["origin", "dest", "origcity", "destcity"]
    assert sorted_rows(joined) == sorted(
        [
            ("A", "B", "Alp", "Bay"),
            ("A", "B", "Alp", "Bow"),
            ("B", "Z", "Bay", None),
            ("B", "Z", "Bow", None),
            (None, "A", None, "Alp"),
        ],
        key=repr,
    )


def test_left_join_many_equals_a_left_join(spark):
    left = spark.createDataFrame(
        [("hot", 1), ("hot", 2), ("warm", 3), ("lonely", 4), (None, 5), ("one", 6)], "k string, l int"
    )
    many = [("hot", i % 5) for i in range(300)] + [("warm", i) for i in range(40)]
    many += [("one", 1), (None, 2), ("unused", 3)] + [("unused", i) for i in range(60)]
    right = spark.createDataFrame(many, "rk string, r int").repartition(5)
    plain = left.join(right, left.k == right.rk, "left")
    ours = op.left_join_many(left, right, "k", "rk")
    assert ours.columns == plain.columns
    assert plain.count() == 643
    assert op.frame_difference(ours, plain).count() == 0


# ---------------------------------------------------------------- groups


def test_distinct_values(spark, sorted_rows):
    frame = spark.createDataFrame([("a", 2), ("b", 2), (None, 1), ("a", None)], "s string, n int")
    assert sorted_rows(op.distinct_values(frame)) == [("n", "1"), ("n", "2"), ("s", "a"), ("s", "b")]


@pytest.mark.parametrize(
    "segments, expected", [(["a", "b", None, "a"], (2, 3)), (["a", "b"], (2, 2)), ([], (0, 0))]
)
def test_distinct_counts(spark, segments, expected):
    frame = spark.createDataFrame([(s,) for s in segments], "s string")
    row = op.distinct_counts(frame, "s").first()
    assert (row["n_distinct"], row["n_distinct_with_null"]) == expected
    assert row["n_approx"] == expected[0]
    assert frame.dropDuplicates(["s"]).distinct().count() == expected[1]
    assert frame.na.drop().distinct().count() == expected[0]


def test_group_stats_match_a_window_and_group_nulls(spark):
    from pyspark.sql import Window

    frame = spark.createDataFrame(
        [(1, "a", 5), (1, "a", 8), (1, None, 3), (1, None, 4), (None, "a", None), (2, "b", 7)],
        "d int, c string, v int",
    )
    w = Window.partitionBy("d", "c")
    expected = frame.select(
        "*",
        F.min("v").over(w).alias("xmin"),
        F.max("v").over(w).alias("xmax"),
        F.round(F.avg("v").over(w), 2).alias("xavg"),
        F.sum("v").over(w).alias("xsum"),
    )
    ours = op.group_stats(frame, ["d", "c"], "v", "x")
    assert ours.columns == expected.columns
    assert op.frame_difference(ours, expected).count() == 0


def test_top_per_group_ties(spark, sorted_rows):
    frame = spark.createDataFrame(
        [(1, "b", 9), (1, "a", 9), (1, "c", 2), (2, "z", None), (2, "y", None), (None, "q", 4)],
        "g int, name string, n int",
    )
    assert sorted_rows(op.top_per_group(frame, ["g"], "n").select("g", "name")) == sorted(
        [(1, "b"), (1, "a"), (2, "z"), (2, "y"), (None, "q")], key=repr
    )
    one = op.top_per_group(frame, ["g"], "n", ties="one", tiebreak=["name"])
    assert sorted_rows(one.select("g", "name")) == sorted([(1, "a"), (2, "y"), (None, "q")], key=repr)
    low = op.top_per_group(frame, ["g"], "n", descending=False)
    assert sorted_rows(low.select("g", "name")) == sorted(
        [(1, "c"), (2, "z"), (2, "y"), (None, "q")], key=repr
    )
    with pytest.raises(ValueError, match="tiebreak"):
        op.top_per_group(frame, ["g"], "n", ties="one")
    with pytest.raises(ValueError, match="ties"):
        op.top_per_group(frame, ["g"], "n", ties="some")


def test_mode_per_group_breaks_ties_downwards_and_skips_null(spark, sorted_rows):
    frame = spark.createDataFrame(
        [("k", 3), ("k", 1), ("k", 3), ("k", 1), ("k", None), ("k", None), ("k", None), ("m", 5)],
        "g string, v int",
    )
    assert sorted_rows(op.mode_per_group(frame, ["g"], "v")) == [("k", 1, 2), ("m", 5, 1)]


def test_ratio_where(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 5), ("b", None)], "g string, v int")
    assert tuple(op.ratio_where(frame, F.col("v") > 2).first()) == (1, 3, 1 / 3)
    by_key = {r[0]: tuple(r)[1:] for r in op.ratio_where(frame, F.col("v") > 2, ["g"]).collect()}
    assert by_key == {"a": (1, 2, 0.5), "b": (0, 1, 0.0)}
    assert tuple(op.ratio_where(frame.where("v > 99"), F.col("v") > 2).first()) == (0, 0, None)


def test_top_k(spark):
    frame = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1)], "k string, n int")
    best = op.top_k(frame, [F.desc("n")], 2, [F.asc("k")])
    assert [r["k"] for r in best.collect()] == ["a", "b"]


# ---------------------------------------------------------------- comparison and quality


def test_frame_difference_counts_copies(spark, sorted_rows):
    left = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    right = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "c int, d string")
    assert sorted_rows(op.frame_difference(left, right)) == sorted(
        [(1, None, 2, 1), (3, "y", 0, 1)], key=repr
    )


def test_expectations(spark, sorted_rows):
    frame = spark.createDataFrame([(1,), (0,), (None,), (2,)], "status int")
    seen = Observation("gate")
    kept = op.expect_or_drop(frame, "valid", "status IS NOT NULL AND status > 0", seen)
    assert sorted_rows(kept) == [(1,), (2,)]
    assert seen.get == {"valid_rows": 4, "valid_dropped": 2}
    # A condition that is null drops the row as well.
    assert op.expect_or_drop(frame, "valid", "status > 0").count() == 2
    report = op.expectation_report(frame, {"valid": "status > 0", "any": "true"})
    assert sorted_rows(report) == [("any", 4, 0), ("valid", 2, 2)]


def test_require_shape(spark):
    frame = spark.createDataFrame([("x", 1, 2.0)], "extra string, n int, v double")
    shape = StructType([StructField("n", IntegerType())])
    assert op.require_shape(frame, shape).columns == ["n", "extra", "v"]
    assert op.require_shape(frame, shape, keep_extra=False).columns == ["n"]
    with pytest.raises(TypeError, match="n: expected string, found int; m: .* found nothing"):
        op.require_shape(
            frame, StructType([StructField("n", StringType()), StructField("m", StringType())])
        )
