from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from fieldmill import functions as fn


def values(spark, rows, schema, *columns):
    return [tuple(row) for row in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_names_and_values_are_cleaned_alike(spark):
    untidy = ["Plain", " Na.me", "A|B;C,D'E#F$G", "Tab\tNew\nLine", "ÉTÉ 1"]
    frame = spark.createDataFrame([(text,) for text in untidy], "v string")
    cleaned = [row[0] for row in frame.select(fn.clean_chars(F.col("v"))).collect()]
    assert cleaned == [fn.clean_name(text) for text in untidy]
    assert cleaned[:4] == ["plain", "name", "abcdefg", "tabnewline"]


def test_clean_chars_keeps_null(spark):
    assert values(spark, [(None,)], "v string", fn.clean_chars(F.col("v"))) == [(None,)]


def test_quoted_names_resolve(spark):
    frame = spark.createDataFrame([(1,)], ["a.b`c"])
    assert frame.select(fn.quoted("a.b`c")).first()[0] == 1


def test_day_name(spark):
    got = values(
        spark, [("1",), ("7",), ("0",), ("8",), ("x",), (None,)], "d string", fn.day_name(F.col("d"))
    )
    assert [row[0] for row in got] == ["Mon", "Sun", None, None, None, None]


@pytest.mark.parametrize(
    "parts, expected",
    [
        (("1988", "3", "1"), date(1988, 3, 1)),
        (("1988", "02", "29"), date(1988, 2, 29)),
        (("1987", "2", "29"), None),
        (("1987", "13", "1"), None),
        (("1987", None, "3"), None),
        (("NA", "1", "1"), None),
    ],
)
def test_date_from_parts(spark, parts, expected):
    column = fn.date_from_parts(F.col("y"), F.col("m"), F.col("d"))
    assert values(spark, [parts], "y string, m string, d string", column) == [(expected,)]


def test_route_is_null_when_an_end_is_unknown(spark):
    got = values(
        spark,
        [("SEA", "PDX"), ("SEA", None), (None, "PDX")],
        "a string, b string",
        fn.route_label(F.col("a"), F.col("b")),
    )
    assert got == [("SEA-PDX",), (None,), (None,)]


def test_epoch_to_timestamp(spark):
    stamp = F.unix_timestamp(fn.epoch_to_timestamp(F.col("s")))
    assert values(spark, [("1574264158",), ("x",), (None,)], "s string", stamp) == [
        (1574264158,),
        (None,),
        (None,),
    ]


def test_times_compare_as_numbers_and_unknown_is_not_late(spark):
    got = values(
        spark,
        [("930", "1015"), ("1020", "1015"), ("NA", "1015"), (None, "1015"), ("1015", "1015")],
        "a string, s string",
        fn.is_later(F.col("a"), F.col("s")),
    )
    assert [row[0] for row in got] == [0, 1, 0, 0, 0]


def test_timing_label_boundaries_and_udf_parity(spark):
    delays = [(15.1,), (15.0,), (7.0,), (0.0,), (-0.1,), (None,)]
    got = values(
        spark, delays, "d double", fn.timing_label(F.col("d")), fn.timing_label_udf(F.col("d"))
    )
    expected = ["Late", "On-time", "On-time", "On-time", "Early", None]
    assert got == [(label, label) for label in expected]


def test_majority_label(spark):
    got = values(spark, [(0.6,), (0.5,), (None,)], "s double", fn.majority_label(F.col("s")))
    assert [row[0] for row in got] == ["late", "early", None]


def test_array_functions_with_nulls_and_empties(spark):
    arrays = [([30, None, 60],), ([],), (None,)]
    got = values(
        spark,
        arrays,
        "a array<bigint>",
        fn.array_sum(F.col("a")),
        fn.element_count(F.col("a")),
        fn.array_mean(F.col("a")),
    )
    assert got == [(90, 3, 30.0), (0, 0, None), (None, 0, None)]


def test_array_mean_of_a_struct_field(spark):
    schema = "v array<struct<_age: bigint>>"
    assert values(spark, [([(20,), (31,)],)], schema, fn.array_mean(F.col("v._age"))) == [(25.5,)]


XML = [
    ('<visitors><visitor id="1" age="68" sex="F"/><visitor id="2" age="34" sex="M"/></visitors>',),
    ('<visitors><visitor id="1" sex="F"/></visitors>',),
    ("<visitors></visitors>",),
    ("<visitors><visitor id=",),
    (None,),
]


def test_parse_xml(spark):
    schema = "visitor array<struct<_id: bigint, _age: bigint, _sex: string>>"
    parsed = fn.parse_xml(F.col("x"), schema)["visitor"]
    got = values(spark, XML, "x string", parsed["_age"], fn.element_count(parsed))
    assert got == [([68, 34], 2), ([None], 1), (None, 0), (None, 0), (None, 0)]


def test_xml_schema_covers_fields_that_only_one_row_has(spark):
    rare = '<visitors><visitor id="9" age="5" sex="F"/><note>late</note></visitors>'
    frame = spark.createDataFrame([XML[1]] * 3000 + [(rare,)] + XML[2:], "x string")
    schema = fn.infer_xml_schema(frame, "x", repeated=["visitor"])
    assert schema.simpleString() == (
        "struct<note:string,visitor:array<struct<_age:bigint,_id:bigint,_sex:string>>>"
    )
    # A forced array also takes the single child.
    ages = frame.select(fn.parse_xml(F.col("x"), schema)["visitor"]["_age"].alias("a"))
    assert ages.where("a[0] = 5").count() == 1
