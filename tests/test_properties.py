"""Operators against plain Python on random small tables."""

from __future__ import annotations

from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldmill import functions as fn
from fieldmill import operators as op

few = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
keys = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
numbers = st.one_of(st.none(), st.integers(-3, 3))
pairs = st.lists(st.tuples(keys, numbers), max_size=25)


def bag(df):
    return Counter(tuple(row) for row in df.collect())


@few
@given(pairs)
def test_top_per_group_all_ties(spark, table):
    groups = defaultdict(list)
    for key, value in table:
        groups[key].append(value)
    expected = Counter()
    for key, values in groups.items():
        known = [v for v in values if v is not None]
        best = max(known) if known else None
        expected[(key, best)] += values.count(best)
    frame = spark.createDataFrame(table, "k string, v int")
    assert bag(op.top_per_group(frame, ["k"], "v")) == expected


@few
@given(pairs)
def test_mode_per_group(spark, table):
    counts = defaultdict(Counter)
    for key, value in table:
        if value is not None:
            counts[key][value] += 1
    expected = Counter()
    for key, counter in counts.items():
        value, n = min(counter.items(), key=lambda item: (-item[1], item[0]))
        expected[(key, value, n)] += 1
    frame = spark.createDataFrame(table, "k string, v int")
    assert bag(op.mode_per_group(frame, ["k"], "v")) == expected


@few
@given(pairs, pairs)
def test_left_join_many(spark, left_rows, right_rows):
    expected = Counter()
    for key, value in left_rows:
        matches = [row for row in right_rows if key is not None and row[0] == key]
        for row in matches or [(None, None)]:
            expected[(key, value, *row)] += 1
    left = spark.createDataFrame(left_rows, "k string, v int")
    right = spark.createDataFrame(right_rows, "rk string, rv int")
    assert bag(op.left_join_many(left, right, "k", "rk")) == expected


@few
@given(pairs, pairs)
def test_frame_difference(spark, left_rows, right_rows):
    left, right = Counter(left_rows), Counter(right_rows)
    expected = Counter(
        (*row, left[row], right[row]) for row in left.keys() | right.keys() if left[row] != right[row]
    )
    schema = "k string, v int"
    frames = (spark.createDataFrame(rows, schema) for rows in (left_rows, right_rows))
    assert bag(op.frame_difference(*frames)) == expected


@few
@given(st.lists(st.one_of(st.none(), st.lists(numbers, max_size=5)), max_size=10))
def test_array_mean(spark, arrays):
    frame = spark.createDataFrame([(a,) for a in arrays], "a array<int>")
    got = [row[0] for row in frame.select(fn.array_mean(F.col("a"))).collect()]
    assert got == [sum(x or 0 for x in a) / len(a) if a else None for a in arrays]


@few
@given(st.text(alphabet="aB .$|,;'#\t\r\n1é", max_size=20))
def test_cleaning_leaves_no_removed_character(spark, text):
    frame = spark.createDataFrame([(text,)], "t string")
    cleaned = frame.select(fn.clean_chars(F.col("t"))).first()[0]
    assert cleaned == "".join(c for c in text.lower() if c not in " .$|,;'#\t\r\n") == fn.clean_name(text)
