"""The birth workload on records derived from events, read from JSON."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmill.functions import infer_xml_schema
from fieldmill.operators import array_positions, array_to_columns, require_shape
from fieldmill.plans import births
from fieldmill.plans.registry import query, rounded_sql
from fieldmill.plans.rehost import (
    BIRTHS_SQL,
    VISITS_SQL,
    birth_documents,
    visited_birth_lines,
    visited_births,
)
from fieldmill.sources import read_json, stored

VISITORS_XML = "visitor array<struct<_id: bigint, _age: bigint, _sex: string>>"

POSITIONS_SQL = f"""SELECT sid, id, year, first_name, county, sex, count, county_clean, first_name_clean,
    strftime(created, '%Y-%m-%d %H:%M:%S') AS created_at,
    strftime(updated, '%Y-%m-%d %H:%M:%S') AS updated_at FROM ({BIRTHS_SQL})"""


def utc_text(column: str) -> Column:
    """A timestamp as UTC text, whatever the session's time zone is."""
    utc = F.to_utc_timestamp(column, F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd HH:mm:ss")


def checked_columns(records: DataFrame) -> DataFrame:
    return records.select(
        "sid", "id", "year", "first_name", "county", "sex", "count", "county_clean", "first_name_clean",
        utc_text("created_at_ts").alias("created_at"),
        utc_text("updated_at_ts").alias("updated_at"),
    )


def birth_records(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_json(spark, birth_documents(spark, folder), True, births.BIRTHS_JSON)
    return births.explode_births(documents).transform(require_shape, births.BIRTH_SHAPE)


@query("json_multiline_positions", POSITIONS_SQL)
def json_multiline_positions(spark: SparkSession, folder: str) -> DataFrame:
    return checked_columns(birth_records(spark, folder))


@query("json_single_document", POSITIONS_SQL)
def json_single_document(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of up to a million records, each split between tasks at its records."""
    path = birth_documents(spark, folder, rows_per_document=1_000_000)
    return checked_columns(births.read_births(spark, path).transform(require_shape, births.BIRTH_SHAPE))


@query("json_view_positions", POSITIONS_SQL)
def json_view_positions(spark: SparkSession, folder: str) -> DataFrame:
    """The same through a JSON source declared in SQL, its schema inferred."""
    view = f"birth_records_{uuid.uuid4().hex}"
    births.publish_births(spark, birth_documents(spark, folder), view)
    records = checked_columns(spark.table(view))
    births.withdraw_births(spark, view)
    return records


TOP_NAMES_SQL = f"""SELECT first_name_clean, count, year FROM ({BIRTHS_SQL})
    QUALIFY rank() OVER (PARTITION BY year ORDER BY count DESC NULLS LAST) = 1"""


@query("top_names_by_year_sql", TOP_NAMES_SQL)
def top_names_by_year_sql(spark: SparkSession, folder: str) -> DataFrame:
    view = f"birth_records_{uuid.uuid4().hex}"
    births.publish_births(spark, birth_documents(spark, folder), view, store=True)
    names = births.top_names_sql(spark, view)
    births.withdraw_births(spark, view)
    return names


@query("top_names_by_year", TOP_NAMES_SQL)
def top_names_by_year(spark: SparkSession, folder: str) -> DataFrame:
    """Finding the best and finding its holders are two reads, so the names are stored first."""
    names = birth_records(spark, folder).select("first_name_clean", "count", "year")
    return births.top_names(stored(names, "names"))


@query(
    "top_name_totals_by_year",
    f"""WITH totals AS (
            SELECT first_name_clean, year, CAST(sum(count) AS BIGINT) AS count
            FROM ({BIRTHS_SQL}) GROUP BY 1, 2)
        SELECT first_name_clean, count, year FROM totals
        QUALIFY row_number() OVER (
            PARTITION BY year ORDER BY count DESC NULLS LAST, first_name_clean) = 1""",
)
def top_name_totals_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return births.top_names(birth_records(spark, folder), ties="one", sum_first=True)


def visits(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_json(
        spark,
        visited_birth_lines(spark, folder),
        schema="event_id bigint, first_name string, county string, visitors string",
    )
    return births.parse_visitors(lines, VISITORS_XML)


XML_SQL = f"""WITH {VISITS_SQL}, ages AS (
        SELECT event_id, string_agg(i || ':' || coalesce(CAST(age AS VARCHAR), '-') || ':' ||
                   CASE WHEN i % 2 = 0 THEN 'M' ELSE 'F' END, ',' ORDER BY i) AS visits
        FROM visitors GROUP BY event_id)
    SELECT event_id, county_clean, 'name' || regexp_extract(first_name, '[0-9]+') AS firstname_clean,
           CAST(num_visitors AS INTEGER) AS num_visitors, coalesce(visits, '') AS visits
    FROM births LEFT JOIN ages USING (event_id)"""


def visits_as_text(parsed: DataFrame) -> DataFrame:
    def one(visitor: Column) -> Column:
        age = F.coalesce(visitor["_age"].cast("string"), F.lit("-"))
        return F.concat_ws(":", visitor["_id"].cast("string"), age, visitor["_sex"])

    as_text = F.coalesce(F.array_join(F.transform("birth_visits", one), ","), F.lit(""))
    return parsed.select(
        "event_id", "county_clean", "firstname_clean", "num_visitors", as_text.alias("visits")
    )


@query("xml_parse", XML_SQL)
def xml_parse(spark: SparkSession, folder: str) -> DataFrame:
    return visits_as_text(visits(spark, folder))


@query("xml_infer", XML_SQL)
def xml_infer(spark: SparkSession, folder: str) -> DataFrame:
    """The XML schema found by looking at every row."""
    raw = visited_births(spark, folder)
    schema = infer_xml_schema(raw, "visitors", repeated=["visitor"])
    return visits_as_text(births.parse_visitors(raw, schema))


@query("visited_birth_count", f"WITH {VISITS_SQL} SELECT count(*) AS n FROM births")
def visited_birth_count(spark: SparkSession, folder: str) -> DataFrame:
    return visits(spark, folder).agg(F.count("*").alias("n"))


@query(
    "avg_children_by_group",
    f"""WITH {VISITS_SQL}
        SELECT county_clean, {rounded_sql("avg(num_visitors)", 4)} AS avg_num_visitors FROM births
        GROUP BY 1 ORDER BY avg(num_visitors) DESC, county_clean LIMIT 1""",
)
def avg_children_by_group(spark: SparkSession, folder: str) -> DataFrame:
    best = births.busiest_counties(visits(spark, folder))
    return best.withColumn("avg_num_visitors", F.round("avg_num_visitors", 4))


@query(
    "mean_visitor_age",
    f"""WITH {VISITS_SQL}, means AS (
            SELECT event_id, sum(coalesce(age, 0)) / count(*) AS mean FROM visitors GROUP BY 1)
        SELECT county_clean, {rounded_sql("avg(mean)", 4)} AS avg_age
        FROM births LEFT JOIN means USING (event_id) GROUP BY 1""",
)
def mean_visitor_age(spark: SparkSession, folder: str) -> DataFrame:
    means = births.mean_visitor_age(visits(spark, folder))
    return means.withColumn("avg_age", F.round("avg_age", 4))


@query(
    "mean_visitor_age_pooled",
    f"""WITH {VISITS_SQL}
        SELECT county_clean, {rounded_sql("sum(coalesce(age, 0)) / count(*)", 4)} AS avg_age
        FROM visitors GROUP BY 1""",
)
def mean_visitor_age_pooled(spark: SparkSession, folder: str) -> DataFrame:
    means = births.mean_visitor_age(visits(spark, folder), pooled=True)
    return means.withColumn("avg_age", F.round("avg_age", 4))


@query(
    "most_common_age",
    f"""WITH {VISITS_SQL}, counted AS (
            SELECT county_clean, age, count(*) AS n FROM visitors WHERE age IS NOT NULL GROUP BY 1, 2)
        SELECT county_clean, age, n FROM counted
        QUALIFY row_number() OVER (PARTITION BY county_clean ORDER BY n DESC, age) = 1""",
)
def most_common_age(spark: SparkSession, folder: str) -> DataFrame:
    return births.most_common_age(visits(spark, folder))


@query(
    "most_common_age_in_county",
    f"""WITH {VISITS_SQL}, counted AS (
            SELECT county_clean, age, count(*) AS n FROM visitors
            WHERE age IS NOT NULL AND county_clean = 'purchaseco' GROUP BY 1, 2)
        SELECT county_clean, age, n FROM counted ORDER BY n DESC, age LIMIT 1""",
)
def most_common_age_in_county(spark: SparkSession, folder: str) -> DataFrame:
    """A filter on the result that the optimizer moves below the grouping and the XML parsing."""
    common = births.most_common_age(visits(spark, folder))
    return common.where(F.col("county_clean") == "purchaseco")


@query(
    "array_to_columns",
    f"""WITH {VISITS_SQL}
        SELECT event_id, CAST(num_visitors AS INTEGER) AS num_visitors,
               max(age) FILTER (i = 1) AS age0, max(age) FILTER (i = 2) AS age1,
               max(age) FILTER (i = 3) AS age2, max(age) FILTER (i = 4) AS age3
        FROM births LEFT JOIN visitors USING (event_id) GROUP BY 1, 2""",
)
def ages_to_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Finding the longest array and filling the columns are two reads, so the parsed visits are stored."""
    parsed = visits(spark, folder).select("event_id", "num_visitors", "ages")
    return array_to_columns(stored(parsed, "visits"), "ages", "age").drop("ages")


@query(
    "array_positions",
    f"""WITH {VISITS_SQL} SELECT event_id, CAST(i - 1 AS INTEGER) AS position, age FROM visitors""",
)
def ages_by_position(spark: SparkSession, folder: str) -> DataFrame:
    """The same ages as rows, however long an array is."""
    return array_positions(visits(spark, folder), "ages", ["event_id"], "age")
