"""Nested birth records: arrays in JSON, visitors as XML in JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampType

from fieldmill.functions import (
    array_mean,
    array_sum,
    clean_chars,
    element_count,
    epoch_to_timestamp,
    infer_xml_schema,
    parse_xml,
)
from fieldmill.operators import mode_per_group, order_split, positions_to_columns, top_k, top_per_group
from fieldmill.sources import json_view, read_document_records, stored

# The slots of one birth record.
BIRTH_FIELDS = (
    "sid",
    "id",
    "position",
    "created_at",
    "created_meta",
    "updated_at",
    "updated_meta",
    "meta",
    "year",
    "first_name",
    "county",
    "sex",
    "count",
)
BIRTH_SHAPE = StructType(
    [
        StructField(name, IntegerType() if name == "count" else StringType())
        for name in BIRTH_FIELDS
        if name not in ("created_at", "updated_at")
    ]
    + [StructField(name, TimestampType()) for name in ("created_at_ts", "updated_at_ts")]
)
# Give this to the JSON reader to spare it the inference pass.
BIRTHS_JSON = "data array<array<string>>"


def explode_births(documents: DataFrame) -> DataFrame:
    """One row per birth record out of documents that hold an array of arrays in ``data``."""
    return shape_births(documents.select(F.explode("data").alias("data")))


def read_births(spark: SparkSession, path: str) -> DataFrame:
    """The records of documents of any size, read by as many tasks as the size asks for; those that aren't arrays are left out.

    The records follow ``"data": [`` and one another after a line end and a comma.
    """
    head = r'\s*\{.*?"data"\s*:\s*\['
    records = read_document_records(spark, path, "array<string>", head)
    return shape_births(records.select(F.col("record").alias("data")).where("data is not null"))


def shape_births(records: DataFrame) -> DataFrame:
    """Columns, types and cleaned keys of records that are arrays in ``data``."""
    return (
        records.transform(positions_to_columns, "data", BIRTH_FIELDS, {"count": "int"})
        .withColumns(
            {
                "created_at_ts": epoch_to_timestamp(F.col("created_at")),
                "updated_at_ts": epoch_to_timestamp(F.col("updated_at")),
                "county_clean": clean_chars(F.col("county")),
                "first_name_clean": clean_chars(F.col("first_name")),
            }
        )
        .drop("created_at", "updated_at")
    )


def publish_births(
    spark: SparkSession, path: str, view: str = "birth_records", store: bool = False
) -> None:
    """Declare the document file in SQL, explode it and publish the table under ``view``.

    With ``store`` the records are written once, so that questions to the view do not parse the
    documents again.
    """
    json_view(spark, f"{view}_raw", path, multi_line=True)
    records = explode_births(spark.sql(f"SELECT * FROM `{view}_raw`"))
    if store:
        records = stored(records, view)
    records.createOrReplaceTempView(view)


def withdraw_births(spark: SparkSession, view: str = "birth_records") -> None:
    """Drop the views of :func:`publish_births`; results already asked for keep working."""
    spark.catalog.dropTempView(view)
    spark.catalog.dropTempView(f"{view}_raw")


def top_names_sql(spark: SparkSession, view: str = "birth_records") -> DataFrame:
    """Most frequent name of each year in SQL; names that share the first place are all kept.

    The ranking runs over the distinct counts of a year and is joined back, so that the records
    which share a first place are never gathered in one task, and the sort ends with the record's key.
    """
    return spark.sql(
        f"""
        WITH placed AS (
            SELECT year, count, rank() OVER (PARTITION BY year ORDER BY count DESC) AS place
            FROM (SELECT DISTINCT year, count FROM `{view}`)
        )
        SELECT births.first_name_clean, births.count, births.year
        FROM `{view}` AS births
        JOIN placed ON births.year <=> placed.year AND births.count <=> placed.count
        WHERE placed.place = 1
        ORDER BY births.year, births.first_name_clean, births.sid
        """
    )


def top_names(births: DataFrame, ties: str = "all", sum_first: bool = False) -> DataFrame:
    """The same with the DataFrame API.

    ``ties="one"`` keeps the alphabetically first name; ``sum_first`` adds up the records of a name
    within a year instead of ranking single records.
    """
    names = births.select("first_name_clean", "count", "year")
    if sum_first:
        names = names.groupBy("first_name_clean", "year").agg(F.sum("count").alias("count"))
        names = names.select("first_name_clean", "count", "year")
    best = top_per_group(names, ["year"], "count", ties=ties, tiebreak=["first_name_clean"])
    return order_split(best, "year", "first_name_clean")


def parse_visitors(births: DataFrame, schema: StructType | str | None = None) -> DataFrame:
    """Parse the XML column ``visitors`` and derive count, ages and cleaned keys.

    Without a schema it is inferred from the whole column by one job. Rows without a county are
    dropped.
    """
    if schema is None:
        schema = infer_xml_schema(births, "visitors", repeated=["visitor"])
    parsed = parse_xml(F.col("visitors"), schema)["visitor"]
    return (
        births.withColumn("birth_visits", parsed)
        .withColumns(
            {
                "num_visitors": element_count(F.col("birth_visits")),
                "ages": F.col("birth_visits._age"),
                "county_clean": clean_chars(F.col("county")),
                "firstname_clean": clean_chars(F.col("first_name")),
            }
        )
        .na.drop(subset=["county_clean"])
        .drop("visitors")
    )


def busiest_counties(visits: DataFrame, k: int = 1) -> DataFrame:
    """Counties with the highest mean number of visitors per birth."""
    means = visits.groupBy("county_clean").agg(F.avg("num_visitors").alias("avg_num_visitors"))
    return top_k(means, [F.desc("avg_num_visitors")], k, tiebreak=[F.asc("county_clean")])


def mean_visitor_age(visits: DataFrame, pooled: bool = False) -> DataFrame:
    """Mean visitor age per county.

    By default the mean over births of each birth's mean age; ``pooled`` weighs every visitor alike.
    A visitor of unknown age counts with age 0 in both.
    """
    if pooled:
        mean = F.try_divide(
            F.sum(array_sum(F.col("ages"))).cast("double"), F.sum("num_visitors")
        )
    else:
        mean = F.avg(array_mean(F.col("ages")))
    return visits.groupBy("county_clean").agg(mean.alias("avg_age"))


def most_common_age(visits: DataFrame) -> DataFrame:
    """The most frequent visitor age of each county with its count; the lower age on a tie."""
    # An outer explode, or Spark infers filters on the array and parses the XML again for each.
    ages = visits.select("county_clean", F.explode_outer("ages").alias("age"))
    return mode_per_group(ages, ["county_clean"], "age")
