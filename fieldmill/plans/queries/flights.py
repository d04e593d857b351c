"""The flight workload on flights derived from line items, read from text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmill.plans import flights
from fieldmill.plans.registry import query, rounded_sql
from fieldmill.plans.rehost import FLIGHT_FIELDS, flight_files, select_list


def _number(name: str) -> str:
    return f'TRY_CAST(nullif("{name}", \'NA\') AS INTEGER)'


_NUMBERS = [
    "Year",
    "Month",
    "DayofMonth",
    "DepTime",
    "CRSDepTime",
    "ArrTime",
    "CRSArrTime",
    "FlightNum",
    "ActualElapsedTime",
    "CRSElapsedTime",
    "AirTime",
    "ArrDelay",
    "DepDelay",
    "Distance",
    "TaxiIn",
    "TaxiOut",
    "Cancelled",
    "Diverted",
]
PREPARED_SQL = f"""
    raw AS (SELECT {select_list(FLIGHT_FIELDS)} FROM lineitem),
    airports AS (
        SELECT 'A' || n_nationkey AS iata, n_name || ' City' AS city FROM nation
        WHERE n_nationkey % 12 <> 5),
    typed AS (
        SELECT {", ".join(f"{_number(name)} AS {name.lower()}" for name in _NUMBERS)},
               {_number("Day Of Week")} AS dayofweek, nullif("Unique.Carrier", 'NA') AS uniquecarrier,
               trim("Tail#Num") AS tailnum, "Origin" AS origin, nullif("Dest", 'NA') AS dest
        FROM raw),
    prepared AS (
        SELECT typed.*, o.city AS origcity, d.city AS destcity, origin || '-' || dest AS route,
               strftime(TRY_CAST(printf('%04d-%02d-%02d', year, month, dayofmonth) AS DATE), '%Y-%m-%d')
                   AS date,
               CASE dayofweek WHEN 1 THEN 'Mon' WHEN 2 THEN 'Tue' WHEN 3 THEN 'Wed' WHEN 4 THEN 'Thu'
                    WHEN 5 THEN 'Fri' WHEN 6 THEN 'Sat' WHEN 7 THEN 'Sun' END AS day,
               CASE WHEN arrtime > crsarrtime THEN 1 ELSE 0 END AS isarrdelay,
               CASE WHEN deptime > crsdeptime THEN 1 ELSE 0 END AS isdepdelay
        FROM typed LEFT JOIN airports o ON origin = o.iata LEFT JOIN airports d ON dest = d.iata)
"""


def prepared_flights(spark: SparkSession, folder: str, drop_empty: bool = False) -> DataFrame:
    first, rest, airport_codes = flight_files(spark, folder)
    return flights.prepare_flights(
        flights.load_flights(spark, first, rest),
        flights.load_airports(spark, airport_codes),
        drop_empty=drop_empty,
    )


@query("flights_prepared", f"WITH {PREPARED_SQL} SELECT * FROM prepared")
def flights_prepared(spark: SparkSession, folder: str) -> DataFrame:
    prepared = prepared_flights(spark, folder, drop_empty=True)
    return prepared.withColumn("date", F.col("date").cast("string"))


@query(
    "flights_carrier_counts",
    f"WITH {PREPARED_SQL} SELECT uniquecarrier, count(*) AS n FROM prepared GROUP BY 1",
)
def flights_carrier_counts(spark: SparkSession, folder: str) -> DataFrame:
    return prepared_flights(spark, folder).groupBy("uniquecarrier").agg(F.count("*").alias("n"))


@query(
    "flights_most_delayed",
    f"""WITH {PREPARED_SQL}
        SELECT uniquecarrier, count(*) AS n FROM prepared WHERE isdepdelay = 1
        GROUP BY 1 ORDER BY n DESC, uniquecarrier NULLS FIRST LIMIT 5""",
)
def flights_most_delayed(spark: SparkSession, folder: str) -> DataFrame:
    return flights.most_delayed(prepared_flights(spark, folder))


@query(
    "flights_timing",
    f"""WITH {PREPARED_SQL}, means AS (
            SELECT uniquecarrier, avg(arrdelay) AS mean FROM prepared
            WHERE uniquecarrier IS NOT NULL AND arrdelay IS NOT NULL GROUP BY 1)
        SELECT uniquecarrier, {rounded_sql("mean", 4)} AS avgdelay,
               CASE WHEN mean > 15 THEN 'Late' WHEN mean < 0 THEN 'Early' ELSE 'On-time' END
                   AS avg_early_or_late
        FROM means""",
)
def flights_timing(spark: SparkSession, folder: str) -> DataFrame:
    labelled = flights.timing(prepared_flights(spark, folder))
    return labelled.withColumn("avgdelay", F.round("avgdelay", 4))


@query(
    "flights_departure_stats",
    f"""WITH {PREPARED_SQL}
        SELECT date, origcity, uniquecarrier, flightnum, crsdeptime, isdepdelay, depdelay,
               min(depdelay) OVER w AS depdelmin, max(depdelay) OVER w AS depdelmax,
               {rounded_sql("avg(depdelay) OVER w", 2)} AS depdelavg, CAST(sum(depdelay) OVER w AS BIGINT) AS depdelsum
        FROM prepared WHERE isdepdelay = 1 AND cancelled = 0
        WINDOW w AS (PARTITION BY date, origcity)""",
)
def flights_departure_stats(spark: SparkSession, folder: str) -> DataFrame:
    stats = flights.departure_stats(prepared_flights(spark, folder))
    return stats.withColumn("date", F.col("date").cast("string"))
