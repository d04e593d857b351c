"""Daily temperatures: explicit schema, catalog table, SQL question."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

TEMPS_SCHEMA = StructType(
    [
        StructField("AirportCode", StringType(), False),
        StructField("Date", DateType(), False),
        StructField("TempHighF", IntegerType(), False),
        StructField("TempLowF", IntegerType(), False),
    ]
)


def temps_from_rows(spark: SparkSession, rows: Iterable[tuple[str, date, int, int]]) -> DataFrame:
    """Temperatures given as tuples."""
    return spark.createDataFrame(list(rows), TEMPS_SCHEMA)


def warm_days(spark: SparkSession, table: str, without: str, after: str) -> DataFrame:
    """Distinct readings of all airports but one after a day, warmest first."""
    return spark.sql(
        f"""
        SELECT DISTINCT AirportCode, Date, TempHighF, TempLowF
        FROM {table}
        WHERE AirportCode <> :without AND Date > CAST(:after AS DATE)
        ORDER BY TempHighF DESC
        """,
        args={"without": without, "after": after},
    )
