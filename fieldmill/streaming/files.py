"""File streams: new files in, appended Parquet out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def stream_json(
    spark: SparkSession,
    folder: str,
    schema: StructType | str,
    multi_line: bool = False,
    **options: str,
) -> DataFrame:
    """Stream the JSON files of a folder, those already there included.

    A stream needs a schema; ``read_json(...).schema`` infers one from files that exist. Options
    such as ``maxBytesPerTrigger`` bound the size of one micro-batch.
    """
    reader = spark.readStream.schema(schema).option("multiLine", multi_line)
    if multi_line:
        reader = reader.option("encoding", "UTF-8")
    return reader.options(**options).json(folder)


def stored_schema(spark: SparkSession, folder: str, empty: StructType | str) -> StructType | str:
    """The columns of all Parquet files in ``folder``, those of later files included; ``empty`` without files."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(folder).schema
    except AnalysisException as error:
        if "unable to infer schema" not in str(error).lower():
            raise
        return empty


def stream_parquet(
    spark: SparkSession, folder: str, schema: StructType | str | None = None, **options: str
) -> DataFrame:
    """Stream a table that another stream wrote to ``folder``.

    Without a schema the one of all stored files is taken; an empty table has none.
    """
    if schema is None:
        schema = spark.read.option("mergeSchema", "true").parquet(folder).schema
    return spark.readStream.schema(schema).options(**options).parquet(folder)


def start_available(
    df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Start appending everything the stream has not processed yet to ``path``, then end.

    Progress is kept in ``checkpoint``: a later start with the same folders takes only new files, and
    a start after a failure resumes without repeating rows.
    """
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(path)


def run_available(
    df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """:func:`start_available`, wait for the end, and return the stored table with the columns of all runs."""
    start_available(df, path, checkpoint, partition_by).awaitTermination()
    spark = df.sparkSession
    return spark.read.schema(stored_schema(spark, path, df.schema)).parquet(path)
