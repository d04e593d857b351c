"""Catalog tables and Parquet inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from fieldmill.functions.text import quoted


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` in ``folder``."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def replace_table(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), path: str | None = None
) -> DataFrame:
    """Write ``df`` as catalog table ``name``, replacing an earlier one, and return the table.

    With ``path`` the table is external, otherwise it is managed. Rows of one partition value are
    written by whichever tasks hold them: no shuffle, so a value that owns most rows cannot pile up
    in a single task. Where many values would mean many small files, repartition before the call.
    """
    spark = df.sparkSession
    drop_table(spark, name)
    writer = df.write.format("parquet").mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return spark.table(name)


def bucketed_table(df: DataFrame, name: str, by: str, buckets: int) -> DataFrame:
    """Write ``df`` as managed table ``name``, its rows dealt to ``buckets`` files sets by a hash of ``by``, and return the table.

    Tables dealt alike join on ``by`` without a shuffle, as often as they are asked; the shuffle is paid once, here. A value
    that owns a large share of the rows makes one large bucket, which a join can't split, so this is for keys
    without such values. The tables lie in the warehouse, which all executors must share.
    """
    spark = df.sparkSession
    drop_table(spark, name)
    dealt = df.repartition(buckets, quoted(by))
    dealt.write.format("parquet").bucketBy(buckets, by).sortBy(by).saveAsTable(name)
    return spark.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop catalog table ``name`` if it is there; files of an external table stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
