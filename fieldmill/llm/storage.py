"""Step results in the shared folder, with the disk of finished steps given back."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame

from fieldmill.sources.shared import new_shared_folder


def step(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder, read it back and let go of the shuffle files that made it.

    Spark removes a shuffle's files when the driver has collected all handles to it; asking for that after each
    step keeps the disk that a job of many steps needs near that of its largest step. The first round lets
    the JVM see what Python has dropped, the second collects it.
    """
    spark = df.sparkSession
    path, schema = f"{new_shared_folder(spark, label)}/table", df.schema
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(schema).parquet(path)
    del df
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    return table
