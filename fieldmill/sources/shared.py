"""Working folders that every executor can reach."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_made_here: list[str] = []


def _filesystem(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder of any file system is there."""
    where, filesystem = _filesystem(spark, path)
    return filesystem.exists(where)


def new_shared_folder(spark: SparkSession, label: str) -> str:
    """A new, empty path under the folder named by ``spark.checkpoint.dir``.

    Intermediate files (text round-trips, stream sinks, stream checkpoints) go there, so that they
    outlive the executor that wrote them. Only a local session without that setting gets a
    temporary folder of its own; a cluster session without it is refused, since a machine-local
    folder would be visible to one host only. The path is removed when the driver JVM ends, or
    earlier by :func:`remove_shared_folders`.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.gettempdir()
    folder = f"{root.rstrip('/')}/fieldmill-{label}-{uuid.uuid4().hex}"
    path, filesystem = _filesystem(spark, folder)
    filesystem.mkdirs(path)
    filesystem.deleteOnExit(path)
    _made_here.append(folder)
    return folder


def remove_shared_folders(spark: SparkSession) -> int:
    """Remove the folders this process has made so far and return how many there were.

    For long-lived drivers, once no result that reads them is needed any more.
    """
    removed = len(_made_here)
    while _made_here:
        path, filesystem = _filesystem(spark, _made_here.pop())
        filesystem.delete(path, True)
    return removed


def stored_path(df: DataFrame, label: str) -> str:
    """Write ``df`` to a new shared folder and return the path of the written table."""
    path = f"{new_shared_folder(df.sparkSession, label)}/table"
    df.write.parquet(path)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new shared folder and return the written table.

    For a prepared table that several steps read: text is parsed and joined once, the later reads are
    columnar and pruned, and they survive the loss of an executor.
    """
    return df.sparkSession.read.schema(df.schema).parquet(stored_path(df, label))
