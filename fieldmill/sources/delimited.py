"""Delimited text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Where the expected format differs from Spark's own CSV defaults.
# (Empty text as null, NaN / Inf / -Inf, kept blanks and permissive mode are the defaults already.)
DIALECT = {
    "escape": '"',
    "maxColumns": "2048",
    "dateFormat": "yyyy-MM-dd",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
}


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str = ",",
    header: bool = True,
    infer: bool = False,
    schema: StructType | str | None = None,
    encoding: str = "UTF-8",
    **options: str,
) -> DataFrame:
    """Read one or many delimited files as one table.

    Without a schema every column is a string; ``infer=True`` asks Spark to guess the types, which
    costs one more pass over the files. ``options`` override the dialect, for instance
    ``nullValue="NA"`` or ``ignoreLeadingWhiteSpace="true"``. Read errors are raised.
    """
    reader = spark.read.options(**DIALECT).options(
        sep=sep, header=header, inferSchema=infer, encoding=encoding, **options
    )
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv([paths] if isinstance(paths, str) else list(paths))


def read_with_borrowed_header(
    spark: SparkSession,
    header_paths: str | Sequence[str],
    other_paths: str | Sequence[str],
    sep: str = ",",
    **options: str,
) -> DataFrame:
    """Read files of which only the first ones name their columns.

    The names found in ``header_paths`` are given to the header-less ``other_paths`` and both are
    stacked. Only the header line is looked at while planning.
    """
    named = read_delimited(spark, header_paths, sep=sep, **options)
    unnamed = read_delimited(
        spark, other_paths, sep=sep, header=False, schema=named.schema, **options
    )
    return unnamed.union(named)
