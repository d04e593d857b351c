"""Readers that keep what they can't read apart, with the reason and the file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fieldmill.functions.text import quoted
from fieldmill.sources.delimited import DIALECT
from fieldmill.sources.shared import stored

_RECORD, _FILE = "_record", "_file"


def _fields(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _as_text(fields: StructType) -> StructType:
    return StructType([StructField(f.name, StringType()) for f in fields] + [StructField(_RECORD, StringType())])


def _split(parsed: DataFrame, fields: StructType, unreadable: Column, texts: Column) -> tuple[DataFrame, DataFrame]:
    """Good rows, and ``(file, reason, fields, record)`` of the others; what is read is stored once for both."""
    rows = stored(parsed, "read")
    good = rows.where(F.col(_RECORD).isNull()).drop(_RECORD, _FILE)
    bad = rows.where(F.col(_RECORD).isNotNull()).withColumn("_texts", texts)
    # a value that is there as text and null as its type
    failed = [
        F.when(F.col("_texts").getField(f.name).isNotNull() & F.col(quoted(f.name)).isNull(), F.lit(f.name))
        for f in fields
        if not isinstance(f.dataType, StringType)
    ]
    names = F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")
    reason = F.when(unreadable, F.lit("broken record")).when(F.size(names) > 0, "unreadable value").otherwise("broken record")
    return good, bad.select(
        F.col(_FILE).alias("file"),
        reason.alias("reason"),
        F.when(reason == "unreadable value", F.array_join(names, ",")).alias("fields"),
        F.col(_RECORD).alias("record"),
    )


def read_delimited_apart(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType | str,
    sep: str = ",",
    header: bool = True,
    **options: str,
) -> tuple[DataFrame, DataFrame]:
    """The readable rows of delimited files, and the others: ``(file, reason, fields, record)``.

    The reason is ``broken record`` (too few or too many fields) or ``unreadable value``, then with the names of the fields
    whose text isn't of their type. A row of which anything is unreadable is not among the readable ones. The files are
    parsed once. Empty files and empty folders of files give two empty tables.
    """
    fields = _fields(schema)
    settings = {**DIALECT, "sep": sep, **options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _RECORD}
    wide = StructType([*fields, StructField(_RECORD, StringType())])
    files = [paths] if isinstance(paths, str) else list(paths)
    parsed = spark.read.options(**settings).option("header", header).schema(wide).csv(files)
    parsed = parsed.withColumn(_FILE, F.col("_metadata.file_path"))
    texts = F.from_csv(F.col(_RECORD), _ddl(_as_text(fields)), settings)
    return _split(parsed, fields, F.col("_texts").getField(_RECORD).isNotNull(), texts)


def read_json_lines_apart(
    spark: SparkSession, paths: str | Sequence[str], schema: StructType | str, **options: str
) -> tuple[DataFrame, DataFrame]:
    """The readable records of JSON line files, and the others: ``(file, reason, fields, record)``.

    As :func:`read_delimited_apart`; a ``broken record`` is a line that isn't one JSON object. Fields that the schema
    doesn't name are ignored, missing ones are null.
    """
    fields = _fields(schema)
    settings = {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _RECORD}
    wide = StructType([*fields, StructField(_RECORD, StringType())])
    files = [paths] if isinstance(paths, str) else list(paths)
    parsed = spark.read.options(**settings).schema(wide).json(files).withColumn(_FILE, F.col("_metadata.file_path"))
    texts = F.from_json(F.col(_RECORD), _as_text(fields), settings)
    return _split(parsed, fields, F.col("_texts").getField(_RECORD).isNotNull(), texts)


def _ddl(fields: StructType) -> str:
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields)
