"""The schemas that a folder of JSON files has had, so that only new files need to be looked at."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, LongType, StringType, StructField, StructType

from fieldmill.sources.shared import path_exists


def merged_type(known: DataType, found: DataType) -> DataType:
    """The narrowest type that holds both: structs by field, arrays by element, numbers as double, all else as text."""
    if known == found:
        return known
    if isinstance(known, StructType) and isinstance(found, StructType):
        others = {field.name: field for field in found}
        fields = [
            StructField(f.name, merged_type(f.dataType, others.pop(f.name).dataType) if f.name in others else f.dataType)
            for f in known
        ]
        return StructType(fields + [StructField(f.name, f.dataType) for f in others.values()])
    if isinstance(known, ArrayType) and isinstance(found, ArrayType):
        return ArrayType(merged_type(known.elementType, found.elementType))
    if isinstance(known, (LongType, DoubleType)) and isinstance(found, (LongType, DoubleType)):
        return DoubleType()
    return StringType()


def only_adds_fields(known: DataType, merged: DataType) -> bool:
    """Whether files of type ``known`` can be read as ``merged``: the same types, and more fields perhaps."""
    if isinstance(known, StructType) and isinstance(merged, StructType):
        types = {field.name: field.dataType for field in merged}
        return all(f.name in types and only_adds_fields(f.dataType, types[f.name]) for f in known)
    if isinstance(known, ArrayType) and isinstance(merged, ArrayType):
        return only_adds_fields(known.elementType, merged.elementType)
    return known == merged


def as_type(column: Column, have: DataType, want: DataType) -> Column:
    """A column of a type in a type that :func:`merged_type` made of it; missing fields are null, structures as text are JSON."""
    if have == want:
        return column
    if isinstance(have, StructType) and isinstance(want, StructType):
        types = {field.name: field.dataType for field in have}
        fields = [
            (as_type(column.getField(f.name), types[f.name], f.dataType) if f.name in types else F.lit(None).cast(f.dataType)).alias(
                f.name
            )
            for f in want
        ]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(have, ArrayType) and isinstance(want, ArrayType):
        return F.transform(column, lambda x: as_type(x, have.elementType, want.elementType))
    if isinstance(have, (StructType, ArrayType)):
        return F.to_json(column)
    return column.cast(want)


def with_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with the columns and types of ``schema``, which was merged from its own."""
    types = {field.name: field.dataType for field in df.schema}
    return df.select(
        *[
            (as_type(F.col(f"`{f.name}`"), types[f.name], f.dataType) if f.name in types else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


class SchemaLog:
    """Schemas in the order they were found, and the files they were found in, stored in ``folder``.

    A *generation* is a run of schemas that only add fields to one another, so one read with the last of them
    serves the files of all. A field that needs another type (a number that turns out fractional, text where a number
    was) begins the next generation.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def generations(self) -> list[StructType]:
        """The last schema of each generation; none before the first file."""
        if not path_exists(self.spark, f"{self.folder}/schemas"):
            return []
        rows = self.spark.read.parquet(f"{self.folder}/schemas").orderBy("version").collect()
        last = {row["generation"]: row["fields"] for row in rows}
        return [StructType.fromJson(json.loads(last[g])) for g in sorted(last)]

    def unseen(self, incoming: str) -> DataFrame:
        """``(path, modificationTime)`` of the files whose schema isn't known yet. Their contents are not read."""
        files = self.spark.read.format("binaryFile").load(incoming).select("path", "modificationTime")
        if not path_exists(self.spark, f"{self.folder}/files"):
            return files
        return files.join(self.spark.read.parquet(f"{self.folder}/files"), ["path", "modificationTime"], "left_anti")

    def update(self, incoming: str, infer: Callable[[list[str]], StructType]) -> list[StructType]:
        """The generations with the files of ``incoming`` that are new, whose schema ``infer`` finds from their paths.

        The schema is stored before the files count as seen: after a failure between the two, the same files are looked
        at once more and change nothing.
        """
        unseen = self.unseen(incoming)
        found = unseen.collect()
        known = self.generations()
        if not found:
            return known
        merged = infer([_literal(row["path"]) for row in found])
        if known:
            merged = merged_type(known[-1], merged)
        if not known or merged != known[-1]:
            adds = bool(known) and only_adds_fields(known[-1], merged)
            generation = len(known) - adds if known else 0
            version = self._versions()
            row = [(version, generation, merged.json())]
            entry = self.spark.createDataFrame(row, "version int, generation int, fields string")
            entry.coalesce(1).write.mode("append").parquet(f"{self.folder}/schemas")
            known = [*(known[:-1] if adds else known), merged]
        seen = self.spark.createDataFrame(found, unseen.schema)
        seen.coalesce(1).write.mode("append").parquet(f"{self.folder}/files")
        return known

    def _versions(self) -> int:
        if not path_exists(self.spark, f"{self.folder}/schemas"):
            return 0
        return self.spark.read.parquet(f"{self.folder}/schemas").count()


def _literal(path: str) -> str:
    """A path in which no character means several paths."""
    return "".join(f"\\{c}" if c in "[]{}*?\\" else c for c in path)
