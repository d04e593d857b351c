"""XML text held in a column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from fieldmill.functions.text import quoted


def parse_xml(
    text: Column, schema: StructType | str, options: Mapping[str, str] | None = None
) -> Column:
    """XML text as a struct; attributes carry a ``_`` prefix. Broken or null text gives null fields."""
    if isinstance(schema, StructType):
        schema = schema.simpleString()
    return F.from_xml(text, schema, dict(options or {}))


def infer_xml_schema(df: DataFrame, column: str, repeated: Sequence[str] = ()) -> StructType:
    """The schema that fits the XML texts of a whole column. Runs a job over that column.

    Every text is looked at by Spark's own inference, spread over the tasks, so a child or
    attribute that turns up in a single row is not missed. Children listed in ``repeated`` become
    arrays even when no row repeats them. A known schema is cheaper: pass it to :func:`parse_xml`.
    """
    texts = df.select(F.col(quoted(column))).where(F.col(quoted(column)).isNotNull())
    reader = df.sparkSession.read.option("mode", "DROPMALFORMED")
    # Spark's reader infers from a Dataset[String]; handed over as one, the texts never leave the JVM.
    strings = getattr(texts._jdf, "as")(df.sparkSession._jvm.org.apache.spark.sql.Encoders.STRING())
    found = reader._df(reader._jreader.xml(strings)).schema
    fields = []
    for field in found.fields:
        if field.name in repeated and not isinstance(field.dataType, ArrayType):
            field = StructField(field.name, ArrayType(field.dataType), True)
        fields.append(field)
    return StructType(fields)
