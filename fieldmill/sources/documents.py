"""JSON files: one record per line, or whole documents that span lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from fieldmill.functions.text import quoted


def read_json(
    spark: SparkSession,
    paths: str | Sequence[str],
    multi_line: bool = False,
    schema: StructType | str | None = None,
    encoding: str = "UTF-8",
) -> DataFrame:
    """Read JSON lines, or one document per file with ``multi_line=True``.

    Line files are split between tasks. A document file is parsed by one task as a whole, so large
    data belongs in many document files. A given schema saves the inference pass.

    For documents the encoding is always declared. Left to detect it, Spark goes back to the file
    for every number that it has to keep as text, which is slow on disk and one request each on an
    object store.
    """
    reader = spark.read.option("multiLine", multi_line)
    if multi_line:
        reader = reader.option("encoding", encoding)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json([paths] if isinstance(paths, str) else list(paths))


def read_document_records(
    spark: SparkSession,
    paths: str | Sequence[str],
    record: str,
    head: str = r"\s*\[",
    separator: str = "\n,",
    **options: str,
) -> DataFrame:
    """The records of large JSON documents, ``(record, unread)``, each document read by as many tasks as its size asks for.

    A document is one array of records, perhaps inside an object: ``head`` is a regular expression for all that comes
    before the first record and for the beginning of no record; ``separator`` is the text between two records, which
    appears nowhere else. ``record`` is the type of a record, an array or a struct. The files are split at separators like text
    at line ends, so no task holds a document. What can't be parsed is null and kept as text in ``unread``; a document without
    records gives none. ``options`` are those of the JSON parser.
    """
    files = [paths] if isinstance(paths, str) else list(paths)
    chunks = spark.read.option("lineSep", separator).text(files)
    text = F.regexp_replace("value", f"^(?s:{head})", "")
    kind = DataType.fromDDL(record)
    if isinstance(kind, StructType):
        # a broken object would be a struct of nulls
        whole = StructType([*kind, StructField("_unread", StringType())])
        parsed = F.from_json("text", whole, {**options, "columnNameOfCorruptRecord": "_unread"})
        parsed = F.when(parsed["_unread"].isNull(), parsed.dropFields("_unread"))
    else:
        parsed = F.from_json("text", kind, options)
    nothing = F.col("text").rlike(r"^[\s\]\}]*$")
    rows = chunks.select(text.alias("text")).where(~nothing).select(parsed.alias("record"), "text")
    return rows.select("record", F.when(F.col("record").isNull(), F.col("text")).alias("unread"))


def json_view(
    spark: SparkSession, name: str, path: str, multi_line: bool = False, replace: bool = True
) -> None:
    """Declare a JSON source in SQL under a temporary view name."""
    create = "CREATE OR REPLACE" if replace else "CREATE"
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    options = f"path '{location}'" + (", multiLine 'true', encoding 'UTF-8'" if multi_line else "")
    spark.sql(f"{create} TEMPORARY VIEW `{name}` USING json OPTIONS ({options})")


def write_documents(
    df: DataFrame, path: str, head: str = "[", foot: str = "]", rows_per_document: int = 10_000
) -> None:
    """Write one string column as multi-line documents: ``head``, comma-separated rows, ``foot``.

    Each task's rows are numbered and every ``rows_per_document`` of them are put together into one document,
    a file of its own. So no document grows with the data, and all of it stays in the JVM.
    """
    number = F.monotonically_increasing_id()
    rows = df.select(F.col(quoted(df.columns[0])).alias("row"), number.alias("number"))
    task, place = F.shiftright("number", 33), F.col("number").bitwiseAND((1 << 33) - 1)
    documents = rows.groupBy(task.alias("task"), F.floor(place / rows_per_document).alias("part")).agg(
        F.array_join(F.collect_list("row"), "\n,").alias("rows")
    )
    (
        documents.select(F.concat(F.lit(head + "\n"), "rows", F.lit("\n" + foot)))
        .write.option("maxRecordsPerFile", 1)
        .text(path)
    )
