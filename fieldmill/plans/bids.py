"""Bid requests from raw JSON files to a joined table, stage by stage."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from fieldmill.operators import expect_or_drop
from fieldmill.sources import bucketed_table, path_exists, read_json, stored
from fieldmill.streaming import (
    SchemaLog,
    gold,
    run_available,
    silver_device,
    silver_imp,
    silver_site,
    start_available,
    stored_schema,
    stream_json,
    stream_parquet,
    with_schema,
)

# The fields that the silver steps read. As an explicit schema it narrows bronze to them.
BID_SCHEMA = """
    id string,
    device struct<os: string, ua: string, geo: struct<country: string>>,
    imp array<struct<id: string, bidfloor: double, banner: struct<h: int, w: int, pos: int>>>,
    ext struct<ads_txt: struct<status: int>>,
    app struct<id: string, name: string>
"""
GOLD_BUCKETS = 64
VALID_CONSENT = "site_gdpr_status IS NOT NULL AND site_gdpr_status > 0"


@dataclass(frozen=True)
class BidTables:
    """Where the stages keep their tables and their progress: sub-folders of ``root``.

    With ``buckets`` the silver tables are stored by a hash of the auction, so that :func:`update_gold` reads only the
    buckets of changed auctions.
    """

    root: str
    buckets: int | None = None

    def table(self, stage: str, generation: int = 0) -> str:
        return f"{self.root}/{stage}" + (f"_{generation}" if generation else "")

    def checkpoint(self, stage: str, generation: int = 0) -> str:
        return f"{self.root}/_progress/{stage}" + (f"_{generation}" if generation else "")

    def schema_log(self, spark: SparkSession) -> SchemaLog:
        return SchemaLog(spark, f"{self.root}/_progress/bronze_schemas")


def update_bronze(
    spark: SparkSession,
    incoming: str,
    tables: BidTables,
    schema: StructType | str | None = None,
    multi_line: bool = True,
    **options: str,
) -> DataFrame:
    """Append the bids of new files in ``incoming`` as they are, with every field they have.

    Without a schema the fields and types are inferred, from the files that no earlier run has looked at only, and
    merged with those known before (:class:`~fieldmill.streaming.SchemaLog`). New fields join the stored table; where a
    field needs a wider type, the rows from then on are stored apart (a *generation*) and all are read in the wider one.
    A given schema saves the inference and keeps only its own fields. ``maxBytesPerTrigger`` or
    ``maxFilesPerTrigger`` cut a large backlog into several micro-batches.
    """
    if schema is not None:
        raw = stream_json(spark, incoming, schema, multi_line=multi_line, **options)
        return run_available(raw, tables.table("bronze"), tables.checkpoint("bronze"))
    known = tables.schema_log(spark).update(
        incoming, lambda paths: read_json(spark, paths, multi_line=multi_line).schema
    )
    current = known[-1] if known else BID_SCHEMA
    raw = stream_json(spark, incoming, current, multi_line=multi_line, **options)
    raw = raw.withColumn("generation", F.lit(max(len(known) - 1, 0)))
    start_available(raw, tables.table("bronze"), tables.checkpoint("bronze"), ["generation"]).awaitTermination()
    return read_bronze(spark, tables)


def _generations(
    spark: SparkSession, tables: BidTables, schema: StructType | str | None = None
) -> list[tuple[int | None, StructType | str]]:
    """(generation, schema) of the stored bids; a table written with a given schema has none."""
    if schema is not None:
        return [(None, schema)]
    known = tables.schema_log(spark).generations()
    return list(enumerate(known)) or [(None, stored_schema(spark, tables.table("bronze"), BID_SCHEMA))]


def _stored(fields: StructType | str, generation: int | None) -> StructType | str:
    """The schema of bronze files, with the folder they lie in if they were written by generation."""
    return fields if generation is None else StructType([*fields, StructField("generation", IntegerType())])


def _of_generation(df: DataFrame, generation: int | None) -> DataFrame:
    return df if generation is None else df.where(F.col("generation") == generation).drop("generation")


def _together(parts: Sequence[DataFrame], schema: StructType) -> DataFrame:
    return reduce(DataFrame.union, [with_schema(part, schema) for part in parts])


def read_bronze(spark: SparkSession, tables: BidTables) -> DataFrame:
    """All stored bids, in the types of the last generation. A field that older files lack is null there."""
    found = _generations(spark, tables)
    stored = [spark.read.schema(_stored(schema, g)).parquet(tables.table("bronze")) for g, schema in found]
    parts = [_of_generation(rows, g) for rows, (g, _) in zip(stored, found)]
    return _together(parts, parts[-1].schema)


SILVER_STEPS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "device": silver_device,
    "imp": silver_imp,
    "site": silver_site,
}


def _bucket(auction: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(auction).cast("string")), F.lit(buckets)).cast("int")


def update_silver(
    spark: SparkSession,
    tables: BidTables,
    stages: Sequence[str] = tuple(SILVER_STEPS),
    schema: StructType | str | None = None,
    **options: str,
) -> dict[str, DataFrame]:
    """Run silver steps over the bronze rows they have not seen, side by side, and wait for all.

    Without a schema bronze is read with the fields of all its files.
    """
    found = _generations(spark, tables, schema)
    running = []
    for generation, fields in found:
        stored = stream_parquet(spark, tables.table("bronze"), _stored(fields, generation), **options)
        new_bids = _of_generation(stored, generation)
        for stage in stages:
            rows, where = SILVER_STEPS[stage](new_bids), generation or 0
            if tables.buckets:
                rows = rows.withColumn("bucket", _bucket(f"{stage}_auction_id", tables.buckets))
            running.append(
                start_available(
                    rows, tables.table(stage, where), tables.checkpoint(stage, where), ["bucket"] if tables.buckets else ()
                )
            )
    for stream in running:
        stream.awaitTermination()
    return {stage: _read_silver(spark, tables, stage, found) for stage in stages}


def _read_silver(spark: SparkSession, tables: BidTables, stage: str, found: list, buckets: Sequence[int] = ()) -> DataFrame:
    parts = []
    for generation, fields in found:
        columns = SILVER_STEPS[stage](spark.createDataFrame([], fields)).schema
        rows = spark.read.schema(columns).parquet(tables.table(stage, generation or 0))
        if buckets:
            where = F.col("bucket") if "bucket" in rows.columns else _bucket(f"{stage}_auction_id", tables.buckets or GOLD_BUCKETS)
            rows = rows.where(where.isin(*buckets))
        parts.append(rows.select(*[F.col(f"`{name}`") for name in columns.names]))
    return _together(parts, columns)


def read_silver(
    spark: SparkSession, tables: BidTables, stage: str, schema: StructType | str | None = None
) -> DataFrame:
    """A stored silver table; it may still be without rows. A field that older files lack is null there."""
    return _read_silver(spark, tables, stage, _generations(spark, tables, schema))


def _gold(
    spark: SparkSession, tables: BidTables, found: list, in_view: Column | None, only_valid_consent: bool, buckets: Sequence[int] = ()
) -> DataFrame:
    device, imp, site = (_read_silver(spark, tables, stage, found, buckets) for stage in SILVER_STEPS)
    bids = gold(device, imp, site, in_view)
    return expect_or_drop(bids, "valid_gdpr_status", VALID_CONSENT) if only_valid_consent else bids


def build_gold(
    spark: SparkSession,
    tables: BidTables,
    in_view: Column | None = None,
    only_valid_consent: bool = False,
    schema: StructType | str | None = None,
) -> DataFrame:
    """Recompute gold from the stored silver tables, optionally with the consent gate."""
    return _gold(spark, tables, _generations(spark, tables, schema), in_view, only_valid_consent)


def read_bids(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str = BID_SCHEMA) -> DataFrame:
    """Bid requests from JSON documents as one batch."""
    return read_json(spark, paths, multi_line=True, schema=schema)


def bucketed_gold(
    bronze: DataFrame, names: dict[str, str], buckets: int = GOLD_BUCKETS, in_view: Column | None = None
) -> DataFrame:
    """Gold over silver stored as bucketed catalog tables ``names`` (by stage), so that no join shuffles.

    For silver that is asked often and whose auctions all have few impressions: the shuffle is paid once, when the tables are
    written. An auction with very many impressions is better served by :func:`build_gold`, whose joins can split it.
    """
    stored_bids = stored(bronze, "bids")
    tables = {
        stage: bucketed_table(step(stored_bids), names[stage], f"{stage}_auction_id", buckets)
        for stage, step in SILVER_STEPS.items()
    }
    return gold(tables["device"], tables["imp"], tables["site"], in_view)


def update_gold(
    spark: SparkSession,
    tables: BidTables,
    in_view: Column | None = None,
    only_valid_consent: bool = False,
    schema: StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """Bring the stored gold table up to date with silver: only the buckets of auctions that have new silver rows are rebuilt.

    Gold is stored by bucket of the auction. The new rows of all three silver tables name the buckets that changed (at
    most as many numbers as there are buckets); those are joined anew from silver and replace what was stored, as one
    overwrite, so a run repeated after a failure leaves the same table. With :attr:`BidTables.buckets` silver
    is read by bucket too. A bid of an auction seen before so changes the earlier rows of that auction as
    :func:`build_gold` would. The first run builds everything, as does the first one after a change of types.
    """
    found, buckets = _generations(spark, tables, schema), tables.buckets or GOLD_BUCKETS
    last = len(found) - 1

    def changed(stage: str, generation: int | None, fields) -> DataFrame:
        columns = SILVER_STEPS[stage](spark.createDataFrame([], fields)).schema
        rows = stream_parquet(spark, tables.table(stage, generation or 0), columns, **options)
        return rows.select(_bucket(f"{stage}_auction_id", buckets).alias("bucket"))

    def rebuild(batch: DataFrame, _: int) -> None:
        numbers = [row["bucket"] for row in batch.distinct().collect()]
        if not numbers:
            return
        bids = _gold(spark, tables, found, in_view, only_valid_consent, numbers)
        (
            bids.withColumn("bucket", _bucket("device_auction_id", buckets))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("bucket")
            .parquet(tables.table("gold", last))
        )

    streams = [changed(stage, generation, fields) for generation, fields in found for stage in SILVER_STEPS]
    (
        reduce(DataFrame.union, streams)
        .writeStream.foreachBatch(rebuild)
        .option("checkpointLocation", tables.checkpoint("gold", last))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    columns = _gold(spark, tables, found, in_view, only_valid_consent).schema
    if not path_exists(spark, tables.table("gold", last)):
        return spark.createDataFrame([], columns)
    return spark.read.schema(columns).parquet(tables.table("gold", last)).select(*columns.names)
