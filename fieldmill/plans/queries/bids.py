"""The bid workload on requests derived from orders, streamed from JSON files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmill.operators import expectation_report
from fieldmill.plans import bids
from fieldmill.plans.registry import query
from fieldmill.plans.rehost import BIDS_SQL, bid_documents
from fieldmill.sources import drop_table, load_table, new_shared_folder, stored
from fieldmill.streaming import in_view_flag


def with_bronze(spark: SparkSession, folder: str) -> bids.BidTables:
    tables = bids.BidTables(new_shared_folder(spark, "medallion"))
    bids.update_bronze(spark, bid_documents(spark, folder), tables, bids.BID_SCHEMA)
    return tables


def one_silver(spark: SparkSession, folder: str, stage: str) -> DataFrame:
    return bids.update_silver(spark, with_bronze(spark, folder), [stage])[stage]


def with_silver(spark: SparkSession, folder: str) -> bids.BidTables:
    tables = with_bronze(spark, folder)
    bids.update_silver(spark, tables)
    return tables


def flat_banner(df: DataFrame) -> DataFrame:
    """Struct columns are not comparable with SQL rows, so the banner is shown as text."""
    text = F.concat_ws("x", "imp_banner.h", "imp_banner.w", "imp_banner.pos")
    return df.withColumn("imp_banner", F.when(F.col("imp_banner").isNotNull(), text))


@query(
    "stream_bronze",
    f"""WITH {BIDS_SQL}
        SELECT id, os, country, CASE WHEN n_imp > 0 THEN n_imp END AS n_imp, status, app_name FROM bids""",
)
def stream_bronze(spark: SparkSession, folder: str) -> DataFrame:
    bronze = spark.read.parquet(with_bronze(spark, folder).table("bronze"))
    return bronze.select(
        "id",
        F.col("device.os").alias("os"),
        F.col("device.geo.country").alias("country"),
        F.when(F.col("imp").isNotNull(), F.size("imp")).alias("n_imp"),
        F.col("ext.ads_txt.status").alias("status"),
        F.col("app.name").alias("app_name"),
    )


@query(
    "stream_bronze_new_field",
    f"""WITH {BIDS_SQL}
        SELECT id, os AS device_os, country AS device_country,
               CASE WHEN o_orderkey % 2 = 1 THEN 'model ' || o_custkey % 9 END AS device_model,
               CASE WHEN o_orderkey % 2 = 1 THEN o_orderkey + 1000 END AS at,
               CAST(CASE WHEN n_imp > 0 THEN n_imp END AS INTEGER) AS n_imp
        FROM bids""",
)
def stream_bronze_new_field(spark: SparkSession, folder: str) -> DataFrame:
    """Requests in two drops, the second with two more fields; both go through bronze and silver."""
    root = new_shared_folder(spark, "drops")
    tables = bids.BidTables(f"{root}/tables")
    drops = [("first", "o_orderkey % 2 = 0", "", ""), ("second", "o_orderkey % 2 = 1",
             "o_orderkey + 1000 AS at,", "concat('model ', o_custkey % 9) AS model,")]
    for name, which, more, device in drops:
        bid_documents(spark, folder, f"{root}/incoming/{name}", which, more, device)
        bronze = bids.update_bronze(spark, f"{root}/incoming/*", tables)
        silver = bids.update_silver(spark, tables, ["device"])["device"]
    kept = bronze.select("id", "at", F.when(F.col("imp").isNotNull(), F.size("imp")).alias("n_imp"))
    return silver.join(kept, F.col("device_auction_id") == F.col("id")).select(
        "id", "device_os", "device_country", "device_model", "at", "n_imp"
    )


@query(
    "in_view_share",
    "SELECT count(*) AS n, true AS only_flags, true AS share_is_close FROM orders",
)
def in_view_share(spark: SparkSession, folder: str) -> DataFrame:
    """The random flag drawn for every order: only 0 and 1, and three in five are 1."""
    flags = load_table(spark, folder, "orders").select(in_view_flag(F.col("o_orderkey")).alias("flag"))
    return flags.agg(
        F.count("*").alias("n"),
        F.bool_and(F.col("flag").isin(0.0, 1.0)).alias("only_flags"),
        (F.abs(F.avg("flag") - 0.6) <= 0.02).alias("share_is_close"),
    )


@query(
    "stream_silver_device",
    f"""WITH {BIDS_SQL}
        SELECT id AS device_auction_id, os AS device_os, ua AS device_ua, country AS device_country
        FROM bids""",
)
def stream_silver_device(spark: SparkSession, folder: str) -> DataFrame:
    return one_silver(spark, folder, "device")


@query(
    "stream_silver_imp",
    f"""WITH {BIDS_SQL}
        SELECT imp_auction_id, imp_id, imp_bidfloor, h || 'x' || w || 'x' || pos AS imp_banner FROM imps""",
)
def stream_silver_imp(spark: SparkSession, folder: str) -> DataFrame:
    return one_silver(spark, folder, "imp").transform(flat_banner)


@query(
    "stream_silver_site",
    f"""WITH {BIDS_SQL}
        SELECT id AS site_auction_id, status AS site_gdpr_status, app_id AS site_id, app_name AS site_name
        FROM bids""",
)
def stream_silver_site(spark: SparkSession, folder: str) -> DataFrame:
    return one_silver(spark, folder, "site")


GOLD_SQL = f"""WITH {BIDS_SQL}, gold AS (
    SELECT id AS device_auction_id, os AS device_os, ua AS device_ua, country AS device_country,
           imp_auction_id, imp_id, imp_bidfloor, h || 'x' || w || 'x' || pos AS imp_banner,
           id AS site_auction_id, status AS site_gdpr_status, app_id AS site_id, app_name AS site_name,
           round(o_orderkey * 7919 % 1000 / 1000.0 + 0.1) AS in_view
    FROM bids LEFT JOIN imps ON id = imp_auction_id)"""


def gold_table(spark: SparkSession, folder: str, only_valid_consent: bool) -> DataFrame:
    # In place of the random draw: the same rounding of a number that SQL can compute too.
    number = F.substring_index("device_auction_id", "-", -1).cast("bigint")
    in_view = F.round(number * 7919 % 1000 / 1000.0 + 0.1)
    tables = with_silver(spark, folder)
    return bids.build_gold(spark, tables, in_view, only_valid_consent).transform(flat_banner)


@query("gold_bids", f"{GOLD_SQL} SELECT * FROM gold")
def gold_bids(spark: SparkSession, folder: str) -> DataFrame:
    return gold_table(spark, folder, only_valid_consent=False)


@query("gold_bids_expected", f"{GOLD_SQL} SELECT * FROM gold WHERE site_gdpr_status > 0")
def gold_bids_expected(spark: SparkSession, folder: str) -> DataFrame:
    return gold_table(spark, folder, only_valid_consent=True)


@query("gold_bids_incremental", f"{GOLD_SQL} SELECT * FROM gold")
def gold_bids_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Requests in two drops; the second time only the buckets of its auctions are joined anew."""
    root = new_shared_folder(spark, "drops")
    tables = bids.BidTables(f"{root}/tables", buckets=8)
    number = F.substring_index("device_auction_id", "-", -1).cast("bigint")
    in_view = F.round(number * 7919 % 1000 / 1000.0 + 0.1)
    for name, which in [("first", "o_orderkey % 16 <> 3"), ("second", "o_orderkey % 16 = 3")]:
        bid_documents(spark, folder, f"{root}/incoming/{name}", which)
        bids.update_bronze(spark, f"{root}/incoming/*", tables)
        bids.update_silver(spark, tables)
        table = bids.update_gold(spark, tables, in_view)
    return table.transform(flat_banner)


@query("gold_bids_bucketed", f"{GOLD_SQL} SELECT * FROM gold")
def gold_bids_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """Silver as tables dealt by auction; gold joins them as they lie. The answer is stored before the tables are dropped."""
    number = F.substring_index("device_auction_id", "-", -1).cast("bigint")
    in_view = F.round(number * 7919 % 1000 / 1000.0 + 0.1)
    requests = bids.read_bids(spark, bid_documents(spark, folder))
    names = {stage: f"fieldmill_{stage}_{uuid.uuid4().hex}" for stage in bids.SILVER_STEPS}
    table = stored(bids.bucketed_gold(requests, names, in_view=in_view), "gold")
    for name in names.values():
        drop_table(spark, name)
    return table.transform(flat_banner)


@query(
    "expectation_report",
    f"""WITH {BIDS_SQL}
        SELECT 'valid_gdpr_status' AS expectation, count(*) FILTER (status > 0) AS kept,
               count(*) - count(*) FILTER (status > 0) AS dropped FROM bids
        UNION ALL
        SELECT 'known_app', count(*), 0 FROM bids""",
)
def consent_report(spark: SparkSession, folder: str) -> DataFrame:
    """How many bids each expectation keeps and drops."""
    site = one_silver(spark, folder, "site")
    return expectation_report(
        site, {"valid_gdpr_status": bids.VALID_CONSENT, "known_app": "site_id IS NOT NULL"}
    )
