"""Silver and gold steps over bid requests.

The silver steps are stateless, so the same function serves a stream and a batch table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmill.operators.lookups import left_join_many
from fieldmill.operators.nested import flatten_struct, prefix_columns


def silver_device(bronze: DataFrame) -> DataFrame:
    """One row per bid: the device and its location, columns ``device_*``."""
    return (
        bronze.select(F.col("id").alias("auction_id"), "device")
        .transform(flatten_struct, "device")
        .transform(flatten_struct, "geo")
        .transform(prefix_columns, "device_")
    )


def silver_imp(bronze: DataFrame) -> DataFrame:
    """One row per impression, columns ``imp_*``; bids without impressions have none."""
    return (
        bronze.select(F.col("id").alias("auction_id"), F.explode("imp").alias("imp"))
        .transform(flatten_struct, "imp")
        .transform(prefix_columns, "imp_")
    )


def silver_site(bronze: DataFrame) -> DataFrame:
    """One row per bid: consent status and app, columns ``site_*``."""
    return (
        bronze.select(
            F.col("id").alias("auction_id"),
            F.col("ext.ads_txt.status").alias("gdpr_status"),
            "app",
        )
        .transform(flatten_struct, "app")
        .transform(prefix_columns, "site_")
    )


def in_view_flag(*keys: Column, seed: int = 0) -> Column:
    """A random 0/1 flag, 1 with probability 0.6.

    With ``keys`` the draw is a hash of them: a task that runs again after a lost executor draws the
    same values, which ``rand`` does not promise behind a shuffle.
    """
    if not keys:
        return F.round(F.rand(seed) + 0.1)
    draw = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1_000_000)) / F.lit(1_000_000.0)
    return F.round(draw + 0.1)


def gold(
    device: DataFrame, imp: DataFrame, site: DataFrame, in_view: Column | None = None
) -> DataFrame:
    """``device LEFT JOIN imp LEFT JOIN site`` on the auction, plus ``in_view``.

    Device and site hold one row per bid and are joined first; the impressions, of which one auction
    may have very many, come last and through a join that lets Spark split a heavy auction.
    """
    if in_view is None:
        in_view = in_view_flag(F.col("device_auction_id"), F.col("imp_id"))
    on = F.col("device_auction_id") == F.col("site_auction_id")
    bids = device.join(site, on, "left")
    joined = left_join_many(bids, imp, "device_auction_id", "imp_auction_id")
    return joined.select(
        *device.columns, *imp.columns, *site.columns, in_view.alias("in_view")
    )

