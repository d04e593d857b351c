"""Inputs of the three workloads, derived row by row from the Parquet tables.

Each derivation is a list of SQL expressions that Spark and the checking database both understand,
so that the same made-up field values reach both sides. Every source row gives one input row: no
grouping, so nothing here depends on how often a key occurs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmill.sources import load_table, new_shared_folder, write_documents


def _clock(minutes: str) -> str:
    """Minutes of the day as an hour-minute number, 75 -> 115."""
    return f"CAST((({minutes}) - ({minutes}) % 60) / 60 * 100 + ({minutes}) % 60 AS INT)"


def _unless(condition: str, value: str) -> str:
    return f"CASE WHEN {condition} THEN 'NA' ELSE CAST({value} AS STRING) END"


_CANCELLED = "l_orderkey % 50 = 0"
_DEP_PLAN = "(l_orderkey * 37 + l_linenumber * 11) % 1440"
_DEP_DELAY = "(l_partkey % 61 - 15)"
_DEP_REAL = f"(({_DEP_PLAN}) + {_DEP_DELAY} + 1440) % 1440"
_ARR_PLAN = "(l_orderkey * 41 + l_suppkey) % 1440"
_ARR_DELAY = "(l_suppkey % 47 - 12 + l_linenumber)"
_ARR_REAL = f"(({_ARR_PLAN}) + {_ARR_DELAY} + 1440) % 1440"

# One flight per line item, headers as untidy as in the field.
FLIGHT_FIELDS = {
    "Year": "CAST(year(l_shipdate) AS STRING)",
    "Month": "CAST(month(l_shipdate) AS STRING)",
    "DayofMonth": "CAST(CASE WHEN l_orderkey % 101 = 0 THEN 31 ELSE day(l_shipdate) END AS STRING)",
    "Day Of Week": "CAST(l_partkey % 9 AS STRING)",
    "DepTime": _unless(_CANCELLED, _clock(_DEP_REAL)),
    "CRSDepTime": f"CAST({_clock(_DEP_PLAN)} AS STRING)",
    "ArrTime": _unless(_CANCELLED, _clock(_ARR_REAL)),
    "CRSArrTime": f"CAST({_clock(_ARR_PLAN)} AS STRING)",
    "Unique.Carrier": _unless("l_orderkey % 40 = 7", "l_returnflag || l_linestatus"),
    "FlightNum": "CAST(l_linenumber AS STRING)",
    "Tail#Num": "'  N' || CAST(l_partkey AS STRING) || ' '",
    "ActualElapsedTime": _unless(_CANCELLED, "60 + l_suppkey % 90"),
    "CRSElapsedTime": "CAST(60 + l_partkey % 90 AS STRING)",
    "AirTime": _unless(_CANCELLED, "40 + l_suppkey % 90"),
    "ArrDelay": _unless(_CANCELLED, _ARR_DELAY),
    "DepDelay": _unless(_CANCELLED, _DEP_DELAY),
    "Origin": "'A' || CAST(l_suppkey % 30 AS STRING)",
    "Dest": _unless("l_partkey % 200 = 3", "'A' || CAST(l_partkey % 30 AS STRING)"),
    "Distance": "CAST(100 + l_partkey AS STRING)",
    "TaxiIn": _unless(_CANCELLED, "l_linenumber % 5"),
    "TaxiOut": _unless(_CANCELLED, "l_linenumber % 7"),
    "Cancelled": f"CASE WHEN {_CANCELLED} THEN '1' ELSE '0' END",
    "CancellationCode": "'NA'",
    "Diverted": "'0'",
    "CarrierDelay": "'NA'",
    "WeatherDelay": "'NA'",
    "NASDelay": "'NA'",
    "SecurityDelay": "'NA'",
    "LateAircraftDelay": "'NA'",
}

# One visited birth per event. Some texts are null, some are cut off.
VISITORS = "CAST(event_id % 5 AS INT)"
NO_VISITORS = "(event_id % 11 = 4 OR event_id % 97 = 6)"
VISIT_FIELDS = {
    "event_id": "event_id",
    "first_name": "' Name.' || CAST(user_id AS STRING)",
    "county": "CASE WHEN user_id % 50 = 9 THEN NULL ELSE upper(event_type) || ' Co.' END",
}

# One bid request per order.
BID_FIELDS = {
    "id": "'bid-' || CAST(o_orderkey AS STRING)",
    "os": "o_orderstatus",
    "ua": "o_orderpriority",
    "country": "'C' || CAST(o_custkey % 25 AS STRING)",
    "n_imp": "CAST(o_orderkey % 4 AS INT)",
    "status": "CASE WHEN o_orderkey % 10 = 9 THEN NULL ELSE CAST(o_orderkey % 3 AS INT) END",
    "app_id": "CAST(o_custkey AS STRING)",
    "app_name": "'App ' || CAST(o_custkey % 7 AS STRING)",
}


def select_list(fields: dict[str, str], quote: str = '"') -> str:
    return ", ".join(f"{sql} AS {quote}{name}{quote}" for name, sql in fields.items())


def flight_files(spark: SparkSession, folder: str) -> tuple[str, str, str]:
    """Write flights and airports as text: files with a header, files without, airport codes."""
    out = new_shared_folder(spark, "flights")
    lines = load_table(spark, folder, "lineitem")
    fields = [f"{sql} AS `{name}`" for name, sql in FLIGHT_FIELDS.items()]
    first_year = F.col("l_shipdate") < "1996-01-01"
    options = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    lines.where(first_year).selectExpr(*fields).write.csv(f"{out}/first", header=True, **options)
    lines.where(~F.coalesce(first_year, F.lit(False))).selectExpr(*fields).write.csv(f"{out}/rest", **options)
    load_table(spark, folder, "nation").selectExpr(
        "CASE WHEN n_nationkey % 12 = 5 THEN NULL ELSE 'A' || CAST(n_nationkey AS STRING) END AS `IA TA`",
        "n_name || ' City' AS `City`",
        "n_regionkey AS `Country;Code`",
    ).write.csv(f"{out}/airports", header=True, sep="\t")
    return f"{out}/first", f"{out}/rest", f"{out}/airports"


def birth_documents(spark: SparkSession, folder: str, rows_per_document: int = 10_000) -> str:
    """Write one birth record per event as multi-line documents ``{"meta": …, "data": [[…], …]}``."""
    out = f"{new_shared_folder(spark, 'births')}/documents"
    records = load_table(spark, folder, "events").selectExpr(
        """CASE WHEN event_id % 13 = 12 THEN concat('["row-', event_id, '", "short"]')
           ELSE concat('["row-', event_id, '", "0-', user_id, '", 0, ', 1500000000 + event_id * 60,
                       ', null, ', 1500000030 + event_id * 60, ', null, "{ }", "',
                       2007 + user_id % 7, '", "', upper(event_type), '. ', user_id % 20, '", "',
                       CASE WHEN user_id % 3 = 0 THEN 'KINGS' ELSE 'St. Law''s Co.' END, '", "',
                       CASE WHEN event_id % 2 = 0 THEN 'F' ELSE 'M' END, '", "',
                       event_id % 40, '"]')
           END AS record"""
    )
    write_documents(records, out, '{"meta": {"view": "births"}, "data": [', "]}", rows_per_document)
    return out


# The same records for the checking database.
BIRTHS_SQL = """
    SELECT 'row-' || event_id AS sid,
           CASE WHEN event_id % 13 = 12 THEN 'short' ELSE '0-' || user_id END AS id,
           CASE WHEN event_id % 13 <> 12 THEN CAST(2007 + user_id % 7 AS VARCHAR) END AS year,
           CASE WHEN event_id % 13 <> 12 THEN upper(event_type) || '. ' || user_id % 20 END AS first_name,
           CASE WHEN event_id % 13 <> 12 THEN
               CASE WHEN user_id % 3 = 0 THEN 'KINGS' ELSE 'St. Law''s Co.' END END AS county,
           CASE WHEN event_id % 13 <> 12 THEN
               CASE WHEN event_id % 2 = 0 THEN 'F' ELSE 'M' END END AS sex,
           CASE WHEN event_id % 13 <> 12 THEN CAST(event_id % 40 AS INTEGER) END AS count,
           CASE WHEN event_id % 13 <> 12 THEN make_timestamp((1500000000 + event_id * 60) * 1000000) END AS created,
           CASE WHEN event_id % 13 <> 12 THEN make_timestamp((1500000030 + event_id * 60) * 1000000) END AS updated,
           CASE WHEN event_id % 13 <> 12 THEN
               CASE WHEN user_id % 3 = 0 THEN 'kings' ELSE 'stlawsco' END END AS county_clean,
           CASE WHEN event_id % 13 <> 12 THEN
               lower(event_type) || CAST(user_id % 20 AS VARCHAR) END AS first_name_clean
    FROM events
"""


def visited_births(spark: SparkSession, folder: str) -> DataFrame:
    """One birth per event with its visitors as XML text; some texts are null, some cut off."""
    age = "concat(' age=\"', 20 + (event_id * 7 + i * 13) % 60, '\"')"
    visitor = (
        f"concat('<visitor id=\"', i, '\"', CASE WHEN (event_id + i) % 7 = 0 THEN '' ELSE {age} END,"
        " ' sex=\"', CASE WHEN i % 2 = 0 THEN 'M' ELSE 'F' END, '\"/>')"
    )
    children = (
        f"array_join(transform(CASE WHEN {VISITORS} = 0 THEN array() ELSE "
        f"sequence(1, {VISITORS}) END, i -> {visitor}), '')"
    )
    return load_table(spark, folder, "events").selectExpr(
        *[f"{sql} AS `{name}`" for name, sql in VISIT_FIELDS.items()],
        f"""CASE WHEN event_id % 11 = 4 THEN NULL
                 WHEN event_id % 97 = 6 THEN concat('<visitors>', {children}, '<visitor id=')
                 ELSE concat('<visitors>', {children}, '</visitors>') END AS visitors""",
    )


def visited_birth_lines(spark: SparkSession, folder: str) -> str:
    """:func:`visited_births` written as JSON lines."""
    out = f"{new_shared_folder(spark, 'visits')}/lines"
    visited_births(spark, folder).write.json(out)
    return out


# One row per event and one per visitor for the checking database. Null counties are dropped.
VISITS_SQL = f"""
    births AS (
        SELECT event_id, first_name, lower(replace(replace(county, ' ', ''), '.', '')) AS county_clean,
               CASE WHEN {NO_VISITORS} THEN 0 ELSE n END AS num_visitors
        FROM (SELECT {select_list(VISIT_FIELDS)}, {VISITORS} AS n FROM events)
        WHERE county IS NOT NULL
    ),
    visitors AS (
        SELECT event_id, county_clean, i,
               CASE WHEN (event_id + i) % 7 = 0 THEN NULL
                    ELSE 20 + (event_id * 7 + i * 13) % 60 END AS age
        FROM (SELECT event_id, county_clean, unnest(range(1, num_visitors + 1)) AS i FROM births)
    )
"""


def bid_documents(
    spark: SparkSession, folder: str, out: str | None = None, which: str = "true", more: str = "", device: str = ""
) -> str:
    """Write one bid request per order as multi-line JSON arrays.

    ``which`` picks orders; ``more`` and ``device`` are further fields of a request and of its device.
    """
    out = out or f"{new_shared_folder(spark, 'bids')}/incoming"
    fields = load_table(spark, folder, "orders").where(which).selectExpr(
        *[f"{sql} AS `{name}`" for name, sql in BID_FIELDS.items()], "o_custkey", "o_orderkey"
    )
    bids = fields.selectExpr(
        f"""to_json(struct(
               id, {more}
               struct(os, ua, {device} struct(country) AS geo) AS device,
               CASE WHEN n_imp = 0 THEN NULL ELSE transform(sequence(1, n_imp), i -> struct(
                   concat(id, '-', i) AS id,
                   CAST(o_custkey % 500 + i AS DOUBLE) / 4 AS bidfloor,
                   struct(50 * i AS h, 320 AS w, i AS pos) AS banner)) END AS imp,
               CASE WHEN status IS NULL THEN NULL ELSE struct(struct(status) AS ads_txt) END AS ext,
               struct(app_id AS id, app_name AS name) AS app
           )) AS bid"""
    )
    write_documents(bids, out)
    return out


# Bids and impressions for the checking database.
BIDS_SQL = f"""
    bids AS (SELECT {select_list(BID_FIELDS)}, o_custkey, o_orderkey FROM orders),
    imps AS (
        SELECT id AS imp_auction_id, id || '-' || i AS imp_id, (o_custkey % 500 + i) / 4.0 AS imp_bidfloor,
               CAST(50 * i AS INTEGER) AS h, 320 AS w, CAST(i AS INTEGER) AS pos
        FROM (SELECT *, unnest(range(1, n_imp + 1)) AS i FROM bids)
    )
"""
