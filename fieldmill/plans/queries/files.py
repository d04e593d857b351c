"""Readers and writers: every query writes a whole table in some format and reads it back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmill.operators import cast_columns, na_to_null
from fieldmill.plans import temps
from fieldmill.plans.registry import query
from fieldmill.sources import (
    drop_table,
    footer_stats,
    load_table,
    new_shared_folder,
    read_delimited,
    read_delimited_apart,
    read_json,
    read_json_lines_apart,
    read_with_borrowed_header,
    replace_table,
    stored,
)

ORDER_TYPES = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "string",
    "o_orderpriority": "string",
}
EVENT_TYPES = {
    "event_id": "bigint",
    "user_id": "bigint",
    "event_type": "string",
    "value": "double",
    "props": "string",
}


def orders_as_text(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as a text file would hold them: dates as text, NA for a priority that is unknown."""
    cheap = F.col("o_totalprice") < 20000
    return load_table(spark, folder, "orders").withColumns(
        {
            "o_orderdate": F.date_format("o_orderdate", "yyyy-MM-dd"),
            "o_orderpriority": F.when(cheap, "NA").otherwise(F.col("o_orderpriority")),
        }
    )


ORDERS_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
    strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
    CASE WHEN o_totalprice >= 20000 THEN o_orderpriority END AS o_orderpriority FROM orders"""


@query("csv_roundtrip_typed", ORDERS_SQL)
def csv_roundtrip_typed(spark: SparkSession, folder: str) -> DataFrame:
    out = new_shared_folder(spark, "csv")
    orders = orders_as_text(spark, folder)
    final = F.col("o_orderstatus") == "F"
    orders.where(final).write.csv(f"{out}/final", header=True, sep=";")
    orders.where(~F.coalesce(final, F.lit(False))).write.csv(f"{out}/open", header=True, sep=";")
    return (
        read_delimited(spark, [f"{out}/final", f"{out}/open"], sep=";")
        .transform(na_to_null)
        .transform(cast_columns, ORDER_TYPES)
    )


@query("csv_declared_schema", ORDERS_SQL)
def csv_declared_schema(spark: SparkSession, folder: str) -> DataFrame:
    out = f"{new_shared_folder(spark, 'csv')}/orders"
    orders_as_text(spark, folder).write.csv(out, header=True)
    schema = ", ".join(f"{name} {dtype}" for name, dtype in ORDER_TYPES.items())
    return read_delimited(spark, out, schema=schema, nullValue="NA")


@query("csv_inferred_schema", ORDERS_SQL)
def csv_inferred_schema(spark: SparkSession, folder: str) -> DataFrame:
    out = f"{new_shared_folder(spark, 'csv')}/orders"
    orders_as_text(spark, folder).write.csv(out, header=True, sep="\t")
    found = read_delimited(spark, out, sep="\t", infer=True, nullValue="NA")
    return found.transform(cast_columns, ORDER_TYPES)


@query("headerless_union", ORDERS_SQL)
def headerless_union(spark: SparkSession, folder: str) -> DataFrame:
    out = new_shared_folder(spark, "headerless")
    orders = orders_as_text(spark, folder)
    first = F.col("o_orderdate") < "1996"
    orders.where(first).write.csv(f"{out}/first", header=True)
    orders.where(~F.coalesce(first, F.lit(False))).write.csv(f"{out}/rest")
    return (
        read_with_borrowed_header(spark, f"{out}/first", f"{out}/rest")
        .transform(na_to_null)
        .transform(cast_columns, ORDER_TYPES)
    )


@query(
    "control_separated_read",
    "SELECT event_id AS key, 'val_' || event_type AS value FROM events",
)
def control_separated_read(spark: SparkSession, folder: str) -> DataFrame:
    out = f"{new_shared_folder(spark, 'pairs')}/pairs"
    load_table(spark, folder, "events").select(
        "event_id", F.concat(F.lit("val_"), "event_type")
    ).write.csv(out, sep="\x01")
    return read_delimited(spark, out, sep="\x01", header=False, schema="key bigint, value string")


@query("padded_text_read", "SELECT s_name AS name, s_nationkey AS age FROM supplier")
def padded_text_read(spark: SparkSession, folder: str) -> DataFrame:
    out = f"{new_shared_folder(spark, 'padded')}/people"
    load_table(spark, folder, "supplier").select(
        F.concat("s_name", F.lit(", "), F.col("s_nationkey").cast("string"))
    ).write.text(out)
    return read_delimited(
        spark, out, header=False, schema="name string, age int", ignoreLeadingWhiteSpace="true"
    )


@query(
    "json_lines_read",
    """SELECT event_id, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS ts
       FROM events""",
)
def json_lines_read(spark: SparkSession, folder: str) -> DataFrame:
    out = f"{new_shared_folder(spark, 'lines')}/events"
    moments = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    load_table(spark, folder, "events").write.option("timestampNTZFormat", moments).json(out)
    moment = F.to_timestamp_ntz("ts", F.lit(moments))
    shown = F.date_format(moment.cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSS").alias("ts")
    schema = ", ".join(f"{name} {dtype}" for name, dtype in EVENT_TYPES.items())
    return read_json(spark, out, schema=f"{schema}, ts string").select(*EVENT_TYPES, shown)


DAMAGES_SQL = """SELECT kind, reason, fields, count(*) AS n, sum(o_orderkey) AS keys FROM (
        SELECT *, unnest(['csv', 'json']) AS kind, CASE o_orderkey % 32 WHEN 3 THEN 'broken record'
                WHEN 5 THEN 'unreadable value' WHEN 6 THEN 'unreadable value' ELSE 'none' END AS reason,
            CASE o_orderkey % 32 WHEN 5 THEN 'o_totalprice' WHEN 6 THEN 'o_custkey,o_totalprice' END AS fields
        FROM orders) GROUP BY 1, 2, 3"""


@query("damaged_rows", DAMAGES_SQL)
def damaged_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as delimited and as JSON lines, some of them damaged: what is readable, and what is kept apart and why."""
    out = new_shared_folder(spark, "damaged")
    damage = F.col("o_orderkey") % 32
    custkey = F.when(damage == 6, "none").otherwise(F.col("o_custkey").cast("string"))
    price = F.when(damage.isin(5, 6), "12,5x").otherwise(F.col("o_totalprice").cast("string"))
    orders = load_table(spark, folder, "orders").select("o_orderkey", custkey.alias("o_custkey"), price.alias("o_totalprice"))
    whole = F.concat_ws(";", *orders.columns)
    orders.select(F.when(damage == 3, F.concat_ws(";", "o_orderkey", F.lit("cut"))).otherwise(whole)).write.text(f"{out}/csv")
    number = F.col("o_custkey").try_cast("bigint")
    shaped = F.to_json(F.struct("o_orderkey", F.when(number.isNull(), '#').otherwise(F.col("o_custkey")).alias("o_custkey"), "o_totalprice"))
    bare = F.regexp_replace(shaped, r'"(-?[0-9.]+(?:E[0-9]+)?)"', "$1")
    orders.select(F.when(damage == 3, F.concat(F.lit('{"o_orderkey":'), "o_orderkey", F.lit(","))).otherwise(bare)).write.text(f"{out}/json")
    schema = "o_orderkey bigint, o_custkey bigint, o_totalprice double"
    parts = []
    for kind, (good, bad) in {
        "csv": read_delimited_apart(spark, f"{out}/csv", schema, sep=";", header=False),
        "json": read_json_lines_apart(spark, f"{out}/json", schema),
    }.items():
        key = F.regexp_extract("record", "([0-9]+)", 1).cast("bigint").alias("o_orderkey")
        apart = bad.select("reason", "fields", key)
        readable = good.select(F.lit("none").alias("reason"), F.lit(None).cast("string").alias("fields"), "o_orderkey")
        parts.append(readable.union(apart).withColumn("kind", F.lit(kind)))
    return parts[0].union(parts[1]).groupBy("kind", "reason", "fields").agg(
        F.count("*").alias("n"), F.sum("o_orderkey").alias("keys")
    )


@query(
    "footer_counts",
    """SELECT count(*) AS n, count(l_orderkey) AS n_l_orderkey, count(l_returnflag) AS n_l_returnflag,
              min(l_orderkey) AS min_l_orderkey, max(l_orderkey) AS max_l_orderkey,
              min(l_quantity) AS min_l_quantity, max(l_quantity) AS max_l_quantity FROM lineitem""",
)
def footer_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and extremes of the line items, answered by the footers of their files."""
    return footer_stats(
        spark, f"{folder.rstrip('/')}/lineitem.parquet", ["l_orderkey", "l_returnflag"], ["l_orderkey", "l_quantity"]
    )


@query(
    "filter_and_dedupe",
    """SELECT o_orderstatus, o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate
       FROM orders WHERE o_orderstatus <> 'F' AND o_orderdate > '1998-06-01'
       GROUP BY ALL""",
)
def filter_and_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    """Replace a catalog table, ask it in SQL, drop it; the files stay for the returned plan."""
    out = f"{new_shared_folder(spark, 'table')}/orders"
    name = f"fieldmill_orders_{uuid.uuid4().hex}"
    orders = load_table(spark, folder, "orders").select(
        "o_orderstatus", "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate")
    )
    replace_table(orders, name, path=out)
    answer = spark.sql(
        f"""SELECT * FROM {name} WHERE o_orderstatus != 'F' AND o_orderdate > '1998-06-01'
            GROUP BY o_orderstatus, o_orderpriority, o_orderdate ORDER BY o_orderdate DESC"""
    )
    drop_table(spark, name)
    return answer


@query(
    "warm_days",
    """SELECT DISTINCT o_orderpriority AS airport, strftime(o_orderdate, '%Y-%m-%d') AS day,
              CAST(floor(o_totalprice / 5000) AS INTEGER) AS high, CAST(o_custkey % 40 AS INTEGER) AS low
       FROM orders WHERE o_orderpriority <> '1-URGENT' AND o_orderdate > '1998-06-01'""",
)
def warm_days_of_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Readings made from orders in a managed table; the answer is stored before the table is dropped."""
    name = f"fieldmill_temps_{uuid.uuid4().hex}"
    readings = load_table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("AirportCode"),
        F.to_date("o_orderdate").alias("Date"),
        F.floor(F.col("o_totalprice") / 5000).cast("int").alias("TempHighF"),
        (F.col("o_custkey") % 40).cast("int").alias("TempLowF"),
    )
    replace_table(readings, name)
    warm = temps.warm_days(spark, name, without="1-URGENT", after="1998-06-01")
    answer = stored(warm, "warm")
    drop_table(spark, name)
    return answer.select(
        F.col("AirportCode").alias("airport"),
        F.date_format("Date", "yyyy-MM-dd").alias("day"),
        F.col("TempHighF").alias("high"),
        F.col("TempLowF").alias("low"),
    )


@query(
    "filter_and_dedupe_frames",
    """SELECT DISTINCT o_orderstatus, o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate
       FROM orders WHERE o_orderstatus <> 'F' AND o_orderdate > '1998-06-01'""",
)
def filter_and_dedupe_frames(spark: SparkSession, folder: str) -> DataFrame:
    late = (F.col("o_orderstatus") != "F") & (F.col("o_orderdate") > "1998-06-01")
    orders = load_table(spark, folder, "orders").where(late)
    return (
        orders.select("o_orderstatus", "o_orderpriority", "o_orderdate")
        .distinct()
        .orderBy(F.desc("o_orderdate"))
        .withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    )


@query(
    "partitioned_write_read",
    """SELECT o_orderstatus, o_orderpriority, count(*) AS n, max(o_orderkey) AS last_key
       FROM orders WHERE o_orderstatus IN ('O', 'P') GROUP BY 1, 2""",
)
def partitioned_write_read(spark: SparkSession, folder: str) -> DataFrame:
    """An external table laid out by status; it is dropped, its files stay, the filter prunes folders."""
    out = f"{new_shared_folder(spark, 'partitioned')}/orders"
    name = f"fieldmill_orders_{uuid.uuid4().hex}"
    replace_table(load_table(spark, folder, "orders"), name, ["o_orderstatus"], out)
    drop_table(spark, name)
    return (
        spark.read.parquet(out)
        .where(F.col("o_orderstatus").isin("O", "P"))
        .groupBy("o_orderstatus", "o_orderpriority")
        .agg(F.count("*").alias("n"), F.max("o_orderkey").alias("last_key"))
    )
