"""Headers, null markers, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from fieldmill.functions import clean_chars, date_from_parts, day_name, route_label
from fieldmill.operators import (
    clean_header,
    drop_all_null_columns,
    lower_names,
    na_to_null,
    require_shape,
)
from fieldmill.plans.registry import query
from fieldmill.sources import load_table


@query(
    "clean_header_sorted",
    """SELECT c_acctbal AS acctbal, c_custkey AS custkey, c_mktsegment AS mktsegment, c_name AS name,
              c_nationkey AS nationkey FROM customer""",
)
def clean_header_sorted(spark: SparkSession, folder: str) -> DataFrame:
    customer = load_table(spark, folder, "customer")
    untidy = customer.select(
        F.concat(F.lit("  "), "c_name", F.lit(" ")).alias(" Na.me"),
        F.col("c_custkey").alias("Cust Key;"),
        F.col("c_nationkey").alias("Nation'Key"),
        F.col("c_acctbal").alias("Acct$Bal"),
        F.concat("c_mktsegment", F.lit("   ")).alias("Mkt#Seg|ment"),
    )
    return untidy.transform(clean_header)


@query(
    "lower_case_columns",
    "SELECT p_partkey, p_name, p_brand AS brand, p_type, p_size, p_retailprice FROM part",
)
def lower_case_columns(spark: SparkSession, folder: str) -> DataFrame:
    part = load_table(spark, folder, "part").withColumnRenamed("p_brand", "Brand")
    return part.toDF(*[name.upper() for name in part.columns]).transform(lower_names)


def flags_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Flag and status of line items, some of them marked as unknown and so null."""
    lines = load_table(spark, folder, "lineitem")
    return lines.select(
        F.when(F.col("l_quantity") < 5, "NA").otherwise(F.col("l_returnflag")).alias("flag"),
        F.when(F.col("l_discount") < 0.02, "NA").otherwise(F.col("l_linestatus")).alias("status"),
    ).transform(na_to_null)


@query(
    "na_to_null_counts",
    """SELECT 'complete rows' AS measure, count(*) AS n FROM lineitem
       WHERE NOT l_quantity < 5 AND NOT l_discount < 0.02
       UNION ALL
       SELECT 'rows with flag', count(*) FROM lineitem WHERE NOT l_quantity < 5
       UNION ALL
       SELECT 'null flags', count(*) FROM lineitem WHERE l_quantity < 5
       UNION ALL
       SELECT 'null statuses', count(*) FROM lineitem WHERE l_discount < 0.02""",
)
def na_to_null_counts(spark: SparkSession, folder: str) -> DataFrame:
    """All four counts in one pass."""
    flag, status = F.col("flag"), F.col("status")
    measures = {
        "complete rows": flag.isNotNull() & status.isNotNull(),
        "rows with flag": flag.isNotNull(),
        "null flags": flag.isNull(),
        "null statuses": status.isNull(),
    }
    counts = flags_with_gaps(spark, folder).agg(*[F.count_if(test).alias(name) for name, test in measures.items()])
    return counts.unpivot([], list(measures), "measure", "n")


@query(
    "rows_without_nulls",
    """SELECT l_returnflag AS flag, l_linestatus AS status, count(*) AS n FROM lineitem
       WHERE NOT l_quantity < 5 AND NOT l_discount < 0.02 GROUP BY 1, 2""",
)
def rows_without_nulls(spark: SparkSession, folder: str) -> DataFrame:
    complete = flags_with_gaps(spark, folder).na.drop()
    return complete.groupBy("flag", "status").agg(F.count("*").alias("n"))


@query(
    "drop_all_null_columns",
    """SELECT o_orderkey, o_orderstatus,
              CASE WHEN o_totalprice > 490000 THEN o_orderpriority END AS rare FROM orders""",
)
def drop_empty_columns(spark: SparkSession, folder: str) -> DataFrame:
    orders = load_table(spark, folder, "orders")
    padded = orders.select(
        F.lit(None).cast("string").alias("empty_first"),
        "o_orderkey",
        F.when(F.col("o_totalprice") < 0, F.col("o_custkey")).alias("never_set"),
        "o_orderstatus",
        F.when(F.col("o_totalprice") > 490000, F.col("o_orderpriority")).alias("rare"),
        F.lit(None).cast("double").alias("empty_last"),
    )
    return padded.transform(drop_all_null_columns)


@query(
    "filter_sql_string",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice / l_quantity AS unit_price
       FROM lineitem
       WHERE l_linestatus = 'F' AND l_quantity > 20 AND l_tax IS NOT NULL AND l_returnflag IS NOT NULL
         AND l_discount + l_tax < 0.08""",
)
def filter_sql_string(spark: SparkSession, folder: str) -> DataFrame:
    lines = load_table(spark, folder, "lineitem")
    return (
        lines.filter("l_linestatus = 'F' and l_quantity > 20")
        .filter(F.col("l_tax").isNotNull() & F.col("l_returnflag").isNotNull())
        .filter(F.col("l_discount") + F.col("l_tax") < 0.08)
        .select(
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            "l_quantity",
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        )
    )


@query(
    "typed_shape_check",
    """SELECT event_id, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS ts
       FROM events""",
)
def typed_shape_check(spark: SparkSession, folder: str) -> DataFrame:
    shape = StructType(
        [
            StructField("event_id", LongType()),
            StructField("user_id", LongType()),
            StructField("event_type", StringType()),
            StructField("value", DoubleType()),
        ]
    )
    checked = load_table(spark, folder, "events").transform(require_shape, shape)
    return checked.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"))


@query(
    "day_name_date_route",
    """WITH parts AS (
           SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, o_orderkey % 33 AS d,
                  o_orderkey % 9 AS weekday, o_orderstatus AS origin,
                  CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS dest
           FROM orders)
       SELECT o_orderkey,
              CASE weekday WHEN 1 THEN 'Mon' WHEN 2 THEN 'Tue' WHEN 3 THEN 'Wed' WHEN 4 THEN 'Thu'
                           WHEN 5 THEN 'Fri' WHEN 6 THEN 'Sat' WHEN 7 THEN 'Sun' END AS day,
              strftime(TRY_CAST(printf('%04d-%02d-%02d', y, m, d) AS DATE), '%Y-%m-%d') AS date,
              origin || '-' || dest AS route
       FROM parts""",
)
def day_name_date_route(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    dest = F.when(key % 5 != 0, F.col("o_orderpriority"))
    made = date_from_parts(F.year("o_orderdate"), F.month("o_orderdate"), key % 33)
    return load_table(spark, folder, "orders").select(
        "o_orderkey",
        day_name(key % 9).alias("day"),
        made.cast("string").alias("date"),
        route_label(F.col("o_orderstatus"), dest).alias("route"),
    )


@query(
    "clean_chars_group",
    """SELECT regexp_replace(lower(p_name || '. ' || p_brand || ' ; ' || p_type),
                             '[.$|,;''\\s#]', '', 'g') AS part_key,
              count(*) AS n
       FROM part GROUP BY 1""",
)
def clean_chars_group(spark: SparkSession, folder: str) -> DataFrame:
    label = F.concat("p_name", F.lit(". "), "p_brand", F.lit(" ; "), "p_type")
    return (
        load_table(spark, folder, "part")
        .groupBy(clean_chars(label).alias("part_key"))
        .agg(F.count("*").alias("n"))
    )


@query(
    "clean_document_text",
    """SELECT doc_id, length(cleaned) AS n_kept, md5(cleaned) AS digest
       FROM (SELECT doc_id, translate(lower(text), '.$|,;''# ' || chr(9) || chr(10) || chr(11)
                                      || chr(12) || chr(13), '') AS cleaned FROM documents)""",
)
def clean_document_text(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = load_table(spark, folder, "documents").select(
        "doc_id", clean_chars(F.col("text")).alias("cleaned")
    )
    return cleaned.select(
        "doc_id",
        F.length("cleaned").cast("bigint").alias("n_kept"),
        F.md5(F.col("cleaned").cast("binary")).alias("digest"),
    )
