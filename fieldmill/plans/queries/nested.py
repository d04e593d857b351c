"""Structs and arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmill.functions import array_mean, array_sum, element_count
from fieldmill.operators import flatten_struct, prefix_columns
from fieldmill.plans.registry import query, rounded_sql
from fieldmill.sources import load_table


@query(
    "flatten_prefix_struct",
    """SELECT c_custkey AS bid_custkey, c_acctbal AS bid_acctbal, c_mktsegment AS bid_segment,
              n_name AS bid_country, n_regionkey AS bid_region,
              CASE WHEN c_custkey % 3 > 0 THEN c_custkey % 3 END AS bid_status
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def flatten_prefix_struct(spark: SparkSession, folder: str) -> DataFrame:
    """Two levels of structs and a deep field path to prefixed columns."""
    customers = load_table(spark, folder, "customer")
    nations = load_table(spark, folder, "nation")
    geo = F.struct(F.col("n_name").alias("country"), F.col("n_regionkey").alias("region"))
    device = F.struct(F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"), geo.alias("geo"))
    remainder = F.col("c_custkey") % 3
    ads_txt = F.struct(F.struct(remainder.alias("status")).alias("ads_txt"))
    nested = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("custkey"),
        device.alias("device"),
        F.when(remainder > 0, ads_txt).alias("ext"),
    )
    return (
        nested.withColumn("status", F.col("ext.ads_txt.status"))
        .drop("ext")
        .transform(flatten_struct, "device")
        .transform(flatten_struct, "geo")
        .transform(prefix_columns, "bid_")
    )


@query(
    "element_at_columns",
    """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS col1, o_orderstatus AS col2,
              CASE WHEN o_custkey % 2 = 0 THEN o_orderpriority END AS col3,
              CAST(NULL AS VARCHAR) AS col4
       FROM orders""",
)
def element_at_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Array slots by one-based position; a slot beyond the end is null."""
    short = F.array(F.col("o_custkey").cast("string"), F.col("o_orderstatus"))
    full = F.array(F.col("o_custkey").cast("string"), F.col("o_orderstatus"), F.col("o_orderpriority"))
    arrays = load_table(spark, folder, "orders").select(
        "o_orderkey", F.when(F.col("o_custkey") % 2 == 0, full).otherwise(short).alias("col")
    )
    return arrays.select(
        "o_orderkey",
        *[F.try_element_at("col", F.lit(i)).alias(f"col{i}") for i in range(1, 5)],
    )


WORDS_SQL = """words AS (
    SELECT role, list_transform(string_split(text, ' '), lambda w: length(w)) AS sizes FROM conversations)"""


def word_sizes(spark: SparkSession, folder: str) -> DataFrame:
    turns = load_table(spark, folder, "conversations")
    return turns.select("role", F.transform(F.split("text", " "), F.length).alias("sizes"))


@query(
    "array_mean_by_group",
    f"""WITH {WORDS_SQL}
        SELECT role, count(*) AS n, {rounded_sql("avg(list_sum(sizes) / len(sizes))", 4)} AS mean_word
        FROM words GROUP BY role""",
)
def array_mean_by_group(spark: SparkSession, folder: str) -> DataFrame:
    """Mean over turns of the mean word length of a turn."""
    means = word_sizes(spark, folder).groupBy("role")
    return means.agg(
        F.count("*").alias("n"), F.round(F.avg(array_mean(F.col("sizes"))), 4).alias("mean_word")
    )


@query(
    "array_mean_pooled",
    f"""WITH {WORDS_SQL}
        SELECT role, CAST(sum(list_sum(sizes)) AS BIGINT) AS n_chars,
               CAST(sum(len(sizes)) AS BIGINT) AS n_words,
               {rounded_sql("sum(list_sum(sizes)) / sum(len(sizes))", 4)} AS mean_word
        FROM words GROUP BY role""",
)
def array_mean_pooled(spark: SparkSession, folder: str) -> DataFrame:
    """Mean over all words of a role."""
    totals = word_sizes(spark, folder).groupBy("role")
    return totals.agg(
        F.sum(array_sum(F.col("sizes"))).alias("n_chars"),
        F.sum(element_count(F.col("sizes")).cast("bigint")).alias("n_words"),
    ).withColumn("mean_word", F.round(F.try_divide("n_chars", "n_words"), 4))
