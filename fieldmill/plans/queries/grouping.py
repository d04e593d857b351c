"""Counts, means, labels, ranks and set comparison over the Parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmill.functions import is_later, timing_label, timing_label_udf
from fieldmill.operators import (
    distinct_counts,
    distinct_sketches,
    distinct_values,
    frame_difference,
    group_stats,
    hashed_sample,
    lookup_roles,
    merge_sketches,
    mode_per_group,
    order_split,
    ratio_where,
    sketched_counts,
    table_difference,
    top_k,
    top_per_group,
)
from fieldmill.plans import flights
from fieldmill.plans.registry import query, rounded_sql
from fieldmill.sources import load_table, stored


def shipments(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with the days from order to shipment in ``delay`` (negative when shipped early)."""
    lines = load_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    orders = load_table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumn(
        "delay", F.datediff("l_shipdate", "o_orderdate")
    )


SHIPMENTS_SQL = """shipments AS (
    SELECT l_suppkey, l_returnflag, l_linestatus, date_diff('day', o_orderdate, l_shipdate) AS delay
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

TIMING_SQL = f"""WITH {SHIPMENTS_SQL}, means AS (
        SELECT l_suppkey, avg(delay) AS mean FROM shipments GROUP BY l_suppkey)
    SELECT l_suppkey, {rounded_sql("mean", 4)} AS avgdelay,
           CASE WHEN mean > 15 THEN 'Late' WHEN mean < 0 THEN 'Early' ELSE 'On-time' END
               AS avg_early_or_late
    FROM means"""


def rounded(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.round(column, 4))


@query("timing_label", TIMING_SQL)
def timing_label_by_supplier(spark: SparkSession, folder: str) -> DataFrame:
    labelled = flights.timing(shipments(spark, folder), "l_suppkey", "delay", timing_label)
    return rounded(labelled, "avgdelay")


@query("timing_label_udf", TIMING_SQL)
def timing_label_udf_by_supplier(spark: SparkSession, folder: str) -> DataFrame:
    labelled = flights.timing(shipments(spark, folder), "l_suppkey", "delay", timing_label_udf)
    return rounded(labelled, "avgdelay")


@query(
    "avg_by_key_desc",
    f"""WITH {SHIPMENTS_SQL}
        SELECT l_returnflag, {rounded_sql("avg(delay)", 4)} AS avgdelay FROM shipments GROUP BY 1 ORDER BY 2 DESC""",
)
def avg_by_key_desc(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(flights.mean_delay(shipments(spark, folder), "l_returnflag", "delay"), "avgdelay")


@query(
    "majority_label",
    f"""WITH {SHIPMENTS_SQL}, shares AS (
            SELECT l_suppkey, avg(CASE WHEN delay > 0 THEN 1 ELSE 0 END) AS share
            FROM shipments GROUP BY 1)
        SELECT l_suppkey, {rounded_sql("share", 4)} AS avg_isdelay,
               CASE WHEN share > 0.5 THEN 'late' ELSE 'early' END AS avg_early_or_late FROM shares""",
)
def majority_label_by_supplier(spark: SparkSession, folder: str) -> DataFrame:
    flagged = shipments(spark, folder).withColumn("late", is_later(F.col("delay"), F.lit(0)))
    return rounded(flights.early_or_late(flagged, "l_suppkey", "late"), "avg_isdelay")


@query(
    "most_delayed_top5",
    f"""WITH {SHIPMENTS_SQL}
        SELECT l_suppkey, count(*) AS n FROM shipments WHERE delay > 0
        GROUP BY 1 ORDER BY n DESC, l_suppkey LIMIT 5""",
)
def most_delayed_top5(spark: SparkSession, folder: str) -> DataFrame:
    return flights.most_delayed(shipments(spark, folder), F.col("delay") > 0, by="l_suppkey")


@query("row_count", "SELECT count(*) AS n FROM lineitem")
def row_count(spark: SparkSession, folder: str) -> DataFrame:
    return load_table(spark, folder, "lineitem").agg(F.count("*").alias("n"))


@query(
    "count_by_key",
    "SELECT nullif(l_returnflag, 'R') AS flag, count(*) AS n FROM lineitem GROUP BY 1",
)
def count_by_key(spark: SparkSession, folder: str) -> DataFrame:
    flag = F.nullif("l_returnflag", F.lit("R"))
    lines = load_table(spark, folder, "lineitem")
    return lines.groupBy(flag.alias("flag")).agg(F.count("*").alias("n"))


@query(
    "count_two_keys",
    "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2",
)
def count_two_keys(spark: SparkSession, folder: str) -> DataFrame:
    orders = load_table(spark, folder, "orders")
    return orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


@query(
    "distinct_counts",
    """WITH segments AS (SELECT nullif(c_mktsegment, 'MACHINERY') AS segment FROM customer)
       SELECT (SELECT count(DISTINCT segment) FROM segments) AS n_distinct,
              (SELECT count(*) FROM (SELECT DISTINCT segment FROM segments)) AS n_distinct_with_null,
              (SELECT count(*) FROM (SELECT segment FROM segments GROUP BY segment))
                  AS n_rows_without_repeats,
              true AS estimate_is_close""",
)
def distinct_counts_of_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct segments four ways; one segment is unknown."""
    segments = load_table(spark, folder, "customer").select(
        F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("segment")
    )
    counts = distinct_counts(segments.dropDuplicates(["segment"]), "segment")
    close = F.abs(F.col("n_approx") - F.col("n_distinct")) <= 0.1 * F.col("n_distinct")
    return counts.select(
        "n_distinct",
        "n_distinct_with_null",
        F.col("n_distinct_with_null").alias("n_rows_without_repeats"),
        close.alias("estimate_is_close"),
    )


@query(
    "approx_distinct_keys",
    """SELECT l_returnflag, count(DISTINCT l_partkey) AS n_parts, true AS estimate_is_close
       FROM lineitem GROUP BY 1""",
)
def approx_distinct_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Exact and estimated counts over the distinct pairs, so that sketches travel per flag, not per part."""
    return (
        load_table(spark, folder, "lineitem")
        .select("l_returnflag", "l_partkey")
        .distinct()
        .groupBy("l_returnflag")
        .agg(
            F.count("l_partkey").alias("n_parts"),
            F.approx_count_distinct("l_partkey").alias("estimate"),
        )
        .select(
            "l_returnflag",
            "n_parts",
            (F.abs(F.col("estimate") - F.col("n_parts")) <= 0.1 * F.col("n_parts")).alias(
                "estimate_is_close"
            ),
        )
    )


@query(
    "distinct_sketch_merge",
    """SELECT l_returnflag, count(DISTINCT l_partkey) AS n_parts, count(DISTINCT l_orderkey) AS n_orders,
              true AS parts_are_close, true AS orders_are_close
       FROM lineitem GROUP BY 1""",
)
def distinct_sketch_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Sketches of two halves of the line items, stored apart and merged, against the exact counts."""
    lines, columns = load_table(spark, folder, "lineitem"), ["l_partkey", "l_orderkey"]
    halves = [
        stored(distinct_sketches(lines.where(F.col("l_linenumber") % 2 == part), ["l_returnflag"], columns), "sketches")
        for part in (0, 1)
    ]
    merged = sketched_counts(merge_sketches(halves[0].union(halves[1]), ["l_returnflag"], columns), columns)
    exact = [
        lines.select("l_returnflag", name).distinct().groupBy(F.col("l_returnflag").alias("flag")).agg(F.count(name).alias(alias))
        for name, alias in (("l_partkey", "n_parts"), ("l_orderkey", "n_orders"))
    ]

    def close(estimate: str, n: str) -> Column:
        return F.abs(F.col(estimate) - F.col(n)) <= 0.02 * F.col(n) + 1

    return (
        merged.join(exact[0], F.col("l_returnflag").eqNullSafe(F.col("flag")))
        .drop("flag")
        .join(exact[1], F.col("l_returnflag").eqNullSafe(F.col("flag")))
        .select(
            "l_returnflag",
            "n_parts",
            "n_orders",
            close("l_partkey", "n_parts").alias("parts_are_close"),
            close("l_orderkey", "n_orders").alias("orders_are_close"),
        )
    )


@query(
    "distinct_values",
    """SELECT DISTINCT 'o_orderstatus' AS "column", o_orderstatus AS value FROM orders
       UNION ALL
       SELECT DISTINCT 'o_orderpriority', o_orderpriority FROM orders
       UNION ALL
       SELECT DISTINCT 'o_custkey', CAST(o_custkey AS VARCHAR) FROM orders""",
)
def distinct_values_of_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = load_table(spark, folder, "orders")
    return distinct_values(orders, ["o_orderstatus", "o_orderpriority", "o_custkey"])


@query(
    "distinct_value_sets",
    """SELECT string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS statuses,
              string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities
       FROM orders""",
)
def distinct_value_sets_of_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The distinct values of two columns that hold a few each, as texts in one row."""
    found = distinct_values(load_table(spark, folder, "orders"), ["o_orderstatus", "o_orderpriority"])

    def joined(column: str) -> Column:
        return F.array_join(F.array_sort(F.collect_list(F.when(F.col("column") == column, F.col("value")))), ",")

    return found.agg(joined("o_orderstatus").alias("statuses"), joined("o_orderpriority").alias("priorities"))


@query(
    "conditional_ratio",
    f"""WITH {SHIPMENTS_SQL}
       SELECT count(*) FILTER (WHERE delay > 60) AS n_passed, count(*) AS n,
              {rounded_sql("count(*) FILTER (WHERE delay > 60) / count(*)", 6)} AS ratio
       FROM shipments""",
)
def conditional_ratio(spark: SparkSession, folder: str) -> DataFrame:
    """Share of all line items that were shipped more than two months after their order."""
    late = ratio_where(shipments(spark, folder), F.col("delay") > 60)
    return late.withColumn("ratio", F.round("ratio", 6))


@query(
    "conditional_ratio_by_key",
    f"""SELECT l_returnflag, count(*) FILTER (WHERE l_discount > 0.05) AS n_passed, count(*) AS n,
              {rounded_sql("count(*) FILTER (WHERE l_discount > 0.05) / count(*)", 4)} AS ratio
       FROM lineitem GROUP BY 1""",
)
def conditional_ratio_by_key(spark: SparkSession, folder: str) -> DataFrame:
    lines = load_table(spark, folder, "lineitem")
    return rounded(ratio_where(lines, F.col("l_discount") > 0.05, ["l_returnflag"]), "ratio")


def yearly_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their year and a price in whole thousands, so that ties do occur."""
    return load_table(spark, folder, "orders").select(
        F.year("o_orderdate").alias("year"),
        "o_orderkey",
        F.floor(F.col("o_totalprice") / 1000).alias("thousands"),
    )


YEARLY_SQL = """yearly AS (
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey,
           CAST(floor(o_totalprice / 1000) AS BIGINT) AS thousands FROM orders)"""
TOP_RANK_SQL = f"""WITH {YEARLY_SQL}
    SELECT year, o_orderkey, thousands FROM yearly
    QUALIFY rank() OVER (PARTITION BY year ORDER BY thousands DESC) = 1"""


@query("top_per_year_rank", TOP_RANK_SQL)
def top_per_year_rank(spark: SparkSession, folder: str) -> DataFrame:
    return top_per_group(yearly_orders(spark, folder), ["year"], "thousands")


@query(
    "top_per_year_rownum",
    f"""WITH {YEARLY_SQL}
        SELECT year, o_orderkey, thousands FROM yearly
        QUALIFY row_number() OVER (PARTITION BY year ORDER BY thousands DESC, o_orderkey) = 1""",
)
def top_per_year_rownum(spark: SparkSession, folder: str) -> DataFrame:
    return top_per_group(
        yearly_orders(spark, folder),
        ["year"],
        "thousands",
        ties="one",
        tiebreak=["o_orderkey"],
    )


@query("top_per_year_sql", TOP_RANK_SQL)
def top_per_year_sql(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(
        """WITH placed AS (
                SELECT year, thousands, rank() OVER (PARTITION BY year ORDER BY thousands DESC) AS place
                FROM (SELECT DISTINCT year, thousands FROM {yearly}))
            SELECT o.year, o.o_orderkey, o.thousands
            FROM {yearly} o JOIN placed p ON o.year <=> p.year AND o.thousands <=> p.thousands
            WHERE p.place = 1 ORDER BY o.year, o.o_orderkey""",
        yearly=yearly_orders(spark, folder),
    )


@query(
    "top_totals_per_year",
    """WITH totals AS (
           SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_custkey, count(*) AS n
           FROM orders GROUP BY 1, 2)
       SELECT year, o_custkey, n FROM totals
       QUALIFY row_number() OVER (PARTITION BY year ORDER BY n DESC, o_custkey) = 1""",
)
def top_totals_per_year(spark: SparkSession, folder: str) -> DataFrame:
    """Totals first, then the winner of each year."""
    totals = (
        load_table(spark, folder, "orders")
        .groupBy(F.year("o_orderdate").alias("year"), "o_custkey")
        .agg(F.count("*").alias("n"))
    )
    return top_per_group(totals, ["year"], "n", ties="one", tiebreak=["o_custkey"])


@query(
    "rank_parity_except",
    f"""WITH {YEARLY_SQL}, ranked AS (
            SELECT *, rank() OVER (PARTITION BY year ORDER BY thousands DESC) AS place,
                   row_number() OVER (PARTITION BY year ORDER BY thousands DESC, o_orderkey) AS one
            FROM yearly)
        SELECT year, o_orderkey, thousands FROM ranked WHERE place = 1 AND one > 1""",
)
def rank_parity_except(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that share a first place but lose the tie-break."""
    return top_per_year_rank(spark, folder).subtract(top_per_year_rownum(spark, folder))


@query(
    "frame_difference",
    f"""WITH {YEARLY_SQL}, ranked AS (
            SELECT *, rank() OVER (PARTITION BY year ORDER BY thousands DESC) AS place,
                   row_number() OVER (PARTITION BY year ORDER BY thousands DESC, o_orderkey) AS one
            FROM yearly)
        SELECT year, o_orderkey, thousands, CAST(1 AS BIGINT) AS left_copies, CAST(0 AS BIGINT) AS right_copies
        FROM ranked WHERE place = 1 AND one > 1""",
)
def rank_difference(spark: SparkSession, folder: str) -> DataFrame:
    """The same question with multiplicities; the SQL form and the ranked form must agree."""
    return frame_difference(top_per_year_sql(spark, folder), top_per_year_rownum(spark, folder))


@query(
    "table_difference",
    """SELECT o_orderkey, o_custkey, o_totalprice + changed AS o_totalprice, 1 - side AS left_copies, side AS right_copies
       FROM (SELECT *, unnest([0.0, 1.0]) AS changed, unnest(CAST([0, 1] AS BIGINT[])) AS side
             FROM orders WHERE o_orderkey % 997 = 5)""",
)
def changed_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders against a stored copy in which few prices differ: digests first, rows of unequal buckets then."""
    orders = load_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    raised = F.when(F.col("o_orderkey") % 997 == 5, F.col("o_totalprice") + 1.0).otherwise(F.col("o_totalprice"))
    return table_difference(orders, stored(orders.withColumn("o_totalprice", raised), "copy"))


@query(
    "repeatable_sample",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR)) LIMIT 1000",
)
def repeatable_sample(spark: SparkSession, folder: str) -> DataFrame:
    """A thousand orders drawn by the hash of their keys."""
    orders = load_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return hashed_sample(orders, ["o_orderkey"], 1000)


@query(
    "window_group_stats",
    f"""SELECT strftime(l_shipdate, '%Y-%m-%d') AS shipdate, l_returnflag, l_partkey, l_quantity,
              min(l_quantity) OVER w AS qtymin, max(l_quantity) OVER w AS qtymax,
              {rounded_sql("avg(l_quantity) OVER w", 2)} AS qtyavg, sum(l_quantity) OVER w AS qtysum
       FROM lineitem WINDOW w AS (PARTITION BY l_shipdate, l_returnflag)""",
)
def window_group_stats(spark: SparkSession, folder: str) -> DataFrame:
    lines = load_table(spark, folder, "lineitem").select(
        "l_shipdate", "l_returnflag", "l_partkey", "l_quantity"
    )
    stats = group_stats(lines, ["l_shipdate", "l_returnflag"], "l_quantity", "qty")
    return order_split(stats, "l_shipdate", "l_returnflag", "l_quantity").select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipdate"),
        *[name for name in stats.columns if name != "l_shipdate"],
    )


@query(
    "ordered_limit",
    """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
)
def ordered_limit(spark: SparkSession, folder: str) -> DataFrame:
    orders = load_table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return top_k(orders, [F.desc("o_totalprice")], 10, [F.asc("o_orderkey")])


@query(
    "three_column_sort",
    """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders ORDER BY 2, 3, 1""",
)
def three_column_sort(spark: SparkSession, folder: str) -> DataFrame:
    orders = load_table(spark, folder, "orders")
    return orders.select("o_orderkey", "o_orderstatus", "o_orderpriority").orderBy(
        "o_orderstatus", "o_orderpriority", "o_orderkey"
    )


@query(
    "sample_rows",
    "SELECT least(count(*), 1000) AS n, least(count(*), 1000) AS n_keys, least(count(*), 1000) AS n_known FROM orders",
)
def sample_rows(spark: SparkSession, folder: str) -> DataFrame:
    """A sample of any thousand rows: its size, that no key comes twice and that all are in the table."""
    keys = load_table(spark, folder, "orders").select("o_orderkey")
    known = keys.withColumnRenamed("o_orderkey", "known")
    return (
        keys.limit(1000)
        .join(known, F.col("o_orderkey") == F.col("known"), "left")
        .agg(
            F.count("*").alias("n"),
            F.count_distinct("o_orderkey").alias("n_keys"),
            F.count("known").alias("n_known"),
        )
    )


@query(
    "dual_role_lookup",
    """SELECT cn.n_name AS customer_nation, sn.n_name AS supplier_nation, count(*) AS n
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN supplier ON l_suppkey = s_suppkey
       LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey
       LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey GROUP BY 1, 2""",
)
def dual_role_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """One dimension looked up in two roles, after the fact rows are counted.

    Orders meet their customers first, so that the line items are shuffled once, by order; from then
    on only counts per customer nation and supplier travel.
    """
    lines = load_table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey")
    orders = load_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customers = load_table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    suppliers = load_table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    buyers = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    per_supplier = (
        lines.join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("c_nationkey", "l_suppkey")
        .agg(F.count("*").alias("n"))
    )
    counted = (
        per_supplier.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("c_nationkey", "s_nationkey")
        .agg(F.sum("n").alias("n"))
    )
    roles = {"c_nationkey": "customer_nation", "s_nationkey": "supplier_nation"}
    nations = load_table(spark, folder, "nation")
    named = lookup_roles(counted, nations, "n_nationkey", "n_name", roles)
    return named.groupBy("customer_nation", "supplier_nation").agg(F.sum("n").alias("n"))


@query(
    "mode_per_group",
    """WITH counted AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2)
       SELECT user_id, event_type, n FROM counted
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) = 1""",
)
def favourite_event_type(spark: SparkSession, folder: str) -> DataFrame:
    return mode_per_group(load_table(spark, folder, "events"), ["user_id"], "event_type")
