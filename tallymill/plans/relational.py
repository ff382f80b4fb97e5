"""Filters, joins and subqueries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymill.operators import sets
from tallymill.plans.registry import query
from tallymill.sources.tables import sql, table


@query(
    "pricing_summary",
    """
    SELECT l_returnflag, l_linestatus,
           sum(l_quantity) AS sum_qty,
           round(sum(l_extendedprice), 2) AS sum_base_price,
           round(sum(l_extendedprice * (1 - l_discount)), 4) AS sum_disc_price,
           round(avg(l_quantity), 6) AS avg_qty,
           round(avg(l_discount), 6) AS avg_disc,
           count(*) AS count_order
    FROM lineitem
    WHERE l_shipdate <= TIMESTAMP '2001-09-02 00:00:00'
    GROUP BY l_returnflag, l_linestatus
    """,
)
def pricing_summary(spark: SparkSession, folder: str) -> DataFrame:
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    return (
        table(spark, folder, "lineitem")
        .filter(F.col("l_shipdate") <= F.expr("TIMESTAMP_NTZ '2001-09-02 00:00:00'"))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.sum("l_quantity").alias("sum_qty"),
            F.round(F.sum(price), 2).alias("sum_base_price"),
            F.round(F.sum(price * (1 - discount)), 4).alias("sum_disc_price"),
            F.round(F.avg("l_quantity"), 6).alias("avg_qty"),
            F.round(F.avg(discount), 6).alias("avg_disc"),
            F.count(F.lit(1)).alias("count_order"),
        )
    )


@query(
    "filter_case",
    """
    SELECT o_orderkey, o_totalprice,
           CASE WHEN o_totalprice >= 300000 THEN 'large'
                WHEN o_totalprice >= 100000 THEN 'middle' ELSE 'small' END AS size_class
    FROM orders
    WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'
      AND o_orderpriority IN ('1-URGENT', '2-HIGH')
    """,
)
def filter_case(spark: SparkSession, folder: str) -> DataFrame:
    price, date = F.col("o_totalprice"), F.col("o_orderdate")
    return (
        table(spark, folder, "orders")
        .filter(
            (date >= F.expr("TIMESTAMP_NTZ '1996-01-01'"))
            & (date < F.expr("TIMESTAMP_NTZ '1999-01-01'"))
            & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
        )
        .select(
            "o_orderkey",
            "o_totalprice",
            F.when(price >= 300000, "large").when(price >= 100000, "middle").otherwise("small").alias("size_class"),
        )
    )


@query(
    "star_join",
    """
    SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue, count(*) AS n_lines
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    WHERE r_name = 'ASIA'
    GROUP BY n_name
    """,
)
def star_join(spark: SparkSession, folder: str) -> DataFrame:
    # Customers of the region select the orders before the large table is met.
    # Line items are added up per order first: an order with very many lines
    # leaves each task as one row. Sizes decide which sides are broadcast.
    lines = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    nations = (
        table(spark, folder, "nation")
        .join(table(spark, folder, "region").filter("r_name = 'ASIA'"), F.expr("n_regionkey = r_regionkey"))
        .select("n_nationkey", "n_name")
    )
    customers = table(spark, folder, "customer").join(nations, F.expr("c_nationkey = n_nationkey"))
    orders = table(spark, folder, "orders").join(customers, F.expr("o_custkey = c_custkey"))
    return (
        orders.join(lines, F.expr("o_orderkey = l_orderkey"))
        .groupBy("n_name")
        .agg(F.round(F.sum("revenue"), 4).alias("revenue"), F.sum("n").alias("n_lines"))
    )


@query(
    "left_outer",
    """
    SELECT c_custkey, count(o_orderkey) AS n_orders, round(coalesce(sum(o_totalprice), 0), 2) AS total
    FROM customer LEFT JOIN orders
      ON c_custkey = o_custkey AND o_orderpriority = '1-URGENT' AND o_totalprice > 200000
    GROUP BY c_custkey
    """,
)
def left_outer(spark: SparkSession, folder: str) -> DataFrame:
    orders = (
        table(spark, folder, "orders")
        .filter("o_orderpriority = '1-URGENT' AND o_totalprice > 200000")
        .groupBy("o_custkey")
        .agg(F.count("o_orderkey").alias("n"), F.sum("o_totalprice").alias("t"))
    )
    return (
        table(spark, folder, "customer")
        .join(orders, F.expr("c_custkey = o_custkey"), "left")
        .select(
            "c_custkey",
            F.coalesce("n", F.lit(0)).alias("n_orders"),
            F.round(F.coalesce("t", F.lit(0.0)), 2).alias("total"),
        )
    )


@query(
    "full_outer",
    """
    WITH p AS (SELECT user_id, count(*) AS n_purchases FROM events
               WHERE event_type = 'purchase' AND value > 150 GROUP BY user_id),
         e AS (SELECT user_id, count(*) AS n_errors FROM events
               WHERE event_type = 'error' AND value > 150 GROUP BY user_id)
    SELECT coalesce(p.user_id, e.user_id) AS user_id, n_purchases, n_errors
    FROM p FULL JOIN e ON p.user_id = e.user_id
    """,
)
def full_outer(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").filter("value > 150")

    def counted(kind: str, name: str) -> DataFrame:
        return events.filter(F.col("event_type") == kind).groupBy("user_id").agg(F.count(F.lit(1)).alias(name))

    return counted("purchase", "n_purchases").join(counted("error", "n_errors"), "user_id", "full")


@query(
    "semi",
    """
    SELECT c_custkey, c_name FROM customer
    WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)
    """,
)
def semi(spark: SparkSession, folder: str) -> DataFrame:
    large = table(spark, folder, "orders").filter("o_totalprice > 400000")
    return sets.matching(table(spark, folder, "customer"), large, {"c_custkey": "o_custkey"}).select("c_custkey", "c_name")


@query(
    "anti",
    """
    SELECT o_orderkey, o_orderstatus FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
    """,
)
def anti(spark: SparkSession, folder: str) -> DataFrame:
    orders, lines = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    return sets.matching(orders, lines, {"o_orderkey": "l_orderkey"}, keep=False).select("o_orderkey", "o_orderstatus")


@query(
    "not_in",
    """
    SELECT c_custkey, c_mktsegment FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)
    """,
)
def not_in(spark: SparkSession, folder: str) -> DataFrame:
    large = table(spark, folder, "orders").filter("o_totalprice > 450000")
    return sets.not_in(table(spark, folder, "customer"), "c_custkey", large, "o_custkey").select("c_custkey", "c_mktsegment")


@query(
    "not_in_null",
    """
    WITH lists AS (
      SELECT 'with null' AS list, nullif(o_custkey, 7) AS k FROM orders WHERE o_totalprice > 20000
      UNION ALL
      SELECT 'without null', o_custkey FROM orders WHERE o_totalprice > 20000)
    SELECT list, count(c_custkey) AS n_customers
    FROM (SELECT DISTINCT list FROM lists) l
    LEFT JOIN customer ON
      (list = 'with null' AND c_custkey NOT IN (SELECT k FROM lists WHERE list = 'with null'))
      OR (list = 'without null' AND c_custkey NOT IN (SELECT k FROM lists WHERE list = 'without null'))
    GROUP BY list
    """,
)
def not_in_null(spark: SparkSession, folder: str) -> DataFrame:
    # One NULL in the list must empty the result; without it rows remain.
    customers = table(spark, folder, "customer")
    orders = table(spark, folder, "orders").filter("o_totalprice > 20000")
    blanked = orders.select(F.nullif("o_custkey", F.lit(7)).alias("k"))
    plain = orders.select(F.col("o_custkey").alias("k"))

    def counted(name: str, listed: DataFrame) -> DataFrame:
        kept = sets.not_in(customers, "c_custkey", listed, "k")
        return kept.agg(F.count(F.lit(1)).alias("n_customers")).select(F.lit(name).alias("list"), "n_customers")

    return counted("with null", blanked).unionByName(counted("without null", plain))


@query(
    "band_join",
    """
    SELECT p_partkey, p_size, band
    FROM part JOIN (VALUES ('tiny', 1, 8), ('small', 9, 19), ('middle', 20, 34), ('large', 35, 50)) b(band, low, high)
      ON p_size BETWEEN low AND high
    """,
)
def band_join(spark: SparkSession, folder: str) -> DataFrame:
    # Bands are cut at multiples of ten, so the join has an equality key and
    # needs no nested loop; the bounds then decide within the bucket.
    bands = spark.sql(
        "SELECT * FROM VALUES ('tiny', 1, 8), ('small', 9, 19), ('middle', 20, 34), ('large', 35, 50) AS b(band, low, high)"
    ).withColumn("bucket", F.explode(F.expr("sequence(low div 10, high div 10)")))
    parts = table(spark, folder, "part").withColumn("size_bucket", F.expr("p_size div 10"))
    return parts.join(bands, F.expr("size_bucket = bucket AND p_size BETWEEN low AND high")).select(
        "p_partkey", "p_size", "band"
    )


@query(
    "lateral",
    """
    SELECT c_custkey, o_orderkey, o_totalprice
    FROM customer, LATERAL (
      SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = c_custkey
      ORDER BY o_totalprice DESC, o_orderkey LIMIT 2) t
    """,
)
def lateral(spark: SparkSession, folder: str) -> DataFrame:
    return sql(
        spark,
        folder,
        """
        SELECT c_custkey, o_orderkey, o_totalprice
        FROM {customer}, LATERAL (
          SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_custkey = c_custkey
          ORDER BY o_totalprice DESC, o_orderkey LIMIT 2) t
        """,
        "customer",
        "orders",
    )


@query(
    "scalar_subq",
    """
    SELECT p_partkey, p_brand, p_retailprice FROM part p
    WHERE p_retailprice > (SELECT avg(p_retailprice) FROM part q WHERE q.p_brand = p.p_brand)
    """,
)
def scalar_subq(spark: SparkSession, folder: str) -> DataFrame:
    return sql(
        spark,
        folder,
        """
        SELECT p_partkey, p_brand, p_retailprice FROM {part} p
        WHERE p_retailprice > (SELECT avg(p_retailprice) FROM {part} q WHERE q.p_brand = p.p_brand)
        """,
        "part",
    )
