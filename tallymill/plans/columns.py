"""Column functions: text, dates, numbers, JSON, arrays, de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymill.plans.registry import query
from tallymill.sources.tables import table


@query(
    "string_fn",
    """
    SELECT p_partkey, upper(p_name) AS name_upper, substring(p_name, 1, 4) AS name_head,
           replace(p_name, ' ', '_') AS name_joined, trim('  ' || p_type || ' ') AS type_trimmed,
           lpad(CAST(p_size AS VARCHAR), 4, '0') AS size_padded, length(p_name) AS name_length,
           concat_ws('/', p_brand, p_type) AS label, p_name LIKE '%ring' AS is_ring
    FROM part
    """,
)
def string_fn(spark: SparkSession, folder: str) -> DataFrame:
    name = F.col("p_name")
    return (
        table(spark, folder, "part")
        .select(
            "p_partkey",
            F.upper(name).alias("name_upper"),
            F.substring(name, 1, 4).alias("name_head"),
            F.replace(name, F.lit(" "), F.lit("_")).alias("name_joined"),
            F.trim(F.concat(F.lit("  "), F.col("p_type"), F.lit(" "))).alias("type_trimmed"),
            F.lpad(F.col("p_size").cast("string"), 4, "0").alias("size_padded"),
            F.length(name).cast("long").alias("name_length"),
            F.concat_ws("/", "p_brand", "p_type").alias("label"),
            name.like("%ring").alias("is_ring"),
        )
    )


@query(
    "regexp",
    """
    SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host,
           regexp_replace(url, '[?#].*$', '') AS bare_url, regexp_matches(url, '[?&]page=[0-9]+') AS is_paged
    FROM pages
    """,
)
def regexp(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select(
        "page_id",
        F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("host"),
        F.regexp_replace("url", r"[?#].*$", "").alias("bare_url"),
        F.col("url").rlike(r"[?&]page=[0-9]+").alias("is_paged"),
    )


@query(
    "explode_words",
    r"""
    SELECT word, count(*) AS n
    FROM (SELECT unnest(string_split_regex(text, '[ \t\n\r]+')) AS word FROM documents)
    WHERE word <> '' GROUP BY word
    """,
)
def explode_words(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "documents")
        .select(F.explode(F.split("text", r"[ \t\n\r]+")).alias("word"))
        .filter("word <> ''")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "date_fn",
    """
    SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
           CAST(year(o_orderdate) AS INTEGER) AS o_year, CAST(quarter(o_orderdate) AS INTEGER) AS o_quarter,
           CAST(isodow(o_orderdate) AS INTEGER) AS iso_weekday,
           CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) AS next_month,
           CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS days_in,
           last_day(CAST(o_orderdate AS DATE)) AS month_end,
           strftime(o_orderdate, '%Y-%m') AS month_text
    FROM orders
    """,
)
def date_fn(spark: SparkSession, folder: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.trunc(day, "month").alias("month_start"),
        F.year(day).alias("o_year"),
        F.quarter(day).alias("o_quarter"),
        (F.weekday(day) + 1).alias("iso_weekday"),
        F.add_months(day, 1).alias("next_month"),
        F.datediff(day, F.lit("1995-01-01").cast("date")).alias("days_in"),
        F.last_day(day).alias("month_end"),
        F.date_format(day, "yyyy-MM").alias("month_text"),
    )


@query(
    "math_fn",
    """
    SELECT p_partkey, round(p_retailprice, 1) AS price_1, CAST(floor(p_retailprice) AS BIGINT) AS price_floor,
           CAST(ceil(p_retailprice) AS BIGINT) AS price_ceil, round(sqrt(p_retailprice), 8) AS price_root,
           round(pow(p_size, 1.5), 6) AS size_pow, round(ln(p_size), 8) AS size_ln,
           CAST(p_partkey % 7 AS BIGINT) AS key_mod, abs(p_size - 25) AS size_off,
           greatest(p_size, 10) AS size_min10, CAST(sign(p_size - 25) AS DOUBLE) AS size_sign
    FROM part
    """,
)
def math_fn(spark: SparkSession, folder: str) -> DataFrame:
    price, size = F.col("p_retailprice"), F.col("p_size")
    return table(spark, folder, "part").select(
        "p_partkey",
        F.round(price, 1).alias("price_1"),
        F.floor(price).alias("price_floor"),
        F.ceil(price).alias("price_ceil"),
        F.round(F.sqrt(price), 8).alias("price_root"),
        F.round(F.pow(size, F.lit(1.5)), 6).alias("size_pow"),
        F.round(F.ln(size), 8).alias("size_ln"),
        (F.col("p_partkey") % 7).alias("key_mod"),
        F.abs(size - 25).alias("size_off"),
        F.greatest(size, F.lit(10)).alias("size_min10"),
        F.signum(size - 25).alias("size_sign"),
    )


@query(
    "json",
    """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           json_extract_string(props, '$.missing') AS missing
    FROM events
    """,
)
def json(spark: SparkSession, folder: str) -> DataFrame:
    parsed = F.from_json("props", "k INT, missing STRING")
    return table(spark, folder, "events").select("event_id", parsed["k"].alias("k"), parsed["missing"].alias("missing"))


@query(
    "array_hof",
    """
    SELECT vec_id, round(list_sum([CAST(x AS DOUBLE) * CAST(x AS DOUBLE) for x in embedding]), 6) AS norm2,
           CAST(len([x for x in embedding if x > 0]) AS INTEGER) AS n_positive,
           CAST(list_max(embedding) AS DOUBLE) AS largest
    FROM embeddings
    """,
)
def array_hof(spark: SparkSession, folder: str) -> DataFrame:
    squares = F.transform("embedding", lambda x: x.cast("double") * x.cast("double"))
    return table(spark, folder, "embeddings").select(
        "vec_id",
        F.round(F.aggregate(squares, F.lit(0.0), lambda a, x: a + x), 6).alias("norm2"),
        F.size(F.filter("embedding", lambda x: x > 0)).alias("n_positive"),
        F.array_max("embedding").cast("double").alias("largest"),
    )


@query(
    "keep_first",
    """
    SELECT o_custkey, o_orderstatus, min(o_orderkey) AS o_orderkey,
           arg_min(o_totalprice, o_orderkey) AS o_totalprice, count(*) AS n_rows
    FROM orders GROUP BY o_custkey, o_orderstatus
    """,
)
def keep_first(spark: SparkSession, folder: str) -> DataFrame:
    # One row per key, chosen by an aggregate rather than a window, so that
    # copies are already dropped in each task.
    return (
        table(spark, folder, "orders")
        .groupBy("o_custkey", "o_orderstatus")
        .agg(
            F.min("o_orderkey").alias("o_orderkey"),
            F.min_by("o_totalprice", "o_orderkey").alias("o_totalprice"),
            F.count(F.lit(1)).alias("n_rows"),
        )
    )
