"""Source scans, and adapters that shape the test star schema into sales tables."""

from __future__ import annotations

import math
from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"

# Columns used of the test star schema.
STAR_SCHEMA = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string"
    ),
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_size int",
    "supplier": "s_suppkey bigint, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


class SalesTables(NamedTuple):
    retail_sale: DataFrame
    dim_date: DataFrame
    dim_location: DataFrame
    dim_product: DataFrame
    dim_customer: DataFrame
    #: Tasks that the sales lines need; none if not known.
    line_tasks: int = 0


#: Sales lines of one task: what its join sorts and its sums keep in memory.
LINES_PER_TASK = 250_000


def dealt(df: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to ``tasks``, where Spark's own number of tasks is smaller; else left to Spark."""
    return df.repartition(tasks, *keys) if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Scan a table by its declared columns; nothing is inferred from the files."""
    return spark.read.schema(STAR_SCHEMA[name]).parquet(f"{folder}/{name}.parquet")


def lower_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def calendar_between(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per day with ISO week numbering; weeks end on Sunday."""
    days = spark.range((last - first).days + 1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("date")
    )
    return days.select(
        "date",
        F.date_add(F.date_trunc("week", "date").cast("date"), 6).alias("week_end_date"),
        F.expr("cast(extract(week from date) as int)").alias("week"),
        F.month("date").alias("period"),
        F.expr("cast(extract(yearofweek from date) as int)").alias("year"),
    )


def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    """Calendar covering every day from the first to the last order."""
    span = load(spark, folder, "orders").agg(
        F.min("o_orderdate").cast("date").alias("first"),
        F.max("o_orderdate").cast("date").alias("last"),
    ).first()
    return calendar_between(spark, span["first"], span["last"])


def line_tasks(spark: SparkSession, folder: str, lines_per_task: int = LINES_PER_TASK) -> int:
    """Tasks for the sales lines, by their number; it stands in the files' footers, so no line is read."""
    return math.ceil(load(spark, folder, "lineitem").count() / lines_per_task)


def retail_sale(spark: SparkSession, folder: str, tasks: int = 0) -> DataFrame:
    lines = dealt(load(spark, folder, "lineitem"), tasks, "l_orderkey")
    orders = dealt(load(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate", "o_orderpriority"
    ), tasks, "l_orderkey")
    price = F.col("l_extendedprice")
    # Some returned lines count negatively, in sales and points.
    sign = F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 4), -1).otherwise(1)
    return lines.join(orders, "l_orderkey").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("l_orderkey").alias("transaction_number"),
        F.col("o_orderdate").cast("date").alias("fiscal_date"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        F.col("l_suppkey").alias("store_number"),
        F.col("l_partkey").alias("item_id"),
        F.when(F.col("l_discount") > 0.05, F.col("l_linenumber")).otherwise(0).alias("offer_id"),
        (price * (1 - F.col("l_discount")) * sign).cast(MONEY).alias("merch_sales"),
        (price * 0.8).cast(MONEY).alias("product_cost"),
        F.col("l_quantity").alias("unit_count"),
        F.when(F.col("l_linestatus") == "O", F.col("l_quantity") / 2).otherwise(0.0).alias("weight"),
        (F.floor(price / 100) * sign).alias("points_issued"),
        F.when(F.col("l_returnflag") == "R", -F.col("l_linenumber")).otherwise(0)
        .cast("bigint").alias("points_redeemed"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("l_orderkey")).alias("ecomm_trans_id"),
    )


def dim_customer(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "customer").select(
        F.col("c_custkey").alias("ldw_customer_id"),
        F.expr("c_custkey div 2").alias("household_id"),
        (F.col("c_custkey") % 31 != 0).cast("int").alias("is_active"),
        (F.col("c_custkey") % 23 == 0).cast("int").alias("deleted_flag"),
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment")).alias("current_card_type"),
    )


def dim_location(spark: SparkSession, folder: str) -> DataFrame:
    nation = load(spark, folder, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    region = load(spark, folder, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return (
        load(spark, folder, "supplier")
        .join(nation, "s_nationkey")
        .join(region, "n_regionkey")
        .select(
            F.col("s_suppkey").alias("id"),
            F.when(F.col("s_suppkey") % 13 == 0, "DC").otherwise("ST").alias("location_type"),
            F.col("r_name").alias("banner_short_name"),
            (F.col("s_acctbal") > 0).cast("int").alias("is_active"),
            F.col("n_name").alias("divisional_regional_rollup"),
        )
    )


def dim_product(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        (F.col("p_size") % 17 != 0).cast("int").alias("is_active"),
        (6600 + F.col("p_size") * 40).cast("string").alias("mdm_sub_cat_id"),
        F.when(F.col("p_partkey") % 29 == 0, F.concat(F.lit("C/C RECORD "), "p_name"))
        .otherwise(F.col("p_name")).alias("variant_name"),
        F.when(F.col("p_size") % 10 == 0, "N").otherwise("Y").alias("financial_sale_flag"),
    )


def sales_tables(spark: SparkSession, folder: str) -> SalesTables:
    tasks = line_tasks(spark, folder)
    return SalesTables(
        retail_sale(spark, folder, tasks),
        dim_date(spark, folder),
        dim_location(spark, folder),
        dim_product(spark, folder),
        dim_customer(spark, folder),
        tasks,
    )


# --- the same tables under the names the gold layer uses ---------------------------


def gold_sales(sales: DataFrame) -> DataFrame:
    return sales.select(
        F.col("customer_id").alias("customer_hk"), F.col("item_id").alias("item_hk"),
        "merch_sales", "fiscal_date",
    )


def gold_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        F.col("ldw_customer_id").alias("customer_hk"),
        F.col("household_id").alias("current_household_id"), "current_card_type",
    )


def gold_items(products: DataFrame) -> DataFrame:
    return products.select(F.col("id").alias("item_hk"), "financial_sale_flag")
