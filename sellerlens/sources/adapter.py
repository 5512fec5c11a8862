"""Map the driver's TPC-H-style tables onto the marketplace schemas.

orders   -> silver orders  (order_id, customer_id, order_status, 5 timestamps)
lineitem -> silver items   (order_id, order_item_id, product_id, seller_id,
                            price, freight_value, shipping_limit_date)

All timestamps stay ``timestamp_ntz`` so results do not depend on the
session time zone. ``landing_*`` return the same rows as untyped text, the
shape the bronze/silver jobs receive from the replication task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def path_of(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(path_of(sf_dir, name))


def _plus_days(n: Column, ts: Column) -> Column:
    return F.timestamp_add("DAY", n.cast("int"), ts)


def orders_from_tpch(raw: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("timestamp_ntz")
    delivered = F.col("o_orderstatus") == "F"
    status = (
        F.when(F.col("o_orderstatus") == "F", "DELIVERED")
        .when(F.col("o_orderstatus") == "O", "PROCESSING")
        .when(k % 40 == 0, "CREATED")
        .otherwise("CANCELED")
    )
    return raw.select(
        k.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        status.alias("order_status"),
        F.timestamp_add("SECOND", ((k * 37) % 86400).cast("int"), day).alias("order_purchase_timestamp"),
        F.when(k % 97 == 0, F.lit(None).cast("timestamp_ntz"))
        .otherwise(_plus_days(k % 4, day)).alias("order_approved_at"),
        F.when(delivered, _plus_days(k % 20, day)).alias("order_delivered_carrier_date"),
        F.when(delivered, _plus_days(k % 40, day)).alias("order_delivered_customer_date"),
        _plus_days(F.lit(20), day).alias("order_estimated_delivery_date"),
    )


def items_from_tpch(raw: DataFrame, seller: str = "partkey") -> DataFrame:
    """``seller='partkey'`` for features (many small sellers), ``'suppkey'`` for daily grids."""
    if seller == "partkey":
        seller_col, product_col = "l_partkey", "l_suppkey"
    elif seller == "suppkey":
        seller_col, product_col = "l_suppkey", "l_partkey"
    else:
        raise ValueError(f"seller must be 'partkey' or 'suppkey', got {seller!r}")
    return raw.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col(product_col).alias("product_id"),
        F.col(seller_col).alias("seller_id"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("freight_value"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("shipping_limit_date"),
    )


def load_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_from_tpch(_read(spark, sf_dir, "orders"))


def load_items(spark: SparkSession, sf_dir: str, seller: str = "partkey") -> DataFrame:
    return items_from_tpch(_read(spark, sf_dir, "lineitem"), seller)


def load(spark: SparkSession, sf_dir: str, seller: str = "partkey") -> tuple[DataFrame, DataFrame]:
    return load_orders(spark, sf_dir), load_items(spark, sf_dir, seller)


# ---------------------------------------------------------------- landing form

def _ts_text(c: str) -> Column:
    # a plain cast formats timestamp_ntz without any time zone (date_format
    # would pass through the session zone and move times inside DST gaps)
    return F.col(c).cast("timestamp_ntz").cast("string")


def landing_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the replication task lands them: text columns, padded
    lower-case status, one all-null column and ``last_updated_dt``."""
    o = load_orders(spark, sf_dir)
    ts_cols = ["order_approved_at", "order_delivered_carrier_date",
               "order_delivered_customer_date", "order_estimated_delivery_date",
               "order_purchase_timestamp"]
    return o.select(
        F.col("order_id").cast("string").alias("order_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.concat(F.lit("  "), F.lower("order_status"), F.lit(" ")).alias("order_status"),
        *[_ts_text(c).alias(c) for c in ts_cols],
        F.lit(None).alias("order_notes"),
    )


def landing_items(spark: SparkSession, sf_dir: str, seller: str = "partkey") -> DataFrame:
    i = load_items(spark, sf_dir, seller)
    return i.select(
        F.col("order_id").cast("string").alias("order_id"),
        F.col("order_item_id"),
        F.col("product_id").cast("string").alias("product_id"),
        F.col("seller_id").cast("string").alias("seller_id"),
        F.col("price").cast("string").alias("price"),
        F.col("freight_value").cast("string").alias("freight_value"),
        _ts_text("shipping_limit_date").alias("shipping_limit_date"),
    )
