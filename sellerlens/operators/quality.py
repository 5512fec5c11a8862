"""Data quality, cleaning and metadata stamps (Q1-Q12)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Neutral provenance stamps; pass a run's own as ``metadata``.
BRONZE_METADATA = {
    "_mt_bronze_extraction_tool": "file_drop",
    "_mt_bronze_source_system": "oltp",
    "_mt_bronze_workflow_created_by": "sellerlens",
}

BRONZE_COLUMNS = [
    "_mt_bronze_ingestion_time", "_mt_bronze_partition_date", "_mt_bronze_dataframe_schema",
    "_mt_bronze_workflow_created_by", "_mt_bronze_extraction_tool", "_mt_bronze_source_system",
]


class BadBatch(ValueError):
    """A landing batch that must not reach bronze."""


def fix_void_columns(df: DataFrame) -> DataFrame:
    """Q1: all-null (void) columns become string columns, in one projection."""
    voids = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NullType)}
    if not voids:
        return df
    return df.select(*[F.col(c).cast("string").alias(c) if c in voids else F.col(c) for c in df.columns])


def check_batch(df: DataFrame, table_name: str) -> DataFrame:
    """Q2 + Q3: reject corrupt-record schemas and empty batches."""
    if "_corrupt_record" in df.columns:
        raise BadBatch(f"table {table_name!r}: landing batch holds corrupt records")
    if df.isEmpty():
        raise BadBatch(f"table {table_name!r}: landing batch has no rows")
    return df


def stamp_bronze(df: DataFrame, run_ts: _dt.datetime,
                 metadata: Mapping[str, str] = BRONZE_METADATA) -> DataFrame:
    """Q4: ingestion time and partition date (text, from one run clock), the
    batch schema (names and types) and the provenance stamps, in one projection."""
    return df.withColumns({
        "_mt_bronze_ingestion_time": F.lit(run_ts.strftime("%Y-%m-%d %H:%M:%S")),
        "_mt_bronze_partition_date": F.lit(run_ts.strftime("%Y-%m-%d")),
        "_mt_bronze_dataframe_schema": F.lit(df.schema.simpleString()),
        "_mt_bronze_workflow_created_by": F.lit(metadata["_mt_bronze_workflow_created_by"]),
        "_mt_bronze_extraction_tool": F.lit(metadata["_mt_bronze_extraction_tool"]),
        "_mt_bronze_source_system": F.lit(metadata["_mt_bronze_source_system"]),
    })


def bronze_batch(df: DataFrame, table_name: str, run_ts: _dt.datetime,
                 metadata: Mapping[str, str] = BRONZE_METADATA) -> DataFrame:
    """Q5: check -> void fix -> stamp. No ``coalesce(1)``: the write stays parallel."""
    return stamp_bronze(fix_void_columns(check_batch(df, table_name)), run_ts, metadata)


def stamp_silver(df: DataFrame, run_date: _dt.date, update_key: str) -> DataFrame:
    """Q6."""
    return df.withColumns({"_mt_silver_ingestion_date": F.lit(run_date),
                           "_mt_silver_update_key": F.lit(update_key)})


def stamp_gold(df: DataFrame, run_date: _dt.date, update_key: str) -> DataFrame:
    """Q7 (columns); the written-row count goes to the load log (read from the written footers)."""
    return df.withColumns({"_mt_gold_ingestion_date": F.lit(run_date),
                           "_mt_gold_update_key": F.lit(update_key)})


# Silver typing (Q8, Q9): the columns of each table by the type they get.
SILVER_ORDERS = {
    "text": ["order_id", "customer_id"],
    "code": ["order_status"],
    "time": ["order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
             "order_estimated_delivery_date", "order_purchase_timestamp"],
}
SILVER_ITEMS = {
    "text": ["order_id", "product_id", "seller_id"],
    "int": ["order_item_id"],
    "number": ["price", "freight_value"],
    "time": ["shipping_limit_date"],
}
SILVER_TYPES = {
    "text": lambda c: c,
    "code": lambda c: F.upper(F.trim(c)),
    "int": lambda c: c.cast("int"),
    "number": lambda c: c.try_cast("double"),
    "time": lambda c: c.try_cast("timestamp_ntz"),
}
# bronze stamps that silver carries on
CARRIED = [c for c in BRONZE_COLUMNS if c != "_mt_bronze_workflow_created_by"]


def silver_transform(df: DataFrame, typing: Mapping[str, Iterable[str]]) -> DataFrame:
    """Type a bronze batch; unreadable numbers and times become null."""
    typed = [SILVER_TYPES[kind](F.col(c)).alias(c) for kind, columns in typing.items() for c in columns]
    return df.select(*typed, *CARRIED)


def silver_orders(bronze: DataFrame) -> DataFrame:
    return silver_transform(bronze, SILVER_ORDERS)


def silver_items(bronze: DataFrame) -> DataFrame:
    return silver_transform(bronze, SILVER_ITEMS)


def missing_rate(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Q10: share of nulls per column, one pass, long form (column, missing_rate)."""
    cols = list(columns or df.columns)
    wide = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) AS (column, missing_rate)")


def impute(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    """Q11: constant imputation."""
    return df.fillna(dict(values))


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Q12: drop columns; unknown names are ignored."""
    return df.drop(*list(columns))
