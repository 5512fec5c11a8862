"""Analytical base table: features + 45-day churn label (ABT1, ABT2, ABT)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import dates_array, day_of
from .features import (FS1_COLUMNS, FS2_COLUMNS, REF, TS, _with_unique_products, fs_seller_orders,
                       seller_day_core)

ABT_FEATURES = FS1_COLUMNS + FS2_COLUMNS[2:]


def abt_features(purchases: DataFrame, seller_orders: DataFrame, churn_days: int = 45) -> DataFrame:
    """ABT1: purchase store LEFT order store, sellers active in the last ``churn_days``."""
    p = purchases.where(F.col("recency") <= churn_days)
    s = seller_orders.drop("_mt_ingestion_date")
    return p.drop("_mt_ingestion_date").join(s, [REF, "seller_id"], "left").select(*ABT_FEATURES)


def first_sale_on_or_after(orders: DataFrame, items: DataFrame, refs: Sequence) -> DataFrame:
    """(seller, ref) -> first sale day >= ref.

    Each distinct sale day d (with previous sale day p) answers every ref in
    (p, d]; a narrow explode over the literal ref list replaces the range join.
    """
    o = orders.select("order_id", day_of(TS).alias("day"))
    days = (items.where(F.col("seller_id").isNotNull()).select("order_id", "seller_id")
            .join(o, "order_id").where(F.col("day").isNotNull())
            .select("seller_id", "day").distinct())
    w = Window.partitionBy("seller_id").orderBy("day")
    d = days.select("seller_id", "day", F.lag("day").over(w).alias("prev_day"))
    return d.select("seller_id", F.col("day").alias("first_sale"), F.explode(F.filter(
        dates_array(refs),
        lambda r: (r <= F.col("day")) & (F.col("prev_day").isNull() | (r > F.col("prev_day")))
    )).alias(REF))


def label(features: DataFrame, orders: DataFrame, items: DataFrame, refs: Sequence,
          churn_days: int = 45) -> DataFrame:
    """ABT2: churn = 1 unless the seller sells within ``churn_days - recency``
    days on or after the reference date."""
    first = first_sale_on_or_after(orders, items, refs)
    f = features.select(REF, "seller_id", "recency").join(first, [REF, "seller_id"], "left")
    ok = F.datediff("first_sale", REF) <= (F.lit(churn_days) - F.col("recency"))
    date_sell = F.when(ok, F.col("first_sale"))
    return f.select("seller_id", REF, date_sell.alias("date_sell"),
                    F.when(date_sell.isNull(), 1).otherwise(0).alias("churn"))


def abt_seller_churn(orders: DataFrame, items: DataFrame, refs: Sequence,
                     lookback_months: int = 6, churn_days: int = 45,
                     item_scope: str = "seller", label_complete: bool = False) -> DataFrame:
    """ABT: one row per (ref, active seller) with 29 features and ``churn``.

    The purchase features and the first sale on/after each ref come out of
    the same pass (``seller_day_core``); the recency gate is applied before
    the remaining joins."""
    core = seller_day_core(orders, items, refs, lookback_months, item_scope)
    core = core.where(F.col("recency") <= churn_days)
    purchases = _with_unique_products(core, orders, items, refs, lookback_months, item_scope,
                                      extra=["first_sale"])
    sorders = fs_seller_orders(orders, items, refs, lookback_months, item_scope)
    j = purchases.join(sorders, [REF, "seller_id"], "left")
    ok = F.datediff("first_sale", REF) <= (F.lit(churn_days) - F.col("recency"))
    cols = [*ABT_FEATURES, F.when(ok, 0).otherwise(1).alias("churn")]
    if label_complete:
        last_day = orders.select(F.max(day_of(TS))).scalar()
        cols.append((F.date_add(F.col(REF), F.lit(churn_days) - F.col("recency")) <= last_day)
                    .alias("label_complete"))
    return j.select(*cols)
