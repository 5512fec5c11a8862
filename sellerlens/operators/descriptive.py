"""Descriptive queries over silver orders/items (D-1 .. D-14).

Status literals are compared upper-cased: silver normalises the status.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import (date_lit, day_of, fractional_days, in_range,
                                 month_floor, month_index, year_month)
from ..session import cut_lineage
from .marts import bounded_calendar

TS = "order_purchase_timestamp"


def _window(orders: DataFrame, start, end) -> DataFrame:
    return orders.where(in_range(TS, date_lit(start), date_lit(end)))


def _status(s: str):
    return F.col("order_status") == s.upper()


# ------------------------------------------------------------------ cohorts

def cohort(orders: DataFrame, items: DataFrame, start, end) -> DataFrame:
    """D-1: distinct sellers per (first active month, month index)."""
    o = (_window(orders, start, end)
         .where(_status("delivered"))
         .where(F.datediff("order_delivered_customer_date", "order_approved_at") > 0)
         .select("order_id", month_floor(TS).alias("date")))
    active = (o.join(items.where(F.col("seller_id").isNotNull()).select("order_id", "seller_id"), "order_id")
              .select("seller_id", "date").distinct())
    w = Window.partitionBy("seller_id")
    indexed = active.select("seller_id", F.min("date").over(w).alias("cohort_date"), "date")
    # one row per (seller, month): COUNT(DISTINCT seller_id) == COUNT(*) here
    return (indexed.groupBy("cohort_date", month_index("date", "cohort_date").alias("cohort_index"))
            .agg(F.count(F.lit(1)).alias("seller_id")))


def cohort_retention(cohorts: DataFrame, decimals: int = 3) -> DataFrame:
    """D-2 (long form): cohort size share per month index, index 1 = 1.0.
    The index-1 size comes from a window over the (small) aggregated cohort
    table, so the cohorts are computed once."""
    size = F.max(F.when(F.col("cohort_index") == 1, F.col("seller_id"))).over(Window.partitionBy("cohort_date"))
    return cohorts.select("cohort_date", "cohort_index",
                          F.round(F.try_divide(F.col("seller_id"), size), decimals).alias("retention"))


def cohort_pivot(cohorts: DataFrame, n_index: int) -> DataFrame:
    """Cohort x month-index matrix with an explicit, bounded column list."""
    return (cohorts.groupBy("cohort_date")
            .pivot("cohort_index", list(range(1, n_index + 1)))
            .agg(F.first("seller_id")))


def months_in_window(start: _dt.date, end: _dt.date) -> int:
    """Number of calendar months touched by ``[start, end)``."""
    n = (end.year - start.year) * 12 + (end.month - start.month)
    return n + (1 if end.day > 1 else 0) - (0 if start.day == 1 else 0)


# --------------------------------------------------------- order inspection

def suspicious_orders(orders: DataFrame, items: DataFrame, start, end) -> DataFrame:
    """D-3: 'created' orders with their items, if any (null = no item)."""
    o = _window(orders, start, end).where(_status("created")).select("order_id", TS)
    i = items.select(F.col("order_id").alias("order_id_item"))
    return (o.join(i, o["order_id"] == i["order_id_item"], "left")
            .select("order_id", "order_id_item", TS))


def suspicious_customers(orders: DataFrame, start, end) -> DataFrame:
    """D-4: every order of customers owning a 'created' order, with the number
    of such orders per customer. The flagged side is reduced to one row per
    customer first, so a customer with many flagged orders does not multiply
    its order history (no order x flagged-order pairs)."""
    flagged = (_window(orders, start, end).where(_status("created"))
               .groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_flagged_orders")))
    return orders.join(flagged, "customer_id")


def stuck_processing(orders: DataFrame, start, end, as_of) -> DataFrame:
    """D-5: 'processing' orders and days since approval at ``as_of``."""
    return (_window(orders, start, end).where(_status("processing"))
            .select("order_id", "customer_id", TS, "order_approved_at",
                    "order_estimated_delivery_date",
                    F.datediff(date_lit(as_of), day_of("order_approved_at")).alias("days_in_processing"))
            .orderBy(TS))


def lookup(df: DataFrame, column: str, value) -> DataFrame:
    """D-6: point lookup (pushed to the parquet scan as a filter)."""
    return df.where(F.col(column) == F.lit(value))


# ----------------------------------------------------------- time series

def monthly_ltv(orders: DataFrame, items: DataFrame, start, end, fill: str = "zero") -> DataFrame:
    """D-7: zero-filled monthly cumulative LTV per seller (delivered orders).

    ``fill='zero'`` reproduces the reference (idle months show 0),
    ``fill='carry'`` carries the last cumulative value forward.
    """
    f = (_window(orders, start, end)
         .where(_status("delivered"))
         .where(fractional_days("order_delivered_customer_date", "order_approved_at") > 0)
         .select("order_id", month_floor(TS).alias("order_month_purchase")))
    lines = (f.join(items.where(F.col("seller_id").isNotNull()), "order_id")
             .select("seller_id", "order_month_purchase",
                     (F.col("price") * F.col("order_item_id")).alias("monetary")))
    # written once: running totals, the calendar and the seller list read it, not the items again
    monthly = cut_lineage(lines.groupBy("seller_id", "order_month_purchase").agg(F.sum("monetary").alias("monetary")))
    w = Window.partitionBy("seller_id").orderBy("order_month_purchase")
    ltv = monthly.select("seller_id", "order_month_purchase",
                         F.sum("monetary").over(w).alias("ltv"))
    months = bounded_calendar(monthly.select("order_month_purchase"), "order_month_purchase")
    grid = (monthly.select("seller_id").distinct()
            .select("seller_id", F.explode(months).alias("order_month_purchase")))
    out = grid.join(ltv, ["seller_id", "order_month_purchase"], "left")
    if fill == "zero":
        value = F.coalesce("ltv", F.lit(0.0))
    elif fill == "carry":
        wc = w.rowsBetween(Window.unboundedPreceding, 0)
        value = F.coalesce(F.last("ltv", ignorenulls=True).over(wc), F.lit(0.0))
    else:
        raise ValueError("fill must be 'zero' or 'carry'")
    return out.select("seller_id", "order_month_purchase", value.alias("forecast_ltv"))


def min_max_orders(orders: DataFrame) -> DataFrame:
    """D-8: first and last purchase."""
    return orders.agg(F.min(TS).alias("first_purchase"), F.max(TS).alias("last_purchase"))


def product_sales(orders: DataFrame, items: DataFrame, product_id) -> DataFrame:
    """D-9: sales of one product with the order time."""
    i = items.where(F.col("product_id") == F.lit(product_id))
    return (i.join(orders, "order_id")
            .select("order_id", "product_id", TS, "freight_value", "seller_id", "price"))


def orders_time_series(orders: DataFrame) -> DataFrame:
    """D-10: orders per year-month, newest first."""
    return (orders.groupBy(year_month(TS).alias("year_month"))
            .agg(F.count("order_id").alias("n_orders"))
            .orderBy(F.desc("year_month")))


def product_price_variation(items: DataFrame) -> DataFrame:
    """D-11: products whose distinct prices vary; stats over distinct prices."""
    pp = items.select("product_id", "price").distinct()
    pv = pp.groupBy("product_id").agg(F.min("price").alias("min_price"),
                                      F.avg("price").alias("avg_price"),
                                      F.max("price").alias("max_price"))
    return pv.where(F.col("min_price") != F.col("max_price")).orderBy(F.desc("avg_price"))


def seller_ltv_delivered(orders: DataFrame, items: DataFrame, start, end) -> DataFrame:
    """LTV per seller: sum over delivered orders of the largest line value."""
    per_order = (items.groupBy("order_id", "seller_id")
                 .agg(F.max(F.col("price") * F.col("order_item_id")).alias("total_price")))
    o = _window(orders, start, end).where(_status("delivered")).select("order_id")
    return (o.join(per_order, "order_id").groupBy("seller_id")
            .agg(F.sum("total_price").alias("ltv")))


def seller_pareto(orders: DataFrame, items: DataFrame, start, end, top: int | None = 25) -> DataFrame:
    """D-12: cumulative seller share by LTV, ``count(ltv' >= ltv) / n``.

    With ``top`` set only the top rows are ranked: every seller counted for
    them has ``ltv >= `` the top-th value, so the count runs over at most
    ``top`` distinct values and never needs a global window. ``top=None``
    ranks everyone with the distributed prefix count.
    """
    from .prefix import cumulative_counts

    # one row per seller, read by the count, the top-k, its floor and the
    # tie counts: materialised once instead of re-aggregating the items 4x
    ltv = cut_lineage(seller_ltv_delivered(orders, items, start, end))
    n = ltv.select(F.count(F.lit(1))).scalar()
    if top is None:
        counts = cumulative_counts(ltv.groupBy("ltv").agg(F.count(F.lit(1)).alias("w")),
                                   "ltv", "w", descending=True)
        return (ltv.join(counts, "ltv")
                .select("seller_id", "ltv", (F.col("cum_w") / n).alias("pareto_rank")))
    head = ltv.orderBy(F.desc("ltv"), F.asc("seller_id")).limit(top)
    floor = head.select(F.min("ltv")).scalar()
    vals = (ltv.where(F.col("ltv") >= floor).groupBy("ltv").agg(F.count(F.lit(1)).alias("w")))
    w = Window.orderBy(F.desc("ltv"))  # <= top distinct values
    vals = vals.select("ltv", F.sum("w").over(w).alias("cum_w"))
    return (head.join(F.broadcast(vals), "ltv")
            .select("seller_id", "ltv", (F.col("cum_w") / n).alias("pareto_rank"))
            .orderBy(F.desc("ltv"), F.asc("seller_id")))


def order_status_counts(orders: DataFrame, start, end) -> DataFrame:
    """D-13: distinct orders by status."""
    return (_window(orders, start, end).groupBy("order_status")
            .agg(F.count_distinct("order_id").alias("n_orders"))
            .orderBy("n_orders"))


def unique_products(items: DataFrame) -> DataFrame:
    """D-14: number of distinct products."""
    return items.agg(F.count_distinct("product_id").alias("unique_products"))
