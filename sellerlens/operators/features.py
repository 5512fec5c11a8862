"""Feature stores for many reference dates in one pass (FS1, FS2).

The reference recomputes each store once per reference date. Here every
source row is routed to the reference dates whose window contains it with a
narrow ``explode(filter(refs, ...))`` (refs is a small literal array, so no
join and no nested loop), and aggregates are first reduced to one row per
(seller, day) so the fan-out (at most ``lookback_months + 1`` refs for
monthly dates) applies to pre-aggregated rows.

Closed forms used instead of windows:
* mean gap between consecutive distinct sale days = (last - first) / (n - 1)
  (the gaps telescope), so FS1d needs no LAG;
* "all history before ref" (FS1c) is an as-of lookup: the running totals of
  the last sale day before ``ref`` are routed to every ref in
  (day, next_day].

Shuffles: items are dealt once by order, which serves the (order, seller)
measures and the join with the orders, and what remains once by seller, which
serves the (seller, day) rows, the per-seller window, the fan-out to reference
dates and the (ref, seller) aggregates. Nothing is shuffled after the fan-out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import dates_array, day_of, safe_div, ts_of

REF = "_mt_date_reference"
TS = "order_purchase_timestamp"

_MEASURES = [
    ("n_prod", lambda: F.count("product_id")),
    ("sum_price", lambda: F.sum("price")),
    ("n_price", lambda: F.count("price")),
    ("sum_line", lambda: F.sum(F.col("price") * F.col("order_item_id"))),
    ("n_line", lambda: F.count(F.col("price") * F.col("order_item_id"))),
    ("max_line", lambda: F.max(F.col("price") * F.col("order_item_id"))),
    ("min_line", lambda: F.min(F.col("price") * F.col("order_item_id"))),
    ("max_price", lambda: F.max("price")),
    ("min_price", lambda: F.min("price")),
    ("sum_freight", lambda: F.sum("freight_value")),
]


def _measures():
    return [f().alias(n) for n, f in _MEASURES]


def refs_in_window(day: Column, refs: Sequence, lookback_months: int) -> Column:
    """Reference dates r with ``add_months(r, -k) <= day < r`` (day-aligned
    form of the half-open timestamp window; both bounds are midnights)."""
    return F.filter(dates_array(refs),
                    lambda r: (day < r) & (day >= F.add_months(r, -lookback_months)))


def _window_filter(orders: DataFrame, refs: Sequence, lookback_months: int) -> DataFrame:
    lo = F.add_months(F.lit(min(refs)), -lookback_months)
    return orders.where((F.col(TS) >= ts_of(lo)) & (F.col(TS) < ts_of(F.lit(max(refs)))))


def seller_orders_base(orders: DataFrame, items: DataFrame, item_scope: str = "seller") -> DataFrame:
    """One row per (seller, order): order attributes plus item measures.

    ``item_scope='seller'``: the seller's own items of the order.
    ``item_scope='order'``: every item of the order (the reference's join by
    order only); measures come from a per-order aggregate joined to the
    distinct (order, seller) pairs, so no item x seller pairs are formed.
    """
    it = items.where(F.col("seller_id").isNotNull())
    if item_scope == "seller":
        per = it.repartition("order_id").groupBy("order_id", "seller_id").agg(*_measures())
    elif item_scope == "order":
        per = _order_measures(items).drop("own_price")
    else:
        raise ValueError("item_scope must be 'seller' or 'order'")
    return per.join(orders, "order_id")


def _order_measures(items: DataFrame) -> DataFrame:
    """One row per (order, seller) with the measures of the whole order (items without a seller
    included) and the seller's own price sum; the order's come from a window over its sellers."""
    merge = {"max": F.max, "min": F.min}
    w = Window.partitionBy("order_id")
    own = items.repartition("order_id").groupBy("order_id", "seller_id").agg(*_measures())
    return own.select("order_id", "seller_id", F.col("sum_price").alias("own_price"),
                      *[merge.get(n[:3], F.sum)(n).over(w).alias(n) for n, _ in _MEASURES]).where(F.col("seller_id").isNotNull())


def _seller_days(base: DataFrame) -> DataFrame:
    return (base.repartition("seller_id").groupBy("seller_id", day_of(TS).alias("day"))
            .agg(F.sum("n_prod").alias("n_prod"), F.sum("sum_price").alias("sum_price"),
                 F.sum("n_price").alias("n_price"), F.sum("sum_line").alias("sum_line"),
                 F.sum("n_line").alias("n_line"), F.max("max_line").alias("max_line"),
                 F.min("min_line").alias("min_line"), F.max("max_price").alias("max_price"),
                 F.min("min_price").alias("min_price"), F.count("order_id").alias("n_orders")))


def seller_descriptions(base: DataFrame, refs: Sequence, lookback_months: int = 6) -> DataFrame:
    """FS1b + FS1d (without distinct products): per (ref, seller) window stats."""
    days = _seller_days(base)
    routed = days.select("*", F.explode(refs_in_window(F.col("day"), refs, lookback_months)).alias(REF))
    r = F.col(REF)
    return (routed.groupBy(REF, "seller_id").agg(
        F.datediff(r, F.max("day")).alias("recency"),
        safe_div(F.sum("sum_price"), F.sum("n_prod")).alias("avg_ticket"),
        safe_div(F.sum("n_prod"), F.sum("n_orders")).alias("avg_order_product"),
        F.max("max_line").alias("max_order_items_price"),
        F.min("min_line").alias("min_order_items_price"),
        safe_div(F.sum("sum_line"), F.sum("n_line")).alias("avg_order_items_price"),
        F.max("max_price").alias("max_item_price"),
        F.min("min_price").alias("min_item_price"),
        safe_div(F.sum("sum_price"), F.sum("n_price")).alias("avg_item_price"),
        F.count("day").alias("quantity_date_orders"),
        F.sum("n_prod").alias("quantity_products_selled"),
        safe_div(F.datediff(F.max("day"), F.min("day")), F.count("day") - 1).alias("avg_seller_interval"),
    ))


def seller_unique_products(orders: DataFrame, items: DataFrame, refs: Sequence,
                           lookback_months: int = 6, item_scope: str = "seller") -> DataFrame:
    """COUNT(DISTINCT product_id) per (ref, seller) over the window."""
    o = orders.select("order_id", day_of(TS).alias("day"))
    it = items.where(F.col("seller_id").isNotNull())
    if item_scope == "seller":
        sp = it.join(o, "order_id").select("seller_id", "product_id", "day")
    else:
        # reference form: every product of every order the seller sold in
        pairs = it.select("order_id", "seller_id").repartition("order_id").distinct()
        prods = items.where(F.col("product_id").isNotNull()).select("order_id", "product_id").repartition("order_id").distinct()
        sp = pairs.join(o, "order_id").join(prods, "order_id").select("seller_id", "product_id", "day")
    sp = sp.repartition("seller_id").distinct()
    routed = sp.select("seller_id", "product_id",
                       F.explode(refs_in_window(F.col("day"), refs, lookback_months)).alias(REF))
    return (routed.groupBy(REF, "seller_id")
            .agg(F.count_distinct("product_id").alias("quantity_unique_product_selled")))


def seller_life(orders: DataFrame, items: DataFrame, refs: Sequence) -> DataFrame:
    """FS1c: all history strictly before each ref (as-of running totals)."""
    own = seller_orders_base(orders, items, "seller")
    own = own.where(F.col(TS) < ts_of(F.lit(max(refs)))).select("seller_id", TS, "sum_price", "order_id")
    days = (own.repartition("seller_id").groupBy("seller_id", day_of(TS).alias("day"))
            .agg(F.sum("sum_price").alias("sum_price"), F.count("order_id").alias("n_orders")))
    w = Window.partitionBy("seller_id").orderBy("day")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    cum = days.select("seller_id", "day",
                      F.sum("sum_price").over(run).alias("ltv"),
                      F.sum("n_orders").over(run).alias("cum_orders"),
                      F.min("day").over(run).alias("first_day"),
                      F.lead("day").over(w).alias("next_day"))
    routed = cum.select("*", F.explode(F.filter(
        dates_array(refs),
        lambda r: (F.col("day") < r) & (F.col("next_day").isNull() | (r <= F.col("next_day")))
    )).alias(REF))
    return routed.select(
        REF, "seller_id", "ltv",
        F.datediff(F.col(REF), F.col("first_day")).alias("days_from_first_sell"),
        safe_div(F.col("cum_orders"), F.datediff("day", "first_day")).alias("frequency"),
    )


def _day_slots(kept: DataFrame, refs: Sequence, lookback_months: int) -> DataFrame:
    """(seller, slot) rows: a sale day inside the windows is a slot of its own. Of the days before all
    windows only totals and the first day are asked for, of those from the last reference date on only
    the first: each side is one slot, with its first day as ``day``."""
    lo, hi = F.add_months(F.lit(min(refs)), -lookback_months), F.lit(max(refs))
    slot = F.when(F.col("day") < lo, F.date_sub(lo, 1)).when(F.col("day") >= hi, hi).otherwise(F.col("day"))
    return (kept.repartition("seller_id").groupBy("seller_id", slot.alias("slot"))
            .agg(F.min("day").alias("day"), F.sum("n_prod").alias("n_prod"), F.sum("sum_price").alias("sum_price"),
                 F.sum("n_price").alias("n_price"), F.sum("sum_line").alias("sum_line"),
                 F.sum("n_line").alias("n_line"), F.max("max_line").alias("max_line"),
                 F.min("min_line").alias("min_line"), F.max("max_price").alias("max_price"),
                 F.min("min_price").alias("min_price"), F.sum("own_price").alias("own_price"),
                 F.count(F.lit(1)).alias("n_orders")))


def seller_day_core(orders: DataFrame, items: DataFrame, refs: Sequence, lookback_months: int = 6,
                    item_scope: str = "seller") -> DataFrame:
    """FS1 (without distinct products) and the first sale on/after each ref,
    for every (ref, seller) with a sale inside the ref's look-back window, in
    one pass: (order, seller) measures -> (seller, day) rows, one for all days
    before the windows and one for all after them -> one per-seller window (running totals, previous / next sale day) -> one
    explode that routes each day to
      * refs whose window holds it          (window statistics),
      * the ref it is the last sale before  (as-of life totals; this day is
        inside that ref's window whenever the (ref, seller) row exists),
      * refs it is the first sale on/after  (churn label),
    -> one aggregation per (ref, seller)."""
    if item_scope == "seller":
        per = (items.where(F.col("seller_id").isNotNull()).repartition("order_id")
               .groupBy("order_id", "seller_id").agg(*_measures()).withColumn("own_price", F.col("sum_price")))
    elif item_scope == "order":
        per = _order_measures(items)
    else:
        raise ValueError("item_scope must be 'seller' or 'order'")
    o = orders.select("order_id", day_of(TS).alias("day")).where(F.col("day").isNotNull())
    # days that no window holds only give running totals and first sales: their other measures stay behind
    some = (F.col("day") >= F.add_months(F.lit(min(refs)), -lookback_months)) & (F.col("day") < F.lit(max(refs)))
    kept = per.join(o, "order_id").select("seller_id", "day", "own_price", *[
        F.when(some, F.col(n)).alias(n) for n, _ in _MEASURES if n != "sum_freight"])
    sd = _day_slots(kept, refs, lookback_months)
    w = Window.partitionBy("seller_id").orderBy("slot")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    sd = sd.select("*",
                   F.sum("own_price").over(run).alias("ltv"),
                   F.sum("n_orders").over(run).alias("cum_orders"),
                   F.min("day").over(run).alias("first_day"),
                   F.lag("day").over(w).alias("prev_day"),
                   F.lead("day").over(w).alias("next_day"))
    day, prev, nxt = F.col("day"), F.col("prev_day"), F.col("next_day")

    def tags(r):
        in_w = (day < r) & (day >= F.add_months(r, -lookback_months))
        first = (r <= day) & (prev.isNull() | (r > prev))
        return F.struct(r.alias("ref"), in_w.alias("in_w"),
                        (in_w & (nxt.isNull() | (r <= nxt))).alias("asof"), first.alias("first"))
    routed = sd.select("*", F.explode(F.filter(F.transform(dates_array(refs), tags),
                                               lambda t: t["in_w"] | t["first"])).alias("t"))
    in_w, asof = F.col("t.in_w"), F.col("t.asof")

    def wv(c):
        return F.when(in_w, F.col(c))
    g = routed.groupBy(F.col("t.ref").alias(REF), "seller_id").agg(
        F.count_if(in_w).alias("quantity_date_orders"),
        F.max(wv("day")).alias("_last"), F.min(wv("day")).alias("_first_w"),
        F.sum(wv("sum_price")).alias("_sum_price"), F.sum(wv("n_prod")).alias("_n_prod"),
        F.sum(wv("n_orders")).alias("_n_orders"), F.sum(wv("sum_line")).alias("_sum_line"),
        F.sum(wv("n_line")).alias("_n_line"), F.sum(wv("n_price")).alias("_n_price"),
        F.max(wv("max_line")).alias("max_order_items_price"),
        F.min(wv("min_line")).alias("min_order_items_price"),
        F.max(wv("max_price")).alias("max_item_price"), F.min(wv("min_price")).alias("min_item_price"),
        F.max(F.when(asof, F.col("ltv"))).alias("ltv"),
        F.max(F.when(asof, F.col("first_day"))).alias("_first_day"),
        F.max(F.when(asof, safe_div(F.col("cum_orders"), F.datediff("day", "first_day")))).alias("frequency"),
        F.min(F.when(F.col("t.first"), day)).alias("first_sale"),
    ).where(F.col("quantity_date_orders") > 0)
    r = F.col(REF)
    return g.select(
        REF, "seller_id",
        F.datediff(r, F.col("_last")).alias("recency"),
        safe_div(F.col("_sum_price"), F.col("_n_prod")).alias("avg_ticket"),
        safe_div(F.col("_n_prod"), F.col("_n_orders")).alias("avg_order_product"),
        "max_order_items_price", "min_order_items_price",
        safe_div(F.col("_sum_line"), F.col("_n_line")).alias("avg_order_items_price"),
        "max_item_price", "min_item_price",
        safe_div(F.col("_sum_price"), F.col("_n_price")).alias("avg_item_price"),
        "quantity_date_orders",
        F.col("_n_prod").alias("quantity_products_selled"),
        safe_div(F.datediff(F.col("_last"), F.col("_first_w")), F.col("quantity_date_orders") - 1)
        .alias("avg_seller_interval"),
        "ltv",
        F.datediff(r, F.col("_first_day")).alias("days_from_first_sell"),
        "frequency", "first_sale",
    )


FS1_COLUMNS = [
    REF, "seller_id", "recency", "avg_ticket", "avg_order_product",
    "max_order_items_price", "min_order_items_price", "avg_order_items_price",
    "max_item_price", "min_item_price", "avg_item_price", "quantity_date_orders",
    "quantity_products_selled", "quantity_unique_product_selled",
    "avg_seller_interval", "ltv", "days_from_first_sell", "frequency",
]


def fs_seller_purchases(orders: DataFrame, items: DataFrame, refs: Sequence,
                        lookback_months: int = 6, item_scope: str = "seller",
                        run_ts: Column | None = None) -> DataFrame:
    """FS1: purchase features per (reference date, seller)."""
    core = seller_day_core(orders, items, refs, lookback_months, item_scope)
    return _with_unique_products(core, orders, items, refs, lookback_months, item_scope, run_ts)


def _with_unique_products(core: DataFrame, orders: DataFrame, items: DataFrame, refs: Sequence,
                          lookback_months: int, item_scope: str, run_ts: Column | None = None,
                          extra: Sequence[str] = ()) -> DataFrame:
    uniq = seller_unique_products(_window_filter(orders, refs, lookback_months), items, refs,
                                  lookback_months, item_scope)
    out = (core.join(uniq, [REF, "seller_id"], "left")
           .withColumn("quantity_unique_product_selled",
                       F.coalesce("quantity_unique_product_selled", F.lit(0)))
           .select(*FS1_COLUMNS, *extra))
    if run_ts is not None:
        out = out.select(REF, run_ts.alias("_mt_ingestion_date"), *FS1_COLUMNS[1:])
    return out


FS2_COLUMNS = [
    REF, "seller_id", "avg_freight_value", "min_freight_value", "max_freight_value",
    "avg_approval_delivery_days", "min_approval_delivery_days", "max_approval_delivery_days",
    "avg_approval_purchase_days", "min_approval_purchase_days", "max_approval_purchase_days",
    "pct_status_delivered", "pct_status_canceled", "pct_delay_delivered_orders",
    "quantity_delay_orders",
]


def fs_order_totals(orders: DataFrame, items: DataFrame, refs: Sequence,
                    lookback_months: int = 6, item_scope: str = "seller") -> DataFrame:
    """FS2a: per (ref, seller, order) summed price and freight with order fields."""
    return _order_totals(seller_orders_base(_window_filter(orders, refs, lookback_months), items, item_scope), refs, lookback_months)


def _order_totals(base: DataFrame, refs: Sequence, lookback_months: int) -> DataFrame:
    return base.select(
        F.explode(refs_in_window(day_of(TS), refs, lookback_months)).alias(REF),
        "seller_id", "order_id", "order_status", TS, "order_approved_at",
        "order_delivered_customer_date", "order_estimated_delivery_date",
        F.col("sum_price").alias("price"), F.col("sum_freight").alias("freight_value"))


def fs_seller_orders(orders: DataFrame, items: DataFrame, refs: Sequence,
                     lookback_months: int = 6, item_scope: str = "seller",
                     compat_counts: bool = False, censor_at_ref: bool = False,
                     run_ts: Column | None = None) -> DataFrame:
    """FS2: freight, lead-time and status-share features per (ref, seller).

    ``compat_counts=True`` reproduces the reference's COUNT(flag), which
    counts false flags too (shares are then 1.0).
    """
    base = seller_orders_base(_window_filter(orders, refs, lookback_months), items, item_scope)
    t = _order_totals(base.select("seller_id", "order_id", "order_status", TS, "order_approved_at", "order_delivered_customer_date",
                                  "order_estimated_delivery_date", "sum_price", "sum_freight").repartition("seller_id"), refs, lookback_months)
    ref_ts = ts_of(F.col(REF))
    dl = F.col("order_delivered_customer_date")
    if censor_at_ref:
        dl = F.when(dl > ref_ts, F.lit(None).cast("timestamp_ntz")).otherwise(dl)
    t = t.select("*",
                 F.coalesce(dl, ref_ts).alias("delivered_c"),
                 (F.col("order_status") == "DELIVERED").alias("flag_delivered"),
                 (F.col("order_status") == "CANCELED").alias("flag_canceled"))
    dd = F.datediff("delivered_c", "order_approved_at")
    pd_ = F.datediff("order_approved_at", TS)
    late = F.col("flag_delivered") & (F.to_date("delivered_c") > F.to_date("order_estimated_delivery_date"))
    n = F.count("order_id")  # rows are unique per (ref, seller, order)
    if compat_counts:
        n_del, n_can = F.count("flag_delivered"), F.count("flag_canceled")
    else:
        n_del, n_can = F.count_if("flag_delivered"), F.count_if("flag_canceled")
    out = t.groupBy(REF, "seller_id").agg(
        F.avg("freight_value").alias("avg_freight_value"),
        F.min("freight_value").alias("min_freight_value"),
        F.max("freight_value").alias("max_freight_value"),
        F.avg(dd).alias("avg_approval_delivery_days"),
        F.min(dd).alias("min_approval_delivery_days"),
        F.max(dd).alias("max_approval_delivery_days"),
        F.avg(pd_).alias("avg_approval_purchase_days"),
        F.min(pd_).alias("min_approval_purchase_days"),
        F.max(pd_).alias("max_approval_purchase_days"),
        safe_div(n_del, n).alias("pct_status_delivered"),
        safe_div(n_can, n).alias("pct_status_canceled"),
        safe_div(F.count_if(late), F.count_if("flag_delivered")).alias("pct_delay_delivered_orders"),
        F.count_if(late).alias("quantity_delay_orders"),
    ).select(*FS2_COLUMNS)
    if run_ts is not None:
        out = out.select(REF, run_ts.alias("_mt_ingestion_date"), *FS2_COLUMNS[1:])
    return out


def fs_filter_sellers(orders: DataFrame, items: DataFrame, refs: Sequence,
                      lookback_months: int = 6) -> DataFrame:
    """FS1a: distinct (ref, order, seller) bought inside each ref's window."""
    o = _window_filter(orders, refs, lookback_months).select("order_id", day_of(TS).alias("day"))
    pairs = items.where(F.col("seller_id").isNotNull()).select("order_id", "seller_id").distinct()
    return (pairs.join(o, "order_id")
            .select(F.explode(refs_in_window(F.col("day"), refs, lookback_months)).alias(REF),
                    "order_id", "seller_id"))


def fs_seller_interval(orders: DataFrame, items: DataFrame, refs: Sequence,
                       lookback_months: int = 6) -> DataFrame:
    """FS1d alone: mean gap between distinct sale days (null for one day)."""
    base = seller_orders_base(_window_filter(orders, refs, lookback_months), items, "seller")
    return seller_descriptions(base, refs, lookback_months).select(REF, "seller_id", "avg_seller_interval")
