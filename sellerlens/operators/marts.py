"""Gold seller marts.

Shapes are chosen for scale: every aggregate is partial (map-side) before its
shuffle; per-seller windows run on data already reduced to one row per
(seller, day), so a seller's window partition is bounded by the calendar and
not by its raw item count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import day_of, ratio_or_zero, safe_div

# Upper bound on the number of distinct days a dense grid may span (~270 years).
MAX_GRID_DAYS = 100_000


def _items_with_purchase(items: DataFrame, orders: DataFrame) -> DataFrame:
    """items LEFT JOIN orders on order_id, keeping the orders-side key."""
    o = orders.select(F.col("order_id").alias("o_order_id"), "order_purchase_timestamp")
    return (items.where(F.col("seller_id").isNotNull())
            .join(o, items["order_id"] == o["o_order_id"], "left"))


def sellers_rfm(items: DataFrame, orders: DataFrame) -> DataFrame:
    """G1: span in days, distinct orders, largest line value and two ratios."""
    ts = F.col("order_purchase_timestamp")
    m = (_items_with_purchase(items, orders)
         .groupBy("seller_id")
         .agg(F.datediff(F.max(ts), F.min(ts)).alias("recency"),
              F.count_distinct("o_order_id").alias("frequency"),
              F.max(F.col("price") * F.col("order_item_id")).alias("monetary")))
    return m.select(
        "seller_id", "recency", "frequency", "monetary",
        ratio_or_zero("frequency", "recency").alias("frequency_recency"),
        safe_div("monetary", "frequency").alias("monetary_frequency"),
    )


def sellers_price_selling_days(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Per seller-day largest line value, previous selling day and value."""
    daily = (_items_with_purchase(items, orders)
             .groupBy("seller_id", day_of("order_purchase_timestamp").alias("date_selled"))
             .agg(F.max(F.col("price") * F.col("order_item_id")).alias("monetary")))
    w = Window.partitionBy("seller_id").orderBy("date_selled")
    lagged = daily.select("seller_id", "date_selled", "monetary",
                          F.lag("date_selled").over(w).alias("lag_date"),
                          F.lag("monetary").over(w).alias("lag_price"))
    return lagged.select("*",
                         F.datediff("date_selled", "lag_date").alias("diff_selling_days"),
                         (F.col("monetary") - F.col("lag_price")).alias("diff_monetary"))


def bounded_calendar(values: DataFrame, col: str, limit: int = MAX_GRID_DAYS):
    """Sorted distinct values of ``col`` as one array, computed as a scalar
    subquery; fails loudly if the calendar exceeds ``limit`` entries."""
    cal = F.collect_set(col)
    return values.select(F.when(F.size(cal) <= F.lit(limit), F.sort_array(cal)).otherwise(
        F.raise_error(F.lit(f"calendar larger than {limit} entries")))).scalar()


def sellers_intermittent_daily(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Every seller x every purchase date, zero-filled, day-over-day change.

    The calendar (distinct purchase dates, bounded by the data's day span) is
    exploded per seller instead of a cartesian join.
    """
    calendar = bounded_calendar(orders.select(day_of("order_purchase_timestamp").alias("d")), "d")
    sellers = items.select("seller_id").distinct()
    grid = sellers.select("seller_id", F.explode(calendar).alias("date"))
    o = orders.select("order_id", day_of("order_purchase_timestamp").alias("date"))
    sales = (o.join(items.where(F.col("seller_id").isNotNull()), "order_id")
             .groupBy("seller_id", "date")
             .agg(F.sum(F.col("price") * F.col("order_item_id")).alias("monetary")))
    filled = (grid.join(sales, ["seller_id", "date"], "left")
              .select("seller_id", "date", F.coalesce("monetary", F.lit(0.0)).alias("monetary")))
    w = Window.partitionBy("seller_id").orderBy("date")
    return filled.select("seller_id", "date", "monetary",
                         (F.col("monetary") - F.lag("monetary").over(w)).alias("diff_monetary"))


def sellers_daily_runs(items: DataFrame, orders: DataFrame) -> DataFrame:
    """G3 in runs: (seller_id, date_from, date_to, n_days, monetary, diff_monetary).

    A run is a sale day, the calendar day after a sale day or at the calendar's start if nothing is
    sold on it, or the whole stretch of the days that follow up to the next sale; monetary and its
    change are equal on all days of a run. A seller has at most three rows per sale day and two
    more, however long the calendar is, where the dense form has sellers x days.
    ``expand_daily_runs`` gives exactly the rows of ``sellers_intermittent_daily``.
    """
    calendar = bounded_calendar(orders.select(day_of("order_purchase_timestamp").alias("d")), "d")
    one = items.sparkSession.range(1)
    days = one.select(F.posexplode(calendar).alias("i", "date"))  # at most MAX_GRID_DAYS rows
    o = orders.select("order_id", day_of("order_purchase_timestamp").alias("date"))
    sales = (o.join(items.where(F.col("seller_id").isNotNull()), "order_id")
             .groupBy("seller_id", "date").agg(F.sum(F.col("price") * F.col("order_item_id")).alias("v"))
             .join(F.broadcast(days), "date").select("seller_id", "i", F.coalesce("v", F.lit(0.0)).alias("v")))
    w = Window.partitionBy("seller_id").orderBy("i")
    near = items.select("seller_id").distinct().join(sales, "seller_id", "left").select(
        "seller_id", "i", "v", F.lag("i").over(w).alias("pi"), F.lag("v").over(w).alias("pv"),
        F.coalesce(F.lead("i").over(w), F.size(calendar)).alias("ni"))
    i, v, none = F.col("i"), F.col("v"), F.lit(None).cast("double")
    zero = F.lit(0.0)

    def run(a, b, value, change, when):
        row = F.struct(a.cast("int").alias("a"), b.cast("int").alias("b"), value.alias("monetary"), change.alias("diff_monetary"))
        return F.when(when & (a <= b), row)

    first, start = F.col("pi").isNull(), F.lit(0)
    before = F.coalesce(i, F.size(calendar))  # a seller without any dated sale: the whole calendar
    change = F.when(i > 0, v - F.when(F.col("pi") == i - 1, F.col("pv")).otherwise(zero))
    runs = F.array(
        run(start, start, zero, none, first & (before > 0)),
        run(F.lit(1), before - 1, zero, zero, first),
        run(i, i, v, change, i.isNotNull()),
        run(i + 1, i + 1, zero, zero - v, F.col("ni") > i + 1),
        run(i + 2, F.col("ni") - 1, zero, zero, i.isNotNull()))
    r = near.select("seller_id", F.explode(runs).alias("r")).where("r IS NOT NULL").select("seller_id", "r.*")
    return r.select("seller_id", F.element_at(calendar, F.col("a") + 1).alias("date_from"), F.element_at(calendar, F.col("b") + 1).alias("date_to"),
                    (F.col("b") - F.col("a") + 1).alias("n_days"), "monetary", "diff_monetary")


def expand_daily_runs(runs: DataFrame, orders: DataFrame) -> DataFrame:
    """The dense rows (seller_id, date, monetary, diff_monetary) of ``sellers_daily_runs``."""
    calendar = bounded_calendar(orders.select(day_of("order_purchase_timestamp").alias("d")), "d")
    dates = F.slice(calendar, F.array_position(calendar, F.col("date_from")).cast("int"), F.col("n_days"))
    return runs.select("seller_id", F.explode(dates).alias("date"), "monetary", "diff_monetary")
