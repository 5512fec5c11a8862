"""Shapes that keep large tables cheap: few shuffles of the items, few rows in running counts."""

import datetime as dt

import pytest
from conftest import make_items, make_orders

from pyspark.sql import functions as F
from sellerlens.operators import features as FS
from sellerlens.operators import model as MD
from sellerlens.operators import subsets as SB

REFS = [dt.date(2000, 1, 1), dt.date(2000, 2, 1)]


def _shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize("build", [FS.seller_day_core, FS.fs_seller_orders])
@pytest.mark.parametrize("scope", ["seller", "order"])
def test_items_are_shuffled_by_order_and_by_seller_only(spark, build, scope):
    o = make_orders(spark, [(1, "DELIVERED", "1999-12-01", "1999-12-02")])
    i = make_items(spark, [(1, 1, 7, 5, 10.0), (1, 2, 8, 6, 5.0), (1, 3, 8, None, 2.0)])
    df = build(o, i, REFS, 6, scope)
    assert _shuffles(df) == 3  # items by order, orders by order, the joined rows by seller
    assert {r.seller_id for r in df.collect()} == {5, 6}


def test_order_scope_counts_items_without_seller_and_repeated_orders(spark):
    o = make_orders(spark, [(1, "DELIVERED", "1999-12-01"), (1, "DELIVERED", "1999-12-01")])
    i = make_items(spark, [(1, 1, 7, 5, 10.0), (1, 2, 8, 6, 5.0), (1, 3, 8, None, 2.0)])
    got = {(str(r[FS.REF]), r.seller_id): r for r in FS.seller_day_core(o, i, REFS, 6, "order").collect()}
    r = got["2000-01-01", 5]
    assert (r.quantity_products_selled, r.max_item_price, r.min_item_price, r.ltv) == (6, 10.0, 2.0, 20.0)


def test_subset_rows_spread_over_the_cores(spark):
    names = MD.feature_names()
    cols = [F.rand(i).alias(c) for i, c in enumerate(names)]
    df = spark.range(9000).select(F.lit(dt.date(2000, 1, 1)).alias(FS.REF), F.col("id").alias("seller_id"), *cols, (F.col("id") % 3 == 0).cast("int").alias("churn"))
    rows = SB._rows(df.where("seller_id < 7000"), df.where("seller_id BETWEEN 7000 AND 7999"), df.where("seller_id >= 8000"), names[:3], 4, "churn")
    assert rows.rdd.getNumPartitions() == 4  # local[4]; 20,000 rows a task were one task
    assert rows.count() == 9000


def test_days_outside_the_windows_are_two_rows_a_seller(spark):
    day = dt.timedelta(1)
    days = [dt.date(1998, 1, 1) + i * day for i in range(0, 1100, 7)]
    kept = spark.createDataFrame([(5, x, 1.0, *[float(i)] * 9) for i, x in enumerate(days)],
                                 "seller_id long, day date, own_price double, " + ", ".join(f"{n} double" for n, _ in FS._MEASURES if n != "sum_freight"))
    rows = {r.slot: r for r in FS._day_slots(kept, REFS, 6).collect()}
    inside = [x for x in days if dt.date(1999, 7, 1) <= x < REFS[-1]]
    assert set(rows) == {dt.date(1999, 6, 30), *inside, REFS[-1]}
    before, after = rows[dt.date(1999, 6, 30)], rows[REFS[-1]]
    assert (before.day, before.own_price, before.n_orders) == (days[0], sum(x < inside[0] for x in days), sum(x < inside[0] for x in days))
    assert after.day == min(x for x in days if x >= REFS[-1])
    o = make_orders(spark, [(i, "DELIVERED", x.isoformat()) for i, x in enumerate(days)])
    items = make_items(spark, [(i, 1, 7, 5, 10.0 + i) for i in range(len(days))])
    for r in FS.seller_day_core(o, items, REFS, 6).collect():
        past = [i for i, x in enumerate(days) if x < r[FS.REF]]
        assert r.ltv == sum(10.0 + i for i in past) and r.days_from_first_sell == (r[FS.REF] - days[0]).days
        assert r.frequency == pytest.approx(len(past) / (days[past[-1]] - days[0]).days)
        assert r.first_sale == min(x for x in days if x >= r[FS.REF])
        assert r.recency == (r[FS.REF] - days[past[-1]]).days
