from conftest import d, make_items, make_orders
from pyspark.sql import functions as F

from sellerlens.functions.columns import year_month
from sellerlens.operators import descriptive as D
from sellerlens.operators import marts as G
from sellerlens.sources import adapter


def test_one_sale_seller_rfm(spark):
    o = make_orders(spark, [(1, "DELIVERED", "2018-01-10 10:00:00")])
    i = make_items(spark, [(1, 1, 100, 7, 10.0)])
    r = G.sellers_rfm(i, o).first()
    assert r["recency"] == 0 and r["frequency"] == 1
    assert r["frequency_recency"] == 0.0  # x/0 -> null -> 0 (D1)
    assert r["monetary_frequency"] == 10.0


def test_selling_days_lag(spark):
    o = make_orders(spark, [(1, "DELIVERED", "2018-01-10 10:00:00"), (2, "DELIVERED", "2018-01-13 09:00:00")])
    i = make_items(spark, [(1, 1, 100, 7, 10.0), (2, 2, 100, 7, 4.0)])
    rows = G.sellers_price_selling_days(i, o).orderBy("date_selled").collect()
    assert rows[0]["lag_date"] is None
    assert rows[1]["diff_selling_days"] == 3 and rows[1]["monetary"] == 8.0 and rows[1]["diff_monetary"] == -2.0


def test_daily_grid_zero_fill(spark):
    o = make_orders(spark, [(1, "DELIVERED", "2018-01-10 10:00:00"), (2, "DELIVERED", "2018-01-12 09:00:00")])
    i = make_items(spark, [(1, 1, 100, 7, 10.0), (2, 1, 100, 8, 4.0)])
    g = {(r["seller_id"], str(r["date"])): r["monetary"] for r in G.sellers_intermittent_daily(i, o).collect()}
    assert g == {(7, "2018-01-10"): 10.0, (7, "2018-01-12"): 0.0, (8, "2018-01-10"): 0.0, (8, "2018-01-12"): 4.0}


def test_status_case_and_cohort_index(spark):
    # seller active in Jan and Mar: index 1 -> 1, index 3 -> 1, index 2 absent
    o = make_orders(spark, [
        (1, "DELIVERED", "2018-01-05 00:00:00", "2018-01-05 00:00:00", "2018-01-09 00:00:00"),
        (2, "DELIVERED", "2018-03-05 00:00:00", "2018-03-05 00:00:00", "2018-03-09 00:00:00")])
    i = make_items(spark, [(1, 1, 100, 7, 10.0), (2, 1, 100, 7, 10.0)])
    c = {r["cohort_index"]: r["seller_id"] for r in D.cohort(o, i, d("2018-01-01"), d("2018-12-01")).collect()}
    assert c == {1: 1, 3: 1}


def test_monthly_ltv_idle_month_zero_and_carry(spark):
    rows = []
    for oid, day in [(1, "2018-01-05"), (2, "2018-03-05"), (3, "2018-02-05")]:
        rows.append((oid, "DELIVERED", f"{day} 00:00:00", f"{day} 00:00:00", f"{day} 12:00:00"))
    o = make_orders(spark, rows)
    # seller 7: 100 in Jan, none in Feb, 50 in Mar; seller 8 makes Feb exist
    i = make_items(spark, [(1, 1, 100, 7, 100.0), (2, 1, 100, 7, 50.0), (3, 1, 100, 8, 1.0)])
    z = D.monthly_ltv(o, i, d("2018-01-01"), d("2018-12-01"), fill="zero").where("seller_id = 7")
    c = D.monthly_ltv(o, i, d("2018-01-01"), d("2018-12-01"), fill="carry").where("seller_id = 7")
    assert [r[0] for r in z.orderBy("order_month_purchase").select("forecast_ltv").collect()] == [100, 0, 150]
    assert [r[0] for r in c.orderBy("order_month_purchase").select("forecast_ltv").collect()] == [100, 100, 150]


def test_pareto_ties(spark):
    # LTV 10, 5, 5, 1 -> .25, .75, .75, 1.0 (both the top-k and the global path)
    o = make_orders(spark, [(k, "DELIVERED", "2018-01-05 00:00:00") for k in range(1, 5)])
    i = make_items(spark, [(1, 1, 1, 1, 10.0), (2, 1, 1, 2, 5.0), (3, 1, 1, 3, 5.0), (4, 1, 1, 4, 1.0)])
    for top in (25, None):
        r = {x["seller_id"]: x["pareto_rank"] for x in
             D.seller_pareto(o, i, d("2018-01-01"), d("2018-02-01"), top=top).collect()}
        assert r == {1: 0.25, 2: 0.75, 3: 0.75, 4: 1.0}


def test_year_month_and_month_clamp(spark):
    df = spark.createDataFrame([(d("2018-01-15"), d("2018-08-31"))], "a date, b date")
    r = df.select(year_month("a").alias("ym"), F.add_months("b", -6).alias("m")).first()
    assert r["ym"] == "2018-01" and str(r["m"]) == "2018-02-28"


def test_daily_runs_expand_to_the_dense_grid(spark):
    """On the given tables, and on sellers without a sale, with sales at both ends, in a row and of value 0."""
    o = make_orders(spark, [(k, "DELIVERED", f"2000-01-{day:02d} 10:00:00") for k, day in enumerate([1, 2, 3, 5, 6, 9, 12, 13], 1)]
                    + [(50, "CREATED", None)])
    i = make_items(spark, [(1, 1, 1, 7, 5.0), (2, 1, 1, 7, 5.0), (8, 1, 1, 7, 2.0), (4, 1, 1, 8, 0.0), (4, 2, 1, 9, 3.0), (4, 1, 2, 9, 1.0),
                           (6, 1, 1, 9, 4.0), (50, 1, 1, 10, 9.0), (99, 1, 1, 11, 9.0)])
    cases = [(o, i), adapter.load(spark, "/root/testdata/sf0.001", "suppkey")]
    for orders, items in cases:
        runs = G.sellers_daily_runs(items, orders)
        dense = G.sellers_intermittent_daily(items, orders)
        got, want = (sorted((tuple(r) for r in d.select("seller_id", "date", "monetary", "diff_monetary").collect()), key=lambda t: t[:2])
                     for d in (G.expand_daily_runs(runs, orders), dense))
        assert len(got) == len(want)
        for a, b in zip(got, want):
            assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-6
            assert (a[3] is None) == (b[3] is None) and (a[3] is None or abs(a[3] - b[3]) < 1e-6)
    small = G.sellers_daily_runs(i, o)
    assert small.where("seller_id = 10").count() == 2  # no dated sale: the first day and the rest
    assert small.where("seller_id = 7").count() == 5  # three sales, the day after the second, the quiet days


def test_daily_runs_are_not_filtered_by_an_interpreted_lambda(spark):
    o = make_orders(spark, [(1, "DELIVERED", "2018-01-10 10:00:00"), (2, "DELIVERED", "2018-01-13 09:00:00")])
    i = make_items(spark, [(1, 1, 100, 7, 10.0), (2, 2, 100, 7, 4.0)])
    runs = G.sellers_daily_runs(i, o)
    assert "lambdafunction" not in runs._jdf.queryExecution().optimizedPlan().toString()
    got = [(r.seller_id, str(r.date_from), str(r.date_to), r.n_days, r.monetary, r.diff_monetary) for r in runs.orderBy("date_from").collect()]
    assert got == [(7, "2018-01-10", "2018-01-10", 1, 10.0, None), (7, "2018-01-13", "2018-01-13", 1, 8.0, -2.0)]
