import datetime as dt
import itertools
import math
import random

import pandas as pd
from conftest import d
from pyspark.sql import functions as F

from sellerlens.operators import decision as X
from sellerlens.operators import evaluate as EV
from sellerlens.operators import stats as ST
from sellerlens.operators.prefix import cumulative_sums


def test_bowley_and_compat(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "x double")
    assert abs(ST.bowley(df, ["x"]).first()["bowley"] - 1 / 3) < 1e-12
    assert abs(ST.bowley(df, ["x"], compat=True).first()["bowley"] - 2.0) < 1e-12


def test_skew_kurtosis_matches_pandas(spark):
    xs = [1.0, 2.0, 2.5, 4.0, 7.5, 9.0, 9.5, 20.0]
    r = ST.skew_kurtosis(spark.createDataFrame([(x,) for x in xs], "x double"), ["x"]).first()
    s = pd.Series(xs)
    assert abs(r["skew"] - s.skew()) < 1e-9 and abs(r["kurtosis"] - s.kurt()) < 1e-9


def test_describe_quartiles_match_pandas(spark):
    xs = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0]
    r = ST.describe(spark.createDataFrame([(x,) for x in xs], "x double"), ["x"]).first()
    s = pd.Series(xs)
    assert abs(r["q25"] - s.quantile(.25)) < 1e-12 and abs(r["std"] - s.std()) < 1e-12


def test_truncated_interval_flag(spark):
    df = spark.createDataFrame([(7.9, 1, 0), (8.0, 1, 1)], "avg_seller_interval double, days_from_first_sell int, churn int")
    rows = ST.flag_rate_by_class(df).where("flag = 'interval_one_week'").collect()
    assert {(r["churn"], r["value"]) for r in rows} == {(0, 0), (1, 1)}


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(0.5, 0), (0.5, 1), (0.9, 1)], "churn_proba double, churn int")
    assert abs(EV.auc(df).first()["auc"] - 0.75) < 1e-12


def _brute_auc(p, y):
    pos = [a for a, b in zip(p, y) if b == 1]
    neg = [a for a, b in zip(p, y) if b == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def test_auc_lift_thresholds_brute_force(spark):
    rnd = random.Random(7)
    rows = [(d("2000-01-01"), k, round(rnd.random(), 1), int(rnd.random() < 0.4)) for k in range(300)]
    df = spark.createDataFrame(rows, "_mt_date_reference date, seller_id long, churn_proba double, churn int")
    p, y = [r[2] for r in rows], [r[3] for r in rows]
    assert abs(EV.auc(df).first()[0] - _brute_auc(p, y)) < 1e-12
    # lift/gain: order by (proba desc, ref, seller)
    srt = sorted(rows, key=lambda r: (-r[2], r[0], r[1]))
    ones, n = sum(y), len(y)
    got = {round(r["fraction"], 6): (r["n_rows"], r["gain"]) for r in EV.lift_gain(df).collect()}
    for i in range(1, 11):
        x = 0.1 * i
        k = math.ceil(x * n)
        here = sum(r[3] for r in srt[:k])
        assert got[round(x, 6)][0] == k and abs(got[round(x, 6)][1] - here / ones) < 1e-12
    # thresholds: p >= t with numpy's float grid
    tm = {round(r["p"], 6): r for r in EV.threshold_metrics(df).collect()}
    for k in range(21):
        t = k * 0.05
        tp = sum(1 for a, b in zip(p, y) if a >= t and b == 1)
        fp = sum(1 for a, b in zip(p, y) if a >= t and b == 0)
        prec = tp / (tp + fp) if tp + fp else 0.0
        assert abs(tm[round(t, 6)]["precision"] - prec) < 1e-12


def test_prefix_sums_match_cumsum(spark):
    rnd = random.Random(3)
    vals = sorted({rnd.randint(0, 10_000) for _ in range(2000)})
    df = spark.createDataFrame([(float(v), 1 + v % 7) for v in vals], "v double, w long")
    got = {r["v"]: r["cum_w"] for r in cumulative_sums(df, "v", ["w"], n_buckets=16).collect()}
    run = 0
    for v in vals:
        run += 1 + v % 7
        assert got[float(v)] == run
    desc = {r["v"]: r["cum_w"] for r in cumulative_sums(df, "v", ["w"], descending=True, inclusive=False, n_buckets=16).collect()}
    total = sum(1 + v % 7 for v in vals)
    assert desc[float(vals[0])] == total - (1 + vals[0] % 7) and desc[float(vals[-1])] == 0


def test_gift_tier_edges(spark):
    df = spark.createDataFrame([(p,) for p in (0.95, 0.9499, 0.85, 0.75, 0.7499)], "churn_proba double")
    assert [r["gift"] for r in X.gift_tier(df).collect()] == [10000, 400, 400, 100, 50]


def test_knapsack_fixture(spark):
    df = spark.createDataFrame([(1, 50.0, 10.0, 0.9), (2, 50.0, 9.0, 0.8), (3, 100.0, 18.0, 0.7)],
                               "seller_id long, gift double, ltv double, churn_proba double")
    got = X.budget_optimal(df, 100, [50, 100])
    assert sorted(r["seller_id"] for r in got.collect()) == [1, 2]


def _dp(budget, items):
    best = (0.0, ())
    for k in range(len(items) + 1):
        for comb in itertools.combinations(range(len(items)), k):
            cost = sum(items[i][0] for i in comb)
            if cost <= budget:
                val = sum(items[i][1] for i in comb)
                if val > best[0] + 1e-9:
                    best = (val, comb)
    return best[0]


def test_knapsack_equals_brute_force_and_beats_greedy(spark):
    rnd = random.Random(11)
    for trial in range(3):
        items = [(rnd.choice([50.0, 100.0, 400.0]), round(rnd.uniform(1, 100), 2)) for _ in range(14)]
        df = spark.createDataFrame([(k, w, v, rnd.random()) for k, (w, v) in enumerate(items)],
                                   "seller_id long, gift double, ltv double, churn_proba double")
        budget = 600.0
        opt = X.budget_optimal(df, budget, [50, 100, 400]).agg(F.sum("ltv"), F.sum("gift")).first()
        assert abs(opt[0] - _dp(budget, items)) < 1e-6 and opt[1] <= budget
        gr = X.budget_greedy(df, budget).agg(F.sum("ltv")).first()[0] or 0.0
        assert gr <= opt[0] + 1e-9


def test_greedy_prefix(spark):
    df = spark.createDataFrame([(1, 0.9, 400.0, 1.0), (2, 0.8, 100.0, 1.0), (3, 0.7, 50.0, 1.0), (4, 0.96, 10000.0, 1.0)],
                               "seller_id long, churn_proba double, gift double, ltv double")
    assert [r["seller_id"] for r in X.budget_greedy(df, 500).orderBy(F.desc("churn_proba")).collect()] == [1, 2]


def _holt_py(ys, alphas, betas):
    if len(ys) < 2:
        return ys[-1]
    best = None
    for a in alphas:
        for b in betas:
            lv, tr, sse = ys[1], ys[1] - ys[0], 0.0
            for v in ys[2:]:
                sse += (v - lv - tr) ** 2
                nl = a * v + (1 - a) * (lv + tr)
                tr = b * (nl - lv) + (1 - b) * tr
                lv = nl
            cand = (sse, a, b, lv + tr)
            best = cand if best is None or cand < best else best
    return best[3]


def test_holt_matches_python_recurrence(spark):
    rnd = random.Random(5)
    series = {k: [round(rnd.uniform(0, 100) + 5 * t, 2) for t in range(rnd.randint(1, 12))] for k in range(20)}
    rows = [(k, d(f"2000-{t + 1:02d}-01"), y) for k, ys in series.items() for t, y in enumerate(ys)]
    df = spark.createDataFrame(rows, "seller_id long, order_month_purchase date, forecast_ltv double")
    got = {r["seller_id"]: r["forecast_ltv"] for r in X.holt_forecast(df, floor=None).collect()}
    for k, ys in series.items():
        assert abs(got[k] - _holt_py(ys, X.HOLT_ALPHAS, X.HOLT_BETAS)) < 1e-6


def _holt_sse(ys, a, b):
    lv, tr, sse = ys[1], ys[1] - ys[0], 0.0
    for v in ys[2:]:
        sse += (v - lv - tr) ** 2
        lv, tr, last = a * v + (1 - a) * (lv + tr), tr, lv
        tr = b * (lv - last) + (1 - b) * tr
    return sse, lv + tr


def test_fitted_holt_is_never_worse_than_the_grid(spark):
    """Against the same pattern search in plain Python, and against the grid's error."""
    rnd = random.Random(11)
    series = {k: [round(rnd.uniform(0, 100) + 5 * t * rnd.random(), 2) for t in range(rnd.randint(1, 12))] for k in range(25)}
    rows = [(k, d(f"2000-{t + 1:02d}-01"), y) for k, ys in series.items() for t, y in enumerate(ys)]
    df = spark.createDataFrame(rows, "seller_id long, order_month_purchase date, forecast_ltv double")
    got = {r["seller_id"]: r for r in X.holt_forecast(df, floor=None, refine=10).collect()}
    better = 0
    for k, ys in series.items():
        if len(ys) < 2:
            assert got[k]["alpha"] is None and got[k]["forecast_ltv"] == ys[-1]
            continue
        grid = min((_holt_sse(ys, a, b)[0], a, b) for a in X.HOLT_ALPHAS for b in X.HOLT_BETAS)
        best = grid
        for step in X.holt_steps(10):
            around = [(max(0.0, min(1.0, best[1] + i * step)), max(0.0, min(1.0, best[2] + j * step))) for i in (-1, 0, 1) for j in (-1, 0, 1)]
            best = min((_holt_sse(ys, a, b)[0], a, b) for a, b in around)
        sse, forecast = _holt_sse(ys, got[k]["alpha"], got[k]["beta"])
        assert sse <= grid[0] + 1e-9 and abs(sse - best[0]) < 1e-6 * (1 + sse) and abs(forecast - got[k]["forecast_ltv"]) < 1e-6
        better += sse < grid[0] - 1e-6
    assert better > 10


def test_greedy_takes_the_row_bound_from_the_tier_table(spark):
    """Tiers below the default gift: more rows fit than the default's size would allow."""
    rows = [(k, 0.9 - k / 100, 10.0, 1.0) for k in range(20)]
    df = spark.createDataFrame(rows, "seller_id long, churn_proba double, gift double, ltv double")
    assert X.budget_greedy(df, 150, tiers=((0.5, 10.0),)).count() == 15


def test_t_pvalue(spark):
    known = [(2.0, 10.0, 0.07338803477), (-2.0, 10.0, 0.07338803477), (0.5, 1.0, 0.70483276469), (0.0, 5.0, 1.0),
             (12.7062047364, 1.0, 0.05), (1.9623390808, 1000.0, 0.05), (3.290526731, 1e9, 0.001), (40.0, 30.0, 0.0)]
    df = spark.createDataFrame(known, "t double, dof double, want double")
    for r in ST.t_two_sided(df).collect():
        assert abs(r.p_value - r.want) < 1e-8, r


def test_mllib_auc_numbins0_is_exact_with_ties(spark):
    from pyspark.ml.linalg import Vectors

    from sellerlens.operators.model import _evaluator_auc
    rnd = random.Random(9)
    rows = [(round(rnd.random(), 1), int(rnd.random() < 0.4)) for _ in range(400)]
    df = spark.createDataFrame([(Vectors.dense([1 - p, p]), y) for p, y in rows], ["probability", "churn"])
    assert abs(_evaluator_auc(df, "churn") - _brute_auc([r[0] for r in rows], [r[1] for r in rows])) < 1e-12


def test_ordered_cumulative_sums_composite_string_keys(spark):
    from sellerlens.operators.prefix import ordered_cumulative_sums
    rnd = random.Random(13)
    # a hot leading value (half the rows share g='a'), string tie keys
    rows = [("a" if k % 2 else rnd.choice("bcd"), f"s{k:05d}", rnd.randint(0, 3)) for k in range(3000)]
    df = spark.createDataFrame(rows, "g string, key string, w long")
    got = {(r["g"], r["key"]): r["cum_w"] for r in ordered_cumulative_sums(df, ["g", "key"], ["w"], 16).collect()}
    run = 0
    for g, key, w in sorted(rows):
        run += w
        assert got[(g, key)] == run


def test_running_totals_over_many_ranges_are_exact(spark):
    from sellerlens.operators.prefix import ordered_cumulative_sums
    n = 3_000_000
    df = spark.range(n, numPartitions=8).selectExpr("xxhash64(id) AS k", "id", "1L AS w", "CAST(id % 17 AS STRING) AS extra")
    out = ordered_cumulative_sums(df, ["k", "id"], ["w"], 32)
    assert out.columns == ["k", "id", "w", "extra", "cum_w"]
    r = out.selectExpr("count(DISTINCT cum_w) AS d", "max(cum_w) AS hi", "min(cum_w) AS lo", "count(extra) AS n").first()
    assert (r.d, r.hi, r.lo, r.n) == (n, n, 1, n)


def test_holt_takes_blocks_of_series_in_the_plan_and_short_null_and_nan_series(spark):
    rows = [(k, dt.date(2000, m + 1, 1), float((k * 7 + m * m) % 11)) for k in range(1, 40) for m in range(1 + k % 9)]
    rows += [(100, dt.date(2000, m, 1), y) for m, y in ((1, 1.0), (2, None), (3, 4.0))]
    rows += [(101, dt.date(2000, m, 1), y) for m, y in ((1, 1.0), (2, float("nan")), (3, 4.0))]
    rows += [(102, dt.date(2000, 1, 1), None), (None, dt.date(2000, 1, 1), 2.0), (None, dt.date(2000, 2, 1), 3.0)]
    df = spark.createDataFrame(rows, "seller_id long, order_month_purchase date, forecast_ltv double")
    out = X.holt_forecast(df, floor=None)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "aggregate(" not in plan.split("MapInArrow")[0]  # no interpreted fold per candidate
    got = {r.seller_id: r for r in out.collect()}
    series = {}
    for k, _, y in rows:
        series.setdefault(k, []).append(y)
    assert set(got) == set(series)
    for k in [*range(1, 40), None]:
        ys = series[k]
        if len(ys) < 2:
            assert (got[k].alpha, got[k].beta, got[k].forecast_ltv) == (None, None, ys[-1])
            continue
        best = min((_holt_sse(ys, a, b)[0], a, b) for a in X.HOLT_ALPHAS for b in X.HOLT_BETAS)
        assert got[k][3:] == best[1:]
        assert got[k].forecast_ltv == _holt_sse(ys, *best[1:])[1]
    assert got[100][2:] == (4.0, 0.1, 0.05) and got[102][2:] == (None, None, None)
    assert got[101].forecast_ltv != got[101].forecast_ltv and got[101][3:] == (0.1, 0.05)
