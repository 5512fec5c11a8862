"""Named queries (S6): ``run(name, spark, sf_dir, params)`` -> DataFrame.

Every entry reads the driver tables through the adapter, so its work grows
with the data. Queries are grouped by module; ``QUERIES`` is the union.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import Params
from ..session import cut_lineage
from ..operators import abt as A
from ..operators import descriptive as D
from ..operators import features as FS
from ..operators import marts as G
from ..sources import adapter

Query = Callable[[SparkSession, str, Params], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def run(name: str, spark: SparkSession, sf_dir: str, params: Params | None = None) -> DataFrame:
    if name not in QUERIES:
        raise KeyError(f"unknown query {name!r}; known: {sorted(QUERIES)}")
    return QUERIES[name](spark, sf_dir, params or Params())


def _oi(spark, sf, seller="partkey"):
    return adapter.load(spark, sf, seller)


# ---------------------------------------------------------------- marts
@register("sellers_rfm")
def _rfm(spark, sf, p):
    o, i = _oi(spark, sf)
    return G.sellers_rfm(i, o)


@register("sellers_price_selling_days")
def _psd(spark, sf, p):
    o, i = _oi(spark, sf)
    return G.sellers_price_selling_days(i, o)


@register("sellers_intermittent_daily")
def _daily(spark, sf, p):
    o, i = _oi(spark, sf, "suppkey")
    return G.sellers_intermittent_daily(i, o)


@register("sellers_daily_runs")
def _daily_runs(spark, sf, p):
    """G3 on the common seller key, in runs."""
    o, i = _oi(spark, sf)
    return G.sellers_daily_runs(i, o)


# ---------------------------------------------------------- descriptive
@register("cohort")
def _cohort(spark, sf, p):
    o, i = _oi(spark, sf)
    return D.cohort(o, i, p.window_start, p.cohort_end)


@register("cohort_retention")
def _cohort_ret(spark, sf, p):
    o, i = _oi(spark, sf)
    return D.cohort_retention(D.cohort(o, i, p.window_start, p.cohort_end))


@register("cohort_pivot")
def _cohort_piv(spark, sf, p):
    o, i = _oi(spark, sf)
    return D.cohort_pivot(D.cohort(o, i, p.window_start, p.cohort_end),
                          D.months_in_window(p.window_start, p.cohort_end))


@register("suspicious_orders")
def _susp(spark, sf, p):
    o, i = _oi(spark, sf)
    return D.suspicious_orders(o, i, p.window_start, p.window_end)


@register("suspicious_customers")
def _susp_c(spark, sf, p):
    return D.suspicious_customers(adapter.load_orders(spark, sf), p.window_start, p.window_end)


@register("stuck_processing")
def _stuck(spark, sf, p):
    return D.stuck_processing(adapter.load_orders(spark, sf), p.window_start, p.window_end, p.stuck_date)


@register("lookup")
def _lookup(spark, sf, p):
    return D.lookup(adapter.load_items(spark, sf), "order_id", p.lookup_order_id)


@register("lookup_seller")
def _lookup_s(spark, sf, p):
    return D.lookup(adapter.load_items(spark, sf), "seller_id", p.lookup_seller_id)


@register("monthly_ltv")
def _mltv(spark, sf, p):
    o, i = _oi(spark, sf)
    return D.monthly_ltv(o, i, p.window_start, p.window_end)


@register("min_max_orders")
def _minmax(spark, sf, p):
    return D.min_max_orders(adapter.load_orders(spark, sf))


@register("product_sales")
def _psales(spark, sf, p):
    o, i = _oi(spark, sf)
    return D.product_sales(o, i, p.lookup_product_id)


@register("orders_time_series")
def _ots(spark, sf, p):
    return D.orders_time_series(adapter.load_orders(spark, sf))


@register("product_price_variation")
def _ppv(spark, sf, p):
    return D.product_price_variation(adapter.load_items(spark, sf))


@register("seller_pareto")
def _pareto(spark, sf, p):
    o, i = _oi(spark, sf)
    return D.seller_pareto(o, i, p.window_start, p.window_end, top=25)


@register("seller_pareto_all")
def _pareto_all(spark, sf, p):
    o, i = _oi(spark, sf)
    return D.seller_pareto(o, i, p.window_start, p.window_end, top=None)


@register("order_status_counts")
def _osc(spark, sf, p):
    return D.order_status_counts(adapter.load_orders(spark, sf), p.window_start, p.window_end)


@register("unique_products")
def _up(spark, sf, p):
    return D.unique_products(adapter.load_items(spark, sf))


# ------------------------------------------------------ feature stores
@register("fs_filter_sellers")
def _ffs(spark, sf, p):
    o, i = _oi(spark, sf)
    return FS.fs_filter_sellers(o, i, p.refs, p.lookback_months)


@register("fs_seller_descriptions")
def _fsd(spark, sf, p):
    o, i = _oi(spark, sf)
    base = FS.seller_orders_base(FS._window_filter(o, p.refs, p.lookback_months), i, p.item_scope)
    d = FS.seller_descriptions(base, p.refs, p.lookback_months).drop("avg_seller_interval")
    u = FS.seller_unique_products(o, i, p.refs, p.lookback_months, p.item_scope)
    return d.join(u, [FS.REF, "seller_id"], "left")


@register("fs_seller_life")
def _fsl(spark, sf, p):
    o, i = _oi(spark, sf)
    return FS.seller_life(o, i, p.refs)


@register("fs_seller_interval")
def _fsi(spark, sf, p):
    o, i = _oi(spark, sf)
    return FS.fs_seller_interval(o, i, p.refs, p.lookback_months)


@register("fs_seller_purchases")
def _fsp(spark, sf, p):
    o, i = _oi(spark, sf)
    return FS.fs_seller_purchases(o, i, p.refs, p.lookback_months, p.item_scope)


@register("fs_order_totals")
def _fot(spark, sf, p):
    o, i = _oi(spark, sf)
    return FS.fs_order_totals(o, i, p.refs, p.lookback_months, p.item_scope)


@register("fs_seller_orders")
def _fso(spark, sf, p):
    o, i = _oi(spark, sf)
    return FS.fs_seller_orders(o, i, p.refs, p.lookback_months, p.item_scope)


@register("fs_seller_purchases_order_scope")
def _fsp_order(spark, sf, p):
    """The wider item scope: every item of a seller's orders counts for the seller."""
    o, i = _oi(spark, sf)
    return FS.fs_seller_purchases(o, i, p.refs, p.lookback_months, "order")


@register("fs_order_totals_order_scope")
def _fot_order(spark, sf, p):
    o, i = _oi(spark, sf)
    return FS.fs_order_totals(o, i, p.refs, p.lookback_months, "order")


@register("fs_seller_orders_order_scope")
def _fso_order(spark, sf, p):
    o, i = _oi(spark, sf)
    return FS.fs_seller_orders(o, i, p.refs, p.lookback_months, "order")


@register("abt_seller_churn_order_scope")
def _abt_order(spark, sf, p):
    o, i = _oi(spark, sf)
    return A.abt_seller_churn(o, i, p.refs, p.lookback_months, p.churn_days, "order")


@register("abt_features")
def _abtf(spark, sf, p):
    o, i = _oi(spark, sf)
    return A.abt_features(FS.fs_seller_purchases(o, i, p.refs, p.lookback_months, p.item_scope),
                          FS.fs_seller_orders(o, i, p.refs, p.lookback_months, p.item_scope),
                          p.churn_days)


@register("abt_label")
def _abtl(spark, sf, p):
    o, i = _oi(spark, sf)
    feats = FS.fs_seller_purchases(o, i, p.refs, p.lookback_months, p.item_scope)
    feats = feats.where(feats["recency"] <= p.churn_days)
    return A.label(feats, o, i, p.refs, p.churn_days)


@register("abt_seller_churn")
def _abt_built(spark, sf, p):
    o, i = _oi(spark, sf)
    return A.abt_seller_churn(o, i, p.refs, p.lookback_months, p.churn_days, p.item_scope)


# ------------------------------------------------- quality and table layer
from pyspark.sql import functions as F  # noqa: E402

from ..operators import quality as Q  # noqa: E402
from ..params import RUN_TS, RUN_TS_PREV  # noqa: E402
from ..sources import landing as L  # noqa: E402
from ..sources import tables as K  # noqa: E402
from . import medallion as M  # noqa: E402


@register("bronze_stamp")
def _bronze(spark, sf, p):
    return Q.bronze_batch(adapter.landing_orders(spark, sf), "postgres_public_orders", RUN_TS)


@register("silver_orders")
def _silver_o(spark, sf, p):
    b = Q.bronze_batch(adapter.landing_orders(spark, sf), "postgres_public_orders", RUN_TS)
    return Q.stamp_silver(Q.silver_orders(b), RUN_TS.date(), "overwrite")


@register("silver_items")
def _silver_i(spark, sf, p):
    b = Q.bronze_batch(adapter.landing_items(spark, sf), "postgres_public_order_items", RUN_TS)
    return Q.stamp_silver(Q.silver_items(b), RUN_TS.date(), "overwrite")


def _two_day_bronze(spark, sf):
    store = M.scratch_store(spark, "bronze")
    landing = {"postgres_public_orders": adapter.landing_orders(spark, sf)}
    M.run_bronze(store, landing, RUN_TS_PREV)
    M.run_bronze(store, landing, RUN_TS)
    M.run_bronze(store, landing, RUN_TS)  # same-day rerun: idempotent
    return store


@register("landing_to_bronze")
def _landing_to_bronze(spark, sf, p):
    """S8 -> S2/S1 -> Q5 -> K8/K4: snapshots of two days go through the daily job; a run taken up
    again on the second day loads nothing twice, and a table without a folder is skipped."""
    store = M.scratch_store(spark, "landing")
    root = f"{store.root}/landing"
    sources = {"postgres_public_orders": adapter.landing_orders, "postgres_public_order_items": adapter.landing_items}
    for name, load in sources.items():
        L.snapshot(Q.fix_void_columns(load(spark, sf)), L.landing_path(root, name), RUN_TS_PREV)
    wanted = [*sources, "postgres_public_absent"]
    M.run_bronze_from_landing(store, root, wanted, RUN_TS_PREV)
    M.run_bronze_from_landing(store, root, wanted[1:], RUN_TS)
    M.run_bronze_from_landing(store, root, wanted, RUN_TS, reload=False)
    both = None
    for name in sources:
        t = (store.read("bronze", name).groupBy(F.col(M.BRONZE_PART).cast("string").alias("partition_date"))
             .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("order_id").alias("n_orders"))
             .withColumn("table_name", F.lit(name)))
        both = t if both is None else both.unionByName(t)
    loads = store.load_log().groupBy("table_name").agg(F.count(F.lit(1)).alias("n_loads"))
    return both.join(loads, "table_name")


@register("latest_snapshot")
def _latest(spark, sf, p):
    store = _two_day_bronze(spark, sf)
    return K.latest_snapshot(store.read("bronze", "postgres_public_orders"), M.BRONZE_PART)


@register("reload_partition")
def _reload(spark, sf, p):
    store = _two_day_bronze(spark, sf)
    return (store.read("bronze", "postgres_public_orders")
            .groupBy(M.BRONZE_PART).agg(F.count(F.lit(1)).alias("n_rows")))


@register("load_log")
def _load_log(spark, sf, p):
    store = M.scratch_store(spark, "log")
    M.run_bronze(store, {"postgres_public_orders": adapter.landing_orders(spark, sf),
                         "postgres_public_order_items": adapter.landing_items(spark, sf)}, RUN_TS)
    return store.load_log().select("layer", "table_name", "written_lines")


@register("upsert")
def _upsert(spark, sf, p):
    """Delivery feed: processing orders arrive delivered on their estimate."""
    store = M.scratch_store(spark, "upsert")
    orders = adapter.load_orders(spark, sf)
    store.create(orders, "silver", "orders")
    feed = (orders.where(F.col("order_status") == "PROCESSING")
            .withColumns({"order_status": F.lit("DELIVERED"),
                          "order_delivered_customer_date": F.col("order_estimated_delivery_date")}))
    store.upsert(feed, "silver", "orders", "order_id")
    store.upsert(feed, "silver", "orders", "order_id")  # idempotent
    return store.read("silver", "orders")


def _partial_then_backfill(spark, sf, p, first_n=3):
    store = M.scratch_store(spark, "fs")
    o, i = _oi(spark, sf)
    M.run_feature_stores(store, o, i, list(p.refs[:first_n]), RUN_TS, p.lookback_months, p.item_scope)
    return store, o, i


@register("ingested_refs")
def _ingested(spark, sf, p):
    store, _, _ = _partial_then_backfill(spark, sf, p)
    return store.ingested_refs("analytics", "fs_seller_purchases")


@register("missing_refs")
def _missing(spark, sf, p):
    store, _, _ = _partial_then_backfill(spark, sf, p)
    return K.missing_refs(M.refs_frame(spark, p.refs), store.ingested_refs("analytics", "fs_seller_purchases"))


@register("fs_backfill")
def _backfill(spark, sf, p):
    store, o, i = _partial_then_backfill(spark, sf, p)
    M.run_feature_stores(store, o, i, list(p.refs), RUN_TS, p.lookback_months, p.item_scope)
    return (store.read("analytics", "fs_seller_purchases")
            .groupBy(FS.REF).agg(F.count(F.lit(1)).alias("n_sellers")))


def _abt(spark, sf, p):
    return M.stored_abt(spark, sf, p)


@register("seller_record")
def _seller_record(spark, sf, p):
    """One seller's ABT rows."""
    return _abt(spark, sf, p).where(F.col("seller_id") == F.lit(p.lookup_seller_id))


@register("gold_load")
def _gold_load(spark, sf, p):
    """G1-G3 stamped, stored and logged from the silver tables."""
    store = M.scratch_store(spark, "gold")
    o, i = _oi(spark, sf)
    store.create(i, "silver", "postgres_public_order_items")
    store.create(o, "silver", "postgres_public_orders")
    M.run_gold(store, RUN_TS)
    keys = None
    for name in M.GOLD:
        t = store.read("gold", name).select(F.lit(name).alias("table_name"), F.col("_mt_gold_update_key").alias("update_key")).distinct()
        keys = t if keys is None else keys.unionByName(t)
    log = store.load_log().where("layer = 'gold'").select("table_name", "written_lines")
    return log.join(keys, "table_name")


@register("missing_rate")
def _mrate(spark, sf, p):
    return Q.missing_rate(_abt(spark, sf, p))


IMPUTE_VALUES = {"frequency": 0.0, "avg_seller_interval": 0.0}


@register("impute")
def _impute(spark, sf, p):
    return Q.impute(_abt(spark, sf, p), IMPUTE_VALUES)


# ------------------------------------------ statistics, evaluation, decision
from ..operators import decision as X  # noqa: E402
from ..operators import evaluate as EV  # noqa: E402
from ..operators import stats as ST  # noqa: E402

ABT_NUMERIC = [c for c in A.ABT_FEATURES if c not in (FS.REF, "seller_id")] + ["churn"]


def _scored(spark, sf, p):
    return EV.score_rule(_abt(spark, sf, p))


@register("describe")
def _describe(spark, sf, p):
    return ST.describe(_abt(spark, sf, p), ABT_NUMERIC)


@register("skew_kurtosis")
def _skew(spark, sf, p):
    return ST.skew_kurtosis(_abt(spark, sf, p), ABT_NUMERIC)


@register("bowley")
def _bowley(spark, sf, p):
    return ST.bowley(_abt(spark, sf, p), ABT_NUMERIC)


@register("correlation")
def _corr(spark, sf, p):
    return ST.correlation(_abt(spark, sf, p), ABT_NUMERIC)


@register("point_biserial")
def _pb(spark, sf, p):
    return ST.point_biserial(_abt(spark, sf, p), "churn", ABT_NUMERIC[:-1])


@register("point_biserial_test")
def _pbt(spark, sf, p):
    return ST.point_biserial_test(_abt(spark, sf, p), "churn", ABT_NUMERIC[:-1])


@register("histogram_by_class")
def _hist(spark, sf, p):
    return ST.histogram_by_class(_abt(spark, sf, p), "recency", "churn", bins=10)


@register("histograms")
def _hists(spark, sf, p):
    """T6 of every ABT feature, overall and per class, raw and log(1 + x)."""
    return ST.histograms(_abt(spark, sf, p), ABT_NUMERIC[:-1])


# The outlier caps of the charts.
HISTOGRAM_CAPS = {"frequency": 1, "quantity_delay_orders": 10, "quantity_products_selled": 35, "quantity_unique_product_selled": 50}


@register("histograms_capped")
def _hists_capped(spark, sf, p):
    """T6 + P15: the four capped features."""
    return ST.histograms(_abt(spark, sf, p), list(HISTOGRAM_CAPS), caps=HISTOGRAM_CAPS)


@register("recency_ecdf")
def _ecdf(spark, sf, p):
    return ST.recency_ecdf(_abt(spark, sf, p))


@register("flag_rate_by_class")
def _flags(spark, sf, p):
    return ST.flag_rate_by_class(_abt(spark, sf, p))


@register("class_balance")
def _balance(spark, sf, p):
    return ST.class_balance(_abt(spark, sf, p), "churn", [FS.REF])


@register("shape")
def _shape(spark, sf, p):
    return ST.shape(_abt(spark, sf, p))


@register("seller_history")
def _hist_seller(spark, sf, p):
    o, i = _oi(spark, sf)
    m = D.monthly_ltv(o, i, p.window_start, p.window_end)
    return m.where(m["seller_id"] == p.lookup_seller_id)


@register("time_split")
def _tsplit(spark, sf, p):
    return ST.time_split(_abt(spark, sf, p), p.oot_month, p.score_month)


@register("target_rate")
def _trate(spark, sf, p):
    return ST.target_rate(ST.time_split(_abt(spark, sf, p), p.oot_month, p.score_month))


@register("argmax_history")
def _argmax(spark, sf, p):
    return ST.argmax_history(_abt(spark, sf, p), "ltv")


@register("manual_sigmoid")
def _sig(spark, sf, p):
    return _scored(spark, sf, p).select(FS.REF, "seller_id", "churn", "churn_proba")


@register("score_by_ref")
def _sbr(spark, sf, p):
    return ST.score_by_ref(_scored(spark, sf, p))


@register("auc")
def _auc(spark, sf, p):
    return EV.auc(_scored(spark, sf, p))


@register("threshold_metrics")
def _thr(spark, sf, p):
    return EV.threshold_metrics(_scored(spark, sf, p))


@register("confusion_matrix")
def _cm(spark, sf, p):
    return EV.confusion_matrix(_scored(spark, sf, p), 0.4)


@register("lift_gain")
def _lift(spark, sf, p):
    return EV.lift_gain(_scored(spark, sf, p))


@register("top_churn")
def _top(spark, sf, p):
    s = _scored(spark, sf, p)
    s = s.where(s[FS.REF] == F.lit(p.score_month))
    return EV.top_k(s, 100).select("seller_id", "churn_proba", "ltv")


def _inputs(spark, sf, p, floor=True):
    """Scored sellers of the scoring month with their forecast LTV, materialised once in
    the shared checkpoint dir: greedy, optimal and the summary all read it."""
    o, i = _oi(spark, sf)
    scored = _scored(spark, sf, p).where(F.col(FS.REF) == F.lit(p.score_month))
    series = D.monthly_ltv(o, i, p.window_start, p.window_end).join(scored.select("seller_id"), "seller_id", "left_semi")
    forecast = X.holt_forecast(series)
    d = cut_lineage(X.decision_inputs(scored, p.score_month, forecast))
    return d.where(F.col("churn_proba") >= p.proba_floor) if floor else d


@register("gift_tier")
def _gift(spark, sf, p):
    return _inputs(spark, sf, p, floor=False)


@register("budget_greedy")
def _greedy(spark, sf, p):
    return X.budget_greedy(_inputs(spark, sf, p), p.budget)


@register("budget_optimal")
def _optimal(spark, sf, p):
    ws = [g for _, g in X.GIFT_TIERS] + [X.GIFT_DEFAULT]
    return X.budget_optimal(_inputs(spark, sf, p), p.budget, ws)


@register("roi_summary")
def _roi(spark, sf, p):
    scored = _inputs(spark, sf, p, floor=False)
    cands = scored.where(F.col("churn_proba") >= p.proba_floor)
    ws = [g for _, g in X.GIFT_TIERS] + [X.GIFT_DEFAULT]
    return X.roi_summary(scored, X.budget_greedy(cands, p.budget), X.budget_optimal(cands, p.budget, ws), p.proba_floor)


@register("score_decision")
def _score_decision(spark, sf, p):
    """The whole chain: fitted model -> scores -> forecast LTV -> gifts -> exact selection."""
    o, i = _oi(spark, sf)
    forecast = X.holt_forecast(_scoring_sellers(spark, sf, p, D.monthly_ltv(o, i, p.window_start, p.window_end)))
    scored = cut_lineage(X.decision_inputs(_score(spark, sf, p), p.score_month, forecast))
    ws = [g for _, g in X.GIFT_TIERS] + [X.GIFT_DEFAULT]
    return X.budget_optimal(scored.where(F.col("churn_proba") >= p.proba_floor), p.budget, ws)


@register("monthly_profit")
def _mprofit(spark, sf, p):
    o, i = _oi(spark, sf)
    return X.monthly_profit(D.monthly_ltv(o, i, p.window_start, p.window_end))


@register("holt_forecast")
def _holt(spark, sf, p):
    o, i = _oi(spark, sf)
    return X.holt_forecast(D.monthly_ltv(o, i, p.window_start, p.window_end))


@register("holt_fitted")
def _holt_fitted(spark, sf, p):
    """X1 with (alpha, beta) fitted per seller instead of the grid's best."""
    o, i = _oi(spark, sf)
    return X.holt_forecast(D.monthly_ltv(o, i, p.window_start, p.window_end), refine=10)


# ------------------------------------------------------------------ models
from ..operators import model as MD  # noqa: E402
from ..operators import subsets as SB  # noqa: E402

GRID_C = (0.001, 0.01, 0.1, 1, 10, 100, 1000)
FINAL_C = 0.1


def _train_oot_score(spark, sf, p):
    # fits read their rows many times: the split ABT is written once
    t = cut_lineage(ST.time_split(_abt(spark, sf, p), p.oot_month, p.score_month))
    return t.where("split = 'train'"), t.where("split = 'oot'"), t.where("split = 'score'")


def _final_model(train, n):
    return MD.build_pipeline(MD.logistic(FINAL_C, n)).fit(train)


@register("split")
def _split(spark, sf, p):
    tr, _, _ = _train_oot_score(spark, sf, p)
    return MD.split(tr, 80, 2).select(FS.REF, "seller_id", "churn", "is_train")


@register("robust_scale")
def _rscale(spark, sf, p):
    return MD.robust_scale(_abt(spark, sf, p), list(MD.ROBUST_FEATURES)).select(
        FS.REF, "seller_id", *MD.ROBUST_FEATURES)


@register("min_max_scale")
def _mmscale(spark, sf, p):
    return MD.min_max_scale(_abt(spark, sf, p), list(MD.MINMAX_FEATURES)).select(
        FS.REF, "seller_id", *MD.MINMAX_FEATURES)


@register("feature_pipeline")
def _pipe(spark, sf, p):
    """Imputed and scaled features of the whole ABT; the scalers are fitted on the training months."""
    abt = cut_lineage(_abt(spark, sf, p))
    prep = MD.build_pipeline().fit(abt.where(F.col(FS.REF) < F.lit(p.oot_month)))
    return prep.transform(abt).select(FS.REF, "seller_id", *[F.col(f"{c}__scaled").alias(c) for c in MD.feature_names()])


@register("glm_binomial")
def _glm(spark, sf, p):
    tr, _, _ = _train_oot_score(spark, sf, p)
    return MD.glm_binomial(tr)


@register("select_by_pvalue")
def _sel(spark, sf, p):
    tr, _, _ = _train_oot_score(spark, sf, p)
    return MD.select_by_pvalue(MD.glm_binomial(tr), 0.2)


@register("logistic")
def _logit(spark, sf, p):
    tr, _, _ = _train_oot_score(spark, sf, p)
    n = tr.count()
    return MD.coefficients(_final_model(tr, n), MD.feature_names())


@register("coefficients")
def _coefs(spark, sf, p):
    tr, _, _ = _train_oot_score(spark, sf, p)
    m = MD.build_pipeline(MD.logistic(100, tr.count())).fit(tr)
    return MD.coefficients(m, MD.feature_names())


@register("lasso")
def _lasso(spark, sf, p):
    tr, _, _ = _train_oot_score(spark, sf, p)
    return MD.lasso(tr, 0.0005)


@register("reduced_logistic")
def _reduced(spark, sf, p):
    """The final logistic on the features that the GLM keeps."""
    tr, _, _ = _train_oot_score(spark, sf, p)
    return MD.reduced_logistic(tr, MD.glm_binomial(tr), 0.2)


@register("cv")
def _cv(spark, sf, p):
    known, oot, _ = _train_oot_score(spark, sf, p)
    halves = MD.split(known, 80, 2)
    tr, test = halves.where("is_train"), halves.where("NOT is_train")
    n = tr.count()
    return MD.cv(tr, oot, lambda: MD.logistic(FINAL_C, n), k=10, test=test)


@register("rfe")
def _rfe(spark, sf, p):
    tr, _, _ = _train_oot_score(spark, sf, p)
    return MD.rfe(tr, C=100, k=10)


@register("subset_search")
def _subsets(spark, sf, p):
    """Subsets of the features that the GLM keeps, with fits on 80 % of the known months."""
    known, oot, _ = _train_oot_score(spark, sf, p)
    halves = MD.split(known, 80, 2)
    tr, test = cut_lineage(halves.where("is_train")), halves.where("NOT is_train")
    kept = {r.feature for r in MD.select_by_pvalue(MD.glm_binomial(tr), 0.2).collect()}  # one row per feature
    return SB.subset_search(tr, test, oot, [n for n in MD.feature_names() if n in kept], k=10)


@register("grid_search")
def _grid(spark, sf, p):
    tr, _, _ = _train_oot_score(spark, sf, p)
    return MD.grid_search(tr, GRID_C, ("l2", "none"), (True, False), k=5)


@register("score")
def _score(spark, sf, p):
    tr, oot, sc = _train_oot_score(spark, sf, p)
    known = tr.unionByName(oot)  # the final fit uses all labelled months
    return MD.score(_final_model(known, known.count()), sc)


@register("persist_model")
def _persist(spark, sf, p):
    tr, oot, sc = _train_oot_score(spark, sf, p)
    known = tr.unionByName(oot)
    store = M.scratch_store(spark, "model")
    path = f"{store.root}/models/churn_logistic"
    MD.save_model(_final_model(known, known.count()), path)
    return MD.score(MD.load_model(path), sc)


@register("describe_full")
def _describe_full(spark, sf, p):
    """Describe, skew/kurtosis and Bowley side by side, joined on the column name."""
    return ST.describe_full(_abt(spark, sf, p), ABT_NUMERIC)


def _scoring_sellers(spark, sf, p, series):
    """``series`` of the sellers that the scoring month has, written once for its readers."""
    wanted = _abt(spark, sf, p).where(F.col(FS.REF) == F.lit(p.score_month)).select("seller_id")
    return cut_lineage(series.join(wanted, "seller_id", "left_semi"))


@register("last_month_profit")
def _last_month(spark, sf, p):
    """X6 (history part): cumulative LTV of the scoring month's sellers in the last
    history month, and that month's profit (change of the cumulative LTV)."""
    o, i = _oi(spark, sf)
    prof = X.monthly_profit(_scoring_sellers(spark, sf, p, D.monthly_ltv(o, i, p.window_start, p.window_end)))
    last = prof.select(F.max("order_month_purchase")).scalar()
    return (prof.where(F.col("order_month_purchase") == last)
            .agg(F.first("order_month_purchase").alias("month"),
                 F.sum("forecast_ltv").alias("ltv_last_month"),
                 F.sum("current_month_profit").alias("profit_last_month")))


@register("forecast_profit")
def _forecast_profit(spark, sf, p):
    """X1 + X6: next month's forecast total over the scoring month's sellers (floored at 0)."""
    o, i = _oi(spark, sf)
    f = X.holt_forecast(_scoring_sellers(spark, sf, p, D.monthly_ltv(o, i, p.window_start, p.window_end)))
    return f.agg(F.first("order_month_purchase").alias("month"), F.count(F.lit(1)).alias("sellers"),
                 F.sum("forecast_ltv").alias("forecast_ltv_total"))


@register("best_thresholds")
def _best_thr(spark, sf, p):
    return EV.best_thresholds(EV.threshold_metrics(_scored(spark, sf, p)), 5)
