"""Model preparation, training and scoring.

Single fits are distributed MLlib jobs over the ABT, searches over many fits
share their passes (``logit``); only coefficients, p-values and per-fold
metrics (a few rows) reach the driver. sklearn's
``C`` maps to ``regParam = 1 / (C * n)`` with ``standardization=False``;
"balanced" class weights become a ``weightCol`` of ``n / (2 * n_class)``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import stable_hash_bucket
from ..session import cut_lineage
from . import logit
from .scaling import MIN_MAX, ROBUST, ColumnScaler, left_out_scalers

KEYS = ("_mt_date_reference", "seller_id")

# The pipeline's scaler groups and dropped columns, full and reduced.
ROBUST_FEATURES = (
    "avg_ticket", "max_order_items_price", "min_order_items_price", "avg_order_items_price",
    "max_item_price", "min_item_price", "avg_item_price", "quantity_date_orders",
    "quantity_products_selled", "quantity_unique_product_selled", "avg_seller_interval", "ltv", "frequency",
    "avg_freight_value", "min_freight_value", "max_freight_value",
    "min_approval_delivery_days", "max_approval_delivery_days", "quantity_delay_orders",
)
MINMAX_FEATURES = (
    "avg_order_product", "days_from_first_sell", "avg_approval_purchase_days",
    "min_approval_purchase_days", "max_approval_purchase_days",
)
DROPPED = ("recency", "_mt_date_reference", "seller_id")
REDUCED_ROBUST_FEATURES = (
    "min_order_items_price", "avg_order_items_price", "max_item_price", "min_item_price",
    "quantity_date_orders", "quantity_products_selled", "quantity_unique_product_selled",
    "avg_seller_interval", "ltv", "frequency", "min_approval_delivery_days", "quantity_delay_orders",
)
REDUCED_MINMAX_FEATURES = ("avg_order_product", "min_approval_purchase_days", "max_approval_purchase_days")
IMPUTE = {"frequency": 0.0, "avg_seller_interval": 0.0}


# ---------------------------------------------------------------- M1
def split(df: DataFrame, train_pct: int = 80, seed: int = 2, keys: Sequence[str] = KEYS) -> DataFrame:
    """Seeded train/test split by a stable hash of the row key: the same rows
    land in the same side however the data is partitioned or retried."""
    b = stable_hash_bucket(list(keys), seed, 100)
    return df.withColumn("is_train", b < F.lit(train_pct))


def stratified_folds(df: DataFrame, k: int, label: str = "churn", seed: int = 2,
                     keys: Sequence[str] = KEYS) -> DataFrame:
    """``fold`` per row: every class is dealt round robin in the order of a seeded hash of
    the key, so a fold holds the class' k-th part, give or take one row. The places come
    from distributed running counts; no class meets in one task."""
    return logit.fold_numbers(df, k, label, [F.xxhash64(F.lit(seed), *keys), *keys])


# ------------------------------------------------------------ M2, M3
def robust_scale(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - median) / (Q3 - Q1) per column, exact quartiles."""
    from .stats import quartiles, to_long
    df = cut_lineage(df)  # read by the quartiles and by the scaling
    # three numbers per column, as MLlib's scaler fits; literals keep the projection narrow
    stats = {r["column"]: r for r in quartiles(to_long(df, cols)).collect()}
    out = {}
    for c in cols:
        r = stats.get(c)
        out[c] = F.try_divide(F.col(c) - F.lit(r.q50), F.lit(r.q75) - F.lit(r.q25)) if r else F.lit(None)
    return df.withColumns(out)


def min_max_scale(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - min) / (max - min) per column into [0, 1]."""
    df = cut_lineage(df)  # read by the range and by the scaling
    stats = df.agg(*[F.min(c).cast("double").alias(f"lo_{c}") for c in cols],
                   *[F.max(c).cast("double").alias(f"hi_{c}") for c in cols]).first()
    out = {}
    for c in cols:
        lo, hi = F.lit(stats[f"lo_{c}"]).cast("double"), F.lit(stats[f"hi_{c}"]).cast("double")
        out[c] = F.try_divide(F.col(c) - lo, hi - lo)
    return df.withColumns(out)


# ---------------------------------------------------------------- M4
def impute_stage(features: Sequence[str], values: dict[str, float]) -> SQLTransformer:
    """Constant imputation (Q11) as a pipeline stage: the named constants,
    0 for any other missing feature (e.g. no delivered order yet)."""
    cols = ", ".join(f"COALESCE(CAST(`{c}` AS DOUBLE), {float(values.get(c, 0.0))}) AS `{c}__imp`"
                     for c in features)
    return SQLTransformer(statement=f"SELECT *, {cols} FROM __THIS__")


def build_pipeline(estimator=None, robust_features: Sequence[str] = ROBUST_FEATURES,
                   minmax_features: Sequence[str] = MINMAX_FEATURES,
                   impute: dict[str, float] = IMPUTE) -> Pipeline:
    """Impute -> scale two feature groups by exact quartiles and ranges -> assemble -> estimator.
    Columns in neither group are not used (Q12: they are dropped)."""
    names = [*robust_features, *minmax_features]
    stages = [impute_stage(names, impute),
              ColumnScaler([f"{c}__imp" for c in names], [f"{c}__scaled" for c in names],
                           [ROBUST] * len(robust_features) + [MIN_MAX] * len(minmax_features)),
              VectorAssembler(inputCols=[f"{c}__scaled" for c in names], outputCol="features", handleInvalid="keep")]
    if estimator is not None:
        stages.append(estimator)
    return Pipeline(stages=stages)


def feature_names(robust_features=ROBUST_FEATURES, minmax_features=MINMAX_FEATURES) -> list[str]:
    return list(robust_features) + list(minmax_features)


# ---------------------------------------------------------------- M7
def with_balanced_weights(df: DataFrame, label: str = "churn") -> DataFrame:
    """sklearn ``class_weight='balanced'``: n / (2 * n_class) per row. Class
    counts come from a grouped count (one row per class, broadcast)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n_class"))
    n = counts.select(F.sum("_n_class")).scalar()
    w = counts.select(label, (n / (2 * F.col("_n_class"))).alias("class_weight"))
    return df.join(F.broadcast(w), label)


def logistic(C: float, n: int, penalty: str = "l2", balanced: bool = False,
             label: str = "churn", max_iter: int = 200) -> LogisticRegression:
    lr = LogisticRegression(featuresCol="features", labelCol=label, regParam=1.0 / (C * n),
                            elasticNetParam=1.0 if penalty == "l1" else 0.0,
                            standardization=False, maxIter=max_iter)
    if balanced:
        lr.setWeightCol("class_weight")
    return lr


def coefficients(model, names: Sequence[str]) -> DataFrame:
    """M8: coefficients sorted by value (a handful of rows built on the driver)."""
    est = model.stages[-1] if isinstance(model, PipelineModel) else model
    coefs = est.coefficients.toArray().tolist()
    rows = sorted(zip(names, coefs), key=lambda t: t[1])
    from pyspark.sql import SparkSession
    s = SparkSession.getActiveSession()
    return s.createDataFrame(rows + [("intercept", float(getattr(est, "intercept", 0.0)))],
                             "feature string, coefficient double")


# ------------------------------------------------------------- M5, M6
def prepared_rows(df: DataFrame, label: str = "churn") -> DataFrame:
    """Blocks (``logit.packed``) of the rows of the preparation pipeline fitted on ``df``."""
    wide = build_pipeline().fit(df).transform(df).select(label, vector_to_array("features").alias("features"))
    return logit.packed(logit.rows_of(wide, "features", label))


def glm_binomial(df: DataFrame, label: str = "churn", names: Sequence[str] | None = None) -> DataFrame:
    """Logistic GLM without intercept and without penalty on the prepared features: coefficients,
    standard errors, z values and p-values. Features that earlier ones determine (avg_ticket equals
    avg_item_price when no product id is missing) are dropped by rule and reported as such."""
    return logit.binomial_table(prepared_rows(df, label), list(names or feature_names()))


def select_by_pvalue(glm_table: DataFrame, alpha: float = 0.2) -> DataFrame:
    return glm_table.where(F.col("p_value") < alpha).select("feature", "p_value")


def reduced_logistic(df: DataFrame, glm_table: DataFrame, alpha: float = 0.2, C: float = 100, label: str = "churn") -> DataFrame:
    """M6 + P16: the L2 logistic refitted on the features that ``select_by_pvalue`` keeps;
    (feature, coefficient), the intercept last."""
    kept = {r.feature for r in select_by_pvalue(glm_table, alpha).collect()}  # one row per feature
    names = feature_names()
    rows = prepared_rows(df, label)
    fit = logit.new_fit(len(names), True, C, features=[i for i, n in enumerate(names) if n in kept])
    logit.newton(rows, [fit], True)
    out = [(n, float(fit.w[i])) for i, n in enumerate(names) if n in kept] + [("intercept", float(fit.w[-1]))]
    return df.sparkSession.createDataFrame(out, "feature string, coefficient double")


# ---------------------------------------------------------------- M9
def lasso(df: DataFrame, alpha: float = 0.0005, label: str = "churn",
          names: Sequence[str] | None = None) -> DataFrame:
    """L1 linear regression on the prepared features (same objective as
    sklearn's Lasso: 1/(2n)||y - Xw||^2 + alpha ||w||_1)."""
    names = list(names or feature_names())
    prep = cut_lineage(build_pipeline().fit(df).transform(df).select(label, "features"))
    m = LinearRegression(featuresCol="features", labelCol=label, regParam=alpha, elasticNetParam=1.0,
                         standardization=False, maxIter=200).fit(prep)
    rows = [(n, float(c)) for n, c in zip(names, m.coefficients.toArray())]
    return df.sparkSession.createDataFrame(rows, "feature string, coefficient double")


# ---------------------------------------------------------------- M18
def score(model: PipelineModel, df: DataFrame, digits: int = 3, keep: Sequence[str] = KEYS) -> DataFrame:
    out = model.transform(df)
    return out.select(*keep, *([c for c in ("churn",) if c in df.columns]),
                      F.round(vector_to_array("probability")[1], digits).alias("churn_proba"))


# ---------------------------------------------------------------- M10
def cv(df: DataFrame, oot: DataFrame, make_estimator, k: int = 10, label: str = "churn",
       balanced: bool = False, test: DataFrame | None = None) -> DataFrame:
    """Stratified k-fold: per fold AUC on train folds, the held-out fold, the test set (if given)
    and the out-of-time set, then a final fit on everything (fold = -1, which the test set validates)."""
    if balanced:
        df = with_balanced_weights(df, label)
    # many fits over the same rows: materialise once in the shared checkpoint dir
    folded = cut_lineage(stratified_folds(df, k, label))
    preps = left_out_preparations(folded, k)
    others = [(number, d) for number, d in ((logit.TEST, test), (logit.OOT, oot)) if d is not None]
    wide = folded.select(label, "fold", *feature_names())
    for number, d in others:
        wide = wide.unionByName(d.select(label, F.lit(number).alias("fold"), *feature_names()))
    rows = _block_rows(wide, preps[logit.ALL], label)
    models = []
    for f in [*range(k), logit.ALL]:
        m = make_estimator().fit(preps[f].transform(folded.where(F.col("fold") != f)))
        models.append((f, f, _on_common_scale(m, preps[f].stages[1], preps[logit.ALL].stages[1])))
    found = logit.cross_aucs(rows, models, True, (logit.HELD, logit.TRAIN, *[n for n, _ in others]), probability=True)

    def auc(f, side):
        value, pos, neg = found.get((f, side), (None, 0, 0))
        return value if value is not None else 0.5 if not pos + neg else float(pos > 0)  # as MLlib's evaluator

    out = []
    for f, _, _ in models:
        at_test, at_oot = (None if d is None else auc(f, n) for n, d in ((logit.TEST, test), (logit.OOT, oot)))
        out.append((f, auc(f, logit.TRAIN), at_test if f < 0 else auc(f, logit.HELD), at_test, at_oot))
    return df.sparkSession.createDataFrame(out, "fold int, auc_train double, auc_valid double, auc_test double, auc_oot double")


def left_out_preparations(folded: DataFrame, k: int) -> dict[int, PipelineModel]:
    """The preparation fitted on the rows outside each fold, and on all rows (-1), in shared passes."""
    impute, scaler, assemble = build_pipeline().getStages()
    fitted = left_out_scalers(impute.transform(folded), scaler.getInputCols(), scaler.getOutputCols(), scaler.getOrDefault(scaler.kinds), k)
    return {f: PipelineModel([impute, m, assemble]) for f, m in fitted.items()}


def _block_rows(df: DataFrame, prep: PipelineModel, label: str) -> DataFrame:
    wide = prep.transform(df).select(label, "fold", vector_to_array("features").alias("features"))
    return logit.packed(logit.rows_of(wide, "features", label, "fold"))


def _on_common_scale(model, own, common) -> np.ndarray:
    """Weights, the intercept last, of a linear model of features scaled by ``own``, for features scaled by ``common``."""
    (a, s), (b, t) = ((np.array(m.getOrDefault(m.centers)), np.array(m.getOrDefault(m.scales))) for m in (own, common))
    w = model.coefficients.toArray()
    return np.append(w * t / s, model.intercept + float((w * (b - a) / s).sum()))


# ---------------------------------------------------------------- M11
def rfe(df: DataFrame, C: float = 100, k: int = 5, label: str = "churn", select_ranks: Sequence[int] | None = None) -> DataFrame:
    """Recursive elimination with stratified k-fold AUC over the prepared features (scaled once, on all
    rows): (feature, ranking, mean_auc_at_size), the last to go first; with ``select_ranks`` only
    features of these ranks. All folds' fits share their passes over the rows (``logit.eliminate``)."""
    folded = cut_lineage(stratified_folds(df, k, label))
    rows = _block_rows(folded, build_pipeline().fit(folded), label)
    out = logit.eliminate(rows, feature_names(), k, C)
    return out if select_ranks is None else out.where(F.col("ranking").isin(list(select_ranks)))


def _evaluator_auc(pred: DataFrame, label: str) -> float:
    """Exact ROC AUC from MLlib (``numBins=0``: no down-sampling of distinct scores)."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="probability",
                                       metricName="areaUnderROC", numBins=0)
    return float(ev.evaluate(pred))


# ---------------------------------------------------------------- M13
def grid_search(df: DataFrame, Cs: Sequence[float], penalties: Sequence[str] = ("l2", "none"),
                weights: Sequence[bool] = (True, False), k: int = 5, label: str = "churn") -> DataFrame:
    """Mean and std (over the folds) of the AUC on the held-out fold and on the training folds for
    every (C, penalty, class weight); ``penalty='none'`` has no C and is fitted once.

    Each fold's preparation is fitted on its training rows. It changes a fit by the scale of its ridge
    only (the intercept is free), so all points of all folds take their Newton steps over the same rows
    together, and one pass ranks the scores of all of them."""
    if not set(penalties) <= {"l2", "none"}:
        raise ValueError("penalties are 'l2' and 'none'")
    points = [(None if c is None else float(c), pen, balanced) for balanced in weights for pen in penalties
              for c in ([None] if pen == "none" else Cs)]
    folded = cut_lineage(stratified_folds(df, k, label))
    d = len(feature_names())
    preps = left_out_preparations(folded, k)
    rows = _block_rows(folded, preps[logit.ALL], label)
    scales = {f: np.array(m.stages[1].getOrDefault(m.stages[1].scales)) for f, m in preps.items()}
    counts = {(r.fold, r[label]): r["count"] for r in folded.groupBy("fold", label).count().collect()}  # one row per fold and class
    fits = []
    for f in range(k):
        sizes = {y: sum(n for (g, z), n in counts.items() if g != f and z == y) for y in (0, 1)}
        n = sum(sizes.values())
        balance = tuple(n / (2 * sizes[y]) if sizes[y] else 1.0 for y in (0, 1))
        for c, _, b in points:
            fit = logit.new_fit(d, True, c, f, class_weights=balance if b else (1.0, 1.0))
            fit.ridge[:d] *= (scales[f] / scales[logit.ALL]) ** 2
            fits.append(fit)
    logit.newton(rows, fits, True)
    aucs = logit.cross_aucs(rows, [(i, fit.left_out, fit.w) for i, fit in enumerate(fits)], True)
    parts = [(i % len(points), side == logit.HELD, auc) for (i, side), (auc, _, _) in sorted(aucs.items())]
    out = []
    for i, (c, pen, balanced) in enumerate(points):
        test, train = ([a for m, h, a in parts if m == i and h == side and a is not None] for side in (True, False))
        out.append((c, pen, "balanced" if balanced else "none", *_mean_std(test), *_mean_std(train)))
    return df.sparkSession.createDataFrame(out, "C double, penalty string, class_weight string, mean_auc double, "
                                                "std_auc double, mean_auc_train double, std_auc_train double")


def _mean_std(values: Sequence[float]) -> tuple[float | None, float | None]:
    if not values:
        return None, None
    mean = sum(values) / len(values)
    return mean, (sum((v - mean) ** 2 for v in values) / len(values)) ** 0.5


# ---------------------------------------------------------------- M19
def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
