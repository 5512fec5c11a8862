"""Scoring rule and evaluation.

All metrics aggregate scores to a bounded number of rows (distinct scores,
21 threshold bins, 10 lift cuts) before anything global happens; the only
global orderings run through ``prefix.cumulative_sums``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import sigmoid
from ..session import cut_lineage
from .prefix import cumulative_sums, ordered_cumulative_sums

# Fixed scoring rule used where a fitted model is not wanted (manual logistic
# function of ABT columns; nulls count as 0).
RULE_FEATURES = ("recency", "quantity_date_orders", "days_from_first_sell", "pct_status_canceled")
RULE_COEFS = (0.09, -0.35, -0.0015, 1.5)
RULE_INTERCEPT = 0.4


def score_rule(abt: DataFrame, features: Sequence[str] = RULE_FEATURES,
               coefs: Sequence[float] = RULE_COEFS, intercept: float = RULE_INTERCEPT,
               digits: int = 3) -> DataFrame:
    """F19 + M18: ``churn_proba = round(1 / (1 + exp(-(x.b + b0))), digits)``."""
    filled = abt.select("*", *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f"_f_{f}")
                               for f in features])
    p = sigmoid([f"_f_{f}" for f in features], coefs, intercept)
    return filled.select(*abt.columns, F.round(p, digits).alias("churn_proba"))


def score_counts(scored: DataFrame, label: str = "churn", proba: str = "churn_proba") -> DataFrame:
    """(score, positives, negatives, rows) per distinct score, checkpointed:
    every metric below reads this instead of recomputing the scored input."""
    y = F.col(label)
    c = scored.groupBy(F.col(proba).alias("s")).agg(
        F.count(F.when(y == 1, 1)).alias("pos"), F.count(F.when(y == 0, 1)).alias("neg"),
        F.count(F.lit(1)).alias("cnt"))
    return cut_lineage(c)


def auc(scored: DataFrame, label: str = "churn", proba: str = "churn_proba",
        counts: DataFrame | None = None) -> DataFrame:
    """Exact ROC AUC, ties counted one half (rank-sum with average ranks)."""
    c = counts if counts is not None else score_counts(scored, label, proba)
    cum = cumulative_sums(c, "s", ["neg"], inclusive=False)  # negatives strictly below
    return cum.agg(F.try_divide(F.sum(F.col("pos") * (F.col("cum_neg") + F.col("neg") * 0.5)),
                                F.sum("pos") * F.sum("neg")).alias("auc"))


def thresholds(step: float = 0.05, stop: float = 1.05) -> list[float]:
    """Same float grid as ``numpy.arange(0, stop, step)``."""
    n = int(math.ceil(stop / step))
    return [i * step for i in range(n)]


def threshold_metrics(scored: DataFrame, label: str = "churn", proba: str = "churn_proba",
                      step: float = 0.05) -> DataFrame:
    """Per threshold t (predict 1 when p >= t): balanced accuracy, FPR,
    precision, recall, specificity, KS difference; undefined ratios -> 0."""
    ts = thresholds(step)
    arr = F.array(*[F.lit(t) for t in ts])
    c = score_counts(scored, label, proba)
    # bin = number of thresholds <= p; then p >= t_k  <=>  bin > k
    bins = (c.select(F.size(F.filter(arr, lambda t: t <= F.col("s"))).alias("b"), "pos", "neg")
            .groupBy("b").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))  # <= len(ts)+1 rows
    per_t = bins.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(ts) - 1))).alias("k"))
    hit = F.col("b") > F.col("k")
    m = per_t.groupBy("k").agg(
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(hit, 0).otherwise(F.col("pos"))).alias("fn"),
        F.sum(F.when(hit, 0).otherwise(F.col("neg"))).alias("tn"))
    auc_value = auc(scored, label, proba, counts=c).scalar()
    z = F.lit(0.0)
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    rec = F.try_divide(tp, tp + fn)
    spec = F.try_divide(tn, tn + fp)
    return m.select(
        F.element_at(arr, F.col("k") + 1).alias("p"),
        F.coalesce((rec + spec) / 2, z).alias("balanced_accuracy"),
        auc_value.alias("auc"),
        F.coalesce(F.try_divide(fp, fp + tn), z).alias("false_positive_rate"),
        F.coalesce(F.try_divide(tp, tp + fp), z).alias("precision"),
        F.coalesce(rec, z).alias("sensibility"),
        F.coalesce(spec, z).alias("specificity"),
        # share of each class scored below t: zeros minus ones
        F.coalesce(F.try_divide(tn, tn + fp) - F.try_divide(fn, tp + fn), z).alias("ks_diffs"),
    ).orderBy("p")


def confusion_matrix(scored: DataFrame, cut: float = 0.4, label: str = "churn",
                     proba: str = "churn_proba") -> DataFrame:
    """Counts by (label, prediction) with prediction = p > cut."""
    return (scored.groupBy(F.col(label).alias("label"), (F.col(proba) > cut).cast("int").alias("pred"))
            .agg(F.count(F.lit(1)).alias("n")))


def lift_gain(scored: DataFrame, label: str = "churn", proba: str = "churn_proba",
              tie_keys: Sequence[str] = ("_mt_date_reference", "seller_id"), step: float = 0.1) -> DataFrame:
    """Gain and lift of the top ``ceil(x*N)`` rows by score, x = step..1.

    Rows are ordered by (score desc, tie_keys). Whole score groups are
    counted from prefix sums over distinct scores; only the (at most 10)
    groups cut by a boundary are ranked row by row, range-partitioned.
    """
    fr = [step * i for i in range(1, int(round(1 / step)) + 1)]
    # the counts and the row-level ranking of split groups both read these rows
    scored = cut_lineage(scored.select(proba, label, *tie_keys))
    y = F.col(label)
    c = cut_lineage(scored.groupBy(F.col(proba).alias("s")).agg(
        F.count(F.when(y == 1, 1)).alias("pos"), F.count(F.when(y == 0, 1)).alias("neg"),
        F.count(F.lit(1)).alias("cnt")))
    tot = c.agg(F.sum("cnt"), F.sum("pos")).first()  # one row of totals
    n_all, ones = F.lit(tot[0]), F.lit(tot[1])
    cum = cumulative_sums(c.select("s", "cnt", "pos"), "s", ["cnt", "pos"], descending=True, inclusive=False)
    cuts = F.array(*[F.lit(x) for x in fr])
    n_of = lambda x: F.ceil(x * n_all)
    hit = (cum.select("s", "cnt", "pos", "cum_cnt", "cum_pos", F.explode(cuts).alias("x"))
           .where((F.col("cum_cnt") < n_of(F.col("x")))
                  & (n_of(F.col("x")) <= F.col("cum_cnt") + F.col("cnt"))))
    hit = hit.select("*", (n_of(F.col("x")) - F.col("cum_cnt")).alias("m"))
    # row-level ranking only inside the (at most 10) score groups that a cut splits: a
    # range-partitioned running count, so even a hot score group spreads over tasks
    split_groups = hit.select(F.col("s").alias(proba)).distinct()
    split = (scored.join(F.broadcast(split_groups), proba, "left_semi")
             .select(F.col(proba).alias("s"), *tie_keys, F.col(label).alias("_y"), F.lit(1).alias("_one")))
    run = cut_lineage(ordered_cumulative_sums(split, ["s", *tie_keys], ["_one", "_y"]))
    first = run.groupBy("s").agg(F.min(F.col("cum__one") - 1).alias("_before"),
                                 F.min(F.col("cum__y") - F.col("_y")).alias("_pos_before"))
    ranked = (run.join(F.broadcast(first), "s")  # one row per split group (<= 10)
              .select("s", (F.col("cum__one") - F.col("_before")).alias("m"),
                      (F.col("cum__y") - F.col("_pos_before")).alias("pos_in")))
    j = hit.join(ranked, ["s", "m"], "left")
    n_here = n_of(F.col("x"))
    ones_here = F.col("cum_pos") + F.coalesce(F.col("pos_in"), F.lit(0))
    return j.select(
        F.col("x").alias("fraction"), n_here.alias("n_rows"),
        F.try_divide(ones_here, ones).alias("gain"),
        F.try_divide(F.try_divide(ones_here, n_here), F.try_divide(ones, n_all)).alias("lift"),
    ).orderBy("fraction")


def top_k(scored: DataFrame, k: int = 100, proba: str = "churn_proba",
          tie_keys: Sequence[str] = ("seller_id",)) -> DataFrame:
    """Top ``k`` rows by score (TakeOrderedAndProject, no global sort)."""
    return scored.orderBy(F.desc(proba), *tie_keys).limit(k)


def best_thresholds(metrics: DataFrame, k: int = 5) -> DataFrame:
    """Thresholds with the largest KS difference (ties: lower threshold)."""
    return metrics.orderBy(F.desc("ks_diffs"), F.asc("p")).limit(k)
