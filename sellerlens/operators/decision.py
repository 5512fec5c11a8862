"""Business decision step.

* X1 Holt linear-trend forecast per seller, over the seller's month array
  (bounded by the month calendar): a fold of (level, trend, SSE) for every
  (alpha, beta) of a small grid, in NumPy for blocks of sellers at once;
  the lowest SSE wins; with ``refine`` a pattern search then fits the pair
  to the series.
* X4 greedy: a gift is at least the smallest tier value, so at most
  ``budget // smallest tier`` rows can fit: top-k first, then a running sum over
  those rows only.
* X5 exact 0/1 knapsack for few distinct weights: inside one weight class an
  optimal pick is always the class's top-n by value, so the search is over
  counts per class. Classes are folded in one by one: the best value per
  spent cost so far meets the class's prefix sums by an equi-join on the
  count, and only the best row per cost goes on. The work is a sum over the
  classes of costs x counts, never their product.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import tier
from ..session import cut_lineage

# what tasks run goes with them, so workers need not find this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Gift tiers of the reference (floor of churn probability -> gift).
GIFT_TIERS = ((0.95, 10000.0), (0.85, 400.0), (0.75, 100.0))
GIFT_DEFAULT = 50.0
SKIP_GIFT = 10000.0  # marketing does not fund the top tier

HOLT_ALPHAS = (0.1, 0.3, 0.5, 0.7, 0.9)
HOLT_BETAS = (0.05, 0.1, 0.2, 0.3, 0.5)


# ------------------------------------------------------------------ X1, X2
CELLS = 1_000_000  # of one block of series, and of its candidates


def _holt_runs(ys: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sse, forecast) of every series, a row of ``ys`` of two values at least, the longest first, and
    every candidate, a column of ``a`` and ``b``: a fold of (level, trend, sse) over the months."""
    shape = (len(ys), a.shape[1])
    level, trend, sse = np.broadcast_to(ys[:, 1:2], shape).copy(), np.broadcast_to(ys[:, 1:2] - ys[:, :1], shape).copy(), np.zeros(shape)
    for k in range(2, ys.shape[1]):
        n = int(np.searchsorted(-sizes, -k, side="left"))  # series with a value here
        v, x, z, l, t = ys[:n, k:k + 1], a[:n], b[:n], level[:n], trend[:n]
        error = v - l - t
        now = x * v + (1 - x) * (l + t)
        trend[:n] = z * (now - l) + (1 - z) * t
        level[:n] = now
        sse[:n] += error * error
    return sse, level + trend


def _lowest(sse: np.ndarray) -> np.ndarray:
    """Each row's first lowest place; NaN is above every number."""
    unknown = np.isnan(sse)
    at = np.argmin(np.where(unknown, np.inf, sse), axis=1)
    lost = unknown[np.arange(len(sse)), at]
    at[lost] = np.argmin(unknown[lost], axis=1)
    return at


def _holt_best(alphas: Sequence[float], betas: Sequence[float], steps: Sequence[float]):
    """Batches of (key, last_ds, ys, last_y) -> (key, last_ds, alpha, beta, f, last_y): the best candidate and its forecast, null
    for a series of fewer than two values; a null value leaves the first candidate and no forecast."""
    grid = np.array(sorted((float(a), float(b)) for a in alphas for b in betas)).reshape(-1, 2).T
    around = np.array([(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)], float).T

    def block(ys, sizes, known):
        a, b = (np.broadcast_to(c, (len(ys), len(c))) for c in grid)
        rows = np.arange(len(ys))
        for step in (None, *steps):
            if step is not None:
                a, b = (np.clip(c[:, None] + d * step, 0.0, 1.0) for c, d in zip((best_a, best_b), around))
            sse, f = _holt_runs(ys, sizes, a, b)
            sse[~known] = 0.0
            at = _lowest(sse)
            best_a, best_b, best_f = a[rows, at], b[rows, at], f[rows, at]
        return best_a, best_b, best_f

    def run(batches):
        for batch in batches:
            series = batch.column(2)
            sizes = pc.list_value_length(series).to_numpy(zero_copy_only=False)
            values = series.flatten()
            flat, held = values.fill_null(0.0).to_numpy(zero_copy_only=False), ~np.asarray(values.is_null())
            starts = np.concatenate(([0], np.cumsum(sizes)))
            order = np.argsort(-sizes, kind="stable")
            order = order[sizes[order] >= 2]
            out, fitted, forecast = np.zeros((3, len(sizes))), np.zeros(len(sizes), bool), np.zeros(len(sizes), bool)
            at = 0
            while at < len(order):
                longest = int(sizes[order[at]])
                mine = order[at:at + max(1, CELLS // max(longest, grid.shape[1]))]
                at += len(mine)
                ys, known = np.zeros((len(mine), longest)), np.zeros(len(mine), bool)
                for i, j in enumerate(mine):
                    ys[i, :sizes[j]] = flat[starts[j]:starts[j + 1]]
                    known[i] = held[starts[j]:starts[j + 1]].all()
                with np.errstate(all="ignore"):
                    out[:, mine] = block(ys, sizes[mine], known)
                fitted[mine], forecast[mine] = True, known
            found = [pa.array(c, mask=~m) for c, m in zip(out, (fitted, fitted, forecast))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *found, batch.column(3)], names=[*batch.schema.names[:2], "alpha", "beta", "f", "last_y"])

    return run


def holt_forecast(series: DataFrame, key: str = "seller_id", ds: str = "order_month_purchase",
                  y: str = "forecast_ltv", alphas: Sequence[float] = HOLT_ALPHAS,
                  betas: Sequence[float] = HOLT_BETAS, floor: float | None = 0.0, refine: int = 0) -> DataFrame:
    """One-step Holt forecast per key: level0 = y2, trend0 = y2 - y1, then
    l' = a*y + (1-a)*(l+t), t' = b*(l'-l) + (1-b)*t, SSE of one-step errors;
    fewer than two points -> last value. Result floored at ``floor``.

    (alpha, beta) is the grid's best (ties: the smaller pair). ``refine`` rounds then fit it to the
    series: each moves to the best of the nine points around the present one, inside [0, 1], and
    halves the distance, from 0.1 on. The present point is one of the nine, so the error never
    rises above the grid's."""
    s = series.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(F.col(ds), F.col(y).cast("double")
                                                                      .alias("y")))).alias("pts"))
    with_y = s.select(key, F.element_at(F.col("pts"), -1)[ds].alias("last_ds"), F.transform("pts", lambda p: p["y"]).alias("ys"),
                      F.element_at(F.col("pts"), -1)["y"].alias("last_y"))
    kept = T.StructType([*with_y.schema.fields[:2], *[T.StructField(c, T.DoubleType()) for c in ("alpha", "beta", "f", "last_y")]])
    best = with_y.mapInArrow(_holt_best(alphas, betas, holt_steps(refine)), kept)
    f = F.coalesce(F.col("f"), F.col("last_y"))
    if floor is not None:
        f = F.greatest(f, F.lit(float(floor)))
    return best.select(key, F.add_months(F.col("last_ds"), 1).alias(ds), f.alias(y), "alpha", "beta")


def holt_steps(rounds: int) -> list[float]:
    """The distances of the refinement: 0.1, halved from round to round."""
    return [0.1 / 2 ** r for r in range(rounds)]


def monthly_profit(series: DataFrame, key: str = "seller_id", ds: str = "order_month_purchase",
                   y: str = "forecast_ltv") -> DataFrame:
    """Month-over-month change of the cumulative value per key."""
    w = Window.partitionBy(key).orderBy(ds)
    return series.select(key, ds, y, (F.col(y) - F.lag(y).over(w)).alias("current_month_profit"))


# ------------------------------------------------------------------- X3
def gift_tier(scored: DataFrame, proba: str = "churn_proba", tiers=GIFT_TIERS,
              default: float = GIFT_DEFAULT) -> DataFrame:
    """Gift value of the first tier whose floor the probability reaches."""
    return scored.withColumn("gift", tier(proba, tiers, default))


# ------------------------------------------------------------------- X4
def budget_greedy(cands: DataFrame, budget: float, proba: str = "churn_proba",
                  gift: str = "gift", key: str = "seller_id", skip_gift: float = SKIP_GIFT,
                  tiers=GIFT_TIERS, default: float = GIFT_DEFAULT) -> DataFrame:
    """By score (desc, key asc), keep the prefix whose running gift total
    stays within budget; the top tier is skipped."""
    c = cands.where(F.col(gift) < skip_gift)
    least = min(default, *[g for _, g in tiers])  # of the table that gave the gifts
    k = int(budget // least) if least > 0 else None
    head = c.orderBy(F.desc(proba), F.asc(key))
    if k is not None:
        head = head.limit(k)  # no more rows than this can fit
    w = Window.orderBy(F.desc(proba), F.asc(key)).rowsBetween(Window.unboundedPreceding, 0)  # <= k rows
    return (head.select("*", F.sum(gift).over(w).alias("cum_gift"))
            .where(F.col("cum_gift") <= budget).drop("cum_gift"))


# ------------------------------------------------------------------- X5
def budget_optimal(cands: DataFrame, budget: float, weights: Sequence[float],
                   value: str = "ltv", gift: str = "gift", key: str = "seller_id") -> DataFrame:
    """Exact 0/1 knapsack (max total value with total gift <= budget) for
    rows whose gift is one of ``weights``. Returns the chosen rows.
    Ties: higher value, then lower cost, then fewer rows of the first weights."""
    ws = sorted({float(w) for w in weights if 0 < float(w) <= budget}, reverse=True)
    if not ws:
        return cands.limit(0)
    c = cands.where((F.col(value) > 0) & F.col(gift).isin(ws))
    # only a tier's top budget // w rows can ever be picked: distributed top-k
    # per tier (TakeOrdered), so the ranking window sees a bounded row count
    top = None
    for w in ws:
        t = c.where(F.col(gift) == w).orderBy(F.desc(value), F.asc(key)).limit(int(budget // w))
        top = t if top is None else top.unionByName(t)
    r = Window.partitionBy(gift).orderBy(F.desc(value), F.asc(key))
    # a bounded table, read once per tier and by the result
    ranked = cut_lineage(top.select("*", F.row_number().over(r).alias("_rank")))
    # per-class prefix sums for n <= budget // w (n = 0 added), a bounded table
    run = Window.partitionBy(gift).orderBy("_rank").rowsBetween(Window.unboundedPreceding, 0)
    pref = (ranked.select(gift, "_rank", F.sum(value).over(run).alias("_v"))
            .where(F.col("_rank") * F.col(gift) <= budget))
    zero = ranked.sparkSession.range(1).select(F.explode(F.array(*[F.lit(w) for w in ws])).alias(gift),
                                               F.lit(0).alias("_rank"), F.lit(0.0).alias("_v"))
    pref = pref.select(F.col(gift).cast("double").alias(gift), F.col("_rank").cast("int").alias("_rank"),
                       "_v").unionByName(zero)
    state = ranked.sparkSession.range(1).select(F.lit(0.0).alias("cost"), F.lit(0.0).alias("value"),
                                                F.array().cast("array<int>").alias("ns"))
    for w in ws:
        t = pref.where(F.col(gift) == w).select(F.col("_rank").alias("n"), "_v")
        room = F.floor((F.lit(float(budget)) - F.col("cost")) / w).cast("int")
        state = (
            state.withColumn("n", F.explode(F.sequence(F.lit(0), room))).join(t, "n")
            .select((F.col("cost") + F.col("n") * w).alias("cost"), (F.col("value") + F.col("_v")).alias("value"),
                    F.concat("ns", F.array(-F.col("n"))).alias("ns"))
            .groupBy("cost").agg(F.max(F.struct("value", "ns")).alias("best")).select("cost", "best.*")
        )
    best = state.orderBy(F.desc("value"), F.asc("cost"), F.desc("ns")).limit(1)
    counts = best.select(F.explode(F.array(*[
        F.struct(F.lit(w).alias(gift), (-F.col("ns")[i]).alias("_n")) for i, w in enumerate(ws)])).alias("x")
    ).select("x.*")  # one row per class
    return (ranked.join(F.broadcast(counts), gift)
            .where(F.col("_rank") <= F.col("_n")).drop("_rank", "_n"))


# ------------------------------------------------------------------- X6
def roi_summary(scored: DataFrame, greedy: DataFrame, optimal: DataFrame,
                floor: float = 0.5, proba: str = "churn_proba", value: str = "ltv",
                gift: str = "gift", key: str = "seller_id") -> DataFrame:
    """Sellers, value and gift spend for everyone scored, everyone above
    the probability floor, the greedy pick and the optimal pick."""
    def agg(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.lit(name).alias("scenario"), F.count_distinct(key).alias("sellers"),
                      F.sum(value).alias("total_ltv"), F.sum(gift).alias("total_gift"))
    above = scored.where(F.col(proba) >= floor)
    n50 = above.select(F.count_distinct(key)).scalar()
    out = (agg(scored, "all_scored").unionByName(agg(above, "all_above_floor"))
           .unionByName(agg(greedy, "greedy")).unionByName(agg(optimal, "optimal")))
    return out.select("*", (F.col("sellers") / n50).alias("share_of_floor_sellers"))


def decision_inputs(abt_scored: DataFrame, month, forecast: DataFrame, floor: float | None = None,
                    proba: str = "churn_proba") -> DataFrame:
    """Scored sellers of one month with their forecast LTV (0 without a delivered
    order in the history) and gift. ``forecast`` is ``holt_forecast``'s result."""
    d = abt_scored.where(F.col("_mt_date_reference") == F.lit(month)).select("seller_id", proba)
    d = d.join(forecast.select("seller_id", F.col("forecast_ltv").alias("ltv")), "seller_id", "left")
    d = gift_tier(d.select("seller_id", proba, F.coalesce("ltv", F.lit(0.0)).alias("ltv")), proba)
    return d if floor is None else d.where(F.col(proba) >= floor)
