"""Statistics over the ABT.

Every statistic is one aggregation pass (plus a ``stack`` to long form);
only per-column summary rows leave the executors.
"""

from __future__ import annotations

import datetime as _dt
import math
from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .prefix import ordered_cumulative_sums

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


# Relative accuracy (1 / SKETCH of the rows) of the sketch that brackets quantiles; results do not depend on it.
SKETCH = 2000


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def _long(wide: DataFrame, cols: list[str], stats: list[str]) -> DataFrame:
    """Wide one-row frame with ``<stat>__<col>`` fields -> one row per column."""
    structs = ", ".join(
        f"'{c}', " + ", ".join(f"`{s}__{c}`" for s in stats) for c in cols)
    names = ", ".join(["column", *stats])
    return wide.selectExpr(f"stack({len(cols)}, {structs}) AS ({names})")


def to_long(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep.., column, value) rows: one per input row and column (``stack``)."""
    body = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    return df.selectExpr(*[f"`{c}`" for c in keep], f"stack({len(cols)}, {body}) AS (column, value)")


def quantiles(long: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(column, p, q): exact quantiles with linear interpolation of (column, value) rows.

    A sketch brackets every quantile on both sides by twice its own error. Values inside a bracket are
    counted one by one, those between brackets together, so few rows are shuffled. Running counts then
    give every value its positions, and the two positions around each quantile are looked up. A
    position outside the brackets (the sketch missed) has every value counted. No column's values meet
    in one buffer."""
    long = long.where("value IS NOT NULL")
    marked = _bracketed(long, probs)
    counts = marked.groupBy("column", "gap", F.when(F.col("gap").isNull(), F.col("value")).alias("_v")).agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("value"), (F.min("value") == F.max("value")).alias("exact"))
    around = cut_lineage(_at_positions(cut_lineage(counts.drop("gap", "_v")), probs))  # one row per column and quantile
    if around.where("NOT exact").limit(1).count():
        counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"), F.lit(True).alias("exact"))
        around = _at_positions(cut_lineage(counts), probs)
    return around.select("column", "p", (F.col("a") + (F.col("b") - F.col("a")) * F.col("part")).alias("q"))


def _bracketed(long: DataFrame, probs: Sequence[float]) -> DataFrame:
    """``long`` with ``gap``: null inside a bracket, else the number of brackets below the value."""
    ends = [min(1.0, max(0.0, p + side * 2 / SKETCH)) for p in probs for side in (-1, 1)]
    sketch = long.groupBy("column").agg(F.percentile_approx("value", ends, SKETCH).alias("_ends"))  # one row per column
    v = F.col("value")
    pairs = [(F.get("_ends", F.lit(2 * i)), F.get("_ends", F.lit(2 * i + 1))) for i in range(len(probs))]
    inside, gap = F.lit(False), F.lit(0)
    for lo, hi in pairs:
        inside, gap = inside | ((v >= lo) & (v <= hi)), gap + (v > hi).cast("int")
    return long.join(F.broadcast(sketch), "column").select(*long.columns, F.when(~inside, gap).alias("gap"))


def quantiles_left_out(long: DataFrame, probs: Sequence[float], k: int) -> DataFrame:
    """(column, left_out, p, q): as ``quantiles`` of (column, value, fold) rows, for each fold 0..k-1 over the
    rows of all other folds, and over all rows (left_out -1). All share their passes: running counts over
    all rows and over each fold's give every complement its positions by subtraction."""
    long = long.where("value IS NOT NULL")
    of_fold = [F.sum(F.when(F.col("fold") == f, F.col("n")).otherwise(0)).alias(f"n{f}") for f in range(k)]
    by = ["column", "gap", F.when(F.col("gap").isNull(), F.col("value")).alias("_v")]
    counts = (_bracketed(long, probs).groupBy(*by, "fold").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
              .groupBy("column", "gap", "_v").agg(F.sum("n").alias("n"), *of_fold, F.max("hi").alias("value"), (F.min("lo") == F.max("hi")).alias("exact")))
    around = cut_lineage(_left_out_positions(cut_lineage(counts.drop("gap", "_v")), probs, k))  # one row per column, fold and quantile
    if around.where("NOT exact").limit(1).count():
        counts = (long.groupBy("column", "value", "fold").agg(F.count(F.lit(1)).alias("n"))
                  .groupBy("column", "value").agg(F.sum("n").alias("n"), *of_fold, F.lit(True).alias("exact")))
        around = _left_out_positions(cut_lineage(counts), probs, k)
    return around.select("column", "left_out", "p", (F.col("a") + (F.col("b") - F.col("a")) * F.col("part")).alias("q"))


def _left_out_positions(counts: DataFrame, probs: Sequence[float], k: int) -> DataFrame:
    """As ``_at_positions``, by column and left-out fold."""
    weights = ["n", *[f"n{f}" for f in range(k)]]
    wanted, before = [], [0] * (k + 1)
    for r in sorted(counts.groupBy("column").agg(*[F.sum(c).alias(c) for c in weights]).collect(), key=lambda r: r["column"]):  # one row per column
        for f in range(-1, k):
            size = r["n"] - (r[f"n{f}"] if f >= 0 else 0)
            for p in probs if size else []:
                at = float(p) * (size - 1)
                wanted.append((r["column"], f, float(p), before[f] + math.floor(at), before[f] + math.ceil(at), at - math.floor(at)))
            before[f] += size
    asked = counts.sparkSession.createDataFrame(wanted, "column string, left_out int, p double, lo long, hi long, part double")
    run = ordered_cumulative_sums(counts, ["column", "value"], weights)
    sides = F.array(*[F.struct(F.lit(f).alias("left_out"), *[(F.col(f"{c}n") - F.col(f"{c}n{f}") if f >= 0 else F.col(f"{c}n")).alias(a)
                                                             for c, a in (("cum_", "cum"), ("", "m"))]) for f in range(-1, k)])
    run = run.select("column", "value", "exact", F.explode(sides).alias("s")).select("column", "value", "exact", "s.*")
    inside = lambda c: (F.col(c) >= F.col("cum") - F.col("m")) & (F.col(c) < F.col("cum"))
    return (run.join(F.broadcast(asked), ["column", "left_out"]).where(inside("lo") | inside("hi")).groupBy("column", "left_out", "p", "part")
            .agg(F.max(F.when(inside("lo"), F.col("value"))).alias("a"), F.max(F.when(inside("hi"), F.col("value"))).alias("b"),
                 F.bool_and("exact").alias("exact")))


def _at_positions(counts: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(column, p, part, a, b, exact): the values at the two positions around each quantile of
    (column, value, n, exact) rows; ``exact`` where both were counted by themselves."""
    run = ordered_cumulative_sums(counts, ["column", "value"], ["n"])
    size = counts.groupBy("column").agg(F.sum("n").alias("size"))
    before = Window.orderBy("column").rowsBetween(Window.unboundedPreceding, -1)  # one row per column
    at = F.col("p") * (F.col("size") - 1)
    wanted = (
        size.select("column", "size", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("off"))
        .withColumn("p", F.explode(F.array(*[F.lit(float(x)) for x in probs])))
        .select("column", "p", (F.col("off") + F.floor(at)).alias("lo"), (F.col("off") + F.ceil(at)).alias("hi"), (at - F.floor(at)).alias("part"))
    )
    inside = lambda c: (F.col(c) >= F.col("cum_n") - F.col("n")) & (F.col(c) < F.col("cum_n"))
    around = (
        run.join(F.broadcast(wanted), "column").where(inside("lo") | inside("hi")).groupBy("column", "p", "part")
        .agg(F.max(F.when(inside("lo"), F.col("value"))).alias("a"), F.max(F.when(inside("hi"), F.col("value"))).alias("b"),
             F.bool_and("exact").alias("exact"))
    )
    return around


def quartiles(long: DataFrame) -> DataFrame:
    """(column, q25, q50, q75), exact."""
    pick = lambda x: F.max(F.when(F.col("p") == x, F.col("q")))
    return quantiles(long, [0.25, 0.5, 0.75]).groupBy("column").agg(pick(0.25).alias("q25"), pick(0.5).alias("q50"), pick(0.75).alias("q75"))


def describe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample std, min, quartiles (exact, linear interpolation), max."""
    cols = list(cols or numeric_columns(df))
    df = cut_lineage(df.select(*cols))  # read by the moments and by the quartiles
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).cast("double").alias(f"count__{c}"), F.avg(x).alias(f"mean__{c}"),
                 F.stddev_samp(x).alias(f"std__{c}"), F.min(x).alias(f"min__{c}"), F.max(x).alias(f"max__{c}")]
    g = _long(df.agg(*aggs), cols, ["count", "mean", "std", "min", "max"])
    return g.join(F.broadcast(quartiles(to_long(df, cols))), "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")  # one row per column


def skew_kurtosis(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Sample-adjusted skewness G1 and excess kurtosis G2 (pandas' forms)."""
    cols = list(cols or numeric_columns(df))
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n__{c}"), F.skewness(x).alias(f"g1__{c}"), F.kurtosis(x).alias(f"g2__{c}")]
    long = _long(df.agg(*aggs), cols, ["n", "g1", "g2"])
    n = F.col("n").cast("double")
    g1 = F.try_divide(F.sqrt(n * (n - 1)), n - 2) * F.col("g1")
    g2 = F.try_divide((n - 1), (n - 2) * (n - 3)) * ((n + 1) * F.col("g2") + 6)
    return long.select("column", g1.alias("skew"), g2.alias("kurtosis"))


def bowley(df: DataFrame, cols: Sequence[str] | None = None, compat: bool = False) -> DataFrame:
    """Quartile skewness. ``compat=True`` evaluates the reference's
    written form ``(q3 - q2) - (q2 - q1) / 1 + (q3 - q1)``."""
    d = describe(df, cols)
    num = (F.col("q75") - F.col("q50")) - (F.col("q50") - F.col("q25"))
    iqr = F.col("q75") - F.col("q25")
    val = (num / F.lit(1.0) + iqr) if compat else F.try_divide(num, iqr)
    return d.select("column", val.alias("bowley"))


def _pair_sums(k: int, center: Sequence[float]):
    """One task's sums for every pair of columns, over the rows that have both: matrix products per batch."""
    left, right = np.triu_indices(k, 1)
    mid = np.array(center)

    def run(batches):
        sums, low, high = np.zeros((6, len(left))), np.full((k, k), np.inf), np.full((k, k), -np.inf)
        for b in batches:
            if not b.num_rows:
                continue
            has = np.column_stack([np.asarray(c.is_valid()) for c in b.columns])
            x = np.column_stack([c.fill_null(0).to_numpy(zero_copy_only=False) for c in b.columns]) - mid
            for j in range(k):  # the range of every column where column j has a value
                both = has if has[:, j].all() else has[has[:, j]]
                near = x if has[:, j].all() else x[has[:, j]]
                low[:, j] = np.minimum(low[:, j], np.where(both, near, np.inf).min(axis=0, initial=np.inf))
                high[:, j] = np.maximum(high[:, j], np.where(both, near, -np.inf).max(axis=0, initial=-np.inf))
            x, m = np.where(has, x, 0.0), has.astype(float)
            n, s, ss, xy = m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x
            sums += [n[left, right], s[left, right], s[right, left], ss[left, right], ss[right, left], xy[left, right]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(left))), *[pa.array(c) for c in sums], pa.array(low[left, right]), pa.array(high[left, right]),
             pa.array(low[right, left]), pa.array(high[right, left])],
            names=["i", "n", "sx", "sy", "sxx", "syy", "sxy", "x0", "x1", "y0", "y1"])

    return run


def correlation(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """T4: Pearson correlation for every column pair (pairwise-complete rows).

    Every task adds up counts, sums and products of all pairs, taken from the columns' means, as
    matrix products; Spark adds the tasks' sums (one row per pair and task)."""
    cols = list(cols or numeric_columns(df))
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    center = [m or 0.0 for m in wide.agg(*[F.avg(c) for c in cols]).first()]
    summed = ["n", "sx", "sy", "sxx", "syy", "sxy"]
    ends = {"x0": F.min, "x1": F.max, "y0": F.min, "y1": F.max}
    tasks = wide.mapInArrow(_pair_sums(len(cols), center), "i long, " + ", ".join(f"{c} double" for c in [*summed, *ends]))
    g = tasks.groupBy("i").agg(*[F.sum(c).alias(c) for c in summed], *[f(c).alias(c) for c, f in ends.items()])
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    spread = F.sqrt((F.col("sxx") - sx * sx / n) * (F.col("syy") - sy * sy / n))
    varied = (F.col("x0") < F.col("x1")) & (F.col("y0") < F.col("y1"))
    pairs = list(combinations(cols, 2))
    name = lambda side: F.get(F.array(*[F.lit(p[side]) for p in pairs]), F.col("i").cast("int"))
    return g.select(name(0).alias("column_a"), name(1).alias("column_b"),
                    F.when((n > 1) & varied, F.try_divide(F.col("sxy") - sx * sy / n, spread)).alias("corr"))


def point_biserial(df: DataFrame, label: str = "churn", cols: Sequence[str] | None = None) -> DataFrame:
    """T5: correlation of the 0/1 label with each feature and its t statistic,
    sorted by absolute correlation (descending)."""
    cols = list(cols or numeric_columns(df, exclude=[label]))
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        y = F.col(label).cast("double")
        aggs += [F.corr(y, x).alias(f"r__{c}"),
                 F.count(F.when(x.isNotNull() & y.isNotNull(), 1)).alias(f"n__{c}")]
    long = _long(df.agg(*aggs), cols, ["r", "n"])
    r = F.col("r")
    t = r * F.sqrt(F.try_divide(F.col("n") - 2, 1 - r * r))
    return long.select("column", "r", "n", t.alias("t")).orderBy(F.desc(F.abs("r")), "column")


def _log_gamma(z: Column) -> Column:
    """ln Gamma(z) for z > 0: Stirling's series at z + 10, then down by the recurrence."""
    y = z + 10
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - 1 / (1680 * y ** 7)
    down = F.log(z)
    for k in range(1, 10):
        down = down + F.log(z + k)
    return series - down


def _beta_fraction(a: str, b: str, x: str, terms: int = 400) -> Column:
    """The continued fraction of the incomplete beta function, as a fold over its terms
    (two per step; numerators and denominators are rescaled to stay in range)."""
    step = f"""
      named_struct(
        'p', acc.q + (m * ({b} - m) * {x} / (({a} + 2 * m - 1) * ({a} + 2 * m))) * acc.p,
        'q', acc.q, 'r', acc.s + (m * ({b} - m) * {x} / (({a} + 2 * m - 1) * ({a} + 2 * m))) * acc.r, 's', acc.s)"""
    odd = f"(-({a} + m) * ({a} + {b} + m) * {x} / (({a} + 2 * m) * ({a} + 2 * m + 1)))"
    return F.expr(f"""
      aggregate(sequence(1, {terms}),
        named_struct('p', 1D, 'q', 1D, 'r', 1D, 's', 1D - ({a} + {b}) * {x} / ({a} + 1)),
        (acc, m) -> transform(array({step}), e -> transform(array(named_struct(
            'p', e.p, 'q', e.p + {odd} * e.q, 'r', e.r, 's', e.r + {odd} * e.s)), g -> named_struct(
            'p', g.p / g.s, 'q', g.q / g.s, 'r', g.r / g.s, 's', 1D))[0])[0],
        acc -> acc.q / acc.s)""")


def t_two_sided(df: DataFrame, t: str = "t", dof: str = "dof", name: str = "p_value") -> DataFrame:
    """``df`` with the two-sided tail probability of Student's t as ``name``: the regularised incomplete
    beta function I_x(dof / 2, 1 / 2) at x = dof / (dof + t * t), in built-in expressions."""
    d = df.withColumns({"_a": F.col(dof).cast("double") / 2, "_b": F.lit(0.5)})
    d = d.withColumn("_x", F.col(dof) / (F.col(dof) + F.col(t) * F.col(t))).withColumn("_y", 1 - F.col("_x"))
    a, b, x, y = (F.col(c) for c in ("_a", "_b", "_x", "_y"))
    front = F.exp(_log_gamma(a + b) - _log_gamma(a) - _log_gamma(b) + a * F.log(x) + b * F.log(y))
    left = x < (a + 1) / (a + b + 2)
    tail = F.when(left, front * _beta_fraction("_a", "_b", "_x") / a).otherwise(1 - front * _beta_fraction("_b", "_a", "_y") / b)
    p = F.when((F.col(dof) <= 0) | F.isnan(t) | F.col(t).isNull(), F.lit(float("nan"))).when(
        F.abs(F.col(t)) == float("inf"), F.lit(0.0)).when(F.col(t) == 0, F.lit(1.0)).otherwise(tail)
    return d.withColumn(name, p).drop("_a", "_b", "_x", "_y")


def point_biserial_test(df: DataFrame, label: str = "churn", cols: Sequence[str] | None = None) -> DataFrame:
    """T5 with the two-sided p-value of H0: r = 0 (t with n-2 dof)."""
    pb = point_biserial(df, label, cols).withColumn("dof", (F.col("n") - 2).cast("double"))
    return t_two_sided(pb).drop("dof")


def histogram_by_class(df: DataFrame, col: str, label: str = "churn", bins: int = 10,
                       log1p: bool = False) -> DataFrame:
    """Equal-width bins over [min, max] (last bin closed), counts and
    density per class."""
    x = F.log1p(F.col(col)) if log1p else F.col(col).cast("double")
    # the range and the bins read these two columns
    d = cut_lineage(df.select(x.alias("x"), F.col(label).alias(label)).where(F.col("x").isNotNull()))
    # one-row range (like numpy's first pass); literals keep the plan narrow
    lo_hi = d.agg(F.min("x"), F.max("x")).first()
    mn, mx = F.lit(lo_hi[0]).cast("double"), F.lit(lo_hi[1]).cast("double")
    width = (mx - mn) / F.lit(bins)
    b = F.least(F.floor(F.try_divide(F.col("x") - mn, mx - mn) * F.lit(bins)), F.lit(bins - 1))
    b = F.coalesce(b, F.lit(0)).cast("int")
    counts = d.groupBy(label, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy(label)
    return counts.select(
        label, "bin", (mn + F.col("bin") * width).alias("lo"), (mn + (F.col("bin") + 1) * width).alias("hi"),
        "count",
        F.try_divide(F.col("count"), F.sum("count").over(w) * width).alias("density"))


def histograms(df: DataFrame, cols: Sequence[str] | None = None, label: str = "churn", bins: int = 25, class_bins: int = 22,
               caps: dict[str, float] | None = None) -> DataFrame:
    """T6 for any number of columns: (series, column, class, bin, lo, hi, count, density).

    Series ``all`` has ``bins`` bins over all rows, ``class`` and ``class_log1p`` have ``class_bins`` per
    class of ``label``, raw and of log(1 + x); every series has its own range (last bin closed; a
    single value takes the middle of a range of length 1). ``caps`` (P15) leaves values above a
    column's cap out. Nulls, and values without a logarithm, count nowhere.

    Two passes: ranges, then counters per (series, column, class, bin); both are partial
    aggregates, so what is shuffled depends on the columns and bins, not on the rows."""
    cols = list(cols or numeric_columns(df, exclude=[label]))
    df = cut_lineage(df.select(label, *cols))  # read by both passes
    body = ", ".join(f"'{c}', " + (f"CASE WHEN `{c}` <= {float(caps[c])} THEN CAST(`{c}` AS DOUBLE) END" if caps and c in caps
                                   else f"CAST(`{c}` AS DOUBLE)") for c in cols)
    long = df.selectExpr(f"CAST(`{label}` AS INT) AS class", f"stack({len(cols)}, {body}) AS (column, v)").where("v IS NOT NULL")
    series = F.array(
        F.struct(F.lit("all").alias("series"), F.lit(None).cast("int").alias("class"), F.col("v").alias("x"), F.lit(bins).alias("bins")),
        F.struct(F.lit("class").alias("series"), F.col("class"), F.col("v").alias("x"), F.lit(class_bins).alias("bins")),
        F.struct(F.lit("class_log1p").alias("series"), F.col("class"), F.log1p("v").alias("x"), F.lit(class_bins).alias("bins")))
    x = long.select("column", F.explode(series).alias("s")).select("column", "s.*").where("x IS NOT NULL AND (series = 'all' OR class IS NOT NULL)")
    keys = ["series", "column", "class"]
    ranges = x.groupBy(*keys).agg(F.min("x").alias("a"), F.max("x").alias("b"), F.count(F.lit(1)).alias("n"))
    # one row per series, column and class
    ranges = ranges.select(*[F.col(k).alias(f"_{k}") for k in keys], "n",
                           F.when(F.col("a") == F.col("b"), F.col("a") - 0.5).otherwise(F.col("a")).alias("mn"),
                           F.when(F.col("a") == F.col("b"), F.col("b") + 0.5).otherwise(F.col("b")).alias("mx"))
    on = (F.col("series") == F.col("_series")) & (F.col("column") == F.col("_column")) & F.col("class").eqNullSafe(F.col("_class"))
    bin_ = F.least(F.floor((F.col("x") - F.col("mn")) / (F.col("mx") - F.col("mn")) * F.col("bins")), F.col("bins") - 1).cast("int")
    counts = x.join(F.broadcast(ranges), on).groupBy(*keys, "bins", "mn", "mx", "n", bin_.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    width = (F.col("mx") - F.col("mn")) / F.col("bins")
    return counts.select(*keys, "bin", (F.col("mn") + F.col("bin") * width).alias("lo"), (F.col("mn") + (F.col("bin") + 1) * width).alias("hi"),
                         "count", (F.col("count") / (F.col("n") * width)).alias("density"))


def recency_ecdf(df: DataFrame, col: str = "recency", label: str = "churn",
                 start: int = 1, stop: int = 50, step: int = 5) -> DataFrame:
    """Per class counts in fixed-width bins [start, stop) (last edge
    closed) and their cumulative share of the class."""
    edges = list(range(start, stop, step))
    nb = len(edges) - 1
    x = F.col(col)
    inside = (x >= edges[0]) & (x <= edges[-1])
    b = F.least(F.floor((x - F.lit(start)) / F.lit(step)), F.lit(nb - 1)).cast("int")
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("class_n"))
    counts = df.where(inside).groupBy(label, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy(label).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)  # <= nb rows per class
    return (counts.join(F.broadcast(sizes), label)
            .select(label, "bin", (F.lit(start) + F.col("bin") * step).alias("lo"), "count",
                    (F.sum("count").over(w) / F.col("class_n")).alias("cum_share")))


def flag_rate_by_class(df: DataFrame, label: str = "churn") -> DataFrame:
    """Share of all rows per (flag, class, value) for 'interval > 7 days'
    (interval truncated to int, null as 0) and 'first sale > 365 days ago'."""
    n = df.select(F.count(F.lit(1))).scalar()
    week = (F.coalesce(F.col("avg_seller_interval"), F.lit(0.0)).cast("int") > 7).cast("int")
    year = (F.col("days_from_first_sell") > 365).cast("int")
    flags = df.select(label, F.explode(F.array(
        F.struct(F.lit("interval_one_week").alias("flag"), week.alias("value")),
        F.struct(F.lit("one_year").alias("flag"), year.alias("value")))).alias("f"))
    return (flags.groupBy("f.flag", label, "f.value").agg(F.count(F.lit(1)).alias("count"))
            .select("flag", label, "value", (F.col("count") / n).alias("share")))


def class_balance(df: DataFrame, label: str = "churn", by: Sequence[str] = ()) -> DataFrame:
    """Class counts and relative frequency, overall or within ``by``."""
    keys = [*by, label]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))  # tiny: classes x groups
    return counts.select(*keys, "count", (F.col("count") / F.sum("count").over(w)).alias("share"))


def shape(df: DataFrame) -> DataFrame:
    """(rows, columns)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(len(df.columns)).alias("n_columns"))


def time_split(df: DataFrame, oot_month: _dt.date, score_month: _dt.date,
               ref: str = "_mt_date_reference") -> DataFrame:
    """Train (< OOT month), oot (== OOT month), score (== scoring month)."""
    r = F.col(ref)
    split = (F.when(r < F.lit(oot_month), "train").when(r == F.lit(oot_month), "oot")
             .when(r == F.lit(score_month), "score"))
    return df.withColumn("split", split).where(F.col("split").isNotNull())


def target_rate(df: DataFrame, label: str = "churn", by: str = "split") -> DataFrame:
    """Mean label per split."""
    return df.groupBy(by).agg(F.avg(F.col(label).cast("double")).alias("target_rate"),
                              F.count(F.lit(1)).alias("n_rows"))


def argmax_history(df: DataFrame, col: str, key: str = "seller_id",
                   order: Sequence[str] = ("_mt_date_reference",)) -> DataFrame:
    """The row holding the max of ``col`` (ties: largest key), then the
    full history of its key (a semi-join, no collect)."""
    top = df.select(F.max_by(F.col(key), F.struct(F.col(col), F.col(key))).alias(key))
    return df.join(F.broadcast(top), key, "left_semi")


def score_by_ref(scored: DataFrame, proba: str = "churn_proba", ref: str = "_mt_date_reference") -> DataFrame:
    """Mean score per reference date."""
    return scored.groupBy(ref).agg(F.avg(proba).alias("mean_proba"), F.count(F.lit(1)).alias("n_rows"))


def describe_full(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """T1 + T2 + T3 side by side (U3): the summary with exact quartiles, sample-adjusted skew and
    kurtosis, and Bowley's skewness, joined on the column name (one row per column)."""
    cols = list(cols or numeric_columns(df))
    df = cut_lineage(df.select(*cols))  # read by the moments and by the quartiles
    q1, q2, q3 = F.col("q25"), F.col("q50"), F.col("q75")
    return describe(df, cols).join(F.broadcast(skew_kurtosis(df, cols)), "column").withColumn(
        "bowley", F.try_divide((q3 - q2) - (q2 - q1), q3 - q1))
