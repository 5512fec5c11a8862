"""Model layer against small NumPy solvers on the pipeline's own features."""

import collections
import datetime as dt
import itertools
import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from sellerlens.operators import logit
from sellerlens.operators import model as MD
from sellerlens.operators import subsets as SB
from sellerlens.operators.scaling import MIN_MAX, ROBUST, ColumnScaler


@pytest.fixture(scope="module")
def abt(spark):
    r = np.random.default_rng(7)
    names = MD.feature_names()
    rows = []
    for i in range(300):
        x = np.round(np.abs(r.normal(10, 4, len(names))), 3)
        y = int(1 / (1 + np.exp(-(0.4 * (x[0] - 10) - 0.5 * (x[7] - 10) + r.normal()))) > 0.5)
        rows.append((dt.date(1998, 1, 1), i, int(abs(x[1])), *map(float, x), y))
    cols = ", ".join(f"{n} double" for n in names)
    return spark.createDataFrame(rows, f"_mt_date_reference date, seller_id long, recency int, {cols}, churn int").cache()


def matrix(df):
    rows = MD.build_pipeline().fit(df).transform(df).select("features", "churn").collect()
    return np.array([r.features.toArray() for r in rows]), np.array([r.churn for r in rows], float)


def newton(x, y, ridge, steps=100):
    """Logistic regression; ``ridge`` per coefficient (0 leaves one free)."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        w -= np.linalg.solve(h, x.T @ (p - y) + ridge * w)
    return w


def test_feature_groups_are_disjoint_and_leave_the_label_source_out():
    full = set(MD.ROBUST_FEATURES) | set(MD.MINMAX_FEATURES)
    assert len(full) == len(MD.feature_names()) == 24 and not full & set(MD.DROPPED)
    assert set(MD.REDUCED_ROBUST_FEATURES) <= set(MD.ROBUST_FEATURES) and set(MD.REDUCED_MINMAX_FEATURES) <= set(MD.MINMAX_FEATURES)


def test_logistic_equals_newton(abt):
    c, n = 0.5, abt.count()
    m = MD.build_pipeline(MD.logistic(c, n)).fit(abt)
    got = {r.feature: r.coefficient for r in MD.coefficients(m, MD.feature_names()).collect()}
    x, y = matrix(abt)
    w = newton(np.column_stack([x, np.ones(n)]), y, np.append(np.full(x.shape[1], 1 / c), 0.0))
    assert np.allclose([got[f] for f in [*MD.feature_names(), "intercept"]], w, atol=5e-3)


def test_glm_equals_newton_without_intercept(abt):
    """Without a ridge; a feature that others determine and one without spread are named as dropped."""
    last, twin = MD.feature_names()[2], MD.feature_names()[1]
    df = abt.withColumns({twin: F.col("avg_ticket") * 2 + 3, last: F.lit(0.0)})
    got = {r.feature: r for r in MD.glm_binomial(df).collect()}
    x, y = matrix(df)
    keep = [i for i, f in enumerate(MD.feature_names()) if not got[f].dropped]
    assert {f for f in got if got[f].dropped} == {twin, last}
    w = newton(x[:, keep], y, np.zeros(len(keep)))
    p = 1 / (1 + np.exp(-x[:, keep] @ w))
    se = np.sqrt(np.diag(np.linalg.inv((x[:, keep] * (p * (1 - p))[:, None]).T @ x[:, keep])))
    names = [MD.feature_names()[i] for i in keep]
    assert np.allclose([got[f].coefficient for f in names], w, rtol=1e-6, atol=1e-8)
    assert np.allclose([got[f].std_error for f in names], se, rtol=1e-6)
    assert np.allclose([got[f].p_value for f in names], [math.erfc(abs(a / b) / math.sqrt(2)) for a, b in zip(w, se)], atol=1e-9)


def plain_auc(y, s):
    pos, neg = s[y == 1][:, None], s[y == 0][None, :]
    return ((pos > neg) + 0.5 * (pos == neg)).mean()


def test_rfe_ranks_equal_numpy(abt):
    k, c = 4, 100.0
    folded = MD.stratified_folds(abt, k).cache()
    rows = MD.build_pipeline().fit(folded).transform(folded).select("features", "churn", "fold").collect()
    x, y, fold = np.array([r.features.toArray() for r in rows]), np.array([r.churn for r in rows], float), np.array([r.fold for r in rows])

    def chain(use):
        current, out = list(range(x.shape[1])), []
        while current:
            z = np.column_stack([x[use][:, current], np.ones(use.sum())])
            w = newton(z, y[use], np.append(np.full(len(current), 1 / c), 0.0))
            out.append((list(current), w))
            current.remove(current[int(np.abs(w[:-1]).argmin())])
        return out

    aucs = [[plain_auc(y[fold == f], np.column_stack([x[fold == f][:, cur], np.ones((fold == f).sum())]) @ w) for cur, w in chain(fold != f)] for f in range(k)]
    mean = dict(zip(range(x.shape[1], 0, -1), np.mean(aucs, axis=0)))
    best = min(mean, key=lambda n: (-round(mean[n], 9), n))
    whole = chain(np.ones(len(y), bool))
    gone = [next(j for j in cur if i + 1 == len(whole) or j not in whole[i + 1][0]) for i, (cur, _) in enumerate(whole)]
    want = {MD.feature_names()[j]: (1 if n <= best else n - best + 1, mean[n]) for n, j in zip(range(x.shape[1], 0, -1), gone)}
    got = MD.rfe(abt, c, k).collect()
    assert {r.feature: r.ranking for r in got} == {f: r for f, (r, _) in want.items()}
    assert np.allclose([r.mean_auc_at_size for r in got], [want[r.feature][1] for r in got], atol=1e-6)
    first = MD.rfe(abt, c, k, select_ranks=[1]).collect()
    assert {r.feature for r in first} == {r.feature for r in got if r.ranking == 1}


def test_folds_hold_equal_parts_of_every_class(abt):
    k = 7
    got = collections.Counter((r.churn, r.fold) for r in MD.stratified_folds(abt, k).select("churn", "fold").collect())
    for label in (0, 1):
        sizes = [got[label, f] for f in range(k)]
        assert max(sizes) - min(sizes) <= 1
    one = {r.seller_id: r.fold for r in MD.stratified_folds(abt, k).collect()}
    assert one == {r.seller_id: r.fold for r in MD.stratified_folds(abt.repartition(9), k).collect()}


def test_reduced_logistic_equals_newton(abt):
    table = MD.glm_binomial(abt)
    kept = [r.feature for r in MD.select_by_pvalue(table, 0.2).collect()]
    got = {r.feature: r.coefficient for r in MD.reduced_logistic(abt, table, 0.2, 0.5).collect()}
    x, y = matrix(abt)
    at = [MD.feature_names().index(f) for f in kept]
    w = newton(np.column_stack([x[:, at], np.ones(len(y))]), y, np.append(np.full(len(at), 2.0), 0.0))
    assert 0 < len(kept) < 24 and np.allclose([got[f] for f in [*kept, "intercept"]], w, atol=1e-6)


def test_collinear_columns_are_found_in_order():
    r = np.random.default_rng(1)
    x = r.normal(size=(50, 4))
    x = np.column_stack([x[:, 0], x[:, 1], x[:, 0] - 3 * x[:, 1], np.zeros(50), 1e6 * x[:, 2], x[:, 3], x[:, 3]])
    assert logit.independent(x.T @ x) == [0, 1, 4, 5]


def test_grouped_auc_equals_pairs(spark):
    r = np.random.default_rng(3)
    rows = [(int(g), float(r.integers(0, 2)), float(r.integers(0, 9))) for g in r.integers(0, 3, 200)] + [(9, 1.0, 2.0)]
    got = {x.g: x.auc for x in logit.grouped_auc(spark.createDataFrame(rows, "g int, y double, score double"), ["g"]).collect()}
    for g in range(3):
        y, s = (np.array([x[i] for x in rows if x[0] == g]) for i in (1, 2))
        assert abs(got[g] - plain_auc(y, s)) < 1e-12
    assert got[9] is None


def test_lasso_equals_coordinate_descent(abt):
    alpha = 0.01
    got = {r.feature: r.coefficient for r in MD.lasso(abt, alpha).collect()}
    x, y = matrix(abt)
    x, y = x - x.mean(0), y - y.mean()
    w = np.zeros(x.shape[1])
    for _ in range(2000):
        for j in range(len(w)):
            rho = x[:, j] @ (y - x @ w + x[:, j] * w[j]) / len(y)
            w[j] = np.sign(rho) * max(abs(rho) - alpha, 0) / (x[:, j] @ x[:, j] / len(y))
    assert np.allclose([got[f] for f in MD.feature_names()], w, atol=2e-3)


def test_folds_elimination_and_grid(abt):
    n = abt.count()
    cv = MD.cv(abt, abt, lambda: MD.logistic(1.0, n), k=2, test=abt).collect()
    assert sorted(r.fold for r in cv) == [-1, 0, 1] and all(r.auc_train > 0.8 and r.auc_test > 0.8 for r in cv)
    assert all(r.auc_valid == r.auc_test for r in cv if r.fold == -1)


def test_grid_search_equals_one_fit_per_point(abt):
    """Every point of every fold against a plain fit on features that were prepared on the fold's training rows."""
    k, c = 3, 0.5
    got = {(r.C, r.penalty, r.class_weight): r for r in MD.grid_search(abt, (c,), ("l2", "none"), (True, False), k).collect()}
    assert set(got) == {(c, "l2", "balanced"), (c, "l2", "none"), (None, "none", "balanced"), (None, "none", "none")}
    folded = MD.stratified_folds(abt, k).cache()
    held, train = [], []
    for f in range(k):
        rows = MD.build_pipeline().fit(folded.where(F.col("fold") != f)).transform(folded).select("features", "churn", "fold").collect()
        x = np.column_stack([np.array([r.features.toArray() for r in rows]), np.ones(len(rows))])
        y, use = np.array([r.churn for r in rows], float), np.array([r.fold != f for r in rows])
        share = use.sum() / (2 * np.array([(y[use] == 0).sum(), (y[use] == 1).sum()]))
        w = np.zeros(x.shape[1])
        ridge = np.append(np.full(x.shape[1] - 1, 1 / c), 0.0)
        for _ in range(60):
            p = 1 / (1 + np.exp(-x[use] @ w))
            s = share[y[use].astype(int)]
            w -= np.linalg.solve((x[use] * (s * p * (1 - p))[:, None]).T @ x[use] + np.diag(ridge), x[use].T @ (s * (p - y[use])) + ridge * w)
        held.append(plain_auc(y[~use], x[~use] @ w))
        train.append(plain_auc(y[use], x[use] @ w))
    r = got[c, "l2", "balanced"]
    assert np.allclose([r.mean_auc, r.std_auc, r.mean_auc_train, r.std_auc_train],
                       [np.mean(held), np.std(held), np.mean(train), np.std(train)], atol=1e-6)
    assert all(r.mean_auc_train >= r.mean_auc - 0.05 for r in got.values())


def test_scaler_is_exact_and_survives_saving(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 5.0, 7, None), (2.0, 5.0, 9, None), (4.0, 5.0, 3, None), (None, 5.0, 3, None)],
                               "a double, flat double, n int, empty double")
    stage = ColumnScaler(["a", "flat", "n", "empty", "n"], ["sa", "sf", "sn", "se", "sr"], [ROBUST, ROBUST, MIN_MAX, ROBUST, ROBUST])
    model = Pipeline(stages=[stage]).fit(df)
    model.write().overwrite().save(str(tmp_path / "p"))
    for m in (model, PipelineModel.load(str(tmp_path / "p"))):
        got = [tuple(r) for r in m.transform(df).orderBy(F.asc_nulls_last("a")).select("sa", "sf", "sn", "se", "sr").collect()]
        # quartiles of a: 1.5, 2, 3; of n: 3, 5, 7.5
        assert got == [(-1 / 1.5, 0.0, 4 / 6, None, 2 / 4.5), (0.0, 0.0, 1.0, None, 4 / 4.5), (2 / 1.5, 0.0, 0.0, None, -2 / 4.5), (None, 0.0, 0.0, None, -2 / 4.5)]
    Pipeline(stages=[stage]).write().overwrite().save(str(tmp_path / "e"))
    again = Pipeline.load(str(tmp_path / "e")).fit(df).transform(df)
    assert again.agg(F.sum("sa")).first()[0] == model.transform(df).agg(F.sum("sa")).first()[0]
    with pytest.raises(ValueError):
        ColumnScaler(["a"], ["b"], ["other"])


def test_saved_model_scores_alike(abt, tmp_path):
    m = MD.build_pipeline(MD.logistic(1.0, abt.count())).fit(abt)
    MD.save_model(m, str(tmp_path / "m"))
    one, two = (sorted(map(tuple, MD.score(x, abt).collect())) for x in (m, MD.load_model(str(tmp_path / "m"))))
    assert one == two and len(one) == 300


def test_subsets_go_from_the_whole_set_to_single_features():
    want = sorted((c for n in range(1, 5) for c in itertools.combinations(range(4), n)), key=lambda c: (len(c), c), reverse=True)
    assert list(SB.subsets(4)) == want and list(SB.subsets(0)) == []


def test_subset_search_equals_one_fit_per_subset_and_fold(spark, abt):
    names, k = ["avg_ticket", "avg_order_product", "quantity_date_orders"], 3
    train, test, oot = (abt.where(F.pmod("seller_id", F.lit(3)) == i) for i in range(3))
    got = {(r.comb_idx, r.metric): r for r in SB.subset_search(train, test, oot, names, k=k, batch=3).collect()}
    assert len(got) == 7 * 3 and got[0, "auc_train"].features == names
    prep, at = MD.build_pipeline().fit(train), [MD.feature_names().index(n) for n in names]

    def part(df):
        rows = prep.transform(df).select("features", "churn").collect()
        return np.array([r.features.toArray()[at] for r in rows]), np.array([r.churn for r in rows], float)

    rows = prep.transform(MD.stratified_folds(train, k)).select("features", "churn", "fold").collect()
    x, y, fold = np.array([r.features.toArray()[at] for r in rows]), np.array([r.churn for r in rows], float), np.array([r.fold for r in rows])
    others = {"auc_test": part(test), "auc_oot": part(oot)}
    for i, s in enumerate(SB.subsets(3)):
        aucs = {m: [] for m in SB.PARTS}
        for f in [*range(k), -1]:
            use, cols = fold != f, list(s)
            w = newton(x[use][:, cols], y[use], np.zeros(len(s)))
            for m, (xs, ys) in {"auc_train": (x[use], y[use]), **others}.items():
                aucs[m].append(plain_auc(ys, np.rint(1000 / (1 + np.exp(-xs[:, cols] @ w)))))
        for m, a in aucs.items():
            r = got[i, m]
            assert r.features == [names[j] for j in s] and np.allclose([r.min, r.mean, r.max], [min(a), np.mean(a), max(a)], atol=1e-9)


def test_subset_search_limits_and_empty_sides(spark, abt):
    nothing = abt.where("false")
    got = SB.subset_search(abt, nothing, abt.where("churn = 1"), ["ltv", "frequency"], k=2, max_subsets=2, batch=1).collect()
    assert [(r.comb_idx, r.n_features, r.metric) for r in got] == [(i, 2 - i, m) for i in range(2) for m in SB.PARTS]
    assert all((r.mean is None) == (r.metric != "auc_train") for r in got)
    assert SB.subset_search(abt, abt, abt, []).collect() == []
