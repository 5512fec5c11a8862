import numpy as np
import pytest

from sellerlens.operators import stats as ST


@pytest.mark.parametrize("sketch", [20, 2000])
def test_quantiles_count_few_values_one_by_one(spark, monkeypatch, sketch):
    rng = np.random.default_rng(1)
    data = {"a": rng.normal(size=6000), "b": rng.integers(0, 4, 6000).astype(float), "c": np.exp(rng.normal(size=6000) * 4)}
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*data.values())], "a double, b double, c double").repartition(5)
    seen = []
    whole = ST.ordered_cumulative_sums
    monkeypatch.setattr(ST, "SKETCH", sketch)
    monkeypatch.setattr(ST, "ordered_cumulative_sums", lambda c, *a: (seen.append(c.count()), whole(c, *a))[1])
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = {(r.column, r.p): r.q for r in ST.quantiles(ST.to_long(df, list(data)), probs).collect()}
    for c, x in data.items():
        assert [got[c, p] for p in probs] == pytest.approx(list(np.quantile(x, probs)), rel=1e-12)
    if sketch == 2000:
        assert max(seen) < 500  # of 12,004 different values


def test_quantiles_outside_their_brackets_are_counted_in_full(spark, monkeypatch):
    df = spark.createDataFrame([(float(i),) for i in range(1000)], "a double")
    place = ST.F.percentile_approx
    monkeypatch.setattr(ST.F, "percentile_approx", lambda v, p, n: ST.F.transform(place(v, p, n), lambda x: x + 300))
    assert [r.q for r in ST.quantiles(ST.to_long(df, ["a"]), [0.25]).collect()] == [249.75]


def test_correlation_of_pairs_with_nulls_and_constants(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 4)) + [0, 1e6, 0, 5]
    x[:, 3] = 5.0
    rows = [tuple(None if (j == 1 and i % 7 == 0) or (j == 2 and i % 3) else float(v) for j, v in enumerate(r)) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(6)
    got = {(r.column_a, r.column_b): r.corr for r in ST.correlation(df).collect()}
    m = np.array([[np.nan if v is None else v for v in r] for r in rows])
    for i, a in enumerate("abc"):
        for j, b in enumerate("abc"):
            if i < j:
                both = ~np.isnan(m[:, i]) & ~np.isnan(m[:, j])
                assert got[a, b] == pytest.approx(np.corrcoef(m[both, i], m[both, j])[0, 1], abs=1e-9)
    assert len(got) == 6 and all(got[a, "d"] is None for a in "abc")
