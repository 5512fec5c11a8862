"""T6 for all columns against NumPy."""

import numpy as np
import pytest

from sellerlens.operators import stats as ST


@pytest.mark.parametrize("caps", [None, {"a": 5.0, "same": -1.0}])
def test_histograms_equal_numpy(spark, caps):
    r = np.random.default_rng(5)
    rows = [(float(x) if x > -2 else None, 3.0, int(r.integers(0, 40)), int(r.integers(0, 2)) if i % 17 else None)
            for i, x in enumerate(r.normal(2, 3, 400))]
    df = spark.createDataFrame(rows, "a double, same double, b int, churn int")
    got = ST.histograms(df, ["a", "same", "b"], bins=25, class_bins=22, caps=caps).collect()
    seen = {}
    for x in got:
        seen.setdefault((x.series, x.column, x["class"]), {})[x.bin] = x
    for j, c in enumerate(("a", "same", "b")):
        cap = (caps or {}).get(c, np.inf)
        for series, k, bins in [("all", None, 25)] + [(s, k, 22) for s in ("class", "class_log1p") for k in (0, 1)]:
            v = np.array([x[j] for x in rows if x[j] is not None and x[j] <= cap and (k is None or x[3] == k)], float)
            if series == "class_log1p":
                v = np.log1p(v[v > -1])
            mine = seen.pop((series, c, k), {})
            if not len(v):
                assert not mine
                continue
            counts, edges = np.histogram(v, bins)
            density, _ = np.histogram(v, bins, density=True)
            assert [mine[b]["count"] if b in mine else 0 for b in range(bins)] == counts.tolist()
            for b, x in mine.items():
                assert np.allclose([x.lo, x.hi, x.density], [edges[b], edges[b + 1], density[b]])
    assert not seen


def test_histograms_of_an_empty_table(spark):
    assert ST.histograms(spark.createDataFrame([], "a double, churn int"), ["a"]).count() == 0
