"""Plan shape of every registered non-model query."""

import contextlib
import importlib
import io

from conftest import SF

from sellerlens.plans import registry

MODEL_KEYS = {"cv", "rfe", "grid_search", "glm_binomial", "select_by_pvalue", "logistic", "coefficients",
              "lasso", "subset_search", "score", "persist_model", "feature_pipeline", "score_decision"}


def test_no_cartesian_nested_loop_or_row_udf(spark):
    E = importlib.import_module("__spark_entry__")
    bad = {}
    for k, q in ((k, E.queries()[k]) for k in registry.QUERIES):
        if k in MODEL_KEYS:
            continue
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            q(spark, SF).explain()
        plan = buf.getvalue()
        hits = [f for f in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython") if f in plan]
        if "ArrowEvalPython" in plan:
            hits.append("ArrowEvalPython")
        if hits:
            bad[k] = hits
    assert bad == {}
