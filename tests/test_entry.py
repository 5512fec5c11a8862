import importlib
import sys
import warnings

from conftest import SF


def test_entry_runs_at_smoke_scale(spark):
    E = importlib.import_module("__spark_entry__")
    df = E.entry(spark)
    assert df.count() > 0
    assert "churn" in df.columns


def test_every_oracle_key_is_a_query():
    E = importlib.import_module("__spark_entry__")
    assert set(E.oracle_sql()) <= set(E.queries())


def test_some_queries_run(spark):
    E = importlib.import_module("__spark_entry__")
    q = E.queries()
    for k in ("sellers_rfm", "cohort", "seller_pareto", "budget_optimal", "threshold_metrics"):
        assert q[k](spark, SF).count() > 0, k


def test_a_missing_module_of_the_optional_queries_costs_only_these(monkeypatch):
    """The library's keys stay when the subpackage, or something that it needs, cannot be imported."""
    E = importlib.import_module("__spark_entry__")
    for gone in ("corpus_pipeline", "sellerlens.llm", "public_tokenizers"):
        with monkeypatch.context() as m:
            for name in [n for n in sys.modules if n == "corpus_pipeline" or n.startswith("sellerlens.llm")]:
                m.delitem(sys.modules, name)
            m.setitem(sys.modules, gone, None)
            with warnings.catch_warnings(record=True):
                warnings.simplefilter("always")
                again = importlib.reload(E)
            assert not any(k.startswith("op") and "_" in k and k[2].isdigit() for k in again.queries()) and "abt_seller_churn" in again.queries()
    importlib.reload(E)
