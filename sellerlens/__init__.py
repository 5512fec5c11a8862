"""sellerlens: marketplace seller analytics as Spark DataFrame operators.

Layout
------
sources/    driver-table adapter, landing reads, table store (sources and sinks)
functions/  column-expression helpers (no Python UDFs)
operators/  quality, marts, feature stores, ABT, descriptive queries,
            statistics, evaluation, models, decision step
plans/      multi-step jobs: medallion run, feature-store backfill, named queries
streaming/  optional landing -> bronze file-stream ingest
"""

from .params import Params  # noqa: F401

__all__ = ["Params"]
