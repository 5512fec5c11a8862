"""Landing-zone reads and full-load snapshots."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def landing_path(root: str, table: str) -> str:
    """``<source>_<schema>_<table>`` -> ``root/<source>/<schema>/<table>``."""
    source, schema, *rest = table.split("_")
    if not rest:
        raise ValueError(f"table name {table!r} is not <source>_<schema>_<table>")
    return f"{root.rstrip('/')}/{source}/{schema}/{'_'.join(rest)}"


def read_landing(spark: SparkSession, path: str) -> DataFrame | None:
    """Read a landing parquet folder; ``None`` only when the path is missing."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            log.warning("landing path missing: %s", path)
            return None
        raise


def snapshot(df: DataFrame, path: str, run_ts=None) -> None:
    """Full-load snapshot of a source DataFrame, gzip parquet, stamped."""
    ts = F.lit(run_ts) if run_ts is not None else F.current_timestamp()
    (df.withColumn("last_updated_dt", ts)
       .write.mode("overwrite").option("compression", "gzip").parquet(path))
