"""Landing -> bronze as an incremental file stream.

The landing folder receives full-load parquet drops. A file-source stream
with ``trigger(availableNow=True)`` picks up only files not seen before (the
stream checkpoint in ``spark.checkpoint.dir`` remembers them), and each
micro-batch goes through the same bronze steps as the batch job: checks,
void fix, stamps, then a dynamic overwrite of its own (day, batch) partition.
Several drops on one day stand side by side, and a retried micro-batch, which
keeps its id and its first run's day, rewrites its own rows alone.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..session import ensure_checkpoint_dir
from ..sources.tables import TableStore

BRONZE_PART = "_mt_bronze_partition_date"
BATCH_PART = "_mt_bronze_batch_id"


def _day_of(store: TableStore, table: str, batch_id: int) -> _dt.date | None:
    """The day under which a retried batch has been written before."""
    if not store.exists("bronze", table):
        return None
    row = store.read("bronze", table).where(F.col(BATCH_PART) == batch_id).agg(F.min(BRONZE_PART)).first()
    return row[0]


def ingest_landing(spark: SparkSession, store: TableStore, table: str, landing_path: str,
                   clock: Callable[[], _dt.datetime] = _dt.datetime.now,
                   checkpoint: str | None = None) -> int:
    """Run the stream until every available file is processed; returns the
    number of non-empty micro-batches written."""
    schema = spark.read.parquet(landing_path).schema
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/bronze_{table}"
    written = []

    def to_bronze(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        run_ts = clock()
        day = _day_of(store, table, batch_id) or run_ts.date()
        stamped = Q.bronze_batch(batch, table, _dt.datetime.combine(day, run_ts.time()))
        n = store.reload_parts(stamped.withColumn(BATCH_PART, F.lit(batch_id).cast("long")), "bronze", table,
                               {BRONZE_PART: day, BATCH_PART: batch_id})
        store.log_load(table, n, run_ts, "bronze")
        written.append(batch_id)

    q = (spark.readStream.schema(schema).parquet(landing_path)
         .writeStream.foreachBatch(to_bronze)
         .option("checkpointLocation", ckpt)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return len(written)
