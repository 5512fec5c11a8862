"""Batch jobs: landing -> bronze -> silver -> gold, feature stores, ABT.

One run clock (``run_ts``) drives every stamp. Each step hands over through
tables in the store; within a step everything is one Spark plan.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import Params
from ..functions.columns import dates_array
from ..operators import abt as A
from ..operators import features as FS
from ..operators import marts as G
from ..operators import quality as Q
from ..session import ensure_checkpoint_dir, remove_at_exit
from ..sources import adapter
from ..sources.landing import landing_path, read_landing
from ..sources.tables import TableStore, latest_snapshot, missing_refs

BRONZE_PART = "_mt_bronze_partition_date"


def scratch_store(spark: SparkSession, name: str = "run") -> TableStore:
    """A fresh store under the shared ``spark.checkpoint.dir``, removed when the driver ends."""
    root = ensure_checkpoint_dir(spark)
    return TableStore(spark, remove_at_exit(spark, f"{root.rstrip('/')}/sellerlens-{name}-{uuid.uuid4().hex[:12]}"))


# ------------------------------------------------------------------ bronze
def run_bronze(store: TableStore, landing: Mapping[str, DataFrame], run_ts: _dt.datetime) -> dict[str, int]:
    """Stamp each landing batch and reload today's bronze partition (K4):
    running the same day twice leaves one copy."""
    written = {}
    for name, df in landing.items():
        if df is None:
            continue
        batch = Q.bronze_batch(df, name, run_ts)
        n = store.reload_partition(batch, "bronze", name, BRONZE_PART, [run_ts.date()])
        store.log_load(name, n, run_ts, "bronze")
        written[name] = n
    return written


def run_bronze_from_landing(store: TableStore, root: str, tables: Sequence[str], run_ts: _dt.datetime,
                            reload: bool = True) -> dict[str, int]:
    """The daily bronze job (S2, S1, Q5, K8, K4): each table's landing folder becomes today's partition.
    A folder that is missing is skipped and reported. A table that already has today's partition is
    loaded again in its place, or left as it is with ``reload=False`` (a run taken up again)."""
    todo = [t for t in tables if reload or not store.partition_loaded("bronze", t, BRONZE_PART, run_ts.date())]
    return run_bronze(store, {t: read_landing(store.spark, landing_path(root, t)) for t in todo}, run_ts)


# ------------------------------------------------------------------ silver
@dataclass(frozen=True)
class SilverSpec:
    bronze_table: str
    typing: Mapping[str, Sequence[str]]
    key: str = "overwrite"  # overwrite | append | comma-separated upsert keys


SILVER = {
    "postgres_public_orders": SilverSpec("postgres_public_orders", Q.SILVER_ORDERS),
    "postgres_public_order_items": SilverSpec("postgres_public_order_items", Q.SILVER_ITEMS),
}


def silver_frame(store: TableStore, spec: SilverSpec, run_ts: _dt.datetime) -> DataFrame:
    bronze = latest_snapshot(store.read("bronze", spec.bronze_table), BRONZE_PART)
    return Q.stamp_silver(Q.silver_transform(bronze, spec.typing), run_ts.date(), spec.key)


def run_silver(store: TableStore, run_ts: _dt.datetime,
               specs: Mapping[str, SilverSpec] = SILVER) -> dict[str, int]:
    written = {}
    for name, spec in specs.items():
        df = silver_frame(store, spec, run_ts)
        if spec.key in ("overwrite", "append"):
            n = store.write(df, "silver", name, spec.key)
        else:
            n = store.upsert(df, "silver", name, spec.key)
        store.log_load(name, n, run_ts, "silver")
        written[name] = n
    return written


# -------------------------------------------------------------------- gold
GOLD: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
    "postgres_public_sellers_rfm": G.sellers_rfm,
    "postgres_public_sellers_price_selling_days": G.sellers_price_selling_days,
    "postgres_public_sellers_daily_runs": G.sellers_daily_runs,  # G.expand_daily_runs gives the dense rows
}


def run_gold(store: TableStore, run_ts: _dt.datetime,
             marts: Mapping[str, Callable[[DataFrame, DataFrame], DataFrame]] = GOLD) -> dict[str, int]:
    items = store.read("silver", "postgres_public_order_items")
    orders = store.read("silver", "postgres_public_orders")
    written = {}
    for name, fn in marts.items():
        df = Q.stamp_gold(fn(items, orders), run_ts.date(), "overwrite")
        n = store.replace(df, "gold", name)
        store.log_load(name, n, run_ts, "gold")
        written[name] = n
    return written


# ---------------------------------------------------------- feature stores
ABT_TABLE = ("analytics", "abt_seller_churn")
FEATURE_STORES = {
    "fs_seller_purchases": FS.fs_seller_purchases,
    "fs_seller_orders": FS.fs_seller_orders,
}


def refs_frame(spark: SparkSession, refs: Sequence[_dt.date]) -> DataFrame:
    return spark.range(1).select(F.explode(dates_array(refs)).alias(FS.REF))


def run_feature_stores(store: TableStore, orders: DataFrame, items: DataFrame,
                       refs: Sequence[_dt.date], run_ts: _dt.datetime,
                       lookback_months: int = 6, item_scope: str = "seller") -> dict[str, list]:
    """Create each store with every reference date in one pass, or backfill
    only the dates not yet ingested (K9/K10), also in one pass."""
    spark = orders.sparkSession
    done = {}
    for name, fn in FEATURE_STORES.items():
        if store.exists("analytics", name):
            todo_df = missing_refs(refs_frame(spark, refs), store.ingested_refs("analytics", name))
            # the reference-date list is a small parameter-sized list
            todo = sorted(r[0] for r in todo_df.collect())
        else:
            todo = sorted(refs)
        if todo:
            df = fn(orders, items, todo, lookback_months, item_scope=item_scope,
                    run_ts=F.lit(run_ts).cast("timestamp_ntz"))
            if store.exists("analytics", name):
                n = store.append(df, "analytics", name, [FS.REF], partition_values=todo, distribution="hash")
            else:
                n = store.create(df, "analytics", name, [FS.REF], distribution="hash")
            store.log_load(name, n, run_ts, "analytics")
        done[name] = todo
    return done


def run_abt(store: TableStore, orders: DataFrame, items: DataFrame, refs: Sequence[_dt.date],
            run_ts: _dt.datetime, churn_days: int = 45) -> int:
    p = store.read("analytics", "fs_seller_purchases")
    s = store.read("analytics", "fs_seller_orders")
    feats = A.abt_features(p, s, churn_days)
    first = A.first_sale_on_or_after(orders, items, refs)
    ok = F.datediff("first_sale", FS.REF) <= (F.lit(churn_days) - F.col("recency"))
    df = (feats.join(first, [FS.REF, "seller_id"], "left")
          .select(*A.ABT_FEATURES, F.when(ok, 0).otherwise(1).alias("churn")))
    # partitioned by reference date: train / out-of-time / scoring reads prune
    n = store.replace(df, "analytics", ABT_TABLE[1], [FS.REF], distribution="hash")
    store.log_load("abt_seller_churn", n, run_ts, "analytics")
    return n


# ------------------------------------------------------------- stored ABT
_abts: dict[tuple, tuple[TableStore, list[str]]] = {}


def input_state(spark: SparkSession, paths: Sequence[str]) -> str:
    """A digest of the names, lengths and change times of all files below ``paths``."""
    digest, sc = hashlib.sha256(), spark.sparkContext
    for path in paths:
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        found, files = p.getFileSystem(sc._jsc.hadoopConfiguration()).listFiles(p, True), []
        while found.hasNext():
            f = found.next()
            files.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
        digest.update("\n".join([*sorted(files), ""]).encode())
    return digest.hexdigest()


def stored_abt(spark: SparkSession, sf_dir: str, params: Params) -> DataFrame:
    """The ABT of these parameters and input files, stored by month and written once in an
    application; statistics and models read it with column pruning and month filters. Changed
    input files, or other parameters that the ABT depends on, make a new one."""
    key = (spark.sparkContext.applicationId, tuple(params.refs), params.lookback_months, params.churn_days, params.item_scope,
           input_state(spark, [adapter.path_of(sf_dir, t) for t in ("orders", "lineitem")]))
    store, columns = _abts.get(key, (None, None))
    if store is None or not store.exists(*ABT_TABLE):
        abt = A.abt_seller_churn(*adapter.load(spark, sf_dir), params.refs, params.lookback_months, params.churn_days, params.item_scope)
        store, columns = scratch_store(spark, "abt"), abt.columns
        store.replace(abt, *ABT_TABLE, [FS.REF], distribution="hash")
        _abts[key] = store, columns
    return store.read(*ABT_TABLE).select(*columns)


def forget_stored_abts() -> None:
    """The next reader builds its ABT anew (for measuring; files go when the driver ends)."""
    _abts.clear()


def has_stored_abt() -> bool:
    return bool(_abts)
