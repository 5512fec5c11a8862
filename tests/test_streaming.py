import datetime as dt
import tempfile

from conftest import SF

from sellerlens.operators import quality as Q
from sellerlens.sources import adapter
from sellerlens.sources.tables import TableStore
from sellerlens.streaming.ingest import ingest_landing


def test_stream_ingest_once_and_incremental(spark):
    root = tempfile.mkdtemp(prefix="sellerlens-stream-")
    landing = f"{root}/landing/postgres/public/orders"
    lo = Q.fix_void_columns(adapter.landing_orders(spark, SF))
    lo.write.mode("overwrite").parquet(landing)
    store = TableStore(spark, f"{root}/lake")
    clock = lambda: dt.datetime(2020, 1, 2, 3, 4, 5)
    ckpt = f"{root}/ckpt"
    assert ingest_landing(spark, store, "postgres_public_orders", landing, clock, ckpt) == 1
    n = store.read("bronze", "postgres_public_orders").count()
    assert n == lo.count()
    # nothing new: no batch, same rows
    assert ingest_landing(spark, store, "postgres_public_orders", landing, clock, ckpt) == 0
    assert store.read("bronze", "postgres_public_orders").count() == n


def test_several_drops_on_one_day_keep_all_rows_once(spark):
    root = tempfile.mkdtemp(prefix="sellerlens-stream-")
    landing = f"{root}/landing/t"
    store = TableStore(spark, f"{root}/lake")
    clock = lambda: dt.datetime(2020, 1, 2, 3, 4, 5)
    rows = lambda a, b: spark.range(a, b).selectExpr("id", "CAST(id AS STRING) AS v")
    rows(0, 100).write.parquet(landing)
    ingest_landing(spark, store, "t", landing, clock, f"{root}/ckpt")
    rows(100, 150).write.mode("append").parquet(landing)
    ingest_landing(spark, store, "t", landing, clock, f"{root}/ckpt")
    got = store.read("bronze", "t")
    assert got.count() == 150 and got.select("id").distinct().count() == 150
    # batch 1 once more, a day later: it lands where it was
    again = Q.bronze_batch(rows(100, 150), "t", clock()).selectExpr("*", "1L AS _mt_bronze_batch_id")
    assert store.reload_parts(again, "bronze", "t", {"_mt_bronze_partition_date": dt.date(2020, 1, 2), "_mt_bronze_batch_id": 1}) == 50
    assert store.read("bronze", "t").count() == 150
