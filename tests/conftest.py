import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[4]").appName("sellerlens-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="sellerlens-test-ckpt-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


def ts(s):
    return dt.datetime.fromisoformat(s)


def d(s):
    return dt.date.fromisoformat(s)


ORDERS_SCHEMA = ("order_id long, customer_id long, order_status string, order_purchase_timestamp timestamp_ntz, "
                 "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
                 "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz")
ITEMS_SCHEMA = ("order_id long, order_item_id int, product_id long, seller_id long, price double, "
                "freight_value double, shipping_limit_date timestamp_ntz")


def make_orders(spark, rows):
    """rows: (order_id, status, purchase, approved=None, delivered=None, estimated=None, customer=1)."""
    out = []
    for r in rows:
        oid, status, purchase, *rest = r
        approved = rest[0] if len(rest) > 0 else None
        delivered = rest[1] if len(rest) > 1 else None
        estimated = rest[2] if len(rest) > 2 else None
        cust = rest[3] if len(rest) > 3 else 1
        f = lambda x: ts(x) if isinstance(x, str) else x
        out.append((oid, cust, status, f(purchase), f(approved), None, f(delivered), f(estimated)))
    return spark.createDataFrame(out, ORDERS_SCHEMA)


def make_items(spark, rows):
    """rows: (order_id, order_item_id, product_id, seller_id, price, freight=0.0)."""
    out = [(r[0], r[1], r[2], r[3], float(r[4]), float(r[5]) if len(r) > 5 else 0.0, None) for r in rows]
    return spark.createDataFrame(out, ITEMS_SCHEMA)
