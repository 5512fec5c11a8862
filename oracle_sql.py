"""Independent DuckDB SQL for the correctness gate.

Each statement re-derives the marketplace tables from the driver views
(``orders``, ``lineitem``) with the FIXTURES.md adapter and then computes each
(``sales``): item rows meet every reference date whose window holds them, days
between sales come from sorted day lists, the next sale from an ASOF join. The
Spark plans use closed forms and one-pass routing instead, and constants are
spelt out here, so a slip on either side shows.
"""

from __future__ import annotations

import datetime as _dt

from sellerlens import Params

P = Params()


def _d(x: _dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


def _t(x: _dt.date) -> str:
    return f"TIMESTAMP '{x.isoformat()} 00:00:00'"


def _orders_cte(name="so"):
    return f"""{name} AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
    CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'O' THEN 'PROCESSING'
      ELSE CASE WHEN o_orderkey % 40 = 0 THEN 'CREATED' ELSE 'CANCELED' END END AS order_status,
    CAST(o_orderdate AS TIMESTAMP) + to_seconds(CAST((o_orderkey * 37) % 86400 AS BIGINT)) AS order_purchase_timestamp,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL
      ELSE CAST(o_orderdate AS TIMESTAMP) + to_days(CAST(o_orderkey % 4 AS INTEGER)) END AS order_approved_at,
    CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS TIMESTAMP) + to_days(CAST(o_orderkey % 20 AS INTEGER)) END AS order_delivered_carrier_date,
    CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS TIMESTAMP) + to_days(CAST(o_orderkey % 40 AS INTEGER)) END AS order_delivered_customer_date,
    CAST(o_orderdate AS TIMESTAMP) + INTERVAL 20 DAY AS order_estimated_delivery_date
  FROM orders)"""


def _items_cte(name="si", seller="l_partkey", product="l_suppkey"):
    return f"""{name} AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, {product} AS product_id,
    {seller} AS seller_id, l_extendedprice AS price, l_quantity AS freight_value,
    CAST(l_shipdate AS TIMESTAMP) AS shipping_limit_date
  FROM lineitem)"""


ADAPTER = _orders_cte() + ",\n" + _items_cte()
ADAPTER_GRID = _orders_cte() + ",\n" + _items_cte("si", "l_suppkey", "l_partkey")
# one row per sold item with its order's facts; amount = price x position in the order
_SALES = """sales AS (
  SELECT si.*, so.* EXCLUDE (order_id), order_purchase_timestamp::DATE AS day, price * order_item_id AS amount
  FROM si LEFT JOIN so USING (order_id))"""
SALES = f"{ADAPTER},\n{_SALES}"
WS, WE = _t(P.window_start), _t(P.window_end)


# Averages of cent amounts over 2^k*5^j rows are exact decimal ties at the 7th
# place; the two engines' last-bit differences would round them apart. A nudge
# far below the 6th decimal and far above summation error moves the edge off
# every such tie. Used identically on both sides.
NUDGE = 2.5e-8


def rounded(sql: str, cols: list[str], digits: int = 6) -> str:
    if not cols:
        return sql
    rep = ", ".join(f"round({c} + {NUDGE}, {digits}) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) q"


def _refs_cte(refs=P.refs) -> str:
    vals = ", ".join(f"({_d(r)})" for r in refs)
    return f"refs AS (SELECT r AS ref FROM (VALUES {vals}) t(r))"


# ------------------------------------------------------------------ marts
SELLERS_RFM = f"""WITH {SALES}
SELECT seller_id, (max(day) - min(day))::INTEGER AS recency, count(DISTINCT order_id) AS frequency, max(amount) AS monetary,
  coalesce(count(DISTINCT order_id)::DOUBLE / nullif((max(day) - min(day))::INTEGER, 0), 0) AS frequency_recency,
  max(amount) / nullif(count(DISTINCT order_id), 0) AS monetary_frequency
FROM sales WHERE seller_id IS NOT NULL GROUP BY seller_id"""

# each selling day with its predecessor, by position in the seller's sorted list of days
SELLERS_PRICE_SELLING_DAYS = f"""WITH {SALES},
best AS (SELECT seller_id, day, max(amount) AS top FROM sales WHERE seller_id IS NOT NULL GROUP BY ALL),
lists AS (SELECT seller_id, list(day ORDER BY day) AS ds, list(top ORDER BY day) AS ms FROM best GROUP BY seller_id),
rows_ AS (SELECT *, unnest(range(1, len(ds) + 1)) AS k FROM lists)
SELECT seller_id, ds[k] AS date_selled, ms[k] AS monetary,
  CASE WHEN k > 1 THEN ds[k - 1] END AS lag_date, CASE WHEN k > 1 THEN ms[k - 1] END AS lag_price,
  CASE WHEN k > 1 THEN (ds[k] - ds[k - 1])::INTEGER END AS diff_selling_days,
  CASE WHEN k > 1 THEN ms[k] - ms[k - 1] END AS diff_monetary
FROM rows_"""

# the sparse sums and a zero row for every selling day of the calendar, added up
SELLERS_INTERMITTENT_DAILY = f"""WITH {ADAPTER_GRID},
{_SALES},
calendar AS (SELECT list(DISTINCT order_purchase_timestamp::DATE) AS days FROM so),
padded AS (
  SELECT seller_id, day, amount FROM sales WHERE day IS NOT NULL AND seller_id IS NOT NULL
  UNION ALL SELECT s.seller_id, unnest(c.days), 0 FROM (SELECT DISTINCT seller_id FROM si) s, calendar c),
daily AS (SELECT seller_id, day AS date, sum(amount) AS monetary FROM padded GROUP BY ALL)
SELECT seller_id, date, monetary, monetary - lag(monetary) OVER one AS diff_monetary
FROM daily WINDOW one AS (PARTITION BY seller_id ORDER BY date)"""

# the dense grid of the common seller key, cut where a day sells, follows a sale, or follows such a day
SELLERS_DAILY_RUNS = f"""WITH {SALES},
calendar AS (SELECT DISTINCT order_purchase_timestamp::DATE AS day FROM so WHERE order_purchase_timestamp IS NOT NULL),
sold AS (SELECT seller_id, day, sum(amount) AS amount FROM sales WHERE day IS NOT NULL GROUP BY ALL),
grid AS (
  SELECT s.seller_id, c.day, sold.day IS NOT NULL AS sells, coalesce(sold.amount, 0) AS monetary
  FROM (SELECT DISTINCT seller_id FROM si) s CROSS JOIN calendar c LEFT JOIN sold ON sold.seller_id = s.seller_id AND sold.day = c.day),
seen AS (
  SELECT *, monetary - lag(monetary) OVER one AS diff_monetary,
    NOT sells AND NOT coalesce(lag(sells) OVER one, true) AS quiet FROM grid WINDOW one AS (PARTITION BY seller_id ORDER BY day)),
cut AS (
  SELECT *, NOT quiet OR NOT lag(quiet) OVER one AS opens FROM seen WINDOW one AS (PARTITION BY seller_id ORDER BY day)),
numbered AS (SELECT *, sum(opens::INTEGER) OVER (PARTITION BY seller_id ORDER BY day) AS run FROM cut)
SELECT seller_id, min(day) AS date_from, max(day) AS date_to, count(*)::INTEGER AS n_days,
  any_value(monetary) AS monetary, any_value(diff_monetary) AS diff_monetary FROM numbered GROUP BY seller_id, run"""

# ------------------------------------------------------------ descriptive
_COHORT_BODY = f"""active AS (
  SELECT DISTINCT seller_id, date_trunc('month', day)::DATE AS m FROM sales
  WHERE order_purchase_timestamp BETWEEN {WS} AND {_t(P.cohort_end)} - INTERVAL 1 MICROSECOND
    AND seller_id IS NOT NULL AND order_status = 'DELIVERED'
    AND order_delivered_customer_date::DATE > order_approved_at::DATE),
aged AS (SELECT seller_id, m, min(m) OVER (PARTITION BY seller_id) AS born FROM active),
cohorts AS (
  SELECT born AS cohort_date, (date_diff('month', born, m) + 1)::INTEGER AS cohort_index, count(*) AS seller_id
  FROM aged GROUP BY ALL)"""

COHORT = f"WITH {SALES},\n{_COHORT_BODY}\nSELECT * FROM cohorts"

COHORT_RETENTION = f"""WITH {SALES},
{_COHORT_BODY}
SELECT cohort_date, cohort_index,
  round(seller_id::DOUBLE / max(seller_id) FILTER (cohort_index = 1) OVER (PARTITION BY cohort_date), 3) AS retention
FROM cohorts"""


def _cohort_pivot() -> str:
    from sellerlens.operators.descriptive import months_in_window
    n = months_in_window(P.window_start, P.cohort_end)
    cols = ", ".join(f'MAX(CASE WHEN cohort_index = {k} THEN seller_id END) AS "{k}"' for k in range(1, n + 1))
    return f"WITH {SALES},\n{_COHORT_BODY}\nSELECT cohort_date, {cols} FROM cohorts GROUP BY cohort_date"


_FLAGGED = f"order_purchase_timestamp BETWEEN {WS} AND {WE} - INTERVAL 1 MICROSECOND AND order_status = 'CREATED'"
SUSPICIOUS_ORDERS = f"""WITH {ADAPTER}
SELECT so.order_id, si.order_id AS order_id_item, order_purchase_timestamp
FROM si RIGHT JOIN so USING (order_id) WHERE {_FLAGGED}"""

SUSPICIOUS_CUSTOMERS = f"""WITH {ADAPTER}
SELECT * FROM (SELECT *, count(*) FILTER ({_FLAGGED}) OVER (PARTITION BY customer_id) AS n_flagged_orders FROM so)
WHERE n_flagged_orders > 0"""

STUCK_PROCESSING = f"""WITH {ADAPTER}
SELECT order_id, customer_id, order_purchase_timestamp, order_approved_at, order_estimated_delivery_date,
  CAST(date_diff('day', CAST(order_approved_at AS DATE), {_d(P.stuck_date)}) AS INTEGER) AS days_in_processing
FROM so
WHERE order_purchase_timestamp >= {WS} AND order_purchase_timestamp < {WE} AND order_status = 'PROCESSING'
ORDER BY order_purchase_timestamp"""

LOOKUP = f"WITH {ADAPTER}\nSELECT * FROM si WHERE order_id = {P.lookup_order_id}"
LOOKUP_SELLER = f"WITH {ADAPTER}\nSELECT * FROM si WHERE seller_id = {P.lookup_seller_id}"

# running totals in the months with sales, zero in the other months that anybody sold in
MONTHLY_LTV = f"""WITH {SALES},
earned AS (
  SELECT seller_id, date_trunc('month', day)::DATE AS m, sum(amount) AS got FROM sales
  WHERE order_purchase_timestamp BETWEEN {WS} AND {WE} - INTERVAL 1 MICROSECOND AND seller_id IS NOT NULL
    AND order_status = 'DELIVERED' AND order_delivered_customer_date > order_approved_at
  GROUP BY ALL),
running AS (SELECT a.seller_id, a.m, sum(b.got) AS total FROM earned a JOIN earned b ON a.seller_id = b.seller_id AND b.m <= a.m GROUP BY ALL),
every AS (SELECT seller_id, unnest(ms) AS m FROM (SELECT DISTINCT seller_id FROM earned), (SELECT list(DISTINCT m) AS ms FROM earned))
SELECT every.seller_id, every.m AS order_month_purchase, coalesce(running.total, 0) AS forecast_ltv
FROM every LEFT JOIN running USING (seller_id, m)"""

MIN_MAX_ORDERS = f"""WITH {ADAPTER}
SELECT MIN(order_purchase_timestamp) AS first_purchase, MAX(order_purchase_timestamp) AS last_purchase FROM so"""

PRODUCT_SALES = f"""WITH {ADAPTER}
SELECT o.order_id, i.product_id, o.order_purchase_timestamp, i.freight_value, i.seller_id, i.price
FROM si i INNER JOIN so o ON o.order_id = i.order_id
WHERE i.product_id = {P.lookup_product_id}"""

ORDERS_TIME_SERIES = f"""WITH {ADAPTER}
SELECT left(order_purchase_timestamp::VARCHAR, 7) AS year_month, count(order_id) AS n_orders FROM so GROUP BY ALL ORDER BY 1 DESC"""

PRODUCT_PRICE_VARIATION = f"""WITH {ADAPTER}
SELECT product_id, list_min(ps) AS min_price, list_avg(ps) AS avg_price, list_max(ps) AS max_price
FROM (SELECT product_id, list(DISTINCT price) AS ps FROM si GROUP BY product_id) WHERE len(ps) > 1 ORDER BY avg_price DESC"""

_PARETO = f"""SELECT seller_id, sum(top) AS ltv, cume_dist() OVER (ORDER BY sum(top) DESC) AS pareto_rank
FROM (SELECT seller_id, max(amount) AS top FROM sales
      WHERE order_purchase_timestamp BETWEEN {WS} AND {WE} - INTERVAL 1 MICROSECOND AND order_status = 'DELIVERED'
      GROUP BY seller_id, order_id)
GROUP BY seller_id"""

SELLER_PARETO = f"WITH {SALES}\n{_PARETO} ORDER BY ltv DESC, seller_id LIMIT 25"
SELLER_PARETO_ALL = f"WITH {SALES}\n{_PARETO}"

ORDER_STATUS_COUNTS = f"""WITH {ADAPTER}
SELECT order_status, COUNT(DISTINCT order_id) AS n_orders FROM so
WHERE order_purchase_timestamp >= {WS} AND order_purchase_timestamp < {WE}
GROUP BY 1 ORDER BY 2"""

UNIQUE_PRODUCTS = f"WITH {ADAPTER}\nSELECT COUNT(DISTINCT product_id) AS unique_products FROM si"

# --------------------------------------------------------- feature stores
# an item row meets each reference date whose look-back window holds its order
_IN_WINDOW = f"""seen AS (
  SELECT refs.ref, sales.*, date_diff('day', day, ref) AS age FROM sales JOIN refs
    ON order_purchase_timestamp < ref AND order_purchase_timestamp >= (ref - INTERVAL {P.lookback_months} MONTH)::DATE
  WHERE seller_id IS NOT NULL)"""

# the wider item scope: all items of an order count for each of its sellers
_WHOLE_ORDERS = f"""{_IN_WINDOW.replace("seen AS", "own AS", 1)},
seen AS (
  SELECT w.ref, w.seller_id, sales.* EXCLUDE (seller_id), date_diff('day', day, w.ref) AS age
  FROM (SELECT DISTINCT ref, seller_id, order_id FROM own) w JOIN sales USING (order_id))"""

_FS1 = f"""{_SALES},
{_IN_WINDOW},
described AS (
  SELECT ref, seller_id, min(age)::INTEGER AS recency, sum(price) / nullif(count(product_id), 0) AS avg_ticket,
    count(product_id) / nullif(count(DISTINCT order_id), 0) AS avg_order_product,
    max(amount) AS max_order_items_price, min(amount) AS min_order_items_price, avg(amount) AS avg_order_items_price,
    avg(price) AS avg_item_price, max(price) AS max_item_price, min(price) AS min_item_price,
    count(DISTINCT day) AS quantity_date_orders, count(product_id) AS quantity_products_selled,
    count(DISTINCT product_id) AS quantity_unique_product_selled
  FROM seen GROUP BY ALL),
gaps AS (
  SELECT ref, seller_id, list_avg(list_transform(range(2, len(ds) + 1), lambda k: date_diff('day', ds[k - 1], ds[k]))) AS avg_seller_interval
  FROM (SELECT ref, seller_id, list_sort(list(DISTINCT day)) AS ds FROM seen GROUP BY ALL)),
lifetime AS (
  SELECT ref, seller_id, sum(price) AS ltv, (ref - min(day))::INTEGER AS days_from_first_sell,
    count(DISTINCT order_id) / nullif(max(day) - min(day), 0) AS frequency
  FROM refs JOIN sales ON order_purchase_timestamp < ref WHERE seller_id IS NOT NULL GROUP BY ref, seller_id),
fs1 AS (
  SELECT ref AS _mt_date_reference, seller_id, recency, avg_ticket, avg_order_product,
    max_order_items_price, min_order_items_price, avg_order_items_price, max_item_price, min_item_price, avg_item_price,
    quantity_date_orders, quantity_products_selled, quantity_unique_product_selled,
    avg_seller_interval, ltv, days_from_first_sell, frequency
  FROM described JOIN lifetime USING (ref, seller_id) JOIN gaps USING (ref, seller_id))"""


def _fs2_stats() -> str:
    """Columns avg/min/max of the order totals' freight and of the two day spans."""
    out = ["avg(freight_value) AS avg_freight_value, min(freight_value) AS min_freight_value, max(freight_value) AS max_freight_value"]
    for span in ("approval_delivery_days", "approval_purchase_days"):
        out.append(f"avg({span}) AS avg_{span}, min({span})::INTEGER AS min_{span}, max({span})::INTEGER AS max_{span}")
    return ",\n    ".join(out)


_FS2 = f"""order_totals AS (
  SELECT ref, seller_id, order_id, any_value(order_status) AS order_status,
    any_value(order_purchase_timestamp) AS order_purchase_timestamp, any_value(order_approved_at) AS order_approved_at,
    any_value(order_delivered_customer_date) AS order_delivered_customer_date,
    any_value(order_estimated_delivery_date) AS order_estimated_delivery_date,
    sum(price) AS price, sum(freight_value) AS freight_value
  FROM seen GROUP BY ref, seller_id, order_id),
judged AS (
  SELECT *, order_approved_at::DATE - order_purchase_timestamp::DATE AS approval_purchase_days,
    coalesce(order_delivered_customer_date::DATE, ref) - order_approved_at::DATE AS approval_delivery_days,
    order_status = 'DELIVERED' AS done, order_status = 'CANCELED' AS dropped,
    order_status = 'DELIVERED' AND coalesce(order_delivered_customer_date::DATE, ref) > order_estimated_delivery_date::DATE AS late
  FROM order_totals),
fs2 AS (
  SELECT ref AS _mt_date_reference, seller_id,
    {_fs2_stats()},
    avg(done::INTEGER) AS pct_status_delivered, avg(dropped::INTEGER) AS pct_status_canceled,
    count_if(late) / nullif(count_if(done), 0) AS pct_delay_delivered_orders, count_if(late)::BIGINT AS quantity_delay_orders
  FROM judged GROUP BY ref, seller_id)"""

_FS1_COLS = ["avg_ticket", "avg_order_product", "max_order_items_price", "min_order_items_price",
             "avg_order_items_price", "max_item_price", "min_item_price", "avg_item_price",
             "avg_seller_interval", "ltv", "frequency"]
_FS2_COLS = ["avg_freight_value", "min_freight_value", "max_freight_value", "avg_approval_delivery_days",
             "avg_approval_purchase_days", "pct_status_delivered", "pct_status_canceled",
             "pct_delay_delivered_orders"]

# the label looks for the first sale on or after the reference date, up to churn_days after the last one
_ABT = f"""profile AS (
  SELECT * FROM fs1 LEFT JOIN fs2 USING (_mt_date_reference, seller_id) WHERE recency <= {P.churn_days}),
sold AS (SELECT DISTINCT seller_id, day FROM sales WHERE seller_id IS NOT NULL AND day IS NOT NULL),
next_sale AS (
  SELECT profile.*, CASE WHEN sold.day - _mt_date_reference <= {P.churn_days} - recency THEN sold.day END AS date_sell
  FROM profile ASOF LEFT JOIN sold ON profile.seller_id = sold.seller_id AND profile._mt_date_reference <= sold.day)"""

_FS1_ALL = f"{ADAPTER},\n{_refs_cte()},\n{_FS1}"
_ABT_ALL = f"{_FS1_ALL},\n{_FS2},\n{_ABT}"
FS_FILTER_SELLERS = f"WITH {_FS1_ALL}\nSELECT DISTINCT ref AS _mt_date_reference, order_id, seller_id FROM seen"
FS_SELLER_PURCHASES = f"WITH {_FS1_ALL}\nSELECT * FROM fs1"
FS_SELLER_DESCRIPTIONS = f"WITH {_FS1_ALL}\nSELECT ref AS _mt_date_reference, * EXCLUDE (ref) FROM described"
FS_SELLER_LIFE = f"WITH {_FS1_ALL}\nSELECT ref AS _mt_date_reference, * EXCLUDE (ref) FROM lifetime"
FS_SELLER_INTERVAL = f"WITH {_FS1_ALL}\nSELECT ref AS _mt_date_reference, * EXCLUDE (ref) FROM gaps"
FS_ORDER_TOTALS = f"WITH {_FS1_ALL},\n{_FS2}\nSELECT ref AS _mt_date_reference, * EXCLUDE (ref) FROM order_totals"
FS_SELLER_ORDERS = f"WITH {_FS1_ALL},\n{_FS2}\nSELECT * FROM fs2"
ABT_FEATURES = f"WITH {_ABT_ALL}\nSELECT * FROM profile"
ABT_LABEL = f"WITH {_ABT_ALL}\nSELECT seller_id, _mt_date_reference, date_sell, (date_sell IS NULL)::INTEGER AS churn FROM next_sale"
_ABT_SELECT = "SELECT * EXCLUDE (date_sell), (date_sell IS NULL)::INTEGER AS churn FROM next_sale"
_ABT_CTES = f"{_ABT_ALL},\nabt AS ({_ABT_SELECT})"
ABT_SELLER_CHURN = f"WITH {_ABT_ALL}\n{_ABT_SELECT}"
ABT_COLUMNS = (["_mt_date_reference", "seller_id", "recency"] + _FS1_COLS[:8]
               + ["quantity_date_orders", "quantity_products_selled", "quantity_unique_product_selled",
                  "avg_seller_interval", "ltv", "days_from_first_sell", "frequency",
                  "avg_freight_value", "min_freight_value", "max_freight_value",
                  "avg_approval_delivery_days", "min_approval_delivery_days", "max_approval_delivery_days",
                  "avg_approval_purchase_days", "min_approval_purchase_days", "max_approval_purchase_days",
                  "pct_status_delivered", "pct_status_canceled", "pct_delay_delivered_orders",
                  "quantity_delay_orders", "churn"])



def _order_scope(sql: str) -> str:
    return sql.replace(_IN_WINDOW, _WHOLE_ORDERS)


MISSING_RATE = f"WITH {_ABT_CTES}\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", AVG(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS missing_rate FROM abt"
    for c in ABT_COLUMNS)
IMPUTE = (f"WITH {_ABT_CTES}\nSELECT * REPLACE (COALESCE(frequency, 0) AS frequency, "
          "COALESCE(avg_seller_interval, 0) AS avg_seller_interval) FROM abt")

# ------------------------------------------------ bronze / silver / tables
from pyspark.sql import types as _T  # noqa: E402

from sellerlens.params import RUN_TS, RUN_TS_PREV  # noqa: E402

_LO_COLS = ["order_id", "customer_id", "order_status", "order_approved_at", "order_delivered_carrier_date",
            "order_delivered_customer_date", "order_estimated_delivery_date", "order_purchase_timestamp",
            "order_notes"]
_LI_TYPES = [("order_id", _T.StringType()), ("order_item_id", _T.IntegerType()), ("product_id", _T.StringType()),
             ("seller_id", _T.StringType()), ("price", _T.StringType()), ("freight_value", _T.StringType()),
             ("shipping_limit_date", _T.StringType())]
_LO_SCHEMA = _T.StructType([_T.StructField(c, _T.StringType(), True) for c in _LO_COLS]).simpleString()
_LI_SCHEMA = _T.StructType([_T.StructField(c, t, True) for c, t in _LI_TYPES]).simpleString()


def _ts_txt(c):
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}"


_LANDING_ORDERS = f"""lo AS (
  SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id,
    '  ' || lower(order_status) || ' ' AS order_status,
    {_ts_txt('order_approved_at')}, {_ts_txt('order_delivered_carrier_date')},
    {_ts_txt('order_delivered_customer_date')}, {_ts_txt('order_estimated_delivery_date')},
    {_ts_txt('order_purchase_timestamp')}, CAST(NULL AS VARCHAR) AS order_notes
  FROM so)"""
_LANDING_ITEMS = f"""li AS (
  SELECT CAST(order_id AS VARCHAR) AS order_id, order_item_id, CAST(product_id AS VARCHAR) AS product_id,
    CAST(seller_id AS VARCHAR) AS seller_id, CAST(price AS VARCHAR) AS price,
    CAST(freight_value AS VARCHAR) AS freight_value, {_ts_txt('shipping_limit_date')}
  FROM si)"""


def _stamps(run_ts, schema_json, partition_as_date=False, created_by=True):
    part = (f"DATE '{run_ts:%Y-%m-%d}'" if partition_as_date else f"'{run_ts:%Y-%m-%d}'")
    out = {"ingestion_time": f"'{run_ts:%Y-%m-%d %H:%M:%S}'", "partition_date": part, "dataframe_schema": f"'{schema_json}'",
           "workflow_created_by": "'sellerlens'", "extraction_tool": "'file_drop'", "source_system": "'oltp'"}
    return ", ".join(f"{v} AS _mt_bronze_{k}" for k, v in out.items() if created_by or k != "workflow_created_by")


BRONZE_STAMP = f"WITH {ADAPTER},\n{_LANDING_ORDERS}\nSELECT *, {_stamps(RUN_TS, _LO_SCHEMA)} FROM lo"
LATEST_SNAPSHOT = f"WITH {ADAPTER},\n{_LANDING_ORDERS}\nSELECT DISTINCT *, {_stamps(RUN_TS, _LO_SCHEMA, True)} FROM lo"
_SILVER_STAMP = f"DATE '{RUN_TS:%Y-%m-%d}' AS _mt_silver_ingestion_date, 'overwrite' AS _mt_silver_update_key"


def _silver(cte, table, schema, **how):
    """All landing columns but the empty notes, some of them retyped."""
    typed = ", ".join(f"{expr} AS {c}" for c, expr in how.items())
    notes = " EXCLUDE (order_notes)" if table == "lo" else ""
    return (f"WITH {ADAPTER},\n{cte}\nSELECT *{notes} REPLACE ({typed}), "
            f"{_stamps(RUN_TS, schema, created_by=False)}, {_SILVER_STAMP} FROM {table}")


SILVER_ORDERS = _silver(_LANDING_ORDERS, "lo", _LO_SCHEMA, order_status="upper(trim(order_status))",
                        **{c: f"TRY_CAST({c} AS TIMESTAMP)" for c in _LO_COLS[3:8]})
SILVER_ITEMS = _silver(_LANDING_ITEMS, "li", _LI_SCHEMA, price="TRY_CAST(price AS DOUBLE)",
                       freight_value="TRY_CAST(freight_value AS DOUBLE)", shipping_limit_date="TRY_CAST(shipping_limit_date AS TIMESTAMP)")
RELOAD_PARTITION = f"""SELECT DATE '{RUN_TS_PREV:%Y-%m-%d}' AS _mt_bronze_partition_date, COUNT(*) AS n_rows FROM orders
UNION ALL SELECT DATE '{RUN_TS:%Y-%m-%d}', COUNT(*) FROM orders"""
LOAD_LOG = """SELECT 'bronze' AS layer, 'postgres_public_orders' AS table_name, COUNT(*) AS written_lines FROM orders
UNION ALL SELECT 'bronze', 'postgres_public_order_items', COUNT(*) FROM lineitem"""
UPSERT = f"""WITH {ADAPTER}
SELECT order_id, customer_id,
  CASE WHEN order_status = 'PROCESSING' THEN 'DELIVERED' ELSE order_status END AS order_status,
  order_purchase_timestamp, order_approved_at, order_delivered_carrier_date,
  CASE WHEN order_status = 'PROCESSING' THEN order_estimated_delivery_date ELSE order_delivered_customer_date END
    AS order_delivered_customer_date,
  order_estimated_delivery_date
FROM so"""
_FIRST3 = ", ".join(_d(r) for r in P.refs[:3])
INGESTED_REFS = (f"WITH {ADAPTER},\n{_refs_cte()},\n{_FS1}\n"
                 f"SELECT DISTINCT _mt_date_reference FROM fs1 WHERE _mt_date_reference IN ({_FIRST3})")
MISSING_REFS = (f"WITH {ADAPTER},\n{_refs_cte()},\n{_FS1}\n"
                f"SELECT ref AS _mt_date_reference FROM refs WHERE ref NOT IN "
                f"(SELECT _mt_date_reference FROM fs1 WHERE _mt_date_reference IN ({_FIRST3}))")
FS_BACKFILL = (f"WITH {ADAPTER},\n{_refs_cte()},\n{_FS1}\n"
               "SELECT _mt_date_reference, COUNT(*) AS n_sellers FROM fs1 GROUP BY 1")

# Double columns rounded (6 decimals) on both sides before hashing.
DOUBLES: dict[str, list[str]] = {
    "sellers_rfm": ["monetary", "frequency_recency", "monetary_frequency"],
    "sellers_price_selling_days": ["monetary", "lag_price", "diff_monetary"],
    "sellers_intermittent_daily": ["monetary", "diff_monetary"], "sellers_daily_runs": ["monetary", "diff_monetary"],
    "cohort_retention": ["retention"],
    "lookup": ["price", "freight_value"],
    "lookup_seller": ["price", "freight_value"],
    "monthly_ltv": ["forecast_ltv"],
    "product_sales": ["freight_value", "price"],
    "product_price_variation": ["min_price", "avg_price", "max_price"],
    "seller_pareto": ["ltv", "pareto_rank"],
    "seller_pareto_all": ["ltv", "pareto_rank"],
    "fs_seller_descriptions": [c for c in _FS1_COLS if c not in ("avg_seller_interval", "ltv", "frequency")],
    "fs_seller_life": ["ltv", "frequency"],
    "fs_seller_interval": ["avg_seller_interval"],
    "fs_seller_purchases": _FS1_COLS,
    "fs_order_totals": ["price", "freight_value"],
    "fs_seller_orders": _FS2_COLS,
    "abt_features": _FS1_COLS + _FS2_COLS,
    "fs_seller_purchases_order_scope": _FS1_COLS, "fs_order_totals_order_scope": ["price", "freight_value"],
    "fs_seller_orders_order_scope": _FS2_COLS, "abt_seller_churn_order_scope": _FS1_COLS + _FS2_COLS,
    "seller_record": _FS1_COLS + _FS2_COLS,
    "abt_seller_churn": _FS1_COLS + _FS2_COLS,
    "impute": _FS1_COLS + _FS2_COLS,
    "missing_rate": ["missing_rate"],
}

_RAW: dict[str, str] = {
    "sellers_rfm": SELLERS_RFM,
    "sellers_price_selling_days": SELLERS_PRICE_SELLING_DAYS,
    "sellers_intermittent_daily": SELLERS_INTERMITTENT_DAILY, "sellers_daily_runs": SELLERS_DAILY_RUNS,
    "cohort": COHORT,
    "cohort_retention": COHORT_RETENTION,
    "cohort_pivot": _cohort_pivot(),
    "suspicious_orders": SUSPICIOUS_ORDERS,
    "suspicious_customers": SUSPICIOUS_CUSTOMERS,
    "stuck_processing": STUCK_PROCESSING,
    "lookup": LOOKUP,
    "lookup_seller": LOOKUP_SELLER,
    "monthly_ltv": MONTHLY_LTV,
    "min_max_orders": MIN_MAX_ORDERS,
    "product_sales": PRODUCT_SALES,
    "orders_time_series": ORDERS_TIME_SERIES,
    "product_price_variation": PRODUCT_PRICE_VARIATION,
    "seller_pareto": SELLER_PARETO,
    "seller_pareto_all": SELLER_PARETO_ALL,
    "order_status_counts": ORDER_STATUS_COUNTS,
    "unique_products": UNIQUE_PRODUCTS,
    "fs_filter_sellers": FS_FILTER_SELLERS,
    "fs_seller_descriptions": FS_SELLER_DESCRIPTIONS,
    "fs_seller_life": FS_SELLER_LIFE,
    "fs_seller_interval": FS_SELLER_INTERVAL,
    "fs_seller_purchases": FS_SELLER_PURCHASES,
    "fs_order_totals": FS_ORDER_TOTALS,
    "fs_seller_orders": FS_SELLER_ORDERS,
    "abt_features": ABT_FEATURES,
    "abt_label": ABT_LABEL,
    "abt_seller_churn": ABT_SELLER_CHURN,
    "fs_seller_purchases_order_scope": _order_scope(FS_SELLER_PURCHASES),
    "fs_order_totals_order_scope": _order_scope(FS_ORDER_TOTALS),
    "fs_seller_orders_order_scope": _order_scope(FS_SELLER_ORDERS),
    "abt_seller_churn_order_scope": _order_scope(ABT_SELLER_CHURN),
    "seller_record": f"SELECT * FROM (\n{ABT_SELLER_CHURN}\n) z WHERE seller_id = {P.lookup_seller_id}",
    "gold_load": """SELECT 'postgres_public_sellers_rfm' AS table_name, count(DISTINCT l_partkey) AS written_lines, 'overwrite' AS update_key FROM lineitem
      UNION ALL SELECT 'postgres_public_sellers_price_selling_days', count(DISTINCT (l_partkey, o_orderdate)), 'overwrite' FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      UNION ALL SELECT 'postgres_public_sellers_daily_runs', count(*), 'overwrite' FROM (""" + SELLERS_DAILY_RUNS + ")",
    "landing_to_bronze": """SELECT * FROM (
        SELECT 'postgres_public_orders' AS table_name, count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_orders FROM orders
        UNION ALL SELECT 'postgres_public_order_items', count(*), count(DISTINCT l_orderkey) FROM lineitem),
      (VALUES ('2001-07-31'), ('2001-08-01')) d(partition_date), (VALUES (2::BIGINT)) l(n_loads)""",
    "bronze_stamp": BRONZE_STAMP,
    "silver_orders": SILVER_ORDERS,
    "silver_items": SILVER_ITEMS,
    "latest_snapshot": LATEST_SNAPSHOT,
    "reload_partition": RELOAD_PARTITION,
    "load_log": LOAD_LOG,
    "upsert": UPSERT,
    "ingested_refs": INGESTED_REFS,
    "missing_refs": MISSING_REFS,
    "fs_backfill": FS_BACKFILL,
    "missing_rate": MISSING_RATE,
    "impute": IMPUTE,
}


def statements() -> dict[str, str]:
    return {k: rounded(v, DOUBLES.get(k, [])) for k, v in _RAW.items()}


# ------------------------------------------ statistics, evaluation, decision

ABT_NUMERIC = [c for c in ABT_COLUMNS if c not in ("_mt_date_reference", "seller_id")]
FEATS = [c for c in ABT_NUMERIC if c != "churn"]


def sig7(c: str) -> str:
    """7 significant digits, same formula on both sides: the mantissa is
    rounded, then scaled by an exact power of ten (multiply or divide)."""
    e = f"floor(log10(abs({c})))"
    m = f"round({c} / pow(10, {e}) + {NUDGE}, 6)"
    return (f"CAST(CASE WHEN {c} = 0 OR {c} IS NULL THEN {c} WHEN {e} >= 0 THEN {m} * pow(10, {e}) "
            f"ELSE round({c} * pow(10, -{e}) + {NUDGE}, 6) / pow(10, -{e}) END AS DOUBLE)")


def sig_wrap(sql: str, cols: list[str]) -> str:
    rep = ", ".join(f"{sig7(c)} AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) q"


def _dbl(c):
    return f"CAST({c} AS DOUBLE)"


_RULE = {"recency": 0.09, "quantity_date_orders": -0.35, "days_from_first_sell": -0.0015, "pct_status_canceled": 1.5}
_rule = " + ".join(["CAST(0.4 AS DOUBLE)"] + [f"COALESCE(CAST({f} AS DOUBLE), 0) * CAST({c} AS DOUBLE)" for f, c in _RULE.items()])
_SCORED = f"{_ABT_CTES},\nscored AS (SELECT *, round(1.0 / (1.0 + exp(-({_rule}))), 3) AS churn_proba FROM abt)"

DESCRIBE = f"WITH {_ABT_CTES}\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", CAST(COUNT({c}) AS DOUBLE) AS count, AVG({_dbl(c)}) AS mean, "
    f"STDDEV_SAMP({_dbl(c)}) AS std, CAST(MIN({c}) AS DOUBLE) AS min, quantile_cont({_dbl(c)}, 0.25) AS q25, "
    f"quantile_cont({_dbl(c)}, 0.5) AS q50, quantile_cont({_dbl(c)}, 0.75) AS q75, CAST(MAX({c}) AS DOUBLE) AS max FROM abt"
    for c in ABT_NUMERIC)


def _moments(c):
    x = _dbl(c)
    return (f"SELECT '{c}' AS \"column\", COUNT({x}) AS n, "
            f"AVG(POWER({x} - m, 2)) AS m2, AVG(POWER({x} - m, 3)) AS m3, AVG(POWER({x} - m, 4)) AS m4 "
            f"FROM abt, (SELECT AVG({x}) AS m FROM abt) mm")


SKEW_KURTOSIS = (f"WITH {_ABT_CTES},\nmoments AS (\n" + "\nUNION ALL\n".join(_moments(c) for c in ABT_NUMERIC) + ")\n"
                 "SELECT \"column\", "
                 "sqrt(n * (n - 1.0)) / NULLIF(n - 2.0, 0) * (m3 / NULLIF(pow(m2, 1.5), 0)) AS skew, "
                 "(n - 1.0) / NULLIF((n - 2.0) * (n - 3.0), 0) * ((n + 1.0) * (m4 / NULLIF(m2 * m2, 0) - 3.0) + 6.0) AS kurtosis "
                 "FROM moments")
BOWLEY = (f"WITH {_ABT_CTES}\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", ((q3 - q2) - (q2 - q1)) / NULLIF(q3 - q1, 0) AS bowley FROM "
    f"(SELECT quantile_cont({_dbl(c)}, 0.25) AS q1, quantile_cont({_dbl(c)}, 0.5) AS q2, "
    f"quantile_cont({_dbl(c)}, 0.75) AS q3 FROM abt)" for c in ABT_NUMERIC))
_PAIRS = [(a, b) for i, a in enumerate(ABT_NUMERIC) for b in ABT_NUMERIC[i + 1:]]
CORRELATION = (f"WITH {_ABT_CTES}\n" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, corr({_dbl(a)}, {_dbl(b)}) AS corr FROM abt" for a, b in _PAIRS))
POINT_BISERIAL = (f"WITH {_ABT_CTES},\npb AS (\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", corr(CAST(churn AS DOUBLE), {_dbl(c)}) AS r, "
    f"COUNT(CASE WHEN {c} IS NOT NULL AND churn IS NOT NULL THEN 1 END) AS n FROM abt" for c in FEATS) + ")\n"
    "SELECT \"column\", r, n, r * sqrt((n - 2) / NULLIF(1 - r * r, 0)) AS t FROM pb")
# Two-sided tail of Student's t with k degrees of freedom: with t = sqrt(k) * tan(a) the density is
# cos(a) ** (k - 1) up to a factor, so the tail is a ratio of two integrals, here by Simpson's rule.
_ANGLE = "(lo + (pi() / 2 - lo) * s / 100000.0)"
_SIMPSON = (f"SUM(CASE WHEN s IN (0, 100000) THEN 1 WHEN s % 2 = 1 THEN 4 ELSE 2 END * "
            f"exp((n - 3) * ln(greatest(cos({_ANGLE}), 1e-300)))) * (pi() / 2 - lo)")
POINT_BISERIAL_TEST = f"""WITH pbt AS ({POINT_BISERIAL}),
ends AS (SELECT "column", n, atan(abs(t) / sqrt(n - 2)) AS lo, 1 AS tail FROM pbt WHERE t IS NOT NULL
  UNION ALL SELECT "column", n, 0.0, 0 FROM pbt WHERE t IS NOT NULL),
area AS (SELECT "column", tail, {_SIMPSON} AS v FROM ends, range(100001) g(s) GROUP BY "column", n, lo, tail),
p AS (SELECT "column", MAX(v) FILTER (tail = 1) / MAX(v) FILTER (tail = 0) AS p_value FROM area GROUP BY "column")
SELECT pbt.*, coalesce(p.p_value, 'nan'::DOUBLE) AS p_value FROM pbt LEFT JOIN p USING ("column")"""
HISTOGRAM_BY_CLASS = f"""WITH {_ABT_CTES},
d AS (SELECT CAST(recency AS DOUBLE) AS x, churn FROM abt WHERE recency IS NOT NULL),
mm AS (SELECT MIN(x) AS mn, MAX(x) AS mx FROM d),
b AS (SELECT churn, CAST(COALESCE(LEAST(floor((x - mn) / NULLIF(mx - mn, 0) * 10), 9), 0) AS INTEGER) AS bin FROM d, mm),
c AS (SELECT churn, bin, COUNT(*) AS count FROM b GROUP BY 1, 2)
SELECT churn, bin, mn + bin * ((mx - mn) / 10) AS lo, mn + (bin + 1) * ((mx - mn) / 10) AS hi, count,
  count / NULLIF(SUM(count) OVER (PARTITION BY churn) * ((mx - mn) / 10), 0) AS density
FROM c, mm"""


def _histograms(features, caps):
    """Every series of every feature by plain grouping; ranges by a window over the series."""
    values = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", churn, {_dbl(c)} AS v FROM abt WHERE {c} IS NOT NULL"
        + (f" AND {c} <= {caps[c]}" if c in caps else "") for c in features)
    return f"""WITH {_ABT_CTES},
v AS ({values}),
s AS (
  SELECT 'all' AS series, "column", CAST(NULL AS INTEGER) AS class, v AS x, 25 AS bins FROM v
  UNION ALL SELECT 'class', "column", CAST(churn AS INTEGER), v, 22 FROM v WHERE churn IS NOT NULL
  UNION ALL SELECT 'class_log1p', "column", CAST(churn AS INTEGER), ln(1 + v), 22 FROM v WHERE churn IS NOT NULL AND v > -1
),
r AS (SELECT series, "column", class, min(x) AS a, max(x) AS b, count(*) AS n FROM s GROUP BY ALL),
e AS (SELECT series, "column", class, n, a - CASE WHEN a = b THEN 0.5 ELSE 0 END AS mn, b + CASE WHEN a = b THEN 0.5 ELSE 0 END AS mx FROM r),
c AS (
  SELECT s.series, s."column", s.class, s.bins, mn, mx, n, CAST(least(floor((x - mn) / (mx - mn) * s.bins), s.bins - 1) AS INTEGER) AS bin, count(*) AS count
  FROM s JOIN e ON s.series = e.series AND s."column" = e."column" AND s.class IS NOT DISTINCT FROM e.class GROUP BY ALL
)
SELECT series, "column", class, bin, mn + bin * ((mx - mn) / bins) AS lo, mn + (bin + 1) * ((mx - mn) / bins) AS hi, count,
  count / (n * ((mx - mn) / bins)) AS density FROM c"""


HISTOGRAMS = _histograms(FEATS, {})
HISTOGRAMS_CAPPED = _histograms(
    ["frequency", "quantity_delay_orders", "quantity_products_selled", "quantity_unique_product_selled"],
    {"frequency": 1, "quantity_delay_orders": 10, "quantity_products_selled": 35, "quantity_unique_product_selled": 50})
RECENCY_ECDF = f"""WITH {_ABT_CTES},
sizes AS (SELECT churn, COUNT(*) AS class_n FROM abt GROUP BY 1),
c AS (SELECT churn, CAST(LEAST(floor((recency - 1) / 5), 8) AS INTEGER) AS bin, COUNT(*) AS count
      FROM abt WHERE recency >= 1 AND recency <= 46 GROUP BY 1, 2)
SELECT c.churn, bin, 1 + bin * 5 AS lo, count,
  SUM(count) OVER (PARTITION BY c.churn ORDER BY bin) / class_n AS cum_share
FROM c JOIN sizes s ON c.churn = s.churn"""
FLAG_RATE_BY_CLASS = f"""WITH {_ABT_CTES},
f AS (
  SELECT 'interval_one_week' AS flag, churn,
    CASE WHEN CAST(trunc(COALESCE(avg_seller_interval, 0)) AS INTEGER) > 7 THEN 1 ELSE 0 END AS value FROM abt
  UNION ALL
  SELECT 'one_year', churn, CASE WHEN days_from_first_sell > 365 THEN 1 ELSE 0 END FROM abt)
SELECT flag, churn, value, COUNT(*) / (SELECT COUNT(*) FROM abt) AS share FROM f GROUP BY 1, 2, 3"""
CLASS_BALANCE = f"""WITH {_ABT_CTES}
SELECT _mt_date_reference, churn, COUNT(*) AS count,
  COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY _mt_date_reference) AS share
FROM abt GROUP BY 1, 2"""
SHAPE = f"WITH {_ABT_CTES}\nSELECT COUNT(*) AS n_rows, {len(ABT_COLUMNS)} AS n_columns FROM abt"
SELLER_HISTORY = f"SELECT * FROM (\n{MONTHLY_LTV}\n) h WHERE seller_id = {P.lookup_seller_id}"
_SPLIT = (f"CASE WHEN _mt_date_reference < {_d(P.oot_month)} THEN 'train' "
          f"WHEN _mt_date_reference = {_d(P.oot_month)} THEN 'oot' "
          f"WHEN _mt_date_reference = {_d(P.score_month)} THEN 'score' END")
TIME_SPLIT = f"WITH {_ABT_CTES}\nSELECT * FROM (SELECT *, {_SPLIT} AS split FROM abt) WHERE split IS NOT NULL"
TARGET_RATE = (f"WITH {_ABT_CTES}\nSELECT split, AVG(CAST(churn AS DOUBLE)) AS target_rate, COUNT(*) AS n_rows "
               f"FROM (SELECT *, {_SPLIT} AS split FROM abt) WHERE split IS NOT NULL GROUP BY 1")
ARGMAX_HISTORY = (f"WITH {_ABT_CTES}\nSELECT * FROM abt WHERE seller_id = "
                  "(SELECT seller_id FROM abt ORDER BY ltv DESC, seller_id DESC LIMIT 1)")
MANUAL_SIGMOID = f"WITH {_SCORED}\nSELECT _mt_date_reference, seller_id, churn, churn_proba FROM scored"
SCORE_BY_REF = (f"WITH {_SCORED}\nSELECT _mt_date_reference, AVG(churn_proba) AS mean_proba, COUNT(*) AS n_rows "
                "FROM scored GROUP BY 1")
_AUC_BODY = """pos AS (SELECT churn_proba AS s FROM scored WHERE churn = 1),
neg AS (SELECT churn_proba AS s FROM scored WHERE churn = 0),
auc AS (
  SELECT SUM(CASE WHEN pos.s > neg.s THEN 1.0 WHEN pos.s = neg.s THEN 0.5 ELSE 0.0 END)
    / ((SELECT COUNT(*) FROM pos) * (SELECT COUNT(*) FROM neg)) AS auc
  FROM pos, neg)"""
AUC = f"WITH {_SCORED},\n{_AUC_BODY}\nSELECT auc FROM auc"
THRESHOLD_METRICS = f"""WITH {_SCORED},
{_AUC_BODY},
th AS (SELECT k, k * CAST(0.05 AS DOUBLE) AS t FROM range(0, 21) r(k)),
cm AS (
  SELECT t,
    CAST(COUNT(CASE WHEN churn_proba >= t AND churn = 1 THEN 1 END) AS DOUBLE) AS tp,
    CAST(COUNT(CASE WHEN churn_proba >= t AND churn = 0 THEN 1 END) AS DOUBLE) AS fp,
    CAST(COUNT(CASE WHEN churn_proba < t AND churn = 1 THEN 1 END) AS DOUBLE) AS fn,
    CAST(COUNT(CASE WHEN churn_proba < t AND churn = 0 THEN 1 END) AS DOUBLE) AS tn
  FROM th, scored GROUP BY t)
SELECT t AS p,
  COALESCE((tp / NULLIF(tp + fn, 0) + tn / NULLIF(tn + fp, 0)) / 2, 0) AS balanced_accuracy,
  (SELECT auc FROM auc) AS auc,
  COALESCE(fp / NULLIF(fp + tn, 0), 0) AS false_positive_rate,
  COALESCE(tp / NULLIF(tp + fp, 0), 0) AS precision,
  COALESCE(tp / NULLIF(tp + fn, 0), 0) AS sensibility,
  COALESCE(tn / NULLIF(tn + fp, 0), 0) AS specificity,
  COALESCE(tn / NULLIF(tn + fp, 0) - fn / NULLIF(tp + fn, 0), 0) AS ks_diffs
FROM cm ORDER BY p"""
CONFUSION_MATRIX = (f"WITH {_SCORED}\nSELECT churn AS label, CAST(churn_proba > 0.4 AS INTEGER) AS pred, "
                    "COUNT(*) AS n FROM scored GROUP BY 1, 2")
LIFT_GAIN = f"""WITH {_SCORED},
ranked AS (SELECT churn, ROW_NUMBER() OVER (ORDER BY churn_proba DESC, _mt_date_reference, seller_id) AS rn FROM scored),
tot AS (SELECT COUNT(*) AS n, SUM(churn) AS ones FROM scored),
cuts AS (SELECT i * CAST(0.1 AS DOUBLE) AS x FROM range(1, 11) r(i)),
c AS (SELECT x, CAST(ceil(x * n) AS BIGINT) AS n_rows, ones, n FROM cuts, tot)
SELECT x AS fraction, n_rows,
  (SELECT SUM(churn) FROM ranked WHERE rn <= n_rows) / ones AS gain,
  ((SELECT SUM(churn) FROM ranked WHERE rn <= n_rows) / n_rows) / (ones / n) AS lift
FROM c ORDER BY fraction"""
TOP_CHURN = (f"WITH {_SCORED}\nSELECT seller_id, churn_proba, ltv FROM scored "
             f"WHERE _mt_date_reference = {_d(P.score_month)} ORDER BY churn_proba DESC, seller_id LIMIT 100")
_INPUTS_SLOT = "@inputs@"
_INPUTS = _INPUTS_SLOT
GIFT_TIER = f"WITH {_INPUTS}\nSELECT * FROM inputs"
_GREEDY = (f"greedy AS (SELECT seller_id, churn_proba, ltv, gift FROM (SELECT *, SUM(gift) OVER (ORDER BY churn_proba DESC, seller_id "
           f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cg FROM cands WHERE gift < 10000) WHERE cg <= {P.budget})")
BUDGET_GREEDY = f"WITH {_INPUTS},\n{_GREEDY}\nSELECT * FROM greedy"
_WS = [w for w in (10000.0, 400.0, 100.0, 50.0) if w <= P.budget]


def _optimal_cte() -> str:
    # per-class prefix sums, count vectors within budget, best vector, rows
    parts = [f"kr AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY gift ORDER BY ltv DESC, seller_id) AS rk FROM cands "
             f"WHERE ltv > 0 AND gift IN ({', '.join(str(w) for w in _WS)}))"]
    for i, w in enumerate(_WS):
        parts.append(f"p{i} AS (SELECT 0 AS n, CAST(0 AS DOUBLE) AS v UNION ALL SELECT rk, SUM(ltv) OVER (ORDER BY rk) FROM kr "
                     f"WHERE gift = {w} QUALIFY rk * {w} <= {P.budget})")
    frm = ", ".join(f"p{i} AS t{i}" for i in range(len(_WS)))
    cost = " + ".join(f"t{i}.n * {w}" for i, w in enumerate(_WS))
    val = " + ".join(f"t{i}.v" for i in range(len(_WS)))
    ns = ", ".join(f"t{i}.n AS n{i}" for i in range(len(_WS)))
    order = ", ".join(f"n{i}" for i in range(len(_WS)))
    parts.append(f"best AS (SELECT {ns}, {val} AS value, {cost} AS cost FROM {frm} WHERE {cost} <= {P.budget} "
                 f"ORDER BY value DESC, cost, {order} LIMIT 1)")
    conds = " OR ".join(f"(kr.gift = {w} AND kr.rk <= best.n{i})" for i, w in enumerate(_WS))
    parts.append(f"optimal AS (SELECT seller_id, churn_proba, ltv, gift FROM kr, best WHERE {conds})")
    return ",\n".join(parts)


BUDGET_OPTIMAL = f"WITH {_INPUTS},\n{_GREEDY},\n{_optimal_cte()}\nSELECT * FROM optimal"


def _agg(name, src):
    return (f"SELECT '{name}' AS scenario, COUNT(DISTINCT seller_id) AS sellers, SUM(ltv) AS total_ltv, "
            f"SUM(gift) AS total_gift, COUNT(DISTINCT seller_id) / (SELECT COUNT(DISTINCT seller_id) FROM cands) "
            f"AS share_of_floor_sellers FROM {src}")


ROI_SUMMARY = (f"WITH {_INPUTS},\n{_GREEDY},\n{_optimal_cte()}\n" + "\nUNION ALL\n".join(
    [_agg("all_scored", "inputs"), _agg("all_above_floor", "cands"), _agg("greedy", "greedy"),
     _agg("optimal", "optimal")]))
MONTHLY_PROFIT = (f"SELECT seller_id, order_month_purchase, forecast_ltv, forecast_ltv - LAG(forecast_ltv) OVER "
                  f"(PARTITION BY seller_id ORDER BY order_month_purchase) AS current_month_profit FROM (\n{MONTHLY_LTV}\n) h")

_ROBUST = ["avg_ticket", "max_order_items_price", "min_order_items_price", "avg_order_items_price", "max_item_price",
           "min_item_price", "avg_item_price", "quantity_date_orders", "quantity_products_selled",
           "quantity_unique_product_selled", "avg_seller_interval", "ltv", "frequency", "avg_freight_value",
           "min_freight_value", "max_freight_value", "min_approval_delivery_days", "max_approval_delivery_days",
           "quantity_delay_orders"]
_MINMAX = ["avg_order_product", "days_from_first_sell", "avg_approval_purchase_days", "min_approval_purchase_days",
           "max_approval_purchase_days"]
ROBUST_SCALE = (f"WITH {_ABT_CTES},\nq AS (SELECT " + ", ".join(
    f"quantile_cont(CAST({c} AS DOUBLE), [0.25, 0.5, 0.75]) AS q_{c}" for c in _ROBUST) + " FROM abt)\n"
    "SELECT _mt_date_reference, seller_id, " + ", ".join(
    f"({c} - q_{c}[2]) / NULLIF(q_{c}[3] - q_{c}[1], 0) AS {c}" for c in _ROBUST) + " FROM abt, q")
MIN_MAX_SCALE = (f"WITH {_ABT_CTES},\nm AS (SELECT " + ", ".join(
    f"MIN({c}) AS lo_{c}, MAX({c}) AS hi_{c}" for c in _MINMAX) + " FROM abt)\n"
    "SELECT _mt_date_reference, seller_id, " + ", ".join(
    f"({c} - lo_{c}) / NULLIF(hi_{c} - lo_{c}, 0) AS {c}" for c in _MINMAX) + " FROM abt, m")
DOUBLES.update({"robust_scale": list(_ROBUST), "min_max_scale": list(_MINMAX)})
_RAW.update({"robust_scale": ROBUST_SCALE, "min_max_scale": MIN_MAX_SCALE})

SPLIT = (f"WITH {_ABT_CTES}\nSELECT _mt_date_reference, seller_id, churn, "
         "('0x' || left(md5('2:' || strftime(_mt_date_reference, '%Y-%m-%d') || ':' || seller_id), 8))::BIGINT % 100 < 80 AS is_train "
         f"FROM abt WHERE _mt_date_reference < {_d(P.oot_month)}")
# quartiles and ranges of the training months, missing values as 0, a spread of 0 as 1
_LEARNT = [f"quantile_cont(coalesce({c}, 0)::DOUBLE, [0.25, 0.5, 0.75]) AS q_{c}" for c in _ROBUST] + [
    f"[min(coalesce({c}, 0))::DOUBLE, max(coalesce({c}, 0))::DOUBLE] AS m_{c}" for c in _MINMAX]
_APPLIED = [f"(coalesce({c}, 0) - q_{c}[2]) / CASE WHEN q_{c}[3] = q_{c}[1] THEN 1 ELSE q_{c}[3] - q_{c}[1] END AS {c}" for c in _ROBUST] + [
    f"(coalesce({c}, 0) - m_{c}[1]) / CASE WHEN m_{c}[2] = m_{c}[1] THEN 1 ELSE m_{c}[2] - m_{c}[1] END AS {c}" for c in _MINMAX]
FEATURE_PIPELINE = (f"WITH {_ABT_CTES},\nlearnt AS (SELECT {', '.join(_LEARNT)} FROM abt WHERE _mt_date_reference < {_d(P.oot_month)})\n"
                    f"SELECT _mt_date_reference, seller_id, {', '.join(_APPLIED)} FROM abt, learnt")
DOUBLES.update({"feature_pipeline": [*_ROBUST, *_MINMAX]})
_RAW.update({"split": SPLIT, "feature_pipeline": FEATURE_PIPELINE})


def _inner(sql: str) -> str:
    """Body of a ``WITH ...`` statement usable as a CTE after the ABT CTEs."""
    return sql.split("\n", 1)[1] if sql.startswith("WITH ") else sql


DESCRIBE_FULL = (f"SELECT d.*, sk.skew, sk.kurtosis, b.bowley FROM (\n{DESCRIBE}\n) d\n"
                 f"JOIN (\n{SKEW_KURTOSIS}\n) sk ON d.\"column\" = sk.\"column\"\n"
                 f"JOIN (\n{BOWLEY}\n) b ON d.\"column\" = b.\"column\"")
_OF_MONTH = f"seller_id IN (SELECT seller_id FROM (WITH {_ABT_CTES} SELECT * FROM abt) z WHERE _mt_date_reference = {_d(P.score_month)})"
LAST_MONTH_PROFIT = (f"WITH p AS (SELECT * FROM ({MONTHLY_PROFIT}) y WHERE {_OF_MONTH})\n"
                     "SELECT MAX(order_month_purchase) AS month, SUM(forecast_ltv) AS ltv_last_month, "
                     "SUM(current_month_profit) AS profit_last_month FROM p "
                     "WHERE order_month_purchase = (SELECT MAX(order_month_purchase) FROM p)")
BEST_THRESHOLDS = f"SELECT * FROM (\n{THRESHOLD_METRICS}\n) m ORDER BY ks_diffs DESC, p LIMIT 5"
_AL = "(0.1), (0.3), (0.5), (0.7), (0.9)"
_BE = "(0.05), (0.1), (0.2), (0.3), (0.5)"
_HOLT_CTES = f"""hm AS ({MONTHLY_LTV}),
hs AS (
  SELECT seller_id, order_month_purchase AS ds, CAST(forecast_ltv AS DOUBLE) AS y,
    ROW_NUMBER() OVER (PARTITION BY seller_id ORDER BY order_month_purchase) AS i,
    COUNT(*) OVER (PARTITION BY seller_id) AS n,
    MAX(order_month_purchase) OVER (PARTITION BY seller_id) AS last_ds
  FROM hm),
hg AS (SELECT CAST(a AS DOUBLE) AS a, CAST(b AS DOUBLE) AS b FROM (VALUES {_AL}) ta(a), (VALUES {_BE}) tb(b)),
rec AS (
  SELECT s2.seller_id, g.a, g.b, 2 AS i, s2.y AS l, s2.y - s1.y AS t, CAST(0 AS DOUBLE) AS sse, s2.n
  FROM hs s1 JOIN hs s2 ON s1.seller_id = s2.seller_id AND s1.i = 1 AND s2.i = 2, hg g
  UNION ALL
  SELECT r.seller_id, r.a, r.b, r.i + 1,
    r.a * s.y + (1 - r.a) * (r.l + r.t),
    r.b * ((r.a * s.y + (1 - r.a) * (r.l + r.t)) - r.l) + (1 - r.b) * r.t,
    r.sse + (s.y - r.l - r.t) * (s.y - r.l - r.t), r.n
  FROM rec r JOIN hs s ON s.seller_id = r.seller_id AND s.i = r.i + 1),
tuned AS (
  SELECT seller_id, a, b, l + t AS f FROM rec WHERE i = n
  QUALIFY ROW_NUMBER() OVER (PARTITION BY seller_id ORDER BY sse, a, b, l + t) = 1),
holt AS (
  SELECT h.seller_id, CAST(h.last_ds + INTERVAL 1 MONTH AS DATE) AS order_month_purchase,
    greatest(COALESCE(b.f, h.y), 0.0) AS forecast_ltv, b.a AS alpha, b.b AS beta
  FROM hs h LEFT JOIN tuned b ON b.seller_id = h.seller_id
  WHERE h.i = h.n)"""
HOLT_FORECAST = f"WITH RECURSIVE {_HOLT_CTES}\nSELECT * FROM holt"


def _holt_fitted() -> str:
    """Ten more searches, each over the nine pairs around the best one so far, at half the last distance."""
    ctes, best = [_HOLT_CTES.split(",\ntuned AS")[0], """t0 AS (
  SELECT seller_id, a, b, l + t AS f FROM rec WHERE i = n
  QUALIFY ROW_NUMBER() OVER (PARTITION BY seller_id ORDER BY sse, a, b, l + t) = 1)"""], "t0"
    for k, step in enumerate(["0.1", "0.05", "0.025", "0.0125", "0.00625", "0.003125", "0.0015625", "0.00078125", "0.000390625", "0.0001953125"], 1):
        ctes.append(f"""c{k} AS (
  SELECT DISTINCT seller_id, greatest(0::DOUBLE, least(1::DOUBLE, a + x::DOUBLE * {step}::DOUBLE)) AS a,
    greatest(0::DOUBLE, least(1::DOUBLE, b + y::DOUBLE * {step}::DOUBLE)) AS b
  FROM {best}, (VALUES (-1), (0), (1)) vx(x), (VALUES (-1), (0), (1)) vy(y)),
r{k} AS (
  SELECT g.seller_id, g.a, g.b, 2 AS i, s2.y AS l, s2.y - s1.y AS t, 0::DOUBLE AS sse, s2.n
  FROM c{k} g JOIN hs s1 ON s1.seller_id = g.seller_id AND s1.i = 1 JOIN hs s2 ON s2.seller_id = g.seller_id AND s2.i = 2
  UNION ALL
  SELECT r.seller_id, r.a, r.b, r.i + 1, r.a * s.y + (1 - r.a) * (r.l + r.t),
    r.b * ((r.a * s.y + (1 - r.a) * (r.l + r.t)) - r.l) + (1 - r.b) * r.t,
    r.sse + (s.y - r.l - r.t) * (s.y - r.l - r.t), r.n
  FROM r{k} r JOIN hs s ON s.seller_id = r.seller_id AND s.i = r.i + 1),
t{k} AS (
  SELECT seller_id, a, b, l + t AS f FROM r{k} WHERE i = n
  QUALIFY ROW_NUMBER() OVER (PARTITION BY seller_id ORDER BY sse, a, b, l + t) = 1)""")
        best = f"t{k}"
    return ("WITH RECURSIVE " + ",\n".join(ctes) + f"""
SELECT h.seller_id, CAST(h.last_ds + INTERVAL 1 MONTH AS DATE) AS order_month_purchase,
  greatest(COALESCE(b.f, h.y), 0.0) AS forecast_ltv, b.a AS alpha, b.b AS beta
FROM hs h LEFT JOIN {best} b ON b.seller_id = h.seller_id WHERE h.i = h.n""")


# the decision step's inputs: the scoring month's sellers, their forecast LTV and gift
_GIFT = "CASE WHEN churn_proba >= 0.95 THEN 10000.0 WHEN churn_proba >= 0.85 THEN 400.0 WHEN churn_proba >= 0.75 THEN 100.0 ELSE 50.0 END"
_INPUTS_CTES = (f"RECURSIVE {_SCORED},\n{_HOLT_CTES},\ninputs AS (SELECT scored.seller_id, churn_proba, coalesce(holt.forecast_ltv, 0) AS ltv, "
                f"CAST({_GIFT} AS DOUBLE) AS gift FROM scored LEFT JOIN holt ON holt.seller_id = scored.seller_id "
                f"WHERE _mt_date_reference = {_d(P.score_month)}),\n"
                f"cands AS (SELECT * FROM inputs WHERE churn_proba >= {P.proba_floor})")
FORECAST_PROFIT = (f"WITH RECURSIVE {_HOLT_CTES}\nSELECT MIN(order_month_purchase) AS month, COUNT(*) AS sellers, "
                   f"SUM(forecast_ltv) AS forecast_ltv_total FROM holt WHERE {_OF_MONTH}")
_RAW.update({"holt_forecast": HOLT_FORECAST, "holt_fitted": _holt_fitted(), "forecast_profit": FORECAST_PROFIT})
DOUBLES.update({k: ["forecast_ltv", "alpha", "beta"] for k in ("holt_forecast", "holt_fitted")})
SIG_EXTRA = {"forecast_profit": ["forecast_ltv_total"]}
DOUBLES.update({"last_month_profit": ["ltv_last_month", "profit_last_month"],
                "best_thresholds": ["p", "balanced_accuracy", "auc", "false_positive_rate", "precision",
                                    "sensibility", "specificity", "ks_diffs"]})
_RAW.update({"best_thresholds": BEST_THRESHOLDS})
_RAW.update({"last_month_profit": LAST_MONTH_PROFIT, "describe_full": DESCRIBE_FULL})

SIG: dict[str, list[str]] = {
    "describe": ["count", "mean", "std", "min", "q25", "q50", "q75", "max"],
    "skew_kurtosis": ["skew", "kurtosis"],
    "bowley": ["bowley"],
    "correlation": ["corr"],
    "point_biserial": ["r", "t"], "point_biserial_test": ["r", "t", "p_value"],
    "histogram_by_class": ["lo", "hi", "density"], "histograms": ["lo", "hi", "density"], "histograms_capped": ["lo", "hi", "density"],
    "roi_summary": ["total_ltv", "total_gift", "share_of_floor_sellers"],
    "describe_full": ["count", "mean", "std", "min", "q25", "q50", "q75", "max", "skew", "kurtosis", "bowley"],
}
SIG.update(SIG_EXTRA)
DOUBLES.update({
    "recency_ecdf": ["cum_share"], "flag_rate_by_class": ["share"], "class_balance": ["share"],
    "seller_history": ["forecast_ltv"],
    "time_split": _FS1_COLS + _FS2_COLS, "target_rate": ["target_rate"],
    "argmax_history": _FS1_COLS + _FS2_COLS, "manual_sigmoid": ["churn_proba"],
    "score_by_ref": ["mean_proba"], "auc": ["auc"],
    "threshold_metrics": ["p", "balanced_accuracy", "auc", "false_positive_rate", "precision",
                          "sensibility", "specificity", "ks_diffs"],
    "lift_gain": ["fraction", "gain", "lift"], "top_churn": ["churn_proba", "ltv"],
    "gift_tier": ["churn_proba", "ltv", "gift"], "budget_greedy": ["churn_proba", "ltv", "gift"],
    "budget_optimal": ["churn_proba", "ltv", "gift"],
    "roi_summary": ["total_ltv", "total_gift", "share_of_floor_sellers"],
    "monthly_profit": ["forecast_ltv", "current_month_profit"],
})
_RAW.update({
    "describe": DESCRIBE, "skew_kurtosis": SKEW_KURTOSIS, "bowley": BOWLEY, "correlation": CORRELATION,
    "point_biserial": POINT_BISERIAL, "point_biserial_test": POINT_BISERIAL_TEST, "histogram_by_class": HISTOGRAM_BY_CLASS, "histograms": HISTOGRAMS,
    "histograms_capped": HISTOGRAMS_CAPPED, "recency_ecdf": RECENCY_ECDF,
    "flag_rate_by_class": FLAG_RATE_BY_CLASS, "class_balance": CLASS_BALANCE, "shape": SHAPE,
    "seller_history": SELLER_HISTORY, "time_split": TIME_SPLIT, "target_rate": TARGET_RATE,
    "argmax_history": ARGMAX_HISTORY, "manual_sigmoid": MANUAL_SIGMOID, "score_by_ref": SCORE_BY_REF,
    "auc": AUC, "threshold_metrics": THRESHOLD_METRICS, "confusion_matrix": CONFUSION_MATRIX,
    "lift_gain": LIFT_GAIN, "top_churn": TOP_CHURN, "gift_tier": GIFT_TIER, "budget_greedy": BUDGET_GREEDY,
    "budget_optimal": BUDGET_OPTIMAL, "roi_summary": ROI_SUMMARY, "monthly_profit": MONTHLY_PROFIT,
})


def statements() -> dict[str, str]:  # noqa: F811
    out = {}
    for k, v in _RAW.items():
        v = v.replace(_INPUTS_SLOT, _INPUTS_CTES)
        if k in SIG:
            out[k] = sig_wrap(v, SIG[k])
        else:
            out[k] = rounded(v, DOUBLES.get(k, []))
    return out
