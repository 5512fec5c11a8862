"""Distributed running totals over a global order.

A window with ``orderBy`` and no ``partitionBy`` runs in one task. Here the
rows are range-partitioned on the order columns and written once, with the
number of their range, into the shared checkpoint folder; so totals per range
and rows come from the very same ranges, whatever Spark samples. Each range
gets its running totals in a window partition of its own, and one row per
range (broadcast: as many rows as ranges) shifts them to global totals. The
plan is the same at every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def ordered_cumulative_sums(df: DataFrame, order_cols: Sequence[str | Column], weight_cols: Sequence[str],
                            n_partitions: int | None = None, inclusive: bool = True) -> DataFrame:
    """``df`` with ``cum_<w>``: the sum of ``w`` over all rows before a row in the order of
    ``order_cols`` (names ascending, or sort expressions) and, when ``inclusive``, the row's own.

    Make the order total with key columns: a hot leading value is then split between ranges."""
    if n_partitions is None:
        n_partitions = max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    order = [F.asc(c) if isinstance(c, str) else c for c in order_cols]
    ranged = cut_lineage(df.repartitionByRange(n_partitions, *order).withColumn("_p", F.spark_partition_id()))
    totals = ranged.groupBy("_p").agg(*[F.sum(w).alias(f"_t_{w}") for w in weight_cols])
    wp = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = totals.select("_p", *[F.coalesce(F.sum(f"_t_{w}").over(wp), F.lit(0)).alias(f"_o_{w}")
                                    for w in weight_cols])
    wi = Window.partitionBy("_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    out = ranged.join(F.broadcast(offsets), "_p")
    return out.select(*df.columns, *[(F.col(f"_o_{w}") + F.coalesce(F.sum(w).over(wi), F.lit(0))).alias(f"cum_{w}")
                                     for w in weight_cols])


def cumulative_sums(df: DataFrame, order_col: str, weight_cols: Sequence[str],
                    descending: bool = False, n_buckets: int | None = None,
                    inclusive: bool = True) -> DataFrame:
    """Running totals by one column of distinct values (callers pre-aggregate ties)."""
    key = F.desc(order_col) if descending else F.asc(order_col)
    return ordered_cumulative_sums(df, [key], weight_cols, n_buckets, inclusive)


def cumulative_counts(df: DataFrame, order_col: str, weight_col: str,
                      descending: bool = False, n_buckets: int | None = None) -> DataFrame:
    out = cumulative_sums(df, order_col, [weight_col], descending, n_buckets)
    return out.select(order_col, F.col(f"cum_{weight_col}").alias("cum_w"))
