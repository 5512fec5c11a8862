"""Shared helpers: table reads, lineage cuts in the shared folder, bounded id
prefilter, byte-level word splitting and distributed connected components."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bits of the id prefilter: its table never exceeds 2**20 rows of 64 bits each.
FILTER_WORDS = 1 << 20

# Word rule A: ASCII letters (lower-cased), digits and every non-ASCII character.
ALNUM_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)

_local_dir: dict[str, str] = {}
_shipped: set[str] = set()


def alnum_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of A-Z-lower-cased UTF-8 bytes."""
    return text.translate(ALNUM_TABLE).split()


def space_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes (bytes.split() splits at just these)."""
    return text.split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temp folder only on a local master."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _local_dir:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        _local_dir[app] = tempfile.mkdtemp(prefix="llm-shared-")
    return _local_dir[app]


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors' Python workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parents[2]
    name = f"{tempfile.mkdtemp(prefix='llm-code-')}/sellerlens-{uuid.uuid4().hex[:8]}.zip"
    with zipfile.ZipFile(name, "w") as z:
        for f in [top / "sellerlens" / "__init__.py", top / "sellerlens" / "params.py", *sorted(Path(__file__).parent.glob("*.py"))]:
            z.write(f, f.relative_to(top))
    sc.addPyFile(name)
    _shipped.add(sc.applicationId)


def give_back() -> None:
    """Hand freed memory back to the system: Python workers live on after a task, and the next stage's need room."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def map_arrow(df: DataFrame, func, schema) -> DataFrame:
    """``mapInArrow`` whose function may use this package's modules; its memory goes back when a task ends."""
    ship(df.sparkSession)

    def run(batches):
        yield from func(batches)
        give_back()

    return df.mapInArrow(run, schema)


def materialise(df: DataFrame) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet into the shared folder and read it back.

    The files survive lost executors; they are removed when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return spark.read.schema(df.schema).parquet(path)


def keep_if_listed(df: DataFrame, key: str, ids: DataFrame, listed: bool = True) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be in ``ids`` (one column): no listed row is lost.

    With ``listed=False`` the other rows, null keys among them.

    A one-hash bit table of at most ``FILTER_WORDS`` 64-bit rows, whatever the
    size of ``ids``, is broadcast, so wide rows that cannot match never reach
    a shuffle. False positives go at the exact join that follows.
    """
    spot = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_WORDS * 64))
    bits = (
        ids.select(spot(ids[ids.columns[0]]).alias("_p"))
        .select(F.shiftright("_p", 6).alias("_w"), F.expr("shiftleft(1L, CAST(_p & 63 AS INT))").alias("_b"))
        .groupBy("_w").agg(F.bit_or("_b").alias("_b"))
    )
    p = spot(df[key])
    return df.join(
        F.broadcast(bits),
        (F.shiftright(p, 6) == bits["_w"])
        & (bits["_b"].bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), p.bitwiseAND(F.lit(63)).cast("int"))) != 0),
        "left_semi" if listed else "left_anti",
    )


def packed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, row): all columns of ``docs`` in one struct, where no other name can clash with them."""
    return docs.select("doc_id", "text", F.struct(*[docs[c] for c in docs.columns]).alias("row"))


def unpacked(df: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns of a ``packed`` frame, some of them changed."""
    return df.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in columns])


def apart(df: DataFrame) -> DataFrame:
    """Forget the partitioning of an aggregate, so that a join on its grouping key deals both sides
    anew and AQE can split a hot key's partition of the other side."""
    return df.hint("rebalance")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` as a lambda variable."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _signature(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return (r[0], r[1])


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest reachable id for every node of ``edges`` (two long columns).

    Alternating large-star / small-star steps: every step is one partial
    aggregation and one equi-join, so a hub with a third of all edges is
    pre-aggregated and its join partition can be split by AQE. Nulls and self
    loops are dropped; an empty edge table gives an empty result.
    """
    a, b = edges.columns[:2]
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct()
    e = materialise(e)
    before = None
    for _ in range(max_rounds):
        # large star: hang every larger neighbour on the smallest id around
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(apart(low), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: hang all smaller neighbours and the node itself on the smallest
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(apart(low), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        )
        e = materialise(small)
        now = _signature(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("connected components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def drop_listed(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not in ``ids`` (one column); only possible matches are shuffled."""
    ids = materialise(ids)
    name = ids.columns[0]
    maybe = keep_if_listed(df, key, ids)
    rest = keep_if_listed(df, key, ids, listed=False)
    return maybe.join(ids, maybe[key] == ids[name], "left_anti").unionByName(rest)
