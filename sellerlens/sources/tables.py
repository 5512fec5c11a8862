"""Table store on parquet paths.

Operations are the ones a lakehouse catalog offers (create, append,
create-or-replace, reload one partition, upsert); on plain parquet:
* partition reload = dynamic partition overwrite (one write, idempotent);
* replace, and upsert of a table without partitions (target ``left_anti``
  source, ``unionByName`` source), write a new version folder and then switch
  the table's small pointer file by a rename: readers see the old version or
  the new one whole, a crash leaves one of them live, and a plan may read the
  table that it replaces. The version before the live one is kept for readers
  that still run, older ones go;
* upsert of a partitioned table rewrites the touched partitions only;
* row counts for the load log are read back from the written parquet
  footers (metadata only, restricted to the partitions just written), so the
  batch is never scanned a second time. (``df.observe`` would avoid even
  that, but an ``Observation`` leaves the session unserializable for later
  MLlib model transforms on Spark 4.1.)
"""

from __future__ import annotations

import datetime as _dt
import functools
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage

LOAD_LOG = ("_meta", "load_log")


POINTER = "_live"
SCHEMA = "_schema"  # of a version when it was written: a table without rows has no file to take it from


class DuplicateKeyError(ValueError):
    pass


class TableExistsError(ValueError):
    pass


class TableNotFoundError(LookupError):
    pass


def _checked(distribution: str) -> str:
    if distribution not in ("none", "hash"):
        raise ValueError(f"unknown write distribution {distribution!r}")
    return distribution


class TableStore:
    def __init__(self, spark: SparkSession, root: str, max_records_per_file: int = 5_000_000,
                 dictionary_page_bytes: int = 128 * 1024 * 1024, distribution: str = "none"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.max_records_per_file = max_records_per_file
        # K6: the reference's 128 MiB parquet dictionary size
        self.dictionary_page_bytes = dictionary_page_bytes
        # K6: how partitioned writes are dealt, unless a call says otherwise
        self.distribution = _checked(distribution)

    # ------------------------------------------------------------ paths
    def path(self, db: str, table: str) -> str:
        return f"{self.root}/{db}/{table}"

    def _fs(self, path: str):
        """(file system, path) of the session's Hadoop configuration: local disk or any store."""
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def versions(self, db: str, table: str) -> list[str]:
        """The live version and, after a replace, the one before it."""
        fs, p = self._fs(f"{self.path(db, table)}/{POINTER}")
        if not fs.exists(p):
            return []
        return self._text(p.toString()).split()

    def live(self, db: str, table: str) -> str:
        """The folder of the live version."""
        found = self.versions(db, table)
        if not found:
            raise TableNotFoundError(f"{db}.{table}")
        return f"{self.path(db, table)}/{found[0]}"

    def _switch(self, db: str, table: str, version: str) -> None:
        """Point to ``version``: the new pointer is written beside the old one and renamed over it in
        one step, so a crash leaves a whole pointer, old or new."""
        before = self.versions(db, table)
        fs, fresh = self._fs(f"{self.path(db, table)}/{POINTER}-{version}")
        stream = fs.create(fresh, True)
        try:
            stream.write(bytearray(" ".join([version, *before[:1]]).encode()))
        finally:
            stream.close()
        self._rename_over(fresh, self._fs(f"{self.path(db, table)}/{POINTER}")[1])
        for old in before[1:]:
            fs.delete(self._fs(f"{self.path(db, table)}/{old}")[1], True)

    def _rename_over(self, source, target) -> None:
        sc = self.spark.sparkContext
        hadoop = sc._jvm.org.apache.hadoop.fs
        how = sc._gateway.new_array(getattr(sc._jvm, "org.apache.hadoop.fs.Options$Rename"), 1)
        how[0] = getattr(hadoop, "Options$Rename").OVERWRITE
        fs = source.getFileSystem(sc._jsc.hadoopConfiguration())
        hadoop.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration()).rename(source, target, how)

    def partition_columns(self, db: str, table: str) -> list[str]:
        """The columns that the live version is partitioned by, outermost first."""
        found, path = [], self.live(db, table)
        while True:
            fs, p = self._fs(path)
            inside = [f.getPath() for f in fs.listStatus(p) if f.isDirectory() and "=" in f.getPath().getName()]
            if not inside:
                return found
            found.append(inside[0].getName().split("=")[0])
            path = inside[0].toString()

    def exists(self, db: str, table: str) -> bool:
        """K7."""
        return bool(self.versions(db, table))

    def read(self, db: str, table: str) -> DataFrame:
        live = self.live(db, table)
        try:
            return self.spark.read.parquet(live)
        except AnalysisException as e:
            if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
        return self.spark.read.schema(self._text(f"{live}/{SCHEMA}")).parquet(live)  # partitions, but not a row yet

    def _text(self, path: str) -> str:
        fs, p = self._fs(path)
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    # ----------------------------------------------------------- writes
    def _writer(self, df: DataFrame, mode: str, partition_by: Sequence[str] = (), distribution: str | None = None):
        """K6. Distribution ``none``: every input task writes its own files, right for a batch of one
        partition value. ``hash``: rows are dealt by the partition columns first, so a partition has few
        files instead of one per task; adaptive execution splits what is above its advisory size between
        tasks (small partitions that hash to a hot one's place with it) and joins small pieces. Files are capped by ``max_records_per_file`` either way."""
        if partition_by and _checked(distribution or self.distribution) == "hash":
            df = df.hint("rebalance", *partition_by)
        w = (df.write.mode(mode).option("maxRecordsPerFile", self.max_records_per_file)
             .option("parquet.dictionary.page.size", self.dictionary_page_bytes))
        return w.partitionBy(*partition_by) if partition_by else w

    def _new_version(self, df: DataFrame, db: str, table: str, partition_by: Sequence[str] = (), distribution: str | None = None) -> None:
        version = f"v-{uuid.uuid4().hex[:12]}"
        path = f"{self.path(db, table)}/{version}"
        self._writer(df, "errorifexists", partition_by, distribution).parquet(path)
        fs, p = self._fs(f"{path}/{SCHEMA}")
        stream = fs.create(p, True)
        try:
            stream.write(bytearray(df.schema.toDDL().encode()))
        finally:
            stream.close()
        self._switch(db, table, version)

    def _into_live(self, df: DataFrame, db: str, table: str, mode: str, partition_by: Sequence[str] = (),
                   distribution: str | None = None) -> None:
        if not self.exists(db, table):
            self._new_version(df, db, table, partition_by, distribution)
            return
        w = self._writer(df, mode, partition_by, distribution)
        if mode == "overwrite":  # only the partitions that df holds
            w = w.option("partitionOverwriteMode", "dynamic")
        w.parquet(self.live(db, table))

    def count_rows(self, db, table, partition_col: str | None = None, values=None) -> int:
        """Rows of the table (or of the given partitions): answered from the
        parquet footers; partition filters prune the listing."""
        t = self.read(db, table)
        if partition_col is not None and values is not None:
            t = t.where(F.col(partition_col).isin(list(values)))
        return int(t.count())

    def create(self, df, db, table, partition_by=(), distribution=None) -> int:
        """K1."""
        if self.exists(db, table):
            raise TableExistsError(f"{db}.{table}")
        self._new_version(df, db, table, partition_by, distribution)
        return self.count_rows(db, table)

    def append(self, df, db, table, partition_by=(), partition_values=None, distribution=None) -> int | None:
        """K2. Returns the rows of ``partition_values`` when given (the
        partitions this append creates), else ``None``."""
        self._into_live(df, db, table, "append", partition_by, distribution)
        if partition_by and partition_values is not None:
            return self.count_rows(db, table, partition_by[0], partition_values)
        return None

    def replace(self, df, db, table, partition_by=(), distribution=None) -> int:
        """K3: create-or-replace; ``df`` may read the table itself."""
        self._new_version(df, db, table, partition_by, distribution)
        return self.count_rows(db, table)

    def reload_partition(self, df, db, table, partition_col: str, values=None) -> int:
        """K4: replace exactly the partitions present in ``df`` (idempotent).
        ``values``: the partition values being loaded, for the row count."""
        self._into_live(df, db, table, "overwrite", [partition_col])
        return self.count_rows(db, table, partition_col, values)

    def reload_parts(self, df, db, table, parts: dict) -> int:
        """K4 for one partition of several columns, given by their values."""
        self._into_live(df, db, table, "overwrite", list(parts))
        t = self.read(db, table)
        for c, v in parts.items():
            t = t.where(F.col(c) == F.lit(v))
        return int(t.count())

    def upsert(self, df, db, table, keys: Sequence[str] | str) -> int:
        """K5: update-all / insert-all on one or comma-separated keys; null keys equal each other.

        Of a partitioned table only the partitions that hold one of the feed's keys, or take one of
        its rows, are rewritten (dynamic overwrite); all other files stay as they are. The same feed
        again gives the same table, so a load that broke off is simply repeated. A table without
        partitions gets a new version."""
        if isinstance(keys, str):
            keys = [k.strip() for k in keys.split(",") if k.strip()]
        dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1)
        if not dup.isEmpty():
            raise DuplicateKeyError(f"source rows repeat a key of {keys}")
        if not self.exists(db, table):
            return self.create(df, db, table)
        target, parts = self.read(db, table), self.partition_columns(db, table)
        # partition values as the table types them; the right sides of joins have names of their own
        typed = df.select(*[df[c].cast(target.schema[c].dataType).alias(c) for c in target.columns])
        right = lambda d, cols: d.select(*[F.col(c).alias(f"_r_{c}") for c in cols])
        same = lambda cols: functools.reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in cols])
        fed = right(typed, keys)
        if not parts:
            self._new_version(target.join(fed, same(keys), "left_anti").unionByName(typed), db, table)
            return self.count_rows(db, table)
        places = target.select(*dict.fromkeys([*keys, *parts]))
        held = places.join(fed, same(keys), "left_semi").select(*parts)
        touched = cut_lineage(held.unionByName(typed.select(*parts)).distinct())
        old = target.withColumn("_dir", F.regexp_replace(F.input_file_name(), "/[^/]*$", "")).join(right(touched, parts), same(parts), "left_semi")
        # written before the table is, as it reads what the write replaces
        new = cut_lineage(old.drop("_dir").join(fed, same(keys), "left_anti").unionByName(typed))
        emptied = old.select("_dir", *parts).distinct().join(right(new, parts).distinct(), same(parts), "left_anti").select("_dir").collect()
        self._into_live(new, db, table, "overwrite", parts)
        jvm = self.spark.sparkContext._jvm
        for r in emptied:  # folders of partitions whose rows have all moved away
            p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(r["_dir"]))
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        return self.count_rows(db, table)

    def write(self, df, db, table, mode: str, keys=None, partition_by=()) -> int:
        """Explicit modes: overwrite / append / upsert / reload."""
        if mode == "overwrite":
            return self.replace(df, db, table, partition_by)
        if mode == "append":
            self.append(df, db, table, partition_by)
            return self.count_rows(db, table)
        if mode == "upsert":
            return self.upsert(df, db, table, keys)
        if mode == "reload":
            return self.reload_partition(df, db, table, partition_by[0])
        raise ValueError(f"unknown write mode {mode!r}")

    # --------------------------------------------------- partition facts
    def max_partition(self, db, table, col: str):
        return self.read(db, table).agg(F.max(col)).first()[0]

    def partition_loaded(self, db, table, col: str, value) -> bool:
        """K8: is the newest partition the given one?"""
        return self.exists(db, table) and self.max_partition(db, table, col) == value

    def ingested_refs(self, db, table, col: str = "_mt_date_reference") -> DataFrame:
        """K9: distinct reference dates present (a DataFrame, not a driver list)."""
        return self.read(db, table).select(col).distinct()

    # ---------------------------------------------------------- load log
    def log_load(self, table: str, rows: int, run_ts: _dt.datetime, layer: str) -> None:
        row = [(layer, table, run_ts, int(rows))]
        df = self.spark.createDataFrame(row, "layer string, table_name string, run_ts timestamp_ntz, written_lines long")
        self.append(df, *LOAD_LOG)

    def load_log(self) -> DataFrame:
        return self.read(*LOAD_LOG)


def latest_snapshot(bronze: DataFrame, partition_col: str = "_mt_bronze_partition_date") -> DataFrame:
    """Rows of the newest partition, de-duplicated. The max is a scalar
    subquery on the partition column, so the scan prunes to one partition."""
    newest = bronze.select(F.max(partition_col)).scalar()
    return bronze.where(F.col(partition_col) == newest).distinct()


def missing_refs(wanted: DataFrame, ingested: DataFrame, col: str = "_mt_date_reference") -> DataFrame:
    """Reference dates not yet in the store (anti-join)."""
    return wanted.select(col).distinct().join(ingested.select(col), col, "left_anti")
