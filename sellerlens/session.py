"""Session helpers.

Operators never read session state except ``spark.checkpoint.dir``; time zone
independence comes from working in ``timestamp_ntz`` throughout.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "sellerlens", driver_memory: str | None = None) -> SparkSession:
    """A session with the library's settings. Master, shuffle partitions and driver
    memory are set only when asked for, so ``spark-submit`` settings hold. On a local
    master without ``spark.checkpoint.dir`` a scratch folder is set, before start."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        b = b.master(master)
        if master.startswith("local"):
            b = b.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="sellerlens-ckpt-"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        b = b.config("spark.driver.memory", driver_memory)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_dirs: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``. Where it is unset, a scratch folder on a
    local master (all tasks share its disk) and an error on a cluster."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = _local_dirs.setdefault(sc.applicationId, "") or tempfile.mkdtemp(prefix="sellerlens-ckpt-")
        _local_dirs[sc.applicationId] = d
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
        # Spark makes a folder of its own there, which nobody needs after this application
        remove_at_exit(spark, sc.getCheckpointDir())
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def remove_at_exit(spark: SparkSession, path: str) -> str:
    """Have the file system delete ``path`` when the driver ends; returns it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path
