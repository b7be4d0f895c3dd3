"""Session settings the library relies on, and the shared scratch location."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every entry point relies on: UTC wall clock for epoch-ms answers and
# attendance dates; AQE for partition coalescing and skew splitting; no generated method that the JVM
# would not compile (it leaves those beyond 8,000 bytes of bytecode to its interpreter).
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

DEFAULT_CHECKPOINT_DIR = "/tmp/formspark-checkpoints"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library needs (idempotent)."""
    for k, v in SESSION_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "formspark") -> SparkSession:
    """A local session for tests and benchmarks (UI off)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Set by the cluster. Only a ``local`` master, where driver and tasks share their folders
    (tests, a laptop), gets a default when it is unset; any other master fails.
    """
    return ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir is not set: master {master} needs a folder that all executors share")
        d = DEFAULT_CHECKPOINT_DIR
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


#: This process's part of the scratch folder.
_RUN = uuid.uuid4().hex
_cleaned: set[str] = set()


def _clean(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001  the session is gone; nothing is left to clean with
        pass


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (never a machine-local temp dir).

    What a process puts there is deleted when it ends.
    """
    base = f"{checkpoint_dir(spark)}/formspark-scratch/{_RUN}"
    if base not in _cleaned:
        _cleaned.add(base)
        atexit.register(_clean, spark, base)
    return f"{base}/{name}-{uuid.uuid4().hex}"


#: Rows of a table, each of which becomes many, that one task reads.
ROWS_A_TASK = 250_000


def spread(df: DataFrame, rows_a_task: int | None = None) -> DataFrame:
    """Round-robin repartition when an input has fewer partitions than the cluster has cores.

    With ``rows_a_task`` also when its partitions would hold more rows than that, by the count that the
    footers of Parquet files give: where a row becomes many, a task has a bounded number of them at any size.

    A small source that fans out (one row per submission -> one row per item)
    or one large unsplittable multi-line CSV would otherwise leave all the
    parsing to a handful of tasks.  Inputs that already have enough splits
    (the normal case at scale) are left alone: no shuffle is added.
    """
    least = df.sparkSession.sparkContext.defaultParallelism
    if rows_a_task is not None:
        least = max(least, -(-df.count() // rows_a_task))
    if df.rdd.getNumPartitions() < least:
        return df.repartition(least)
    return df
