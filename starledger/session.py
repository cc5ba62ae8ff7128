"""Session and scratch-space helpers.

Library code never invents a machine-local folder on a cluster: shared
scratch space (checkpoints, staging tables) lives under the folder the
cluster names in ``spark.checkpoint.dir``.  Only a local-mode session
without that setting (tests) gets a private temporary folder.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "starledger", extra: dict | None = None) -> SparkSession:
    """Session used by tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it if needed.

    Order: the context's folder, then ``spark.checkpoint.dir`` from the
    session; a fresh temporary folder only for a local-mode session.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        sc.setCheckpointDir(named)
        return sc.getCheckpointDir()
    if not re.match(r"local($|\[)", sc.master):  # local-cluster has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running starledger jobs")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="starledger-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path for a staging table next to the checkpoints."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/starledger-scratch/{name}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this library made, through Spark's file system."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet into the shared scratch space and read
    it back: for input that several jobs, or several passes, work on."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable (not local) checkpoint: fixes the data a multi-pass
    algorithm sees, and survives the loss of executors.  Without a
    driver-side context (a remote session) the server's own
    ``spark.checkpoint.dir`` is used."""
    try:
        checkpoint_dir(df.sparkSession)
    except Exception as exc:  # remote sessions have no SparkContext
        if "sparkContext" not in str(exc) and "JVM" not in str(exc) and "Connect" not in str(exc):
            raise
    return df.checkpoint(eager=True)


def run_concurrently(tasks: dict, workers: int = 4) -> dict:
    """Run independent Spark actions (table writes) from a few driver
    threads.  Spark schedules jobs from different threads side by side,
    so many small jobs (one-file dimensions, summaries) overlap instead
    of leaving executors idle between them.  Results by task name; the
    first failure is raised."""
    from concurrent.futures import ThreadPoolExecutor
    if workers <= 1 or len(tasks) <= 1:
        return {name: fn() for name, fn in tasks.items()}
    with ThreadPoolExecutor(max_workers=workers) as pool:
        futures = {name: pool.submit(fn) for name, fn in tasks.items()}
        return {name: f.result() for name, f in futures.items()}
