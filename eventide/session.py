"""Session helpers: UTC clock, AQE, and the shared checkpoint folder.

Jobs never pick a checkpoint folder of their own on a cluster: the folder is
read from ``spark.checkpoint.dir`` (or the SparkContext's checkpoint dir).
Only a local-mode session with nothing configured (tests) gets a fresh
scratch folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "eventide") -> SparkSession:
    """Session for tests, benches and local runs (UI off, AQE on, UTC)."""
    return (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .getOrCreate()
    )


def use_utc(spark: SparkSession) -> None:
    """Pin the session clock to UTC.

    The driver tables store ``TIMESTAMP_NTZ``; casting them to ``TIMESTAMP``
    and extracting hours both follow the session zone, so every query pins it.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Reads ``SparkContext.getCheckpointDir()`` first, then the
    ``spark.checkpoint.dir`` setting. Only when neither is set and the master
    is local (tests) is a scratch folder created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return (sc.getCheckpointDir() or configured).rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: a cluster run needs a shared folder "
            "for checkpoints and intermediate tables")
    scratch = tempfile.mkdtemp(prefix="eventide-ckpt-")
    sc.setCheckpointDir(scratch)
    return (sc.getCheckpointDir() or scratch).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/eventide/{name}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Make ``eventide`` importable on executors (needed by the Python state
    processors): zip the package into the shared checkpoint folder and add
    it with ``addPyFile``, once per SparkContext."""
    import os
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_eventide_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = scratch_path(spark, "pkg") + ".zip"
    if target.startswith("file:") or "://" not in target:
        local = target.removeprefix("file:")
        os.makedirs(os.path.dirname(local), exist_ok=True)
    else:
        # remote checkpoint folder: the zip is a driver-side artifact that
        # Spark's file server hands to the executors
        local = tempfile.mkstemp(prefix="eventide-", suffix=".zip")[1]
        target = local
    with zipfile.ZipFile(local, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _dirs, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(target)
    sc._eventide_shipped = True


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Compute ``df`` once, store it in the shared checkpoint folder and
    continue from the stored copy (a reliable, eager ``checkpoint``).

    Used where a derived table is read several times (so the base data is
    scanned once) or where the lineage must be cut. The stored copy
    survives executor loss, unlike a cached or locally checkpointed one;
    Spark 4 computes and writes it in a single job. ``name`` labels the
    step for readers of the code.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def python_workers_can_import(spark: SparkSession) -> None:
    """Python code of this package run inside tasks (pandas folds, state
    processors): ship the package and pickle its functions by value, so
    workers and driver-side Python runners need no install of their own."""
    import eventide
    from pyspark import cloudpickle

    ship_package(spark)
    cloudpickle.register_pickle_by_value(eventide)
