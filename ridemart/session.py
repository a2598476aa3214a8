"""Spark session defaults and the shared lineage-cutting folder."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_shipped: set[str] = set()


def get_spark(master: str | None = None, app: str = "ridemart",
              shuffle_partitions: int | None = None,
              extra_conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings every ridemart job relies on.

    UTC session time zone (calendar attributes and minute differences must not depend on the
    machine), AQE with partition coalescing and skew-join splitting, no web UI.
    """
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("RIDEMART_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # checkpoint files of dense-key numbering are removed once their DataFrame is gone
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application: functions sent to their Python workers
    import it by name."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="ridemart-ship-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


#: Input files' bytes for each shuffle partition at first (AQE merges small ones), and the most bytes of a scan's split or of
#: merged partitions: a task's rows, which may be ten times as large in memory, are then sorted there without spilling.
SHUFFLE_INPUT_BYTES, TASK_BYTES = 4 << 20, 32 << 20
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
TASK_SIZES = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
_held_conf: dict[SparkSession, dict[str, str | None]] = {}


def size_tasks(spark: SparkSession, paths: list[str]) -> None:
    """Let the number of a job's tasks grow with its input files, so that a task's share does not: the session's later
    shuffles start from as many partitions as the files' bytes ask for, and scans and merged partitions are smaller. Settings
    that are finer already stay. ``reset_tasks`` gives the session its own settings back."""
    reset_tasks(spark)
    size, conf = 0, spark._jsparkSession.sessionState().newHadoopConf()
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = where.getFileSystem(conf)
        if fs.exists(where):
            size += fs.getContentSummary(where).getLength()
    own = {k: spark.conf.get(k, None) for k in (INITIAL_PARTITIONS, *TASK_SIZES)}
    least = int(own[INITIAL_PARTITIONS] or spark.conf.get("spark.sql.shuffle.partitions"))
    _held_conf[spark] = own
    spark.conf.set(INITIAL_PARTITIONS, str(max(least, -(-size // SHUFFLE_INPUT_BYTES))))
    for key in TASK_SIZES:
        held = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
        spark.conf.set(key, f"{min(held, TASK_BYTES)}b")


def reset_tasks(spark: SparkSession) -> None:
    """Undo ``size_tasks``."""
    for key, value in _held_conf.pop(spark, {}).items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder for checkpoints and intermediate tables.

    On a cluster this is whatever the deployment put in ``spark.checkpoint.dir`` (shared storage
    that survives executor loss). Only when it is unset -- local runs and tests -- a fresh
    folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    conf_dir = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not conf_dir:
        master = sc.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="ridemart-ckpt-", dir="/tmp")
        spark.conf.set(CHECKPOINT_CONF, conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder, unique to this application."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    app_id = spark.sparkContext.applicationId
    return "/".join([base, "ridemart", app_id, *parts])
