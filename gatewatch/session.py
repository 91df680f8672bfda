"""SparkSession settings the engine relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings that matter for correctness or for the plans' shape.
ENGINE_CONF = {
    # day buckets and current_date follow the session zone: pin it
    "spark.sql.session.timeZone": "UTC",
    # adaptive execution: runtime broadcast of sides measured small, skew
    # splitting for joins, partition coalescing
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # state with lists and timers, off the JVM heap
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder, `spark.checkpoint.dir` of the session. All
    executors must reach it, so none is made up here."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the checkpoint folder, for tables that a job writes once
    and reads several times. On a local master without one, a temporary folder."""
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None) and (
            spark.sparkContext.master.startswith("local")):
        return tempfile.mkdtemp(prefix="gatewatch-shared-")
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/shared-{uuid.uuid4().hex}"


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "gatewatch",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for local runs and tests (UI off, UTC, AQE on)."""
    os.environ.setdefault("PYSPARK_PYTHON", "python3")
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(ENGINE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    # the status store keeps every job, stage and SQL execution (with its plan)
    # even without a UI; long local sessions only need recent ones
    conf["spark.ui.retainedJobs"] = "200"
    conf["spark.ui.retainedStages"] = "200"
    conf["spark.ui.retainedTasks"] = "10000"
    conf["spark.sql.ui.retainedExecutions"] = "50"
    # release finished queries' shuffle files and broadcast blocks promptly
    # (the cleaner acts on JVM garbage collection, by default every 30 min)
    conf["spark.cleaner.periodicGC.interval"] = "1min"
    conf["spark.driver.memory"] = os.environ.get("GATEWATCH_DRIVER_MEMORY", "8g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    """Set the runtime-modifiable engine settings on an existing session."""
    for k, v in ENGINE_CONF.items():
        spark.conf.set(k, v)
