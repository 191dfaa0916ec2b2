"""SparkSession construction and the few settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
import warnings

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

#: settings that are set only where the submitter (submit arguments, defaults file) left them out
DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even when that costs one more shuffle downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Broadcast only what was measured: no planning-time broadcast from (compressed-file) size
    # estimates; AQE turns a join into a broadcast when a side's shuffled size is known small.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": os.environ.get("CARETRAIL_BROADCAST_MAX", "64MB"),
    # checkpoint files of report stages are removed once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

#: checkpoint folders that this process made for itself, which the next one will not know
OWN_FOLDERS: set[str] = set()


def submitted_conf() -> SparkConf:
    """What the submitter set: submit arguments and the defaults file, as the JVM sees them."""
    first = SparkConf(loadDefaults=False)
    first.set("spark.driver.memory", os.environ.get("CARETRAIL_DRIVER_MEMORY", "8g"))  # submit arguments come after it
    SparkContext._ensure_initialized(conf=first)
    return SparkConf()


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "caretrail") -> SparkSession:
    """The running session, or a new one that keeps everything the submitter set.

    Master and shuffle partitions are set only when asked for here or left out by the submitter; a bare
    local start gets ``local[$BENCH_CPUS]``. The time zone is pinned to UTC because whole-day differences
    and epoch seconds must not follow a wall clock.
    """
    running = SparkSession.getActiveSession()
    if running is None:
        given = submitted_conf()
        builder = SparkSession.builder.config("spark.sql.session.timeZone", "UTC")
        if not given.contains("spark.app.name"):
            builder = builder.appName(app_name)
        local = master or (None if given.contains("spark.master") else f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        if local:
            builder = builder.master(local)
        if shuffle_partitions or (local and not given.contains("spark.sql.shuffle.partitions")):
            builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or os.environ.get("BENCH_CPUS", "8")))
        for key, value in DEFAULTS.items():
            if not given.contains(key):
                builder = builder.config(key, value)
        running = builder.getOrCreate()
        running.sparkContext.setLogLevel("ERROR")
    check_settings(running)
    ensure_checkpoint_dir(running)
    return running


def check_settings(spark: SparkSession) -> None:
    """Warn about settings under which results or hot keys would suffer."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        warnings.warn("spark.sql.session.timeZone is not UTC: days and epoch seconds will follow a wall clock", stacklevel=2)
    for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"):
        if spark.conf.get(key) != "true":
            warnings.warn(f"{key} is off: partitions of hot keys will not be split", stacklevel=2)


def is_local(spark: SparkSession) -> bool:
    """One machine: driver and executors are one process."""
    return spark.sparkContext.master.partition("[")[0] == "local"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder. On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is; without it a cluster session is refused. Only a local session gets a folder of its own. On
    a Spark Connect session the server's setting applies and is returned as configured."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no driver-side context; the server owns the setting
        return spark.conf.get("spark.checkpoint.dir", "") or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="caretrail-ckpt-")
        OWN_FOLDERS.add(configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def stable_root(spark: SparkSession) -> str | None:
    """The configured shared folder itself, which stays the same from one application to the next."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return None if root in OWN_FOLDERS else root
