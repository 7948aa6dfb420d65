"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. Time zone matters: ages are computed from
# unix_timestamp(birthdate) and must not shift with the executor's locale.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "cartwise") -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    On a cluster leave ``master`` as None so spark-submit decides; tests pass
    ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to a session someone else built."""
    for k, v in SESSION_DEFAULTS.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder and register it with the SparkContext.

    The cluster names it in ``spark.checkpoint.dir``; we only invent one when it
    is unset and Spark runs in local mode (tests, the bench). On a cluster with
    no setting we refuse rather than write to a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset conf raises in some versions
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="cartwise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


# Sizing rules for inputs far larger than memory (fixed values of this build).
INPUT_BYTES_PER_SHUFFLE_PARTITION = 1 << 30     # projections and partial aggregation shrink data first
MIN_SHUFFLE_PARTITIONS, MAX_SHUFFLE_PARTITIONS = 200, 50_000
MIN_SPLIT_BYTES, MAX_SPLIT_BYTES = 128 << 20, 1 << 30
TARGET_SCAN_TASKS = 200_000


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files under ``paths`` from file-system metadata only."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            total += fs.getContentSummary(path).getLength()
    return total


def size_for_input(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """Set shuffle partitions and scan split size from the size of ``paths``, unless
    the application set them itself (at launch or in this session).

    An explicit call, for one input: nothing calls it on its own, and a later
    call for another input replaces what an earlier one set. Shuffle
    partitions: about one per GiB of input, clamped to [200, 50,000]; AQE
    coalesces the small ones after each map stage, so over-provisioning is
    cheap while under-provisioning spills. Scan splits grow from 128 MiB to at
    most 1 GiB so a 100 TB scan stays near 200,000 tasks. Returns what was set.
    """
    launched = spark.sparkContext.getConf()
    changed: dict[str, str] = {}
    size = input_bytes(spark, paths)
    if size <= 0:
        return changed
    wanted = {
        "spark.sql.shuffle.partitions": str(min(MAX_SHUFFLE_PARTITIONS, max(
            MIN_SHUFFLE_PARTITIONS, size // INPUT_BYTES_PER_SHUFFLE_PARTITION))),
        "spark.sql.files.maxPartitionBytes": str(min(MAX_SPLIT_BYTES, max(
            MIN_SPLIT_BYTES, size // TARGET_SCAN_TASKS))),
    }
    for key, value in wanted.items():
        ours = f"cartwise.sized.{key}"     # remembers what this function set
        if launched.contains(key) or spark.conf.get(key, None) not in (_default(spark, key), spark.conf.get(ours, None)):
            continue
        spark.conf.set(key, value)
        spark.conf.set(ours, value)
        changed[key] = value
    return changed


def _default(spark: SparkSession, key: str) -> str | None:
    """The built-in default of a SQL setting (None if unknown)."""
    try:
        entry = spark.sparkContext._jvm.org.apache.spark.sql.internal.SQLConf.getConfigEntry(key)
        return str(entry.defaultValueString())
    except Exception:  # noqa: BLE001 - unknown key or gateway difference
        return None
