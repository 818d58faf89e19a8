"""Session settings shared by tests, the bench and the driver entry.

Nothing here changes results; it pins the settings the value checks rely on
(UTC session time zone) and the ones that matter at cluster scale (AQE with
skew-join splitting and runtime broadcast decisions, sized shuffles).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings applied to any session we touch.  They are all runtime SQL confs,
# so they can be set on a session created elsewhere (driver, notebook).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE re-plans a shuffled join as a broadcast join only when the
    # *measured* size of the small side is below this bound; above it the
    # join stays sort-merge.  This is the size check behind every join whose
    # smaller side grows with the data.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; set one only if unset.

    On a cluster the setting names a shared (HDFS/object store) folder that
    survives executor loss.  Only local runs (tests, bench) fall back to a
    fresh folder under /tmp; on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "patchlens") -> SparkSession:
    """Local session for tests and the bench (UI off, no ports beyond Spark's own)."""
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PATCHLENS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.local.dir", scratch)
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .config("spark.driver.extraJavaOptions", f"-Dderby.system.home={scratch}")
    )
    for k, v in RUNTIME_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
