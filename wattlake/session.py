"""Session builder and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. UTC because source times carry no zone;
# ANSI so bad casts fail loudly unless the ``try_`` form is used on purpose;
# dynamic partition overwrite so replacing days never touches other days.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split partitioned writes (REBALANCE) whose day holds a large share of rows
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # silver keeps ``date`` as text in the path; read it back as DATE
    "spark.sql.sources.partitionColumnTypeInference.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# On a cluster, consider raising ``spark.sql.adaptive.autoBroadcastJoinThreshold``
# (runtime, measured-size broadcast with sort-merge fallback) so the per-slot
# aggregates that facts join back broadcast instead of shuffling the fact
# side; measured slower on a single machine, so it is not set here.


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "wattlake", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the pipeline's settings.

    On a cluster, leave ``master`` and ``shuffle_partitions`` unset: the
    cluster's own configuration wins and AQE sizes partitions at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Apply the SQL settings on an existing session (e.g. the driver's)."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staging: ``spark.checkpoint.dir``.

    The cluster names it; only when it is unset on a ``local`` master (tests,
    a laptop) do we pick a fresh local folder and register it on the session.
    On a cluster a driver-local folder would be invisible to executors (and
    lost with the driver's disk), so an unset folder is an error there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the driver and all executors")
        d = tempfile.mkdtemp(prefix="wattlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared folder for one run."""
    return f"{shared_dir(spark)}/wattlake/{name}-{uuid.uuid4().hex[:12]}"
