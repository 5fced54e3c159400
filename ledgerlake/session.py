"""Session settings the operators rely on.

All timestamps are zone-less (``timestamp_ntz``) and read as UTC, ANSI mode is
on (Spark 4 default), AQE re-plans joins at runtime and splits skewed
partitions, and partition overwrite is dynamic so that a job can replace one
slice of a partitioned table.
"""

from __future__ import annotations

import gc
import tempfile

from pyspark.sql import SparkSession

# Settings every session must have for the operators to give right results.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Settings for speed; a cluster may tune them.
PERFORMANCE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, app_name: str = "ledgerlake",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Get or create a session with the settings above (UI off)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {**REQUIRED_CONF, **PERFORMANCE_CONF,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            # lineage cuts are small and many; drop their files once unreferenced
            "spark.cleaner.referenceTracking.cleanCheckpoints": "true"}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the required settings to an existing session (idempotent)."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    for k, v in PERFORMANCE_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


SCRATCH_KEY = "ledgerlake.scratch.dir"


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    Read from ``spark.checkpoint.dir`` (the cluster's shared folder) or the
    context's checkpoint directory.  When the session names none, a local
    master gets a local folder and any other is refused; the folder is kept under our own key, since a core
    setting cannot be changed on a running session.
    """
    d = (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SCRATCH_KEY, None)
         or spark.sparkContext.getCheckpointDir())
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="ledgerlake-")
        spark.conf.set(SCRATCH_KEY, d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def new_scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared scratch folder (never reused)."""
    import uuid
    return f"{scratch_dir(spark)}/ledgerlake/{name}-{uuid.uuid4().hex[:12]}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch path that is read no more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release_shuffles(spark: SparkSession) -> None:
    """Shuffle files of ended jobs stay on disk until the driver collects its garbage, which it does by its own memory
    alone; between the large steps of a job it is told to."""
    gc.collect()
    for _ in range(2):                          # what the first one only finds to be garbage goes with the second
        spark._jvm.System.gc()
        spark._jvm.System.runFinalization()
