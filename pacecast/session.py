"""Spark session and shared-storage helpers.

The library never invents machine-local scratch space on a cluster: the
shared folder is whatever the cluster names in ``spark.checkpoint.dir``.
Where that setting is absent, a session with a local master (tests) gets a
private temporary folder and any other session an error.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "pacecast", driver_memory: str = "8g",
                  extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests (a cluster supplies its own)."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for key, value in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def cluster_conf(total_cores: int, input_bytes: int,
                 shuffle_bytes_per_partition: int = 512 << 20) -> dict[str, str]:
    """Suggested settings for a cluster session (the library sets none itself).

    The first aggregations shuffle at most the pruned input after map-side
    partial aggregation, so initial shuffle partitions are sized from the
    input (``shuffle_bytes_per_partition`` each, at least 2 per core) and AQE
    coalesces the small later stages to ~128 MB. Splits
    stay at 128 MB so a scan task fits comfortably in executor memory.
    """
    partitions = max(2 * total_cores, -(-input_bytes // shuffle_bytes_per_partition))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(128 << 20),
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }


_local_folders: dict[str, str] = {}  # by application id


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for checkpoints and written tables.

    Read from the session: the context's checkpoint directory or
    ``spark.checkpoint.dir``. Without either, a local master gets one private
    temporary folder for its application; on a cluster, where executors would not
    see such a folder, an error names the missing setting. The session's own
    checkpoint directory is never changed.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if sc.applicationId not in _local_folders:
        _local_folders[sc.applicationId] = tempfile.mkdtemp(prefix="pacecast-")
    return _local_folders[sc.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for one written table."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{os.getpid()}-{next(_counter)}"


def materialize(df, name: str, scratch: list | None = None):
    """Write ``df`` to a fresh Parquet folder in the shared folder and read it back.

    Used after the heavy aggregations, where the result is small (a daily
    series, a forecast frame): it is computed once even when read by
    several branches, later stages never recompute the raw-data work after
    a lost executor, and the read-back carries real file sizes for AQE.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    if scratch is not None:
        scratch.append(path)
    return df.sparkSession.read.parquet(path)


def remove_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch folders once nothing reads them any more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        jpath = jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(conf).delete(jpath, True)
    paths.clear()


def _count():
    i = 0
    while True:
        i += 1
        yield i


_counter = _count()
