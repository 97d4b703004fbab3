"""The forecast table - Parquet partitioned by ``date``.

A run replaces the days ``[lo, hi)``: the rows are first staged as Parquet
partitioned by day in the shared checkpoint folder (cutting the lineage,
which may read earlier partitions of the same table, and making the write
retry-safe), then written with *dynamic* partition overwrite so only the
slice's day partitions are swapped, each committed by Spark's output
committer. Days of the slice that the new rows do not cover (a slice with
no live series) are removed before that write: a run that breaks off in between
leaves no stale day beside new ones, and running the slice again completes it.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove_paths, scratch_path


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return bool(fs.exists(jpath))


def stored_days(spark: SparkSession, path: str) -> dict[dt.date, object]:
    """Day partitions present under ``path`` (partition name -> Hadoop path)."""
    if not table_exists(spark, path):
        return {}
    fs, jpath = _fs(spark, path)
    out = {}
    for status in fs.listStatus(jpath):
        name = status.getPath().getName()
        if status.isDirectory() and re.fullmatch(r"date=\d{4}-\d{2}-\d{2}", name):
            out[dt.date.fromisoformat(name[len("date="):])] = status.getPath()
    return out


def read_output(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame | None:
    if not stored_days(spark, path):
        return None
    # a date whatever the session infers from partition names
    df = spark.read.parquet(path).withColumn("date", F.col("date").cast("date"))
    return df.select(*columns) if columns else df


def write_slice(df: DataFrame, path: str, lo: dt.date, hi: dt.date,
                columns: list[str] | None = None) -> list[dt.date]:
    """Replace the days ``[lo, hi)`` of the table at ``path`` with ``df``'s rows.

    Returns the days written. Rows outside the slice are never written.
    The rows are staged partitioned by day (one file per day) in the shared
    folder: the staged day folders tell which days the slice has, and the
    final write copies them without another shuffle.
    """
    spark = df.sparkSession
    rows = df.filter((F.col("date") >= F.lit(lo)) & (F.col("date") < F.lit(hi)))
    if columns:
        rows = rows.select(*columns)
    staging = scratch_path(spark, "slice-staging")
    rows.repartition("date").write.mode("overwrite").partitionBy("date").parquet(staging)
    try:
        written = sorted(stored_days(spark, staging))
        fs, _ = _fs(spark, path)
        for day, jpath in stored_days(spark, path).items():
            if lo <= day < hi and day not in written:
                fs.delete(jpath, True)
        if written:
            staged = spark.read.parquet(staging)
            if columns:
                staged = staged.select(*columns)
            (staged.write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic")
             .partitionBy("date")
             .parquet(path))
    finally:
        remove_paths(spark, [staging])
    return written
