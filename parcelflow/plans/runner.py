"""Stages that resume: a stage whose output is written is read instead of run again."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name that driver and executors share: below spark.checkpoint.dir, or, in local mode only, a temporary
    folder."""
    told = spark.conf.get("spark.checkpoint.dir", None)
    if not told and not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{(told or os.path.join(tempfile.gettempdir(), 'parcelflow-runs')).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Partitions that a shuffle begins with, at least; where Spark adapts, it puts small ones together by their size.
PARTITIONS = 240


def spread(spark: SparkSession) -> None:
    """Lets shuffles begin with many partitions, unless the session says with how many. With just one for each core, what a
    task sorts or groups would grow with the input."""
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(max(PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))))


def join_in_place(spark: SparkSession) -> None:
    """Lets tables that are both shuffled by one of a join's keys be joined by all of them without another shuffle."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def written(rows: DataFrame, path: str, mode: str = "error") -> DataFrame:
    """The rows, written and read again. Files of the shuffles that made them are deleted at once, not when the driver comes
    to collect its garbage."""
    spark, name = rows.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        rows.write.mode(mode).option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(name, before)
    return spark.read.parquet(path)


def kept(rows: DataFrame, name: str) -> DataFrame:
    """The same rows, made once and written, for plans that read them more than once."""
    return written(rows, scratch(rows.sparkSession, name))


class Run:
    """One job's stages below a folder in a shared store. Spark's own _SUCCESS commit of a stage's table is its marker."""

    def __init__(self, spark: SparkSession, root: str, job: str):
        self.spark, self.path = spark, f"{root.rstrip('/')}/{job}"

    def done(self, stage: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.path}/{stage}/_table")
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
                return None
            raise

    def stage(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        found = self.done(name)
        if found is not None:
            return found
        return written(make(), f"{self.path}/{name}/_table", "overwrite")
