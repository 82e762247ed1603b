"""Jobs that go on where their last run ended: a log of commits, each a version of a state and the mark it was read up to.

A run reads what is new since its province's mark, less a lookback for rows that came late, merges it with the state and
writes that as a new version. Only then one row is added to the log, which moves state and mark together: a run that fails
moves neither, and the next one reads the same again. Versions are never overwritten.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .checks import Check, checked_write

LOG = "part string, mark timestamp_ntz, batch bigint, version string"


class Increments:
    """The states of one job, a part (province) each, below a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, root: str, job: str):
        self.spark, self.path = spark, f"{root.rstrip('/')}/{job}"

    def log(self) -> DataFrame:
        """All commits: part, mark, batch, version."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_log")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], LOG)
        return self.spark.read.schema(LOG).parquet(f"{self.path}/_log")

    def last(self, part: str):
        """The newest commit of a part, or None before its first run."""
        newest = F.max_by(F.struct("mark", "batch", "version"), F.struct(F.coalesce("batch", F.lit(-1)), "mark", "version"))
        row = self.log().where(F.col("part") == part).agg(newest.alias("x")).first()
        return row["x"]

    def mark(self, part: str) -> dt.datetime | None:
        last = self.last(part)
        return None if last is None else last["mark"]

    def state(self, part: str) -> DataFrame | None:
        last = self.last(part)
        return None if last is None else self.spark.read.parquet(f"{self.path}/{part}/{last['version']}")

    def _commit(self, part: str, state: DataFrame, mark: dt.datetime | None, batch: int | None, checks: list[Check]) -> dict[str, object]:
        version = uuid.uuid4().hex
        seen = checked_write(state, f"{self.path}/{part}/{version}", part, checks)
        self.spark.createDataFrame([(part, mark, batch, version)], LOG).coalesce(1).write.mode("append").parquet(f"{self.path}/_log")
        return seen

    def run(self, part: str, read: Callable[[dt.datetime, dt.datetime], DataFrame], merge: Callable[[DataFrame | None, DataFrame], DataFrame], now: dt.datetime, first: dt.datetime, lookback: dt.timedelta, checks: list[Check] | None = None) -> dict[str, object]:
        """Merge what read(start, now) gives with the state; what the checks observed on the way. The first run starts at
        `first`, later ones at the mark less the lookback: rows that come later than that are missed."""
        mark = self.mark(part)
        start = first if mark is None else mark - lookback
        return self._commit(part, merge(self.state(part), read(start, now)), now, None, checks or [])

    def batch(self, part: str, number: int, rows: DataFrame, merge: Callable[[DataFrame | None, DataFrame], DataFrame]) -> bool:
        """The same for a stream's numbered batch; one that is committed already is left out, as after a restart."""
        last = self.last(part)
        if last is not None and last["batch"] is not None and last["batch"] >= number:
            return False
        self._commit(part, merge(self.state(part), rows), None, number, [])
        return True

    def states(self, parts: list[str]) -> DataFrame:
        """The newest states of the parts that have one, with the part."""
        out = None
        for part in parts:
            state = self.state(part)
            if state is not None:
                state = state.withColumn("part", F.lit(part))
                out = state if out is None else out.unionByName(state, allowMissingColumns=True)
        if out is None:
            raise ValueError("no part has a state")
        return out


def due(log: DataFrame, parts: list[str], now: dt.datetime, every: dt.timedelta) -> list[str]:
    """The parts without a commit since `every` ago, in their order: each province runs when its own last run is old."""
    fresh = log.where(F.col("mark") > F.lit(now - every).cast("timestamp_ntz")).select("part").distinct()
    done = {r[0] for r in fresh.collect()}  # one row a province
    return [p for p in parts if p not in done]


def follow(stream: DataFrame, parts: dict[str, F.Column], increments: Increments, merge: Callable[[DataFrame | None, DataFrame], DataFrame], checkpoint: str):
    """Start a query that merges all that a stream has not read yet, each part's rows into its own state, and stops. The
    checkpoint is the stream's offset log; a batch that failed half way is merged again for the parts that lack it."""

    def each(rows: DataFrame, number: int) -> None:
        rows = rows.persist()
        try:
            for part, of_part in parts.items():
                increments.batch(part, number, rows.where(of_part), merge)
        finally:
            rows.unpersist()

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
