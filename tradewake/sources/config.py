"""Which routing table a micro-batch used, so that one that runs again uses the same."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewake.schemas import TABLE_PROCESS

_VERSIONED = T.StructType([*TABLE_PROCESS, T.StructField("version_ts", T.LongType())])


class ConfigHistory:
    """Routing tables as they were loaded, below a folder that belongs to a job's checkpoint.

    A table that differs from the one before is written as a new version; every micro-batch notes
    the version it uses before it routes anything. ``versions`` is what routing as of a time takes.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _names(self, folder: str, prefix: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}/{prefix}*")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [s.getPath().getName()[len(prefix):] for s in fs.globStatus(path) or []]

    def _version(self, number: int) -> DataFrame:
        return self.spark.read.schema(_VERSIONED).parquet(f"{self.root}/versions/v={number}")

    def versions(self) -> DataFrame:
        """All versions, each with the time ``version_ts`` at which it was loaded first."""
        found = [f"{self.root}/versions/v={n}" for n in self._names("versions", "v=")]
        if not found:
            return self.spark.createDataFrame([], _VERSIONED)
        return self.spark.read.schema(_VERSIONED).parquet(*found)

    def of_batch(self, batch_id: int, load: Callable[[], DataFrame]) -> DataFrame:
        """The routing table of a micro-batch: what it used before if it ran before, else what
        ``load`` gives now."""
        noted = self._names("batches", f"{batch_id}-")
        if noted:
            return self._version(int(noted[0])).drop("version_ts")
        now = load().select(*TABLE_PROCESS.fieldNames()).persist()
        try:
            numbers = sorted(int(n) for n in self._names("versions", "v="))
            last = numbers[-1] if numbers else -1
            if last < 0 or self._differ(now, self._version(last).drop("version_ts")):
                last += 1
                now.coalesce(1).withColumn(
                    "version_ts", F.lit(int(time.time() * 1000)).cast("long")) \
                    .write.mode("overwrite").parquet(f"{self.root}/versions/v={last}")
        finally:
            now.unpersist()
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/batches/{batch_id}-{last}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path).close()
        return self._version(last).drop("version_ts")

    @staticmethod
    def _differ(a: DataFrame, b: DataFrame) -> bool:
        return not (a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty())
