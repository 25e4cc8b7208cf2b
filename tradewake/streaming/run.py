"""Start streams with a checkpoint, or run one over all present input."""

from __future__ import annotations

import gc
import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tradewake.session import SETTINGS, shared_dir
from tradewake.sources.arrival import FORMAT

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
PARTITIONS = "spark.sql.shuffle.partitions"
EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
# Counting a store's rows for the progress reports costs a read before every write and delete.
TRACK_ROWS = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
# A join's part of state in one store; by default it is four, each committed by itself.
JOIN_FORMAT, ONE_STORE = "spark.sql.streaming.join.stateFormatVersion", "3"
# A store's files lie on the executor's disk and in the checkpoint, and a part writes most of them
# once: packed tightly, in large blocks, without space set aside. The write buffer holds a part of
# PART_ROWS rows, so that those of a micro-batch are not looked up in blocks on disk.
ROCKSDB = "spark.sql.streaming.stateStore.rocksdb"
FILES = {f"{ROCKSDB}.compression": "zstd", f"{ROCKSDB}.blockSizeKB": "64",
         f"{ROCKSDB}.allowFAllocate": "false", f"{ROCKSDB}.writeBufferSizeMB": "128"}
# A store's local files go once its part is committed, and versions before the last two as well.
UNLOAD = {"spark.sql.streaming.stateStore.unloadOnCommit": "true",
          "spark.sql.streaming.minBatchesToRetain": "2"}
# Rows of state beyond which a store's reads and writes get slow: its write buffer holds these.
PART_ROWS = 150_000


def state_parts(spark: SparkSession, rows: int) -> int:
    """Parts of state for a stream that takes in about ``rows`` before the watermark lets go of
    any: as many as the session shuffles with, more if they would be too large."""
    return max(int(spark.conf.get(PARTITIONS)), -(-rows // PART_ROWS))


@contextmanager
def stream_settings(spark: SparkSession, partitions: int | None = None,
                    empty_batches: bool = True, unload: bool = False) -> Iterator[None]:
    """Settings a stream takes over when it starts: RocksDB state, and ``partitions`` of it if
    given, else as many as the session shuffles with. The number is fixed by the first start.
    Afterwards the session is as it was.

    Without ``empty_batches`` no micro-batch runs on the watermark alone. For inner joins: it
    would put out nothing and only delete state, which the next one with input does as well.

    ``unload`` is for few micro-batches of much input each: the executors' disks hold the state that
    tasks work on, not all of it. Every micro-batch reads its state from the checkpoint then, which
    keeps two versions. Spark does so for aggregations, not for joins.
    """
    wanted = {PROVIDER: SETTINGS[PROVIDER], TRACK_ROWS: "false", JOIN_FORMAT: ONE_STORE, **FILES}
    if unload:
        wanted |= UNLOAD
    if not empty_batches:
        wanted[EMPTY_BATCHES] = "false"
    if partitions:
        wanted[PARTITIONS] = str(partitions)
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def start_batches(df: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None],
                  once: bool = False, every: str | None = None, mode: str = "append"
                  ) -> StreamingQuery:
    """Hand every micro-batch to ``handle``; ``once`` stops after the input present now.

    Numbered file topics can't plan ahead, so Spark would give them one batch, which closes no
    window. They run on until nothing is left to do.
    """
    writer = df.writeStream.outputMode(mode).foreachBatch(handle) \
        .option("checkpointLocation", checkpoint)
    if once and FORMAT in df._jdf.queryExecution().logical().toString():
        query = writer.start()
        threading.Thread(target=_stop_when_done, args=(query,), daemon=True).start()
        return query
    if once:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def _stop_when_done(query: StreamingQuery) -> None:
    try:
        query.processAllAvailable()
    except StreamingQueryException:
        pass  # whoever waits for the query gets it
    query.stop()


class LateRows(StreamingQueryListener):
    """Adds up the rows that streams dropped for being behind the watermark.

    Register it with ``spark.streams.addListener`` before the start; progress reports arrive a
    moment after their micro-batch.
    """

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        self.dropped[run] = self.dropped.get(run, 0) + sum(
            op.numRowsDroppedByWatermark for op in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))

    def rows(self, query: StreamingQuery) -> int:
        return self.dropped.get(str(query.runId), 0)


def show_stream(df: DataFrame, prefix: str, checkpoint: str,
                rows_shown: int | None = None) -> StreamingQuery:
    """Print the rows of every micro-batch under a prefix, to look at a stream (A11): all of them,
    one after the other, or the first ``rows_shown``."""
    def show(rows: DataFrame, batch_id: int) -> None:
        print(f"{prefix} {batch_id}")
        for row in (rows.limit(rows_shown) if rows_shown else rows).toLocalIterator():
            print(row)

    return start_batches(df, checkpoint, show)


def finish(query: StreamingQuery, seconds: int | None = None) -> None:
    """Wait for a query that ends by itself; with a limit, stop it and fail beyond that."""
    done = query.awaitTermination(seconds) if seconds else query.awaitTermination() is None
    query.stop()
    if not done:
        raise TimeoutError(f"stream did not end within {seconds} s")


def release_shuffles(spark: SparkSession) -> None:
    """Have the files of shuffles deleted that nothing needs any more. Spark does so once the
    driver has collected what refers to them, which a driver with little to do puts off for long."""
    gc.collect()
    spark._jvm.System.gc()


def drain_to_folder(spark: SparkSession, df: DataFrame, name: str, seconds: int | None = None,
                    empty_batches: bool = True, partitions: int | None = None,
                    unload: bool = False) -> str:
    """Run a stream over all present input; the parquet folder of what it appended.

    Results and checkpoint are written below the cluster's shared checkpoint folder.
    """
    base = shared_dir(spark, name)
    with stream_settings(spark, partitions, empty_batches, unload):
        query = (
            df.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True).start(f"{base}/rows")
        )
    finish(query, seconds)
    return f"{base}/rows"


def drain(spark: SparkSession, df: DataFrame, name: str, seconds: int | None = None,
          empty_batches: bool = True, partitions: int | None = None,
          unload: bool = False) -> DataFrame:
    """As :func:`drain_to_folder`, read back."""
    folder = drain_to_folder(spark, df, name, seconds, empty_batches, partitions, unload)
    return spark.read.schema(df.schema).parquet(folder)


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """The state that a stream holds after its last micro-batch, as ``key`` and ``value``.

    For a look at what has expired and what has not; ``operator`` counts the stateful operators of
    the query from 0.
    """
    return spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
