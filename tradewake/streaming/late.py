"""Late rows kept: what a stream drops behind its watermark goes to a place of its own."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradewake.streaming.sides import start_with_sides

Handle = Callable[[DataFrame, int], None]


def watermark_of(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """The watermark of a micro-batch in epoch milliseconds, 0 before there is one.

    It is read from the plan of the micro-batch in the checkpoint, which Spark writes before the
    batch runs. So a batch that is run again after a failure has the watermark it had.
    """
    if batch_id < 0:
        return 0
    lines = spark.read.text(f"{checkpoint.rstrip('/')}/offsets/{batch_id}").collect()
    plans = [json.loads(r.value) for r in lines if r.value.startswith("{")]
    return next(p["batchWatermarkMs"] for p in plans if "batchWatermarkMs" in p)


def late(event_time: str, watermark_ms: int, window: str | None = None) -> Column:
    """A row is late once the watermark has reached its time, or the end of its window."""
    end = F.window(event_time, window)["end"] if window else F.col(event_time)
    return end <= F.timestamp_millis(F.lit(watermark_ms))


def start_with_late(result: DataFrame, rows: DataFrame, event_time: str, checkpoint: str,
                    handle: Handle, handle_late: Handle, window: str | None = None,
                    once: bool = False, every: str | None = None) -> StreamingQuery:
    """Start ``result`` and hand the input rows it drops for being late to ``handle_late``.

    ``rows`` is the input of the stateful operator of ``result``, with its watermark on
    ``event_time``; ``window`` is the length of its tumbling windows, None for an operator without.
    One operator is meant, and one watermark. Every micro-batch has the results and its input
    rows side by side. Spark judges lateness by the watermark of the micro-batch before.
    """
    spark = result.sparkSession

    def write(found: dict[str, DataFrame], batch_id: int) -> None:
        behind = late(event_time, watermark_of(spark, checkpoint, batch_id - 1), window)
        handle(found["_result"], batch_id)
        handle_late(found["_row"].filter(behind), batch_id)

    return start_with_sides({"_result": result, "_row": rows}, checkpoint, write, once, every)
