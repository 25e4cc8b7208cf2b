"""Sequences of events of a key: matched in time, or timed out (F3 in general)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MATCHED = "matched"
TIMED_OUT = "timed_out"


def _outcome(start: Column, follower: Callable[[int], Column], steps: int, within_ms: int) -> Column:
    """Outcome and number of matched steps of the sequence that begins at ``start``; null where it
    is broken. ``follower(i)`` is the i-th event after it."""
    def said(name: str, n: int) -> Column:
        return F.struct(F.lit(name).alias("outcome"), F.lit(n).alias("length"))

    found = said(MATCHED, steps)
    for i in range(steps - 1, 0, -1):
        event = follower(i)
        over = event.isNull() | (event["time"] - start["time"] >= within_ms)
        found = F.when(over, said(TIMED_OUT, i)).when(event["steps"][i], found)
    return F.when(start["steps"][0], found)


def match_sequence(events: DataFrame, key: str, time: str, steps: Sequence[Column],
                   within_ms: int, order: Sequence[str] = (), columns: Sequence[str] | None = None,
                   delay: str = "0 seconds") -> DataFrame:
    """Events of one key that meet ``steps`` one directly after the other, within ``within_ms`` of
    the first (the end excluded).

    Returns a row for each event that meets the first step, unless an event in its way breaks the
    sequence: ``outcome`` is ``matched``, or ``timed_out`` if time ran out before the last step was
    met, ``length`` is the number of steps met and ``events`` has their ``columns`` in order (all by
    default). Events come in order of ``time`` (epoch milliseconds), then ``order``. An event may
    take part in several sequences. Events without a key or a time take no part.

    Time is cut into slots of ``within_ms``. What can follow an event in time is in its slot or the
    next, so every event goes to its own slot and to the one before, and each slot of a key is
    looked at by itself. So a key that owns most of the table is spread over its time range, and
    the same cut closes slots by watermark in a stream, where a slot's events are sorted lists.
    """
    columns = list(columns or events.columns)
    flags = F.array(*(F.coalesce(s, F.lit(False)) for s in steps))
    event = F.struct(F.col(time).alias("time"), *(F.col(c).alias(f"o{i}") for i, c in enumerate(order)),
                     flags.alias("steps"), F.struct(*columns).alias("row"))
    rows = events.filter(F.col(key).isNotNull() & F.col(time).isNotNull()).select(
        F.col(key).alias("_key"), event.alias("_event"),
        F.timestamp_millis(F.col(time)).alias("_rowtime"))
    n = len(steps)

    def done(df: DataFrame, start: Column, follower: Callable[[int], Column]) -> DataFrame:
        chain = F.array(start["row"], *(follower(i)["row"] for i in range(1, n)))
        return df.select(_outcome(start, follower, n, within_ms).alias("_found"),
                         chain.alias("_chain")).filter(F.col("_found").isNotNull()).select(
            "_found.outcome", "_found.length",
            F.slice("_chain", 1, F.col("_found.length")).alias("events"))

    if not events.isStreaming:
        slot = F.floor(F.col("_event.time") / within_ms)
        dealt = rows.withColumn("_slot", F.explode(F.array(slot, slot - 1))).withColumn(
            "_own", slot == F.col("_slot"))
        by = Window.partitionBy("_key", "_slot").orderBy(
            "_event.time", *(f"_event.o{i}" for i in range(len(order))))
        led = dealt.select("_own", "_event", *(
            F.lead("_event", i).over(by).alias(f"_next{i}") for i in range(1, n)))
        return done(led.filter("_own"), F.col("_event"), lambda i: F.col(f"_next{i}"))
    size, step = f"{2 * within_ms} milliseconds", f"{within_ms} milliseconds"
    lists = rows.withWatermark("_rowtime", delay).groupBy(
        F.window("_rowtime", size, step).alias("_w"), "_key").agg(
        F.array_sort(F.collect_list("_event")).alias("_events"))
    # Those in the first half of a window have all that may follow them in it.
    half = F.unix_millis("_w.start") + within_ms
    led = lists.select("_events", F.posexplode("_events").alias("_at", "_event"), half.alias("_half")) \
        .filter(F.col("_event.time") < F.col("_half"))
    return done(led, F.col("_event"), lambda i: F.get("_events", F.col("_at") + i))
