"""Unique visits per day and bounces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewake.functions.times import day_key, rowtime_millis
from tradewake.operators.keyed import first_per_key
from tradewake.operators.measures import entry_page


def unique_visits(page: DataFrame, entry_only: bool = True, order: Sequence[str] = ("ts",),
                  delay: str = "1 day", salts: int = 1, columns: Sequence[str] | None = None
                  ) -> DataFrame:
    """The first page of every device and day, all its columns or those named.

    ``entry_only`` lets only pages without a predecessor count. In batch the first row is the
    least by ``order``. In a stream it is the first to arrive; state is dropped ``delay``
    after its event time, which has to be a day at least. ``salts`` above 1 thins out a device's
    rows in so many parts first, so that a hot device and day is not one task's work, at the
    price of a second shuffle and more state.
    """
    if page.isStreaming and page.sparkSession.sql(
            f"SELECT INTERVAL '{delay}' < INTERVAL '1 day'").first()[0]:
        raise ValueError("with a delay under a day a device could count twice on one day")
    page = page.select(*columns) if columns else page
    rows = page.filter(entry_page()) if entry_only else page
    rows = rows.withColumn("_mid", F.col("common.mid")).withColumn("_day", day_key("ts"))
    if not page.isStreaming:
        return first_per_key(rows, ["_mid", "_day"], order).select(*page.columns)
    rows = rows.withColumn("_rowtime", rowtime_millis("ts")).withWatermark("_rowtime", delay)
    if salts > 1:
        part = F.pmod(F.xxhash64(*dict.fromkeys(("ts", *order))), F.lit(salts))
        rows = rows.withColumn("_salt", part)
        rows = rows.dropDuplicatesWithinWatermark(["_mid", "_day", "_salt"])
    return rows.dropDuplicatesWithinWatermark(["_mid", "_day"]).select(*page.columns)


def bounces(page: DataFrame, within_s: int = 10, order: Sequence[str] = ("ts",),
            delay: str = "0 seconds", columns: Sequence[str] | None = None) -> DataFrame:
    """Entry pages that no other page of the same device follows within ``within_s`` seconds, all
    their columns or those named.

    ``columns`` include those of ``order``. Naming what is read later keeps the rest out of the
    shuffle; array columns moreover keep the window expansion from being compiled.

    Time is cut into slots of ``within_s``. A page that is not the last of its slot has a
    follower less than ``within_s`` later, so only the last page of a slot can be a bounce, and
    the first page of the next slot decides. A sliding window of two slots holds both. That is
    one aggregation, combined before the shuffle, without a self-join or a per-device sort,
    and the same plan closes windows by watermark in a stream.
    """
    page = page.select(*columns) if columns else page
    size, step = f"{2 * within_s} seconds", f"{within_s} seconds"
    sort_key = F.struct("ts", *[c for c in order if c != "ts"])
    first_slot = F.col("_rowtime") < F.col("_w.start") + F.expr(f"INTERVAL {within_s} SECONDS")
    windowed = (
        page.withColumn("_rowtime", rowtime_millis("ts"))
        .withWatermark("_rowtime", delay)
        .withColumn("_w", F.window("_rowtime", size, step))
        .select(
            F.col("common.mid").alias("_mid"), "_w",
            # Only what can become a result travels with its columns.
            F.when(first_slot & entry_page(), F.struct(*page.columns)).alias("_row"),
            F.when(first_slot, sort_key).alias("_order"),
            F.when(first_slot, F.col("ts")).alias("_last"),
            F.when(~first_slot, F.col("ts")).alias("_next"),
        )
    )
    last = windowed.groupBy("_mid", "_w").agg(
        F.max_by("_row", "_order").alias("_row"), F.max("_last").alias("_last"),
        F.min("_next").alias("_next"),
    )
    alone = F.col("_next").isNull() | (F.col("_next") - F.col("_last") >= within_s * 1000)
    return last.filter(F.col("_row").isNotNull() & alone).select("_row.*")
