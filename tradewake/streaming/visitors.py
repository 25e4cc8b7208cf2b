"""New-visitor flag repair on streams (F1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewake.functions.records import parse_rows, set_field
from tradewake.functions.times import day_key
from tradewake.plans.logs import usable
from tradewake.schemas import RAW_LOG


def _flagged():
    return usable() & F.coalesce(F.col("common.is_new") == "1", F.lit(False))


def logs_beside_first_days(raw: DataFrame) -> DataFrame:
    """Parsed rows of a text stream, and beside them the first day of every device they flag new.

    A row has either ``_log`` or ``_mid`` and ``_first_day``. The first day is that of the least
    time in the micro-batch a device is first flagged in: a streaming aggregate, which orders by
    the time of the micro-batch first. So a later batch never changes it, a device's rows are
    combined before the shuffle, and the state holds a day per device. In update mode it puts out
    the devices of the micro-batch, known or new, and no others.
    """
    logs = parse_rows(raw, RAW_LOG, keep=tuple(raw.columns))
    # The current time of a stream is that of its micro-batch, also when the batch runs again.
    days = logs.filter(_flagged()).select(
        F.col("common.mid").alias("_mid"), F.struct(
            F.current_timestamp().alias("batch"), "ts").alias("_order"),
        day_key("ts").cast("int").alias("_day"),
    ).groupBy("_mid").agg(F.min_by("_day", "_order").alias("_first_day"))
    rows = logs.select(F.struct("*").alias("_log"))
    return rows.unionByName(days, allowMissingColumns=True)


def repair_batch(batch: DataFrame) -> DataFrame:
    """The parsed rows of a micro-batch with repaired flags, malformed ones as parsed.

    Only rows flagged new are joined, with the days of the same micro-batch. The batch should be
    persisted.
    """
    logs = batch.filter(F.col("_log").isNotNull()).select("_log.*")
    days = batch.filter(F.col("_mid").isNotNull()).select("_mid", "_first_day")
    joined = logs.filter(_flagged()).join(days, F.col("common.mid") == F.col("_mid"), "left")
    kept = F.col("_first_day") == day_key("ts").cast("int")
    repaired = joined.withColumn(
        "common", set_field("common", "is_new", F.when(kept, F.lit("1")).otherwise(F.lit("0"))))
    return repaired.select(*logs.columns).unionByName(logs.filter(~_flagged()))
