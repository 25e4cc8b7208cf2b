"""Raw logs to start, page and display logs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewake.functions.records import CORRUPT, parse_rows, set_field
from tradewake.functions.times import day_key
from tradewake.operators.lateral import explode_display
from tradewake.schemas import RAW_LOG


@dataclass(frozen=True)
class LogSplit:
    start: DataFrame
    page: DataFrame
    display: DataFrame


def parse_logs(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Log rows of a text ``value`` column; ``keep`` carries columns such as the offset."""
    return parse_rows(raw, RAW_LOG, keep=keep)


def usable() -> Column:
    """The row has a device, a time and parsed in full; never null."""
    return F.col("common.mid").isNotNull() & F.col("ts").isNotNull() & F.col(CORRUPT).isNull()


def valid_logs(logs: DataFrame) -> DataFrame:
    return logs.filter(usable()).drop(CORRUPT)


def quarantined_logs(logs: DataFrame) -> DataFrame:
    return logs.filter(~usable())


def repair_is_new(logs: DataFrame, order: str = "ts") -> DataFrame:
    """Clear ``is_new`` on rows whose day is not the device's first day as a new visitor.

    Rows flagged ``0`` neither set nor meet a first day. ``order`` is the column that says
    which flagged row of a device came first.

    The first day is a per-device minimum, so it aggregates before the shuffle and joins back.
    Only flagged rows take part in the join; the others, which are most of a log, are not
    shuffled. Adaptive execution splits the rows of a hot device in that join.
    """
    flagged = F.coalesce(F.col("common.is_new") == "1", F.lit(False))
    day = day_key("ts").cast("int")
    new = logs.filter(flagged)
    first = new.groupBy(F.col("common.mid").alias("_mid")).agg(
        F.min_by(day, F.col(order)).alias("_first_day"))
    joined = new.join(first, F.col("common.mid") == F.col("_mid"), "left")
    repaired = F.when(F.col("_first_day") != day, F.lit("0")).otherwise(F.lit("1"))
    changed = joined.withColumn("common", set_field("common", "is_new", repaired))
    return changed.select(*logs.columns).unionByName(logs.filter(~flagged))


def is_start() -> Column:
    """The log reports an application start: its ``start`` object has fields."""
    return F.coalesce(F.cardinality("start"), F.lit(0)) > 0


def split_logs(logs: DataFrame, display_context: bool = False) -> LogSplit:
    """Start logs apart from page logs, and the displays of page logs one by one.

    ``display_context`` adds ``ts`` and ``common`` to display rows.
    """
    page = logs.filter(~is_start()).drop("start")
    keep = ("ts", "common") if display_context else ()
    return LogSplit(
        start=logs.filter(is_start()),
        page=page,
        display=explode_display(page, keep=keep),
    )
