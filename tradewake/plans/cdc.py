"""Change records to fact topics and dimension tables by a routing table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewake.constants import SINK_DIM, SINK_FACT
from tradewake.functions.records import CORRUPT, parse_rows
from tradewake.functions.text import in_comma_list, is_blank
from tradewake.operators.keyed import first_per_key
from tradewake.operators.sides import broadcast_if_small
from tradewake.schemas import CDC

@dataclass(frozen=True)
class CdcSplit:
    facts: DataFrame
    dims: DataFrame


def parse_cdc(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Change records whose ``data`` is an object with fields; other rows are dropped.

    An object without fields is the only one whose text is at most three characters long, so
    this is the length test on the text, made on the parsed row.
    """
    return whole_changes(parse_rows(raw, CDC, keep=keep))


def whole_changes(parsed: DataFrame) -> DataFrame:
    """Of parsed records those that change something; see :func:`parse_cdc`."""
    return parsed.filter(F.col(CORRUPT).isNull() & (F.cardinality("data") > 0)).drop(CORRUPT)


def broken_changes(parsed: DataFrame) -> DataFrame:
    """Of parsed records those that aren't change records at all: broken JSON, or a field of the
    wrong shape. Records without a payload aren't broken; they change nothing."""
    return parsed.filter(F.col(CORRUPT).isNotNull())


def normal_type(kind: Column) -> Column:
    """The first load of a table counts as insert."""
    return F.when(kind == "bootstrap-insert", "insert").otherwise(kind)


def apply_config(cdc: DataFrame, config: DataFrame) -> DataFrame:
    """Change records joined with their routing entry, the payload cut to the listed columns.

    Records without an entry are dropped. The routing table has one row per source table and
    operation. It is broadcast after its rows are counted: a shuffle would send all records of
    a busy table to one task.
    """
    return _routed(cdc.withColumn("type", normal_type(F.col("type"))), config)


def _routed(records: DataFrame, config: DataFrame, more: Sequence[str] = (),
            condition: Column | None = None) -> DataFrame:
    entries = config.select(
        "source_table", "operate_type", "sink_type", "sink_table", "sink_columns",
        F.coalesce("sink_pk", F.lit("id")).alias("sink_pk"), *more,
    )
    same = (F.col("table") == F.col("source_table")) & (F.col("type") == F.col("operate_type"))
    routed = records.join(
        broadcast_if_small(entries), same if condition is None else same & condition,
    ).drop("source_table", "operate_type")
    listed = F.map_filter("data", lambda k, _: in_comma_list(k, F.col("sink_columns")))
    kept = F.when(is_blank("sink_columns"), F.col("data")).otherwise(listed)
    return routed.withColumn("data", kept)


def config_periods(versions: DataFrame) -> DataFrame:
    """Versions of the routing table with the time ``_until`` at which the next one begins.

    ``versions`` has whole tables, each with the time ``version_ts`` from which it holds in epoch
    milliseconds. There is one row per entry and version, so this is small.
    """
    times = versions.select("version_ts").distinct()
    after = times.select("version_ts", F.lead("version_ts").over(
        Window.orderBy("version_ts")).alias("_until"))
    return versions.join(F.broadcast(after), "version_ts")


def apply_config_as_of(cdc: DataFrame, versions: DataFrame, at: str = "ts") -> DataFrame:
    """Change records routed by the version of the routing table that held at their time ``at``.

    So records that are read again later are routed as they were at first. A version replaces the
    one before as a whole: entries it lacks route no more, and records older than every version
    are dropped, as are those without a time.
    """
    periods = config_periods(versions)
    records = cdc.withColumn("type", normal_type(F.col("type")))
    held = (F.col("version_ts") <= F.col(at)) & (
        F.col("_until").isNull() | (F.col(at) < F.col("_until")))
    return _routed(records, periods, ["version_ts", "_until"], held).drop("version_ts", "_until")


def split_routed(routed: DataFrame) -> CdcSplit:
    return CdcSplit(
        facts=routed.filter(F.col("sink_type") == SINK_FACT),
        dims=routed.filter(F.col("sink_type") == SINK_DIM),
    )


def route_cdc(cdc: DataFrame, config: DataFrame) -> CdcSplit:
    """Facts (for topics) and dimension rows (for tables); other sink types are not routed."""
    return split_routed(apply_config(cdc, config))


def fact_messages(facts: DataFrame) -> DataFrame:
    """``topic`` and JSON ``value`` of every fact, as multi-topic sinks take them (A4)."""
    return facts.select(F.col("sink_table").alias("topic"), F.to_json("data").alias("value"))


def dim_tables(config: DataFrame) -> list[Row]:
    """The dimension tables the routing table names: table, columns, key, and whether inserts go
    there, in which case the table is created ahead of its first row.

    The columns are those of the insert entry, since that one makes the table; without one, all
    columns that any entry lists. An entry without a list takes every column, so then there is
    none.

    Collected, since each becomes a write of its own; bounded by the routing table.
    """
    entries = config.filter(F.col("sink_type") == SINK_DIM)
    listed = F.array_distinct(F.flatten(F.array_sort(F.collect_set(F.split("sink_columns", ",")))))
    insert = F.col("operate_type") == "insert"
    return entries.groupBy("sink_table").agg(
        F.when(F.max(insert), F.max(F.when(insert, F.col("sink_columns"))))
        .when(F.max(is_blank("sink_columns")), None)
        .otherwise(F.array_join(listed, ",")).alias("sink_columns"),
        F.coalesce(F.max("sink_pk"), F.lit("id")).alias("pk"),
        F.max(F.col("operate_type") == "insert").alias("on_insert"),
    ).collect()


def dim_schema(sink_columns: str) -> T.StructType:
    """A dimension table declared by the routing table: every column is text."""
    return T.StructType([T.StructField(c, T.StringType()) for c in sink_columns.split(",")])


def dim_rows(dims: DataFrame, sink_table: str, sink_columns: str | None, pk: str = "id",
             order: Sequence[str] = ("ts",)) -> DataFrame:
    """Change rows of one dimension table, with the columns that order them.

    Without a column list the payload stays a map next to the key.
    """
    rows = dims.filter(F.col("sink_table") == sink_table)
    if sink_columns:
        names = dict.fromkeys([*sink_columns.split(","), pk])
        columns = [F.col("data")[c].cast("string").alias(c) for c in names]
    else:
        as_text = F.transform_values("data", lambda _, v: v.cast("string"))
        columns = [F.col("data")[pk].cast("string").alias(pk), as_text.alias("data")]
    return rows.select(*columns, *order)


def upsert_dim(current: DataFrame | None, changes: DataFrame, pk: Sequence[str],
               order: Sequence[str] = ("ts",)) -> DataFrame:
    """The newest row per primary key of stored and changed rows.

    A column that only one side has is null in the other's rows. Changes without a key are left
    out: they name no row.
    Applying the same changes again gives the same table, so a replayed batch is harmless.
    """
    changes = changes.dropna(subset=list(pk))
    rows = changes if current is None else current.unionByName(changes, allowMissingColumns=True)
    return first_per_key(rows, pk, order, newest=True)
