"""Tables behind JDBC: routing and dimension tables to read, statistics tables to append to.

Connection settings are always given by the caller.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tradewake.functions.text import camel_columns
from tradewake.schemas import drop_transient

BATCH_ROWS = 5_000


def read_options(url: str, table: str, connection: Mapping[str, str] | None = None,
                 partition: tuple[str, int, int, int] | None = None) -> dict[str, str]:
    """``partition`` is (column, lower, upper, parts); a large table needs it to be read in parts."""
    options = {"url": url, "dbtable": table, **(connection or {})}
    if partition:
        column, lower, upper, parts = partition
        options |= {"partitionColumn": column, "lowerBound": str(lower),
                    "upperBound": str(upper), "numPartitions": str(parts)}
    return options


def read_table(spark: SparkSession, url: str, table: str,
               connection: Mapping[str, str] | None = None,
               partition: tuple[str, int, int, int] | None = None,
               camel: bool = False) -> DataFrame:
    """A table; filters on it are pushed to the database."""
    df = spark.read.format("jdbc").options(**read_options(url, table, connection, partition)).load()
    return camel_columns(df) if camel else df


def write_options(url: str, table: str, connection: Mapping[str, str] | None = None,
                  batch_rows: int = BATCH_ROWS) -> dict[str, str]:
    return {"url": url, "dbtable": table, "batchsize": str(batch_rows), **(connection or {})}


def append_table(df: DataFrame, url: str, table: str,
                 connection: Mapping[str, str] | None = None,
                 batch_rows: int = BATCH_ROWS) -> None:
    """Append rows in batches, matched by column name; columns marked transient stay out."""
    options = write_options(url, table, connection, batch_rows)
    drop_transient(df).write.format("jdbc").options(**options).mode("append").save()
