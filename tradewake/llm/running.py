"""Sums over all rows before a row, in a total order, without a task that sees all rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Stage

PART = "__part"


def _cumulated(batches: Iterator[pa.RecordBatch], values: Sequence[str]
               ) -> Iterator[pa.RecordBatch]:
    """The batches of one sorted partition with its number and the sums before every row."""
    part = TaskContext.get().partitionId()
    so_far = {v: 0 for v in values}
    for batch in batches:
        columns = [*batch.columns, pa.array(np.full(batch.num_rows, part), pa.int64())]
        for v in values:
            x = batch.column(v).to_numpy(zero_copy_only=False).astype(np.int64)
            upto = so_far[v] + np.cumsum(x)
            columns.append(pa.array(upto - x, pa.int64()))
            so_far[v] = int(upto[-1]) if len(x) else so_far[v]
        names = [*batch.schema.names, PART, *(f"__{v}" for v in values)]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def running(df: DataFrame, order: Sequence[str | F.Column], values: Sequence[str], stage: Stage,
            ) -> DataFrame:
    """``df`` with ``before_<v>`` for every long column ``v`` of ``values``: its sum over all rows
    before, in ``order``.

    ``df`` should be a written table: it is sampled for the ranges, then sorted. Rows equal in all
    of ``order`` come in any order and may share a task, so ``order`` should tell rows apart.
    A task sums its own range; what ranges sum to is one row each, and those rows are summed and
    sent to all tasks: their number is that of the partitions.
    """
    rows = df.count()
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(parts, rows // 1000), rows // 1_000_000)
    schema = T.StructType([*df.schema, T.StructField(PART, T.LongType()),
                           *(T.StructField(f"__{v}", T.LongType()) for v in values)])
    ranged = stage.save(
        df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .mapInArrow(partial(_cumulated, values=tuple(values)), schema))
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(PART).agg(*(F.sum(v).alias(f"__sum_{v}") for v in values))
    offsets = totals.select(PART, *(
        F.coalesce(F.sum(f"__sum_{v}").over(before), F.lit(0)).alias(f"__start_{v}")
        for v in values))
    return ranged.join(F.broadcast(offsets), PART).select(
        *df.columns, *((F.col(f"__start_{v}") + F.col(f"__{v}")).alias(f"before_{v}")
                       for v in values))
