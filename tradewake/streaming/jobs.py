"""The ten jobs, linked by topics.

Every job takes its topics, a checkpoint folder and its parameters, and returns the started
query. With ``once`` it handles the input present now and ends.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradewake import constants as C
from tradewake import schemas as S
from tradewake.functions.records import CORRUPT, parse_rows, to_values
from tradewake.functions.times import text_millis
from tradewake.operators.enrich import Dimension, enrich_all
from tradewake.operators.measures import unreadable_item
from tradewake.plans.cdc import (apply_config, broken_changes, dim_rows, dim_tables, fact_messages,
                                 split_routed, whole_changes)
from tradewake.plans.logs import quarantined_logs, split_logs, valid_logs
from tradewake.plans.stats import (product_keywords, product_parts, product_totals,
                                   search_keywords, visitor_stats)
from tradewake.plans.visits import bounces, unique_visits
from tradewake.plans.wide import event_millis, order_wide, payment_wide
from tradewake.sources.config import ConfigHistory
from tradewake.sources.dims import DimStore
from tradewake.sources.topics import Topics
from tradewake.streaming.run import start_batches, stream_settings
from tradewake.streaming.sides import start_with_sides
from tradewake.streaming.visitors import logs_beside_first_days, repair_batch

#: Takes the rows of a micro-batch and its number, so that a replayed one can be recognised.
Sink = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class Input:
    """A topic read for a job: its rows, and the records that can't be used with their topic."""

    rows: DataFrame
    rejected: DataFrame


def _read(spark: SparkSession, topics: Topics, topic: str, schema, group: str,
          usable: Column | None = None, doubtful: Column | None = None,
          keep: Sequence[str] = ()) -> Input:
    """A topic's records by ``schema``. Text that isn't a record is rejected, as are records that
    aren't ``usable``. ``doubtful`` ones are used and set aside as well. ``keep`` are columns of the
    source that stay, such as the offset, where it has them."""
    raw = topics.read_stream(spark, topic, group)
    keep = tuple(c for c in keep if c in raw.columns)
    parsed = parse_rows(raw, schema, keep=("value", *keep))
    fit = F.col(CORRUPT).isNull()
    if usable is not None:
        fit = fit & F.coalesce(usable, F.lit(False))
    odd = ~fit if doubtful is None else ~fit | F.coalesce(doubtful, F.lit(False))
    return Input(parsed.filter(fit).drop(CORRUPT, "value"),
                 parsed.filter(odd).select(F.lit(topic).alias("topic"), "value"))


def _known_visitor() -> Column:
    return F.col("common.mid").isNotNull() & F.col("ts").isNotNull()


def _sold(time: Column) -> Column:
    """A record names a SKU and its time can be read."""
    return F.col("sku_id").isNotNull() & time.isNotNull()


def _visitors(spark: SparkSession, topics: Topics, group: str) -> tuple[Input, list[str]]:
    """Page logs with a device and a time, and the columns that put them in arrival order."""
    page = _read(spark, topics, C.TOPIC_PAGE_LOG, S.PAGE_LOG, group, _known_visitor(),
                 keep=("offset",))
    return page, [c for c in ("ts", "offset") if c in page.rows.columns]


def quarantine_topic(job: str) -> str:
    """Where a job puts what it can't use: records as JSON with ``topic`` and ``value``."""
    return f"{C.TOPIC_QUARANTINE}_{job}"


def _start(df: DataFrame, inputs: Sequence[Input], topics: Topics, job: str, handle: Sink,
           checkpoint: str, once: bool) -> StreamingQuery:
    """Start a job with its inputs' rejected records beside the result."""
    rejected = reduce(DataFrame.unionByName, [i.rejected for i in inputs])

    def write(found: dict[str, DataFrame], batch_id: int) -> None:
        handle(found["_rows"], batch_id)
        if not found["_rejected"].isEmpty():
            topics.write_batch(to_values(found["_rejected"]), quarantine_topic(job), batch_id)

    return start_with_sides({"_rows": df, "_rejected": rejected}, checkpoint, write, once)


def _to_topic(topics: Topics, topic: str) -> Sink:
    return lambda rows, batch_id: topics.write_batch(to_values(rows), topic, batch_id)


def user_log_job(spark: SparkSession, topics: Topics, checkpoint: str,
                 once: bool = False) -> StreamingQuery:
    """Raw logs to start, page and display topics; malformed ones to the quarantine topic."""
    raw = topics.read_stream(spark, C.TOPIC_RAW_LOG, "user_log").select("value")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            logs = repair_batch(batch)
            split = split_logs(valid_logs(logs).drop("value"))
            topics.write_together({
                C.TOPIC_START_LOG: to_values(split.start),
                C.TOPIC_PAGE_LOG: to_values(split.page),
                C.TOPIC_DISPLAY_LOG: to_values(split.display),
                C.TOPIC_QUARANTINE: quarantined_logs(logs).select("value"),
            }, batch_id)
        finally:
            batch.unpersist()

    return start_batches(logs_beside_first_days(raw), checkpoint, write, once, mode="update")


def business_job(spark: SparkSession, topics: Topics, checkpoint: str,
                 load_config: Callable[[], DataFrame], dims: DimStore, once: bool = False,
                 every: str | None = "5 seconds",
                 history: ConfigHistory | None = None) -> StreamingQuery:
    """Change records to fact topics and dimension tables.

    The routing table is loaded anew in every micro-batch (R4): what it says then is what
    counts, so removed entries stop routing. With ``history`` a micro-batch that runs again after
    a failure routes by the table it used at first.
    """
    raw = topics.read_stream(spark, C.TOPIC_CDC, "business")

    def write(batch: DataFrame, batch_id: int) -> None:
        config = (history.of_batch(batch_id, load_config) if history else load_config()).persist()
        # Changes of one time count in order of arrival, where the topic tells it.
        offset = [c for c in ("offset",) if c in batch.columns]
        order = ["ts", *offset]
        # Parsed once; facts, every dimension table and the quarantine read the same rows.
        parsed = parse_rows(batch, S.CDC, keep=("value", *offset)).persist()
        try:
            if config.isEmpty():
                raise ValueError("the routing table is empty")
            split = split_routed(apply_config(whole_changes(parsed).drop("value"), config))
            topics.write_batch(fact_messages(split.facts), batch_id=batch_id)
            broken = broken_changes(parsed).select(F.lit(C.TOPIC_CDC).alias("topic"), "value")
            if not broken.isEmpty():
                topics.write_batch(to_values(broken), quarantine_topic("business"), batch_id)
            # Control data: one row per dimension table, bounded by the routing table.
            changed = {r.sink_table for r in split.dims.select("sink_table").distinct().collect()}
            for table in dim_tables(config):
                if table.sink_columns and table.on_insert:
                    dims.create(table.sink_table, table.sink_columns, order, [table.pk])
                if table.sink_table in changed:
                    rows = dim_rows(split.dims, table.sink_table, table.sink_columns, table.pk,
                                    order)
                    dims.upsert(table.sink_table, rows, [table.pk], order)
        finally:
            parsed.unpersist()
            config.unpersist()

    return start_batches(raw, checkpoint, write, once, every)


def unique_visit_job(spark: SparkSession, topics: Topics, checkpoint: str,
                     entry_only: bool = True, once: bool = False) -> StreamingQuery:
    page, order = _visitors(spark, topics, "unique_visit")
    visits = unique_visits(page.rows, entry_only, order).select(*S.PAGE_LOG.fieldNames())
    return _start(visits, [page], topics, "unique_visit", _to_topic(topics, C.TOPIC_UNIQUE_VISIT),
                  checkpoint, once)


def user_jump_job(spark: SparkSession, topics: Topics, checkpoint: str, within_s: int = 10,
                  once: bool = False) -> StreamingQuery:
    page, order = _visitors(spark, topics, "user_jump")
    jumps = bounces(page.rows, within_s, order).select(*S.PAGE_LOG.fieldNames())
    return _start(jumps, [page], topics, "user_jump", _to_topic(topics, C.TOPIC_USER_JUMP),
                  checkpoint, once)


def order_wide_job(spark: SparkSession, topics: Topics, checkpoint: str,
                   load_dims: Callable[[], Sequence[Dimension]] = tuple, once: bool = False,
                   **options) -> StreamingQuery:
    """Orders with details, then the dimensions, whose newest version every batch looks up."""
    at = event_millis("create_time", options.get("precision", "day"))
    orders = _read(spark, topics, C.TOPIC_ORDER_INFO, S.ORDER_INFO, "order_wide",
                   F.col("id").isNotNull() & at.isNotNull())
    details = _read(spark, topics, C.TOPIC_ORDER_DETAIL, S.ORDER_DETAIL, "order_wide",
                    F.col("order_id").isNotNull() & at.isNotNull())

    def write(batch: DataFrame, batch_id: int) -> None:
        wide = enrich_all(batch, load_dims()).select(*S.ORDER_WIDE.fieldNames())
        topics.write_batch(to_values(wide), C.TOPIC_ORDER_WIDE, batch_id)

    with stream_settings(spark, empty_batches=False):
        return _start(order_wide(orders.rows, details.rows, **options), [orders, details], topics,
                      "order_wide", write, checkpoint, once)


def payment_wide_job(spark: SparkSession, topics: Topics, checkpoint: str, once: bool = False,
                     **options) -> StreamingQuery:
    of_order = F.col("order_id").isNotNull()
    payments = _read(spark, topics, C.TOPIC_PAYMENT_INFO, S.PAYMENT_INFO, "payment_wide",
                     of_order & text_millis("callback_time").isNotNull())
    wide = _read(spark, topics, C.TOPIC_ORDER_WIDE, S.ORDER_WIDE, "payment_wide",
                 of_order & text_millis("create_time").isNotNull())
    with stream_settings(spark, empty_batches=False):
        return _start(payment_wide(payments.rows, wide.rows, **options), [payments, wide], topics,
                      "payment_wide", _to_topic(topics, C.TOPIC_PAYMENT_WIDE), checkpoint, once)


def visitor_stats_job(spark: SparkSession, topics: Topics, checkpoint: str, sink: Sink,
                      once: bool = False, **options) -> StreamingQuery:
    """Visitor statistics to ``sink``, such as a JDBC table."""
    inputs = [_read(spark, topics, t, S.PAGE_LOG, "visitor_stats", F.col("ts").isNotNull())
              for t in (C.TOPIC_PAGE_LOG, C.TOPIC_UNIQUE_VISIT, C.TOPIC_USER_JUMP)]
    return _start(visitor_stats(*(i.rows for i in inputs), **options), inputs, topics,
                  "visitor_stats", sink, checkpoint, once)


def product_stats_job(spark: SparkSession, topics: Topics, checkpoint: str,
                      load_dims: Callable[[], Sequence[Dimension]] = tuple,
                      inputs: Sequence[str] = ("page", "favor", "cart", "order_wide",
                                               "payment_wide", "refund", "comment"),
                      once: bool = False, **options) -> StreamingQuery:
    """Product statistics of the given inputs to their topic, named by the newest dimensions.

    A page of which one item names no SKU counts with the others and is set aside as well.
    """
    made = _sold(text_millis("create_time"))
    paid = _sold(text_millis(F.coalesce("payment_create_time", "callback_time")))
    sources = {
        "page": (C.TOPIC_PAGE_LOG, S.PAGE_LOG, F.col("ts").isNotNull(), unreadable_item()),
        "favor": (C.TOPIC_FAVOR_INFO, S.FAVOR_INFO, made),
        "cart": (C.TOPIC_CART_INFO, S.CART_INFO, made),
        "order_wide": (C.TOPIC_ORDER_WIDE, S.ORDER_WIDE, made),
        "payment_wide": (C.TOPIC_PAYMENT_WIDE, S.PAYMENT_WIDE, paid),
        "refund": (C.TOPIC_REFUND_INFO, S.REFUND_INFO, made),
        "comment": (C.TOPIC_COMMENT_INFO, S.COMMENT_INFO, made),
    }
    read = {}
    for name in inputs:
        topic, schema, *conditions = sources[name]
        read[name] = _read(spark, topics, topic, schema, "product_stats", *conditions)
    of_totals = {k: options.pop(k) for k in ("dims", "as_of_ms") if k in options}
    parts = product_parts(**{n: i.rows for n, i in read.items()}, **options)

    def write(batch: DataFrame, batch_id: int) -> None:
        named = enrich_all(product_totals(batch, **of_totals), load_dims()).select(*S.PRODUCT_STATS.fieldNames())
        topics.write_batch(to_values(named), C.TOPIC_PRODUCT_STATS, batch_id)

    return _start(parts, list(read.values()), topics, "product_stats", write, checkpoint, once)


def search_keyword_job(spark: SparkSession, topics: Topics, checkpoint: str, sink: Sink,
                       once: bool = False, **options) -> StreamingQuery:
    page = _read(spark, topics, C.TOPIC_PAGE_LOG, S.PAGE_VIEW_SQL, "keyword_stats",
                 F.col("ts").isNotNull())
    return _start(search_keywords(page.rows, **options), [page], topics, "keyword_stats", sink,
                  checkpoint, once)


def product_keyword_job(spark: SparkSession, topics: Topics, checkpoint: str, sink: Sink,
                        once: bool = False, **options) -> StreamingQuery:
    stats = _read(spark, topics, C.TOPIC_PRODUCT_STATS, S.PRODUCT_STATS_SQL, "product_keywords")
    return _start(product_keywords(stats.rows, **options), [stats], topics, "product_keywords",
                  sink, checkpoint, once)
