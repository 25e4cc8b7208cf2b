"""Topics of text records (A1-A4): Kafka in production, folders of text files elsewhere.

Both kinds have the same methods, so jobs do not know which one they run on. Delivery is at
least once: a micro-batch that is run again after a failure writes its records again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tradewake.functions.records import parse_rows
from tradewake.functions.times import rowtime_seconds
from tradewake.sources.arrival import register_topics

# Fixed value: how long a producer transaction may last, in milliseconds.
TRANSACTION_TIMEOUT_MS = 900_000
# Records of a compressed file: about a second of one task's parsing.
FILE_RECORDS = 100_000


def commit_name(batch_id: int, topics: Sequence[str]) -> str:
    return f"{batch_id}~{'+'.join(sorted(topics))}"


def committed_batches(names: Sequence[str], topic: str) -> set[int]:
    """Micro-batches of a topic among the names of commit records."""
    parts = [n.split("~") for n in names if "~" in n]
    return {int(batch) for batch, topics in parts if topic in topics.split("+")}


@dataclass(frozen=True)
class KafkaTopics:
    """Topics of a Kafka cluster; needs Spark's Kafka connector on the class path."""

    servers: str
    options: Mapping[str, str] = field(default_factory=dict)

    def source_options(self, topic: str, group: str, starting: str = "latest") -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.servers, "subscribe": topic,
            # A prefix: sources that share one group id may each read only part.
            "groupIdPrefix": group, "startingOffsets": starting, **self.options,
        }

    def sink_options(self, topic: str | None = None) -> dict[str, str]:
        """Without ``topic`` every row names its own in a ``topic`` column."""
        fixed = {
            "kafka.bootstrap.servers": self.servers,
            "kafka.transaction.timeout.ms": str(TRANSACTION_TIMEOUT_MS), **self.options,
        }
        return {**fixed, "topic": topic} if topic else fixed

    def read_stream(self, spark: SparkSession, topic: str, group: str,
                    starting: str = "latest") -> DataFrame:
        options = self.source_options(topic, group, starting)
        rows = spark.readStream.format("kafka").options(**options).load()
        return rows.select(F.col("value").cast("string").alias("value"), "partition", "offset")

    def write_batch(self, df: DataFrame, topic: str | None = None, batch_id: int = 0) -> None:
        df.write.format("kafka").options(**self.sink_options(topic)).save()

    def write_together(self, rows: Mapping[str, DataFrame], batch_id: int = 0) -> None:
        """The rows of a micro-batch for several topics; Kafka's sink doesn't commit them as one."""
        for topic, df in rows.items():
            self.write_batch(df, topic, batch_id)

    def write_stream(self, df: DataFrame, topic: str, checkpoint: str) -> DataStreamWriter:
        return (df.writeStream.format("kafka").options(**self.sink_options(topic))
                .option("checkpointLocation", checkpoint))


@dataclass(frozen=True)
class FileTopics:
    """Topics as folders ``topic=<name>`` of text files below ``root``.

    ``arrival`` gives every record its ``partition`` and ``offset``, as Kafka does, so that jobs can
    tell which of two records of equal time came first. A trigger then takes ``max_bytes`` of a
    topic, if given, else all that is new.

    ``committed`` shows readers only micro-batches whose writer has finished all its topics: one
    empty file below ``_commits`` names batch and topics, so they come into sight together, and
    what a lost writer left never does. The batch that runs again replaces it. Streams then need
    ``arrival``, and a batch must not come into sight before one with a lower number.

    ``compression`` names a codec of Spark's text files, such as ``lz4``. One task reads a
    compressed file, so a file takes at most ``FILE_RECORDS`` records. Offsets count bytes of plain
    text, so ``arrival`` goes without.
    """

    root: str
    max_files: int | None = None
    arrival: bool = False
    max_bytes: int | None = None
    committed: bool = False
    compression: str | None = None

    def __post_init__(self) -> None:
        if self.arrival and self.compression:
            raise ValueError("topics in order of arrival are plain text")

    def path(self, topic: str) -> str:
        return f"{self.root.rstrip('/')}/topic={topic}"

    def read_stream(self, spark: SparkSession, topic: str, group: str = "",
                    starting: str = "earliest") -> DataFrame:
        if self.arrival:
            reader = spark.readStream.format(register_topics(spark))
            if self.committed:
                reader = reader.option("commits", self._commits()).option("topic", topic)
            if self.max_bytes:
                reader = reader.option("maxBytes", str(self.max_bytes))
                if group:
                    reader = reader.option(
                        "progress", f"{self.root.rstrip('/')}/_progress/{group}/{topic}")
            return reader.load(self.path(topic))
        reader = spark.readStream.option("recursiveFileLookup", "true")
        if self.max_files:
            reader = reader.option("maxFilesPerTrigger", self.max_files)
        return reader.text(self.path(topic))

    def _commits(self) -> str:
        return f"{self.root.rstrip('/')}/_commits"

    def read(self, spark: SparkSession, topic: str) -> DataFrame:
        if self.committed:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{self._commits()}/*")
            fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
            found = committed_batches(
                [s.getPath().getName() for s in fs.globStatus(folder) or []], topic)
            paths = [f"{self.path(topic)}/batch={i}" for i in sorted(found)]
            # A batch without rows for a topic has no folder.
            at = spark._jvm.org.apache.hadoop.fs.Path
            paths = [p for p in paths if fs.exists(at(p))]
            return spark.read.text(paths) if paths else spark.createDataFrame([], "value string")
        return spark.read.option("recursiveFileLookup", "true").text(self.path(topic))

    def create(self, spark: SparkSession, topic: str) -> None:
        """A topic without records, unless it is there: streams can't start on a missing folder."""
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path(topic))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)

    def write_batch(self, df: DataFrame, topic: str | None = None, batch_id: int = 0) -> None:
        # A folder per micro-batch is overwritten when that batch runs again.
        rows = df.withColumn("topic", F.lit(topic)) if topic else df
        rows = rows.withColumn("batch", F.lit(batch_id)).select("value", "topic", "batch")
        writer = (rows.write.mode("overwrite").partitionBy("topic", "batch")
                  .option("partitionOverwriteMode", "dynamic"))
        if self.compression:
            writer = writer.option("compression", self.compression).option(
                "maxRecordsPerFile", FILE_RECORDS)
        writer.text(self.root)

    def write_together(self, rows: Mapping[str, DataFrame], batch_id: int = 0) -> None:
        """The rows of a micro-batch for several topics, then the record that they are there."""
        for topic, df in rows.items():
            self.write_batch(df, topic, batch_id)
        if self.committed:
            spark = next(iter(rows.values())).sparkSession
            name = commit_name(batch_id, list(rows))
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{self._commits()}/{name}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path).close()

    def write_stream(self, df: DataFrame, topic: str, checkpoint: str) -> DataStreamWriter:
        return (df.writeStream.option("checkpointLocation", checkpoint)
                .foreachBatch(lambda rows, batch_id: self.write_batch(rows, topic, batch_id)))


Topics = KafkaTopics | FileTopics


def topic_table(spark: SparkSession, topics: Topics, topic: str, schema: T.StructType, view: str,
                group: str = "", watermark: str | None = None) -> DataFrame:
    """A JSON topic as a temporary view for SQL (A2).

    With a ``ts`` field in epoch milliseconds, ``watermark`` adds a ``rowtime`` column that is
    delayed by that much.
    """
    rows = parse_rows(topics.read_stream(spark, topic, group), schema).drop("_corrupt")
    if watermark:
        rows = rows.withColumn("rowtime", rowtime_seconds("ts")).withWatermark("rowtime", watermark)
    rows.createOrReplaceTempView(view)
    return rows
