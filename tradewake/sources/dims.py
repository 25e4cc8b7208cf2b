"""Stored dimension tables (A7, A8, D5): rows dealt into parts by a hash of their key.

A table is a folder ``data`` with one folder per write and a folder ``manifest`` with one small
file per version. A manifest names, for every part, the write that holds its rows; it also has the
schema, the key and the number of parts. A write holds only the parts it changes, so its size
follows the keys that changed and not the table. The manifest is put in place by a rename after
all files are there: readers see a whole version or the one before, whatever writer is lost.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewake.operators.sides import broadcast_if_small
from tradewake.plans.cdc import dim_schema, upsert_dim

PART = "_part"


@dataclass(frozen=True)
class Manifest:
    """One version of a table: ``writes`` says for each part that has rows which write holds them."""

    version: int
    parts: int
    pk: tuple[str, ...]
    schema: T.StructType
    writes: dict[int, int]

    def to_text(self) -> str:
        return json.dumps({"parts": self.parts, "pk": list(self.pk),
                           "schema": self.schema.jsonValue(), "writes": self.writes})

    @classmethod
    def from_text(cls, version: int, text: str) -> Manifest:
        found = json.loads(text)
        return cls(version, found["parts"], tuple(found["pk"]),
                   T.StructType.fromJson(found["schema"]),
                   {int(k): v for k, v in found["writes"].items()})


def part_of(pk: Sequence[str], parts: int) -> Column:
    """The part of a row; keys count as text, so 1 and '1' are in one part."""
    return F.pmod(F.xxhash64(*(F.col(c).cast("string") for c in pk)), F.lit(parts)).cast("int")


class DimStore:
    def __init__(self, spark: SparkSession, root: str, keep_seconds: float = 86_400,
                 parts: int = 16):
        """``parts`` is fixed when a table is first written: so many that one is a task's work.
        What no newer version uses is deleted once that version has been there for
        ``keep_seconds``: longer than any reader takes."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep_seconds = keep_seconds
        self.parts = parts
        self._cached: dict[str, tuple[int, DataFrame]] = {}

    def _path(self, table: str, *below: str) -> str:
        return "/".join((self.root, table, *below))

    def _hadoop(self, path: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def _listed(self, pattern: str) -> list:
        """Status of the files and folders that match, in no order."""
        fs, path = self._hadoop(pattern)
        return list(fs.globStatus(path) or [])

    def versions(self, table: str) -> list[int]:
        return sorted(int(s.getPath().getName()[2:])
                      for s in self._listed(self._path(table, "manifest", "v=*")))

    def manifest(self, table: str, version: int | None = None) -> Manifest | None:
        """A version of a table, the newest unless named."""
        if version is None:
            found = self.versions(table)
            if not found:
                return None
            version = found[-1]
        fs, path = self._hadoop(self._path(table, "manifest", f"v={version}"))
        stream = fs.open(path)
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return Manifest.from_text(version, text)

    def _commit(self, table: str, manifest: Manifest) -> int:
        """Put a manifest in place; fails if its version is there already."""
        fs, at = self._hadoop(self._path(table, "manifest", f"v={manifest.version}"))
        _, draft = self._hadoop(self._path(table, "manifest", f"_draft-{uuid.uuid4().hex}"))
        stream = fs.create(draft)
        stream.write(bytearray(manifest.to_text().encode()))
        stream.close()
        if fs.exists(at) or not fs.rename(draft, at):
            fs.delete(draft, False)
            raise RuntimeError(f"{table}: version {manifest.version} has another writer")
        self._forget(table)
        return manifest.version

    def _forget(self, table: str) -> None:
        """Delete versions that were replaced more than ``keep_seconds`` before the newest was
        written, and the files only they use."""
        now = time.time() * 1000
        found = sorted((int(s.getPath().getName()[2:]), s.getModificationTime())
                       for s in self._listed(self._path(table, "manifest", "v=*")))
        old = [version for (version, _), (_, newer) in zip(found, found[1:-1])
               if now - newer > self.keep_seconds * 1000]
        if not old:
            return
        gone = {w for v in old for w in self.manifest(table, v).writes.items()}
        for version, _ in found[len(old):]:
            gone -= set(self.manifest(table, version).writes.items())
        for part, write in gone:
            fs, path = self._hadoop(self._path(table, "data", f"w={write}", f"{PART}={part}"))
            fs.delete(path, True)
        for version in old:
            fs, path = self._hadoop(self._path(table, "manifest", f"v={version}"))
            fs.delete(path, False)

    def _rows(self, table: str, manifest: Manifest, parts: Sequence[int] | None = None
              ) -> DataFrame:
        chosen = manifest.writes if parts is None else {
            p: manifest.writes[p] for p in parts if p in manifest.writes}
        paths = [self._path(table, "data", f"w={w}", f"{PART}={p}") for p, w in chosen.items()]
        if not paths:
            return self.spark.createDataFrame([], manifest.schema)
        return self.spark.read.schema(manifest.schema).parquet(*paths)

    def read(self, table: str) -> DataFrame | None:
        """The newest version, or None. Readers in a stream call this once per micro-batch."""
        manifest = self.manifest(table)
        return manifest and self._rows(table, manifest)

    def read_keys(self, table: str, keys: DataFrame) -> DataFrame | None:
        """The newest rows of the keys in ``keys``, which has the table's key columns.

        Only the parts those keys fall into are read. The numbers of the parts are collected, at
        most as many as the table has.
        """
        manifest = self.manifest(table)
        if manifest is None:
            return None
        pk = list(manifest.pk)
        wanted = keys.select(*pk).distinct()
        touched = self._touched(wanted.select(part_of(pk, manifest.parts).alias(PART)))
        rows = self._rows(table, manifest, touched)
        return rows.join(broadcast_if_small(wanted), pk, "left_semi")

    def cached(self, table: str) -> DataFrame | None:
        """The newest version, kept in executor memory until a newer one exists.

        Asking costs one folder listing, so a stream can ask in every micro-batch.
        """
        found = self.versions(table)
        if not found:
            return None
        version, rows = self._cached.get(table, (-1, None))
        if version != found[-1]:
            self.invalidate(table)
            rows = self._rows(table, self.manifest(table, found[-1])).persist()
            self._cached[table] = (found[-1], rows)
        return rows

    def invalidate(self, table: str) -> None:
        _, rows = self._cached.pop(table, (-1, None))
        if rows is not None:
            rows.unpersist()

    @staticmethod
    def _touched(rows: DataFrame) -> list[int]:
        return [r[0] for r in rows.select(PART).distinct().collect()]

    def _write(self, table: str, before: Manifest, rows: DataFrame, touched: Sequence[int]) -> int:
        """The version after ``before``: ``rows``, which have their part, are all rows of the
        parts ``touched``."""
        # A number of its own for every try, so that one that failed leaves nothing behind.
        write = 1 + max((int(s.getPath().getName()[2:]) for s in
                         self._listed(self._path(table, "data", "w=*"))), default=-1)
        # A task may write several parts; a part is written by one task.
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        (rows.repartition(max(1, min(len(touched), tasks)), PART).write.partitionBy(PART)
         .parquet(self._path(table, "data", f"w={write}")))
        have = {int(s.getPath().getName().split("=")[1]) for s in
                self._listed(self._path(table, "data", f"w={write}", f"{PART}=*"))}
        writes = {p: w for p, w in before.writes.items() if p not in touched}
        writes |= {p: write for p in have}
        schema = T.StructType([f for f in rows.schema if f.name != PART])
        return self._commit(table, replace(
            before, version=before.version + 1, schema=schema, writes=writes))

    def write(self, table: str, rows: DataFrame, pk: Sequence[str] | None = None) -> int:
        """Replace a whole table; its new version. Keys are expected to be unique."""
        before = self.manifest(table)
        if before is None:
            before = Manifest(-1, self.parts, tuple(pk or ("id",)), T.StructType([]), {})
        before = replace(before, pk=tuple(pk or before.pk))
        dealt = rows.withColumn(PART, part_of(before.pk, before.parts))
        return self._write(table, before, dealt, range(before.parts))

    def create(self, table: str, sink_columns: str, order: Sequence[str] = ("ts",),
               pk: Sequence[str] = ("id",)) -> bool:
        """An empty table of text columns, unless the table exists."""
        if self.versions(table):
            return False
        schema = dim_schema(sink_columns)
        for column in order:
            schema = schema.add(column, T.LongType())
        self._commit(table, Manifest(0, self.parts, tuple(pk), schema, {}))
        return True

    def upsert(self, table: str, changes: DataFrame, pk: Sequence[str],
               order: Sequence[str] = ("ts",)) -> int:
        """Bring the newest row of every changed key into the table; its new version.

        The changes are combined by key first. Of the table only the parts they fall into are
        read and written. Without changes the version stays. Applying changes again changes
        nothing but the version.
        """
        before = self.manifest(table) or Manifest(-1, self.parts, tuple(pk), T.StructType([]), {})
        if before.pk != tuple(pk) and before.writes:
            raise ValueError(f"{table} is stored by {before.pk}, not {tuple(pk)}")
        newest = upsert_dim(None, changes, pk, order) \
            .withColumn(PART, part_of(pk, before.parts)).persist()
        try:
            touched = self._touched(newest)
            if not touched and before.version >= 0:
                return before.version
            stored = None
            if before.schema.fields:
                stored = self._rows(table, before, touched).withColumn(
                    PART, part_of(pk, before.parts))
            merged = upsert_dim(stored, newest, pk, order)
            return self._write(table, replace(before, pk=tuple(pk)), merged, touched)
        finally:
            newest.unpersist()
