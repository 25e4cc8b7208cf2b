"""Topics of text files in order of arrival: a stream source that numbers records (A1).

A topic is a folder whose files, taken by batch number and name, are one log that only grows. A
record is a line. Its offset is the place of its first byte in the log, so offsets rise in order
of arrival over all files, and its partition is the number of the writing task. What is not in
place yet, such as files below a folder that starts with ``_`` or ``.``, isn't part of the log.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

FORMAT = "tradewake_topic"
SCHEMA = "value string, partition int, offset long"


def topic_source() -> type:
    """The data source class. Everything it needs is defined in here, so that it is sent to the
    workers by value and needs no installed package."""
    import json
    import re

    import pyarrow as pa
    from pyarrow import fs
    from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

    class Piece(InputPartition):
        def __init__(self, path: str, base: int, start: int, end: int, partition: int):
            self.path, self.base, self.start, self.end = path, base, start, end
            self.partition = partition

    def opened(uri: str):
        return fs.FileSystem.from_uri(uri if re.match(r"\w+:", uri) else f"file://{uri}")

    class TopicReader(DataSourceStreamReader):
        """Offsets are one number, the bytes of the log that are read.

        A trigger takes at most ``maxBytes``, counted from where the last one ended. A query that
        starts learns that from the file ``progress``, which belongs to its checkpoint; without
        one its first trigger takes all there is.
        """

        def __init__(self, options):
            self.path = options["path"]
            self.most = int(options.get("maxBytes", 0))
            self.split = int(options.get("splitBytes", 64 << 20))
            self.progress = options.get("progress")
            self.commits, self.topic = options.get("commits"), options.get("topic")
            self.at = None

        def committed(self):
            """Micro-batches whose commit record names the topic; None where none are asked for."""
            if not self.commits:
                return None
            system, folder = opened(self.commits)
            names = [re.fullmatch(r"(\d+)~(.+)", i.base_name) for i in system.get_file_info(
                fs.FileSelector(folder, allow_not_found=True))]
            return {int(n[1]) for n in names if n and self.topic in n[2].split("+")}

        def segments(self):
            """Path, first offset, size and partition of every file, in order."""
            system, root = opened(self.path)
            listed = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
            found, done = [], self.committed()
            for info in listed:
                below = info.path[len(root):].strip("/").split("/")
                if info.type != fs.FileType.File or any(x[0] in "_." for x in below):
                    continue
                batch = re.search(r"(?:^|/)batch=(\d+)/", "/".join(below))
                if done is not None and not (batch and int(batch[1]) in done):
                    continue
                task = re.match(r"part-(\d+)", below[-1])
                found.append((int(batch[1]) if batch else 0, "/".join(below), info,
                              int(task[1]) if task else 0))
            base = 0
            for _, _, info, partition in sorted(found, key=lambda x: x[:2]):
                yield info.path, base, info.size, partition
                base += info.size

        def noted(self, end=None):
            """Read or write down how far triggers were planned."""
            if not self.progress:
                return None
            system, path = opened(self.progress)
            if end is None:
                if system.get_file_info(path).type != fs.FileType.File:
                    return 0
                with system.open_input_stream(path) as f:
                    return json.loads(f.read())["at"]
            system.create_dir(path.rpartition("/")[0], recursive=True)
            with system.open_output_stream(path) as f:
                f.write(json.dumps({"at": end}).encode())

        def initialOffset(self):
            self.at = 0
            return {"at": 0}

        def latestOffset(self):
            total = sum(size for _, _, size, _ in self.segments())
            at = self.noted() if self.at is None else self.at
            if not self.most or at is None:
                return {"at": total}
            return {"at": max(at, min(total, at + self.most))}

        def partitions(self, start, end):
            self.at = end["at"]
            self.noted(end["at"])
            pieces = []
            for path, base, size, partition in self.segments():
                low, high = max(start["at"] - base, 0), min(end["at"] - base, size)
                for a in range(low, high, self.split):
                    pieces.append(Piece(path, base, a, min(a + self.split, high), partition))
            return pieces

        def read(self, piece):
            """The records that begin in the piece, the last one to its end."""
            system, _ = opened(self.path)
            with system.open_input_file(piece.path) as f:
                at = piece.start
                if at:
                    f.seek(at - 1)
                    at += self.rest_of_line(f) - 1
                f.seek(at)
                raw = f.read(max(0, piece.end - at))
                if raw and not raw.endswith(b"\n"):
                    tail = []
                    self.rest_of_line(f, tail)
                    raw += b"".join(tail)
            if not raw:
                return
            lines = raw.removesuffix(b"\n").split(b"\n")
            offsets, place = [], piece.base + at
            for line in lines:
                offsets.append(place)
                place += len(line) + 1
            for k in range(0, len(lines), 10_000):
                part = lines[k:k + 10_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.decode("utf-8", "replace") for x in part], pa.string()),
                     pa.array([piece.partition] * len(part), pa.int32()),
                     pa.array(offsets[k:k + 10_000], pa.int64())],
                    names=["value", "partition", "offset"])

        @staticmethod
        def rest_of_line(f, into=None):
            """Bytes up to and with the next line feed; they are put into ``into``."""
            count = 0
            while block := f.read(1 << 16):
                end = block.find(b"\n") + 1
                block = block[:end] if end else block
                count += len(block)
                if into is not None:
                    into.append(block)
                if end:
                    break
            return count

    class TopicSource(DataSource):
        @classmethod
        def name(cls):
            return FORMAT_NAME

        def schema(self):
            return SCHEMA_TEXT

        def streamReader(self, schema):
            return TopicReader(self.options)

    # Closed over, as names of this module aren't known where the class arrives.
    FORMAT_NAME, SCHEMA_TEXT = FORMAT, SCHEMA
    return TopicSource


def register_topics(spark: SparkSession) -> str:
    """Make the source known to the session; its format name."""
    spark.dataSource.register(topic_source())
    return FORMAT
