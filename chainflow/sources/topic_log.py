"""A topic log on shared storage, as a Spark data source (``format("topiclog")``): S20, S21, T14 and the sinks K01-K25.

A folder holds a log of topics, each with partitions, each with rows at offsets 0, 1, 2, ...:

    <path>/_commits/000000000007.json     one file a commit; what it lists has happened
    <path>/<topic>/<partition>/<id>.parquet   rows of one task, in order

**Writing** is in two phases.  Tasks write their rows to new files, which nobody sees; the driver then gives
the files their offsets, in the order of the tasks, and publishes one commit file under the next number.
Publishing fails if that number is taken, and is tried again behind the other writer's commit.  A commit names its
``writer`` and batch; a batch that the log already has is not added again, so a stream that is killed between
writing and committing, or between committing and noting it, leaves each message once.  Every ``FULL``-th commit
repeats the whole list, so that a reader opens few files.

**Reading**, in batch or as a stream, takes ``subscribe`` (topics, comma-separated) or ``subscribePattern`` (``*`` is one
dot-free part of a name; topics that appear later are picked up from their first row on), and starts at ``startingOffsets``
``earliest`` or ``latest``, at given offsets (JSON, as in checkpoints), or at ``startingTimestamp``: the first offset
whose time is not before that many milliseconds.  Commits keep the highest time of every ``STEP`` rows, so one
block of one file is looked at for that.  A stream's position is in its checkpoint.  One input partition is a range of
one file, of at most ``maxRows`` rows.

Rows: topic string, partition int, offset long, timestamp timestamp, key binary, value binary.  Written rows need topic and value;
a missing partition comes from the key's CRC32 (no key: 0), a missing time is the time of writing.

Paths go through ``pyarrow.fs``.  Stores on which a rename replaces its target need a single writer a folder.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import TaskContext, cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter,
                                    DataSourceStreamReader, InputPartition, WriterCommitMessage)

FORMAT = "topiclog"
SCHEMA = "topic string, partition int, offset long, timestamp timestamp, key binary, value binary"
#: Rows for which one highest time is kept, and commits after which the whole list is repeated.
STEP = 4096
FULL = 50
MAX_ROWS = 1_000_000

_STORED = pa.schema([("timestamp", pa.timestamp("us", "UTC")), ("key", pa.binary()), ("value", pa.binary())])


def filesystem(path: str):
    """(file system, path on it)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else "file://" + os.path.abspath(path.removeprefix("file:")))


def wildcard(pattern: str) -> re.Pattern:
    return re.compile(r"\.".join("[^.]+" if part == "*" else re.escape(part) for part in pattern.split(".")))


class Log:
    """The committed state of a log: segments of every (topic, partition) in order, and each writer's batches."""

    def __init__(self, path: str):
        from pyarrow import fs

        self.fs, self.path = filesystem(path)
        self.segments: dict[str, dict[str, list[dict]]] = {}
        self.writers: dict[str, int] = {}
        selector = fs.FileSelector(f"{self.path}/_commits", allow_not_found=True)
        names = sorted(f.base_name for f in self.fs.get_file_info(selector) if re.fullmatch(r"\d+\.json", f.base_name))
        self.next = int(names[-1][:-5]) + 1 if names else 0
        first = max((i for i, n in enumerate(names) if int(n[:-5]) % FULL == 0), default=0)
        for name in names[first:]:
            with self.fs.open_input_stream(f"{self.path}/_commits/{name}") as f:
                commit = json.loads(f.read())
            for s in commit["segments"]:
                self.segments.setdefault(s["topic"], {}).setdefault(str(s["partition"]), []).append(s)
            self.writers |= commit["writers"]

    def ends(self) -> dict[str, dict[str, int]]:
        return {t: {p: s[-1]["offset"] + s[-1]["rows"] for p, s in parts.items()} for t, parts in self.segments.items()}

    def publish(self, files: list[dict], writer: str, batch: int) -> bool:
        """Add files as one commit; False where the writer's batch is there already."""
        if self.writers.get(writer, -1) >= batch:
            return False
        ends = self.ends()
        added = []
        for f in files:
            parts = ends.setdefault(f["topic"], {})
            at = parts.get(str(f["partition"]), 0)
            added.append(f | {"offset": at})
            parts[str(f["partition"])] = at + f["rows"]
        whole = self.next % FULL == 0
        old = [s for parts in self.segments.values() for ss in parts.values() for s in ss] if whole else []
        text = json.dumps({"segments": old + added, "writers": (self.writers if whole else {}) | {writer: batch}})
        self._create(f"{self.path}/_commits/{self.next:012d}.json", text.encode())
        return True

    def _create(self, path: str, data: bytes) -> None:
        """Write a file under a name that nobody has taken, or raise FileExistsError."""
        from pyarrow import fs

        self.fs.create_dir(os.path.dirname(path), recursive=True)
        draft = f"{path}.{uuid.uuid4().hex}.tmp"
        with self.fs.open_output_stream(draft) as f:
            f.write(data)
        if isinstance(self.fs, fs.LocalFileSystem):
            try:
                os.link(draft, path)  # fails where the name exists
            finally:
                os.unlink(draft)
            return
        if self.fs.get_file_info(path).type != fs.FileType.NotFound:
            self.fs.delete_file(draft)
            raise FileExistsError(path)
        self.fs.move(draft, path)


def commit(path: str, files: list[dict], writer: str, batch: int) -> bool:
    """Publish a batch's files, behind whatever other writers commit meanwhile."""
    while True:
        try:
            return Log(path).publish(files, writer, batch)
        except FileExistsError:
            time.sleep(0.01)


class _Options:
    def __init__(self, options):
        self.path = options["path"]
        self.topics = [t.strip() for t in options.get("subscribe", "").split(",") if t.strip()]
        pattern = options.get("subscribePattern")
        self.pattern = wildcard(pattern) if pattern else None
        self.start = options.get("startingOffsets")
        self.since = options.get("startingTimestamp")
        self.max_rows = int(options.get("maxRows", MAX_ROWS))

    def takes(self, topic: str) -> bool:
        if self.pattern is None and not self.topics:
            return True
        return topic in self.topics or bool(self.pattern and self.pattern.fullmatch(topic))

    def ends(self, log: Log) -> dict:
        return {t: parts for t, parts in sorted(log.ends().items()) if self.takes(t)}

    def starts(self, log: Log, default: str) -> dict:
        """{topic: {partition: offset}} to start at; a partition that is not named starts at 0."""
        ends = self.ends(log)
        if self.since is not None:
            return {t: {p: first_at(log, t, p, int(self.since)) for p in parts} for t, parts in ends.items()}
        start = self.start or default
        if start == "latest":
            return ends
        if start == "earliest":
            return {t: dict.fromkeys(parts, 0) for t, parts in ends.items()}
        return {t: parts for t, parts in json.loads(start).items() if self.takes(t)}

    def ranges(self, log: Log, start: dict, end: dict) -> list[InputPartition]:
        out = []
        for topic, parts in end.items():
            for p, stop in parts.items():
                begin = start.get(topic, {}).get(p, 0)
                for s in log.segments.get(topic, {}).get(p, ()):
                    lo, hi = max(begin, s["offset"]), min(stop, s["offset"] + s["rows"])
                    for at in range(lo, hi, self.max_rows):
                        out.append(Range(self.path, topic, int(p), s["file"], s["offset"], at, min(at + self.max_rows, hi)))
        return out


class Range(InputPartition):
    """Offsets ``lo`` to ``hi`` (exclusive) of a file whose first row is at ``base``."""

    def __init__(self, path, topic, partition, file, base, lo, hi):
        self.path, self.topic, self.partition, self.file = path, topic, partition, file
        self.base, self.lo, self.hi = base, lo, hi


def first_at(log: Log, topic: str, partition: str, since_ms: int) -> int:
    """The first offset of a partition whose time is not before ``since_ms``; its end where there is none."""
    end = 0
    for s in log.segments.get(topic, {}).get(partition, ()):
        end = s["offset"] + s["rows"]
        block = next((i for i, high in enumerate(s["times"]) if high >= since_ms * 1000), None)
        if block is None:
            continue
        with log.fs.open_input_file(f"{log.path}/{s['file']}") as f:
            at = 0  # row groups hold STEP rows each
            times = pq.ParquetFile(f).read_row_group(block, columns=["timestamp"]).column(0)
            at = pc.index(pc.greater_equal(times.cast(pa.int64()), since_ms * 1000), True).as_py()
        return s["offset"] + block * STEP + at
    return end


def read_range(r: Range | None) -> Iterator[pa.RecordBatch]:
    if r is None:  # Spark's stand-in where there is no partition
        return
    store, path = filesystem(r.path)
    with store.open_input_file(f"{path}/{r.file}") as f:
        source = pq.ParquetFile(f)
        for group in range((r.lo - r.base) // STEP, -(-(r.hi - r.base) // STEP)):
            first = r.base + group * STEP
            rows = source.read_row_group(group)
            lo, hi = max(0, r.lo - first), min(rows.num_rows, r.hi - first)
            rows = rows.slice(lo, hi - lo).combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(r.topic), hi - lo), pa.repeat(pa.scalar(r.partition, pa.int32()), hi - lo),
                 pa.array(range(first + lo, first + hi), pa.int64()),
                 *(pa.concat_arrays(rows.column(c).chunks) for c in _STORED.names)],
                ["topic", "partition", "offset", *_STORED.names])


class Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = _Options(options)

    def partitions(self) -> list[InputPartition]:
        log = Log(self.options.path)
        return self.options.ranges(log, self.options.starts(log, "earliest"), self.options.ends(log))

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return read_range(partition)


class StreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.options = _Options(options)

    def initialOffset(self) -> dict:
        return self.options.starts(Log(self.options.path), "latest")

    def latestOffset(self) -> dict:
        return self.options.ends(Log(self.options.path))

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return self.options.ranges(Log(self.options.path), start, end)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return read_range(partition)

    def commit(self, end: dict) -> None:
        """Nothing to do: positions are in the checkpoint."""


class Files(WriterCommitMessage):
    def __init__(self, task: int, files: list[dict]):
        self.task, self.files = task, files


class _Segment:
    """One file being written: row groups of ``STEP`` rows and the highest time of each."""

    def __init__(self, store, path: str, topic: str, partition: int):
        self.topic, self.partition = topic, partition
        self.file = f"{topic}/{partition}/{uuid.uuid4().hex}.parquet"
        store.create_dir(f"{path}/{topic}/{partition}", recursive=True)
        self.writer = pq.ParquetWriter(store.open_output_stream(f"{path}/{self.file}"), _STORED, compression="zstd")
        self.held: list[pa.Table] = []
        self.waiting = self.rows = 0
        self.times: list[int] = []

    def add(self, rows: pa.Table) -> None:
        self.held.append(rows)
        self.waiting += rows.num_rows
        while self.waiting >= STEP:
            self._group(STEP)

    def _group(self, n: int) -> None:
        rows = pa.concat_tables(self.held).combine_chunks()
        self.held, self.waiting = [rows.slice(n)], rows.num_rows - n
        rows = rows.slice(0, n)
        self.writer.write_table(rows, row_group_size=STEP)
        self.times.append(pc.max(rows.column("timestamp").cast(pa.int64())).as_py())
        self.rows += n

    def close(self) -> dict:
        if self.waiting:
            self._group(self.waiting)
        self.writer.close()
        return {"topic": self.topic, "partition": self.partition, "file": self.file, "rows": self.rows, "times": self.times}


class _Writing:
    def __init__(self, options: dict):
        self.path = options["path"]
        self.partitions = int(options.get("partitions", 1))
        self.writer = options.get("writer") or options.get("checkpointLocation") or uuid.uuid4().hex
        self.batch = int(options.get("batch", 0))

    def write_files(self, batches: Iterator[pa.RecordBatch]) -> Files:
        store, path = filesystem(self.path)
        open_: dict[tuple[str, int], _Segment] = {}
        now = int(time.time() * 1e6)
        for batch in batches:
            cols = dict(zip(batch.schema.names, batch.columns))
            n = batch.num_rows

            def column(name, kind, default=None):
                got = cols.get(name)
                return pa.nulls(n, kind) if got is None else got.cast(kind)

            keys = column("key", pa.binary())
            stamps = pc.fill_null(column("timestamp", pa.timestamp("us", "UTC")), pa.scalar(now, pa.timestamp("us", "UTC")))
            own = column("partition", pa.int32()).to_pylist()
            topics = column("topic", pa.string()).to_pylist()
            places = [(t, p if p is not None else (zlib.crc32(k) % self.partitions if k is not None else 0))
                      for t, p, k in zip(topics, own, keys.to_pylist())]
            table = pa.Table.from_arrays([stamps, keys, column("value", pa.binary())], schema=_STORED)
            rows_of: dict[tuple[str, int], list[int]] = {}
            for i, place in enumerate(places):
                rows_of.setdefault(place, []).append(i)
            for (topic, partition), rows in rows_of.items():
                if not topic or "/" in topic or topic.startswith(("_", ".")):
                    raise ValueError(f"not a topic's name: {topic!r}")
                if (topic, partition) not in open_:
                    open_[topic, partition] = _Segment(store, path, topic, partition)
                open_[topic, partition].add(table.take(pa.array(rows)))
        return Files(TaskContext.get().partitionId(), [s.close() for s in open_.values()])

    def publish(self, messages: list, batch: int) -> None:
        done = sorted((m for m in messages if m is not None), key=lambda m: m.task)
        files = [f for m in done for f in m.files]
        if not commit(self.path, files, self.writer, batch):
            self.discard(messages)

    def discard(self, messages: list) -> None:
        store, path = filesystem(self.path)
        for f in (f for m in messages if m is not None for f in m.files):
            store.delete_file(f"{path}/{f['file']}")


class Writer(_Writing, DataSourceArrowWriter):
    def write(self, iterator: Iterator[pa.RecordBatch]) -> Files:
        return self.write_files(iterator)

    def commit(self, messages: list) -> None:
        self.publish(messages, self.batch)

    def abort(self, messages: list) -> None:
        self.discard(messages)


class StreamWriter(_Writing, DataSourceStreamArrowWriter):
    def __init__(self, options):
        super().__init__(options)
        if "writer" not in options and "checkpointLocation" not in options:
            raise ValueError("name the stream: its batches are told from others' by the option writer")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Files:
        return self.write_files(iterator)

    def commit(self, messages: list, batchId: int) -> None:
        self.publish(messages, batchId)

    def abort(self, messages: list, batchId: int) -> None:
        self.discard(messages)


class TopicLog(DataSource):
    """The data source ``topiclog``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options)

    def streamReader(self, schema) -> StreamReader:
        return StreamReader(self.options)

    def writer(self, schema, overwrite: bool) -> Writer:
        if overwrite:
            raise ValueError("a log is only appended to")
        return Writer(self.options)

    def streamWriter(self, schema, overwrite: bool) -> StreamWriter:
        return StreamWriter(self.options)


def register(spark: SparkSession) -> None:
    """Make ``format("topiclog")`` known to the session."""
    spark.dataSource.register(TopicLog)


# executors need no copy of this library
cloudpickle.register_pickle_by_value(sys.modules[__name__])
