"""Deterministic sharded WARC writer and its reader.

Writing: payloads that occur more than once are found by their SHA-256 (counted
map-side first); the record with the smallest page_id is the response, the others are
revisits of it.  Records are cut into shards by exact bytes along the order (page_id, payload
digest), so the same table gives the same archives however it is partitioned, clustered ids
fill no shard, and the pages of one id (or of none) are cut by their payloads.  Only rows of
one id with equal payloads stay together.  A task sorts its shard, regenerates headers and digests, writes each record as its own gzip
member and rolls to the next file when the compressed size reaches ``roll_bytes``.

Commit: files are written under names that hold a random part; the job's result is the
list of the files of the attempts that Spark accepted (the staged manifest).  Each is
then renamed to its final name, a step that may be repeated, and the manifest is
written last.  Readers take what the manifest lists; leftovers of lost attempts are never
read.

Files are opened through ``pyarrow.fs`` by the folder's URI (file, hdfs, s3, gs), so the
folder must be one that all executors reach.

Defined cases: a null payload is empty; a null url is empty; records of a null page_id come
last and are responses only where no record with an id has their payload; of repeated
rows the first is the response and the others revisit it; control characters in a url are
percent-encoded; extra columns are ignored; an empty table gives an empty manifest.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

MANIFEST = "shard int, number int, temporary string, name string, records long, bytes long, sha256 string"
RECORDS = ("page_id long, url string, record_type string, payload binary, payload_bytes long, "
           "payload_digest string, refers_to long")
#: Fixed value: the profile of a revisit that has the same payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAX_BROADCAST_ROWS = 200_000
#: The shards' borders go to every task (about 25 bytes each); a larger table gets larger shards.
MAX_SHARDS = 200_000


def file_system(uri: str):
    """(file system, path) of a folder's URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def digest32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id, digest: str, copy: int) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}:{copy}>"


def record(page_id, url: str, payload: bytes, digest: str, copy: int, refers_to, revisit: bool, date: str) -> bytes:
    """One WARC/1.1 record: an HTTP response, or its head alone for a revisit."""
    safe = "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
             ).encode()
    if not revisit:
        block += payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Target-URI: {safe}",
             f"WARC-Date: {date}", f"WARC-Record-ID: {record_id(page_id, digest, copy)}",
             "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}",
             f"WARC-Block-Digest: sha1:{digest32(block)}"]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest, 0)}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _File:
    """A file being written under a temporary name."""

    def __init__(self, fs, folder: str, shard: int, number: int):
        self.shard, self.number, self.records, self.bytes = shard, number, 0, 0
        self.name = f"pages-{shard:06d}-{number:05d}.warc.gz"
        self.temporary = f"tmp/{self.name}.{uuid.uuid4().hex}"
        self.sha = hashlib.sha256()
        self.out = fs.open_output_stream(posixpath.join(folder, self.temporary), compression=None)

    def add(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.bytes += len(data)
        self.records += 1

    def close(self) -> tuple:
        self.out.close()
        return (self.shard, self.number, self.temporary, self.name, self.records, self.bytes, self.sha.hexdigest())


def _borders(pages: DataFrame, shard_bytes: int) -> list[tuple]:
    """First (no id, page_id, key's head) of each shard: shards are cut by bytes along that order.

    Rows are first added up per (page_id, head), so that copies are one row; those are
    sorted by range, and a place is the bytes before it in its range and in the ranges below.
    """
    order = [F.col("page_id").asc_nulls_last(), F.col("head")]
    parts = max(1, int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    groups = (pages.groupBy("page_id", "head").agg(F.sum(F.octet_length("payload") + 600).alias("bytes"))
              .repartitionByRange(parts, *order).sortWithinPartitions(*order))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            size = batch.column(2).to_numpy()
            ends = before + np.cumsum(size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(size), part, np.int32)), *batch.columns, pa.array(ends - size)],
                ["part", "page_id", "head", "bytes", "before"])
            before = int(ends[-1]) if len(ends) else before

    placed = C.written(groups.mapInArrow(place, C.take("part int, page_id long, head long, bytes long, before long")),
                       "places")
    ranges, offset = [], 0
    for part, size in sorted(placed.groupBy("part").agg(F.sum("bytes")).collect()):
        ranges.append((part, offset))
        offset += size
    if not ranges:
        return []
    shard_bytes = max(shard_bytes, -(-offset // MAX_SHARDS))
    offsets = pages.sparkSession.createDataFrame(ranges, "part int, offset long")
    at = F.floor((F.col("offset") + F.col("before")) / shard_bytes)
    firsts = (placed.join(F.broadcast(offsets), "part").groupBy(at.alias("shard"))
              .agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "head")).alias("first")))
    return sorted((r["first"].none, r["first"].page_id or 0, r["first"].head) for r in firsts.collect())


def _shard_of(borders: list[tuple]):
    """Arrow function (page_id, head) -> number of the shard; only ids that are cut look at the head."""
    none = bisect.bisect_left(borders, (True,))
    ids = np.array([b[1] for b in borders[:none]], np.int64)
    heads = [b[2] for b in borders]

    def number(page_id: pa.Array, head: pa.Array) -> pa.Array:
        missing = np.asarray(page_id.is_null())
        values = page_id.fill_null(0).to_numpy(zero_copy_only=False)
        low = np.where(missing, none, np.searchsorted(ids, values, "left"))
        high = np.where(missing, len(heads), np.searchsorted(ids, values, "right"))
        shard = low - 1
        for i in np.flatnonzero(low < high):
            shard[i] = bisect.bisect_right(heads, head[int(i)].as_py(), int(low[i]), int(high[i])) - 1
        return pa.array(shard, pa.int32())

    return number


def write_warc(pages: DataFrame, out: str, shard_bytes: int = 32 << 20, roll_bytes: int = 4 << 20,
               min_revisit_bytes: int = 0, level: int = 6, date: str = "1970-01-01T00:00:00Z",
               page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write all pages below the folder ``out`` (a URI); returns the committed manifest."""
    spark = pages.sparkSession
    src = pages.select(F.col(page_id).cast("long").alias("page_id"),
                       F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"),
                       F.coalesce(F.col(html).cast("string"), F.lit("")).alias("payload"))
    src = src.withColumn("key", F.sha2(F.col("payload").cast("binary"), 256))
    again = C.written(src.where(F.octet_length("payload") >= min_revisit_bytes).groupBy("key")
                      .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
                      .where("n > 1").select("key", "first_id", F.lit(True).alias("repeated")), "repeated")
    src = src.withColumn("head", F.conv(F.substring("key", 1, 15), 16, 10).cast("long"))
    borders = _borders(src, shard_bytes)
    if again.count() <= MAX_BROADCAST_ROWS:
        again = F.broadcast(again)
    number = F.arrow_udf(_shard_of(borders), "int")
    ready = (src.withColumn("shard", number("page_id", "head")).join(again, "key", "left")
             .repartitionById(max(1, len(borders)), F.col("shard"))
             .sortWithinPartitions("shard", F.col("page_id").asc_nulls_last(), "key", "url")
             .select("shard", "page_id", "url", "payload", "key", "first_id",
                     F.coalesce("repeated", F.lit(False)).alias("repeated")))
    names = [f.split()[0] for f in MANIFEST.split(", ")]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = file_system(out)
        fs.create_dir(posixpath.join(folder, "tmp"), recursive=True)
        file, last, copy, done = None, None, 0, []
        for batch in batches:
            for i, (shard_no, pid, key, first, repeated) in enumerate(zip(
                    *(batch.column(c).to_pylist() for c in (0, 1, 4, 5, 6)))):
                url_, payload = batch.column(2)[i].as_py(), batch.column(3)[i].as_buffer().to_pybytes()
                copy = copy + 1 if last == (shard_no, pid, key) else 0
                last = (shard_no, pid, key)
                revisit = repeated and not (pid == first and copy == 0)
                if file is None or file.shard != shard_no or file.bytes >= roll_bytes:
                    number = file.number + 1 if file and file.shard == shard_no else 0
                    if file:
                        done.append(file.close())
                    file = _File(fs, folder, shard_no, number)
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                data = record(pid, url_, payload, digest32(payload), copy, first, revisit, date)
                file.add(packer.compress(data) + packer.flush())
        if file:
            done.append(file.close())
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*done), (
                    pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()))], names)

    staged = C.written(ready.mapInArrow(write, C.take(MANIFEST)), "staged")

    def rename(batch: pa.RecordBatch) -> dict:
        from pyarrow import fs as pafs

        fs, folder = file_system(out)
        for temporary, name, size in zip(*(batch.column(c).to_pylist() for c in (2, 3, 5))):
            source, target = posixpath.join(folder, temporary), posixpath.join(folder, name)
            if fs.get_file_info(source).type == pafs.FileType.File:
                fs.move(source, target)
            found = fs.get_file_info(target)
            if found.type != pafs.FileType.File or found.size != size:
                raise OSError(f"{target} is missing or has not {size} bytes")
        return dict(zip(names, batch.columns))

    C.map_arrow(staged, rename, C.take(MANIFEST)).write.parquet(f"{out}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{out}/manifest")


def parse(data: bytes) -> tuple:
    """(page_id, url, type, payload or None, payload bytes, digest, refers_to) of a record; checks its digests."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n" or f"sha1:{digest32(block)}" != fields["WARC-Block-Digest"]:
        raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or digest32(payload) != digest):
        raise ValueError(f"damaged payload {fields['WARC-Record-ID']}")

    def page(urn):
        number = urn.split(":")[2]
        return int(number) if number else None

    return (page(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], fields["WARC-Type"],
            None if revisit else payload, size, digest, page(fields["WARC-Refers-To"]) if revisit else None)


def members(stream, size: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a stream, one after the other."""
    left = b""
    while True:
        unpack, out = zlib.decompressobj(31), []
        while not unpack.eof:
            data = left or stream.read(size)
            left = b""
            if not data:
                if out:
                    raise ValueError("the archive ends inside a record")
                return
            out.append(unpack.decompress(data))
        left = unpack.unused_data
        yield b"".join(out)


def read_warc(spark: SparkSession, out: str, with_payload: bool = True, batch_bytes: int = 4 << 20) -> DataFrame:
    """All records of the archives that the manifest of ``out`` lists."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{out}/manifest").select("name", "records")
    files = manifest.repartition(max(1, min(4096, manifest.count())), "name")
    schema = C.take(RECORDS)
    types = (pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = file_system(out)
        for batch in batches:
            for name, records in zip(*(c.to_pylist() for c in batch.columns)):
                rows, held, seen = [], 0, 0
                with fs.open_input_stream(posixpath.join(folder, name), compression=None) as stream:
                    for data in members(stream):
                        row = parse(data)
                        seen += 1
                        rows.append(row if with_payload else (*row[:3], None, *row[4:]))
                        held += len(data)
                        if held >= batch_bytes:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(list(c), t) for c, t in zip(zip(*rows), types)], schema.names)
                            rows, held = [], 0
                if seen != records:
                    raise ValueError(f"{name} has {seen} of {records} records")
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), t) for c, t in zip(zip(*rows), types)], schema.names)

    return files.mapInArrow(read, schema)
