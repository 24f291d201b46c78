"""Helpers shared by the operators: shared folders, slim Arrow maps, table reads."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .kernels import slices, worker_cache

#: Bytes of an Arrow batch on its way to a Python worker; Spark's own 64 MB, a core each, are most of an executor's free memory.
BATCH_BYTES = 4 << 20


def slim_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, unless the cluster's settings name their size."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Where it is unset a local session gets one of its own; on a cluster that is
    an error, because a machine-local folder would not be seen by others.
    """
    slim_batches(spark)
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        path = "file://" + tempfile.mkdtemp(prefix="chainflow-llm-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one."""
    return scratch_below(shared_dir(spark), name)


def scratch_below(path: str, name: str) -> str:
    """A new folder below ``path``."""
    return f"{path.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Removes a query's shuffle files when it ends; otherwise they stay until the driver's garbage collector finds their plan.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: For ``written``, where a value is about a MiB: Parquet else looks at a page's size after 100 rows, and all of a page is held beside Spark's heap.
LONG_VALUES = {"parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1}


def written(df: DataFrame, name: str, options: dict | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` below the shared folder and read it again.

    The shuffle files of the write go when it has ended: what is written needs them no more, and the disk holds those of one step only.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.options(**(options or {})).parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


class Shared:
    """A broadcast object of this subpackage's classes, for executors without a copy of the repository.

    The caller sees to its size.  A worker unpacks it once and keeps the last one only.
    """

    def __init__(self, spark: SparkSession, value):
        self.key = uuid.uuid4().hex
        self.packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        cache = worker_cache()
        if cache.get("shared", ("",))[0] != self.key:
            cache["shared"] = (self.key, pickle.loads(self.packed.value))
        return cache["shared"][1]


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], dict | None], schema: T.StructType) -> DataFrame:
    """``mapInArrow`` with a function from one batch to named columns (None: no rows)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    slim_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cols = fn(batch)
                if cols is not None:
                    yield pa.RecordBatch.from_arrays(
                        [c if isinstance(c := cols[f.name], pa.Array) and c.type == f.type
                         else pa.array(c, f.type, from_pandas=False) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def map_slices(df: DataFrame, text: str, fn: Callable[[pa.RecordBatch], dict | None], schema: T.StructType) -> DataFrame:
    """``map_arrow`` over slices of batches that hold about ``CHUNK_BYTES`` of column ``text``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    slim_batches(df.sparkSession)
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, rows, _, _ in slices(batch.column(at)):
                cols = fn(batch.slice(lo, rows))
                if cols is not None:
                    yield pa.RecordBatch.from_arrays(
                        [c if isinstance(c := cols[f.name], pa.Array) and c.type == f.type
                         else pa.array(c, f.type, from_pandas=False) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def take(schema: str) -> T.StructType:
    return T._parse_datatype_string(schema)


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop input columns whose names an operator is about to produce (any case)."""
    clash = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in clash])


def attach(rows: DataFrame, table: DataFrame, key: str, copies: str, most: int = 50_000) -> DataFrame:
    """``rows`` with the other columns of ``table``, which has each key of ``rows`` once and its number of rows, ``copies``.

    Keys that hold more than one in ``most`` of all rows are fewer than ``most``; they are broadcast.  The others are shuffled,
    and none of them can fill a task.
    """
    total = table.agg(F.sum(copies)).first()[0] or 0
    hot = F.col(copies) > max(100, total // most)
    columns = [*rows.columns, *(c for c in table.columns if c not in (key, copies))]
    heavy = F.broadcast(table.where(hot).drop(copies))
    light = table.where(~hot).drop(copies)
    return (rows.join(heavy, key).select(*columns)
            .unionByName(rows.join(heavy, key, "left_anti").join(light, key).select(*columns)))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def crc_fold(column: str, parts: int):
    """crc32 of the id as text, modulo ``parts``: the fold that held-out rows are told by."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(parts))
