"""Stored blocks that ranges of numbers and times reach as pushed predicates.

Layout below a folder: ``blocks`` holds the rows in day partitions, written from ranges of
(day, number), so that a busy day is spread over files and a file's row groups have
narrow bounds of ``number`` and ``blockTimestamp``; ``days`` has one row per day with
the lowest and highest number in it; ``schema`` holds no rows.

A read by number asks ``days`` for the first and last day that can hold it, then filters
day and number: other days are not listed, other row groups not read.  A read by
time derives its days from the bounds.  Late blocks only widen the bounds of their day.

Defined cases: rows without a whole block number or a time go to the partition of null
days (numbers that are null match no range, and a read without bounds returns them);
a bound that is None or not positive is open; an empty table is stored as such.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = 86_400
ROW_GROUP_BYTES = 16 << 20


def write_blocks(blocks: DataFrame, path: str, files: int | None = None) -> None:
    """Store ``blocks`` with a numeric ``number``; ``files`` is the number of write tasks."""
    rows = (blocks.withColumn("number", F.expr("try_cast(blockNumber AS bigint)"))
            .withColumn("day", F.floor(F.col("blockTimestamp") / DAY).cast("int")))
    dealt = rows.repartitionByRange(files, "day", "number") if files else rows.repartitionByRange("day", "number")
    (dealt.sortWithinPartitions("day", "number").write.partitionBy("day")
     .option("parquet.block.size", ROW_GROUP_BYTES).parquet(f"{path}/blocks"))
    rows.where("false").write.parquet(f"{path}/schema")
    (_stored(blocks.sparkSession, path).where("number IS NOT NULL").groupBy("day").agg(F.min("number").alias("low"), F.max("number").alias("high"))
     .coalesce(1).write.parquet(f"{path}/days"))


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(spark.read.parquet(f"{path}/schema").schema).parquet(f"{path}/blocks")


def read_numbers(spark: SparkSession, path: str, start: int | None = None, end: int | None = None) -> DataFrame:
    """Stored blocks with ``start <= number <= end`` (F07); a null or non-positive bound is open."""
    low, high = (b if b and b > 0 else None for b in (start, end))
    rows, days = _stored(spark, path), spark.read.parquet(f"{path}/days")
    if low is None and high is None:
        return rows
    number, held = F.lit(True), F.lit(True)
    if low is not None:
        number, held = number & (F.col("number") >= low), held & (F.col("high") >= low)
    if high is not None:
        number, held = number & (F.col("number") <= high), held & (F.col("low") <= high)
    found = days.where(held)
    first, last = found.agg(F.min("day"), F.max("day")).first()
    if first is None and found.where("day IS NULL").isEmpty():
        return rows.where("false")
    inside = F.col("day").between(first, last) if first is not None else F.lit(False)
    if not found.where("day IS NULL").isEmpty():
        inside = inside | F.col("day").isNull()
    return rows.where(inside & number)


def read_times(spark: SparkSession, path: str, start: int | None = None, end: int | None = None) -> DataFrame:
    """Stored blocks with ``start <= blockTimestamp < end`` (F06); a null or non-positive bound is open."""
    rows = _stored(spark, path)
    if start is not None and start > 0:
        rows = rows.where((F.col("day") >= start // DAY) & (F.col("blockTimestamp") >= start))
    if end is not None and end > 0:
        rows = rows.where((F.col("day") <= (end - 1) // DAY) & (F.col("blockTimestamp") < end))
    return rows
