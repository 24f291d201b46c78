"""An hourly rollup kept as a table, in partitions of days.

Hours that got new rows are computed again and replace their old rows; other hours of the same day are carried over, and
other days are not touched (dynamic partition overwrite).  A collection of the last 86,400 seconds reads the two
day partitions that they can lie in, however long the history is.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = 86400


def day_of(ts):
    return F.floor(ts / DAY).cast("long")


def read_hours(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """All stored hours; None before the first update."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in (e.getCondition() or str(e)):
            raise
        return None


def update_hours(hours: DataFrame, path: str) -> None:
    """Store ``hours`` (chainId, window_start, measures) in place of the same (chain, hour) rows.

    One writer at a time; a failed update leaves whole old or whole new days.
    """
    spark = hours.sparkSession
    new = hours.withColumn("day", day_of(F.col("window_start")))
    stored = read_hours(spark, path, new.schema)
    if stored is not None:
        touched = new.select("day").distinct()
        kept = (stored.join(touched, "day", "left_semi")
                .join(new.select("chainId", "window_start"), ["chainId", "window_start"], "left_anti"))
        new = new.unionByName(kept)
    (new.repartition("day").sortWithinPartitions("chainId", "window_start").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path))


def hours_between(stored: DataFrame, start: int, end: int) -> DataFrame:
    """Hours from ``start`` to ``end`` (both included), from the day partitions in between."""
    return stored.filter(F.col("day").between(start // DAY, end // DAY) & F.col("window_start").between(start, end)).drop("day")


def last_day(stored: DataFrame, end: int) -> DataFrame:
    """The hours of the 86,400 seconds up to ``end``."""
    return hours_between(stored, end - DAY, end)
