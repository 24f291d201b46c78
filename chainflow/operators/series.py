"""The 15 metric series at four grains (S14), from one hourly rollup whose distinct counts merge exactly.

Addresses get dense numbers within their chain, in order of their first appearance, so that
addresses that are active at the same time lie close together.  An hour keeps, besides its sums and peaks, bitmaps of the
numbers of its parties and senders, in buckets of 32,768 (``bitmap_construct_agg``).  A day, week or month is the sum of its hours and the
union of their bitmaps (``bitmap_or_agg``); no transaction is read again, and no count is approximate.

Every group is (chain, hour) or smaller; windows run over rows of hours or grains, whose number is bounded by the time span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainflow.functions import scalar as C
from chainflow.operators import metrics as M

#: The names of the series, and the grains.
SERIES = ("activeAddresses", "activeSenders", "txCount", "cumulativeAddresses", "cumulativeTxCount", "cumulativeContracts",
          "cumulativeDeployers", "gasUsed", "avgGps", "maxGps", "avgTps", "maxTps", "avgGasPrice", "maxGasPrice", "feesPaid")
GRAINS = ("hour", "day", "week", "month")

HOUR = 3600
_KEY = ["chainId", "hour"]


def _hour(ts: str = "ts") -> Column:
    return M.pane_of(ts, HOUR).alias("hour")


def number_addresses(feat: DataFrame) -> DataFrame:
    """(chainId, item, first_ts, code): a dense number for each address of a chain, by first appearance.

    The running number is segmented: rows are ranked within (chain, hour of first appearance), and
    hours are added up per chain.
    """
    first = M.first_seen(feat)
    hour = M.pane_of("first_ts", HOUR)
    within = Window.partitionBy("chainId", "_h").orderBy("first_ts", "item")
    before = Window.partitionBy("chainId").orderBy("_h").rowsBetween(Window.unboundedPreceding, -1)
    starts = first.groupBy("chainId", hour.alias("_h")).agg(F.count("*").alias("_n")).select(
        "chainId", "_h", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    ranked = first.withColumn("_h", hour).withColumn("_r", F.row_number().over(within))
    return ranked.join(starts, ["chainId", "_h"]).select(
        "chainId", "item", "first_ts", (F.col("_start") + F.col("_r")).cast("long").alias("code"))


def address_bitmaps(feat: DataFrame, codes: DataFrame) -> DataFrame:
    """(chainId, hour, role, bucket, bits): the addresses of each hour, a = any party, s = sender."""
    seen = M._roles(feat, ("a", "s")).select("chainId", _hour(), "role", "item").distinct()
    coded = seen.join(codes.select("chainId", "item", "code"), ["chainId", "item"])
    return coded.groupBy(*_KEY, "role", F.bitmap_bucket_number("code").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("code")).alias("bits"))


def hourly_totals(tx: DataFrame, blocks: DataFrame, codes: DataFrame) -> DataFrame:
    """Additive measures and peaks of each (chain, hour); a side without rows in the hour is null there."""
    feat = M.tx_features(tx)
    seconds = feat.groupBy("chainId", "ts").agg(
        F.count("*").alias("n"), F.sum("gasUsed").alias("g"), F.sum("gasPrice").alias("sp"),
        F.count("gasPrice").alias("np"), F.max("gasPrice").alias("mp"))
    of_tx = seconds.groupBy("chainId", _hour()).agg(
        F.sum("n").alias("n"), F.sum("g").alias("g"), F.max("n").alias("mn"), F.max("g").alias("mg"),
        F.sum("sp").alias("sp"), F.sum("np").alias("np"), F.max("mp").alias("mp"))
    of_blocks = M.block_typed(blocks).groupBy("chainId", _hour()).agg(
        F.sum("gasUsed").alias("gu"), F.sum("feesSpent").alias("fs"))
    created = feat.filter(F.col("ok") & (F.coalesce(F.col("to"), F.lit("")) == ""))
    deployers = created.groupBy("chainId", "from").agg(F.min("ts").alias("ts"))
    news = (codes.select("chainId", F.col("first_ts").alias("ts"), F.lit("a").alias("what"))
            .unionByName(created.select("chainId", "ts", F.lit("k").alias("what")))
            .unionByName(deployers.select("chainId", "ts", F.lit("d").alias("what")))
            .groupBy("chainId", _hour()).agg(*(F.count_if(F.col("what") == w).alias(f"n{w}") for w in "akd")))
    return of_tx.join(of_blocks, _KEY, "full").join(news, _KEY, "full")


def grain_start(hour: Column, grain: str) -> Column:
    """Start of the hour, day, week (from Monday) or month of a Unix time, UTC."""
    return C.ts_to_epoch(C.interval_trunc(C.epoch_to_ts(hour), grain))


def grain_seconds(start: Column, grain: str) -> Column:
    if grain == "month":
        first = C.epoch_to_ts(start)
        return C.ts_to_epoch(F.add_months(first.cast("date"), 1).cast("timestamp")) - start
    return F.lit({"hour": HOUR, "day": 24 * HOUR, "week": 168 * HOUR}[grain])


def _at_grains(rows: DataFrame, grains: tuple[str, ...]) -> DataFrame:
    """Each row of an hour once per grain, with ``interval`` and ``timestamp``, the grain's start."""
    starts = F.array(*(F.struct(F.lit(g).alias("interval"), grain_start(F.col("hour"), g).alias("timestamp")) for g in grains))
    return rows.select("*", F.inline(starts)).drop("hour")


def metric_series(tx: DataFrame, blocks: DataFrame, grains: tuple[str, ...] = GRAINS) -> DataFrame:
    """All series: chainId, timestamp, interval, metric, value.  A point without rows of its kind is left out.

    One plan for all grains: the hours' rows are dealt to the grains, so the hourly rollup is in it once.
    """
    feat = M.tx_features(tx)
    codes = number_addresses(feat)
    totals, bits = hourly_totals(tx, blocks, codes), address_bitmaps(feat, codes)
    key = ["chainId", "interval", "timestamp"]
    added = _at_grains(totals, grains).groupBy(*key).agg(
        *(F.sum(c).alias(c) for c in ("n", "g", "sp", "np", "gu", "fs", "na", "nk", "nd")),
        *(F.max(c).alias(c) for c in ("mn", "mg", "mp")))
    sets = (_at_grains(bits, grains).groupBy(*key, "role", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
            .groupBy(*key).agg(*(F.sum(F.when(F.col("role") == r, F.col("n"))).alias(f"set_{r}") for r in "as")))
    running = Window.partitionBy("chainId", "interval").orderBy("timestamp").rowsBetween(Window.unboundedPreceding, 0)
    seconds = F.coalesce(*(F.when(F.col("interval") == g, grain_seconds(F.col("timestamp"), g)) for g in grains))

    def total(c):
        return F.sum(F.coalesce(c, F.lit(0))).over(running)

    value = {
        "activeAddresses": F.col("set_a"), "activeSenders": F.col("set_s"), "txCount": F.col("n"),
        "cumulativeAddresses": total("na"), "cumulativeTxCount": total("n"), "cumulativeContracts": total("nk"),
        "cumulativeDeployers": total("nd"), "gasUsed": F.col("gu"), "avgGps": M._ratio(F.col("g"), seconds), "maxGps": F.col("mg"),
        "avgTps": M._ratio(F.col("n"), seconds), "maxTps": F.col("mn"), "avgGasPrice": M._ratio(F.col("sp"), F.col("np")),
        "maxGasPrice": F.col("mp"), "feesPaid": F.col("fs")}
    return (added.join(sets, key, "left")
            .select(*key, *(value[m].cast("double").alias(m) for m in SERIES))
            .unpivot(key, list(SERIES), "metric", "value").filter(F.col("value").isNotNull())
            .select("chainId", "timestamp", "interval", "metric", "value"))


def in_range(series: DataFrame, start: int = 0, end: int = 0) -> DataFrame:
    """Points from ``start`` to ``end`` (both included); 0 leaves a side open."""
    if start > 0:
        series = series.filter(F.col("timestamp") >= start)
    if end > 0:
        series = series.filter(F.col("timestamp") <= end)
    return series


def paged(series: DataFrame, page_size: int) -> DataFrame:
    """``series`` with the number of the page, from 0, that each point is on: ascending in time, each series by itself."""
    order = Window.partitionBy("chainId", "metric", "interval").orderBy("timestamp")
    return series.withColumn("page", F.floor((F.row_number().over(order) - 1) / page_size).cast("long"))


def page(series: DataFrame, chain: str, metric: str, interval: str, page_size: int, token: int | None = None,
         start: int = 0, end: int = 0) -> tuple[list, int | None]:
    """One page of one series after ``token``, and the token of the next page (None: there is none)."""
    points = in_range(series, start, end).filter(
        (F.col("chainId") == chain) & (F.col("metric") == metric) & (F.col("interval") == interval))
    if token is not None:
        points = points.filter(F.col("timestamp") > token)
    rows = points.select("timestamp", "value").orderBy("timestamp").limit(page_size + 1).collect()
    return rows[:page_size], rows[page_size - 1]["timestamp"] if len(rows) > page_size else None
