"""Structured Streaming forms of the T-rows.

Every stateful stream has a watermark (event time = block timestamp) so its
state is evicted; checkpoints live under the session's
``spark.checkpoint.dir`` (a shared folder on a cluster), so a lost executor
or a restarted driver resumes from the last committed micro-batch.
Sources are Kafka on a cluster (``sources.decode.read_topic``) and file
streams in tests; the transformations are the same.
"""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from chainflow.operators import fanout as P
from chainflow.session import checkpoint_dir

WATERMARK = "10 minutes"


def stream_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the shared checkpoint directory."""
    return os.path.join(checkpoint_dir(spark), *parts)


def file_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """Parquet file stream (the test stand-in for a topic)."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def run_available_now(stream: DataFrame, sink: str, checkpoint: str, mode: str = "append",
                      fmt: str = "parquet", partition_by: list[str] | None = None):
    """Drain everything available, then stop (batch/stream equivalence runs)."""
    w = (stream.writeStream.format(fmt).option("path", sink)
         .option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start()
    q.awaitTermination()
    return q


def micro_batches(stream: DataFrame, fn, checkpoint: str, every: str = "5 seconds",
                  available_now: bool = False, mode: str = "append"):
    """Flush on a processing-time trigger; ``fn(batch_df, batch_id)`` per batch.

    The batch size is bounded on the source (``maxOffsetsPerTrigger`` for
    Kafka, ``maxFilesPerTrigger`` for files).
    """
    w = stream.writeStream.foreachBatch(fn).outputMode(mode).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=every)
    return w.start()


def with_event_time(df: DataFrame, ts: str = "blockTimestamp", watermark: str = WATERMARK) -> DataFrame:
    return df.withColumn("eventTime", F.timestamp_seconds(F.col(ts))).withWatermark("eventTime", watermark)


# --- T03-T07: windowed metrics ------------------------------------------------

def window_counts_stream(tx: DataFrame, size: str, slide: str | None = None) -> DataFrame:
    """Windowed activity per chain on a stream (append mode: a window is
    emitted once the watermark passes its end).

    Exact distinct counts are not supported on streaming aggregations; the
    stream form reports ``approx_count_distinct``, the batch form is exact.
    """
    t = with_event_time(tx)
    win = F.window("eventTime", size, slide) if slide else F.window("eventTime", size)
    return t.groupBy(win.alias("w"), "chainId").agg(
        F.count("*").alias("tx_count"),
        F.count_if(F.col("txStatus") == "1").alias("success_count"),
        F.approx_count_distinct("from").alias("active_senders_approx"),
    ).select("chainId", F.unix_seconds(F.col("w.start")).alias("window_start"),
             "tx_count", "success_count", "active_senders_approx")


def distinct_senders_stream(tx: DataFrame, size: str, slide: str | None = None) -> DataFrame:
    """Exact distinct senders per chain and window on a stream.

    Two chained stateful operators in append mode: (window, chain, sender)
    is deduplicated under the watermark, then counted per window.  Both
    states are evicted once the watermark passes the window end.
    """
    t = with_event_time(tx)
    win = F.window("eventTime", size, slide) if slide else F.window("eventTime", size)
    pairs = t.select(win.alias("w"), "chainId", "from").dropDuplicates(["w", "chainId", "from"])
    return pairs.groupBy("w", "chainId").agg(F.count("*").alias("active_senders")) \
        .select("chainId", F.unix_seconds(F.col("w.start")).alias("window_start"), "active_senders")


def cumulative_stream(tx: DataFrame) -> DataFrame:
    """T06 stream form: all-time running totals per chain in update mode.

    The state is one row per chain (bounded by the number of chains), so no
    watermark is needed; each trigger emits the chains that changed.
    """
    return tx.groupBy("chainId").agg(
        F.count("*").alias("total_txs"),
        F.sum(F.col("receiptGasUsed").try_cast("decimal(38,0)")).cast("string").alias("total_gas_used"),
        F.max("blockTimestamp").alias("last_ts"))


def first_seen_stream(tx: DataFrame) -> DataFrame:
    """A26 / W06 stream form: exact first appearance per (chain, address).

    A streaming ``min(ts)`` in update mode: a row is emitted when an address
    is new or seen earlier than before.  The state is one entry per address
    (RocksDB on a cluster), which is the size of the answer itself; running
    distinct counts are counts of first-seen times up to t.
    """
    parties = tx.select("chainId", F.col("blockTimestamp").alias("ts"),
                        F.explode(F.array("from", "to")).alias("address")) \
        .filter(F.col("address").isNotNull() & (F.col("address") != ""))
    return parties.groupBy("chainId", "address").agg(F.min("ts").alias("first_ts"))


# --- T01: re-emit suppression with state -------------------------------------

def suppress_recent_stream(sightings: DataFrame, keys: list[str], ts: str, interval_s: int,
                           tiebreak: list[str] | None = None, watermark: str = WATERMARK) -> DataFrame:
    """Streaming T01: per key, the last *emitted* time is the state.

    A state entry times out once the watermark passes ``last + interval``:
    any later sighting would be emitted anyway, so dropping it is exact and
    the state stays bounded (the reference's map is never evicted).
    """
    tiebreak = tiebreak or []
    cols = [*keys, ts, *tiebreak]
    out_schema = ", ".join(f"{c} {sightings.schema[c].dataType.simpleString()}" for c in cols)

    def fold(key, frames, state):
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get[0] if state.exists else None
        # a key's rows come in several frames: order them together
        rows = pd.concat([pdf[cols] for pdf in frames]).sort_values([ts, *tiebreak])
        times = rows[ts].to_numpy()
        at = 0 if last is None else int(np.searchsorted(times, last + interval_s))
        emitted = []
        while at < len(times):  # jump from one emitted sighting to the next
            emitted.append(at)
            last = int(times[at])
            at = int(np.searchsorted(times, last + interval_s))
        if last is not None:
            state.update((int(last),))
            state.setTimeoutTimestamp((int(last) + interval_s) * 1000)
        if emitted:
            yield rows.iloc[emitted]

    timed = sightings.withColumn("_et", F.timestamp_seconds(F.col(ts))).withWatermark("_et", watermark)
    return timed.groupBy(*keys).applyInPandasWithState(
        fold, out_schema, "last long", "append", GroupStateTimeout.EventTimeTimeout)


# --- T02: message dedup -----------------------------------------------------------

def dedup_stream(envelopes: DataFrame, key: str = "messageId", ts: str = "receivedAt",
                 watermark: str = WATERMARK) -> DataFrame:
    t = envelopes.withColumn("_et", F.timestamp_seconds(F.col(ts))).withWatermark("_et", watermark)
    return t.dropDuplicatesWithinWatermark([key]).drop("_et")


# --- T09 / T10: foreachBatch jobs ----------------------------------------------

def webhook_fanout_batch(sink: str):
    """One envelope batch -> six outputs, written per batch.

    The batch is persisted once and read six times; writes are idempotent per
    batch id (one folder per batch), so a retried batch replaces itself.
    """
    def run(batch: DataFrame, batch_id: int):
        batch.persist()
        try:
            outs = {
                "transactions": P.tx_rows(batch),
                "erc20": P.explode_children(batch, "erc20Transfers", tx_col="event.transaction"),
                "erc721": P.explode_children(batch, "erc721Transfers", tx_col="event.transaction"),
                "erc1155": P.explode_children(batch, "erc1155Transfers", tx_col="event.transaction"),
                "internal": P.explode_children(batch, "internalTransactions", tx_col="event.transaction"),
                "logs": P.explode_logs(batch),
            }
            for name, df in outs.items():
                df.write.mode("overwrite").parquet(os.path.join(sink, name, f"batch={batch_id}"))
        finally:
            batch.unpersist()
    return run


def dynamic_chains_batch(table: str, seed: list[str]):
    """Chain events extend the monitored chain table while running.

    Each batch writes its own chains (and the seed) to its own folder, so a
    retried batch replaces itself; the table is the distinct set of all folders.
    """
    def run(batch: DataFrame, batch_id: int):
        spark = batch.sparkSession
        new = batch.filter(F.col("event_type").startswith("chain.")).select("chainId")
        spark.createDataFrame([(c,) for c in seed], "chainId string").unionByName(new).distinct() \
            .write.mode("overwrite").parquet(f"{table.rstrip('/')}/v={batch_id}")
    return run


def latest_chain_table(spark: SparkSession, table: str):
    """All monitored chains so far; None before the first batch.  Read by Spark, from any store."""
    try:
        return spark.read.schema("chainId string, v bigint").parquet(table).select("chainId").distinct()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in (e.getCondition() or str(e)):
            raise
        return None


# --- T11 / T12: stream-static joins ----------------------------------------------

def heads_to_blocks_stream(frames: DataFrame, blocks: DataFrame) -> DataFrame:
    """Decoded head stream ⋈ static block table on hash, stamped with the
    stream's chain (J01 + P12).  Stream-static inner joins keep no state."""
    from chainflow.operators.lookups import heads_join_blocks
    from chainflow.sources import decode, feeds
    heads = decode.newheads_filter(decode.decode_newheads(frames)).select(
        "hash", F.substring("subscription", len(feeds.HEADS_SUBSCRIPTION) + 1, 64).alias("streamChain"))
    joined = heads_join_blocks(heads, blocks.select("blockHash", "blockNumber", "blockTimestamp"))
    return joined.select("hash", "blockNumber", "blockTimestamp", F.col("streamChain").alias("chainId"))


def heads_join_blocks_streams(heads: DataFrame, blocks: DataFrame, delay_s: int = 600,
                              watermark: str = WATERMARK) -> DataFrame:
    """J01 with both sides streaming: a head matches its block when the block
    arrives within ``delay_s`` seconds of the head (either order).

    Watermarks on both sides plus the event-time range bound the join state:
    rows older than watermark - delay are evicted.
    """
    h = heads.select("hash", F.timestamp_seconds("receivedAt").alias("headTime")) \
        .withWatermark("headTime", watermark)
    b = blocks.select("blockHash", "blockNumber", "chainId",
                      F.timestamp_seconds("blockTimestamp").alias("blockTime")) \
        .withWatermark("blockTime", watermark)
    cond = ((h["hash"] == b["blockHash"])
            & (b["blockTime"] >= h["headTime"] - F.expr(f"INTERVAL {delay_s} SECONDS"))
            & (b["blockTime"] <= h["headTime"] + F.expr(f"INTERVAL {delay_s} SECONDS")))
    return h.join(b, cond, "inner").select("hash", "blockNumber", "chainId")


def observe_counters(stream: DataFrame, name: str = "ingest") -> DataFrame:
    """A36/A37 on a stream: processed / error / invalid-signature counters and
    the last event time, reported per micro-batch in
    ``query.lastProgress["observedMetrics"]`` without an extra pass."""
    cols = stream.columns
    metrics = [F.count(F.lit(1)).alias("messages")]
    if "is_corrupt" in cols:
        metrics += [F.count_if(~F.col("is_corrupt")).alias("processed"),
                    F.count_if(F.col("is_corrupt")).alias("errors")]
    if "signature_valid" in cols:
        metrics.append(F.count_if(~F.col("signature_valid")).alias("invalid_sigs"))
    if "eventTime" in cols:
        metrics.append(F.max("eventTime").alias("last_event_time"))
    return stream.observe(name, *metrics)


def resubscribe_stream(subscriptions: DataFrame) -> DataFrame:
    """T13 on a stream: the latest subscription per client (update mode)."""
    return subscriptions.groupBy("clientId").agg(
        F.max_by(F.struct("subTopic", "subChain"), "subTime").alias("s")) \
        .select("clientId", "s.subTopic", "s.subChain")


def live_fanout_stream(messages: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Topic stream -> arity filter -> stamp -> envelope -> match against the subscriptions
    (static side), each message by the one that a client had at its time (T13)."""
    from chainflow.operators import filters
    from chainflow.operators.lookups import fanout_subscriptions, subscription_periods
    msgs = P.stamp_live(filters.topic_arity_filter(messages), F.col("eventTime"))
    sent = P.live_envelope(msgs, data_col="value").select("offset", "type", "chainId", "eventTime", "envelope")
    return fanout_subscriptions(sent, subscription_periods(subscriptions), time_col="eventTime") \
        .select("clientId", "offset", "envelope")
